"""Keyed tables that an update rewrites in part.

A keyed table is a Parquet folder partitioned by a hash bucket of its key. An update finds the
buckets that its rows fall into, merges only those, and replaces only their folders; the files of
all other buckets stay as they are. So the work of an update grows with the update and the buckets
it touches, not with the table.

An update is staged in full beside the table before anything is replaced. If the job is lost while
buckets are being replaced, the next ``update`` (or ``recover``) first replaces them again from the
stage, which leads to the same table; readers see the table without the update, or with it.

Defined results: of rows with one key the last in load order stays; rows of an update win over rows
of the table; NULL is a key value like any other; an empty update changes nothing; the columns and
their types must be those of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pidlink.operators.flatten import keep_last

#: The bucket column's name tells the number of buckets: ``_bucket_of_64``.
_PREFIX = "_bucket_of_"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.column = f"{_PREFIX}{buckets}"
        self.stage = f"{path.rstrip('/')}__staged"

    # ---------------------------------------------------------------- making and opening

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64) -> KeyedTable:
        """A new table of the last row of every key; an error if there is one already."""
        table = cls(rows.sparkSession, path, keys, buckets)
        last = keep_last(rows, table.keys, list(order))
        table._spread(last).write.mode("errorifexists").partitionBy(table.column).parquet(path)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str, keys: Sequence[str]) -> KeyedTable:
        found = [c for c in spark.read.parquet(path).columns if c.startswith(_PREFIX)]
        if not found:
            raise ValueError(f"no keyed table: {path}")
        return cls(spark, path, keys, int(found[0].removeprefix(_PREFIX)))

    # ---------------------------------------------------------------- reading

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(self.column)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Rows whose key is in ``wanted`` (the key columns); only the buckets of those keys are read."""
        keys = wanted.select(*self.keys, self._bucket().alias(self.column)).distinct()
        rows = self._in(self._stored(), self._touched(keys))
        return rows.join(keys, self._same(rows, keys), "left_semi").drop(self.column)

    # ---------------------------------------------------------------- updating

    def update(self, rows: DataFrame, order: Sequence[str]) -> list[int]:
        """Merge ``rows`` in; returns the buckets that were rewritten."""
        self.recover()
        stored = self._stored()
        columns = [c for c in stored.columns if c != self.column]
        incoming = f"{self.stage}_incoming"
        last = keep_last(rows.select(*columns, *(c for c in order if c not in columns)), self.keys, list(order)).select(*columns)
        last.withColumn(self.column, self._bucket()).write.mode("overwrite").parquet(incoming)
        new = self.spark.read.parquet(incoming)
        touched = self._touched(new)
        if touched:
            old = self._in(stored, touched)
            merged = old.join(new, self._same(old, new), "left_anti").select(*columns).unionByName(new.select(*columns))
            self._spread(merged).write.mode("overwrite").partitionBy(self.column).parquet(self.stage)
            self.recover()
        self._delete(incoming)
        return touched

    def recover(self) -> bool:
        """Replace the buckets of a complete stage, if there is one; whether there was."""
        if not self._exists(f"{self.stage}/_SUCCESS"):
            self._delete(self.stage)  # an update that was lost before it was staged
            return False
        staged = self.spark.read.parquet(self.stage)
        staged = staged.repartition(self.buckets, self.column).sortWithinPartitions(self.column, *self.keys)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.column).parquet(self.path)
        self._delete(self.stage)
        return True

    # ---------------------------------------------------------------- helpers

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Rows by bucket, sorted by key inside a file (row groups then have narrow key ranges)."""
        return (rows.withColumn(self.column, self._bucket()).repartition(self.buckets, self.column)
                .sortWithinPartitions(self.column, *self.keys))

    def _touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self.column).distinct().collect())  # at most ``buckets`` numbers

    def _in(self, rows: DataFrame, touched: list[int]) -> DataFrame:
        return rows.where(F.col(self.column).isin(touched))

    def _same(self, a: DataFrame, b: DataFrame) -> Column:
        return reduce(Column.__and__, (a[k].eqNullSafe(b[k]) for k in self.keys))

    def _file_system(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        p, fs = self._file_system(path)
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        p, fs = self._file_system(path)
        fs.delete(p, True)
