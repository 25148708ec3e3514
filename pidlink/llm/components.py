"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round replaces the edges by edges to smaller neighbours; after O(log n) rounds every
node points at the smallest node of its component. Edges are pre-aggregated to one minimum
per node, and the minimum is joined back many-to-one (a join that Spark can split at a hot
node); no task holds the neighbours of a node together. Each round's edges are written to the
shared folder, so that lineage stays short; the driver sees one count and one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pidlink.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): the smallest node of the component of every node that has an
    edge and is not itself a root. Repeated edges and edges of a node to itself are allowed;
    an empty table gives an empty table."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = None
    while True:
        e = stored(_small_star(_large_star(e).where("u > v").distinct()).distinct(), "star")
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
