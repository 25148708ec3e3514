"""Provenance of the records that found no counterpart: which data source did they come from?

Inputs are the JSON-LD graphs of the Meta RDF dump: provenance graphs (snapshots with
``prov#hadPrimarySource`` / ``prov#specializationOf``) and bibliographic-resource nodes
(``@id``, ``@type``, ``datacite/hasIdentifier``). Per-graph work is done with
higher-order functions on the graph's own array (no shuffle); the union of sources per
resource is a pre-aggregated (distinct) group by; everything else is joins and group-bys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.functions import constants as K
from pidlink.functions import strip_prefix

GRAPH = "@graph"


def _ids(arr: Column) -> Column:
    """``[{'@id': x}, ...]`` -> ``[x, ...]`` (NULL list -> empty)."""
    return F.transform(F.coalesce(arr, F.array()), lambda o: o.getField("@id"))


def _has_source(g: Column) -> Column:
    """Whether a graph names a primary source (false, not NULL, without any snapshot)."""
    return F.coalesce(F.exists(g, lambda s: F.exists(F.coalesce(s.getField(K.PROV_PRIMARY_SOURCE), F.array()),
                                                     lambda o: o.getField("@id").isNotNull())), F.lit(False))


def _described_resource(g: Column) -> Column:
    """The resource that the first describing snapshot names; NULL without one."""
    described = F.filter(g, lambda s: F.size(F.coalesce(s.getField(K.PROV_SPECIALIZATION_OF), F.array())) > 0)
    return F.try_element_at(F.try_element_at(described, F.lit(1)).getField(K.PROV_SPECIALIZATION_OF), F.lit(1)).getField("@id")


def graph_provenance(graphs: DataFrame) -> DataFrame:
    """Per provenance graph: (br_uri, sources array). Graphs with no primary source, or no
    snapshot saying which resource they describe, are dropped (see ``dropped_graphs``)."""
    g = F.col(GRAPH)
    sources = F.array_distinct(F.filter(
        F.flatten(F.transform(g, lambda s: _ids(s.getField(K.PROV_PRIMARY_SOURCE)))), lambda x: x.isNotNull()))
    # Filter on a cheap existence test first: a filter written on the built arrays would be
    # pushed below the projection and build them twice.
    return (
        graphs.where(_has_source(g))
        .select(_described_resource(g).alias("br_uri"), sources.alias("sources"))
        .where(F.col("br_uri").isNotNull())
    )


def _per_graph(graphs: DataFrame) -> DataFrame:
    """``graph_provenance``, unless that is what is given."""
    return graphs if "br_uri" in graphs.columns else graph_provenance(graphs)


def dropped_graphs(graphs: DataFrame) -> DataFrame:
    """Exactly the graphs that ``graph_provenance`` leaves out: without a source id or without the
    id of a described resource, lists of objects without ids and graphs without snapshots included."""
    g = F.col(GRAPH)
    return graphs.where(~(_has_source(g) & _described_resource(g).isNotNull()))


def provenance_table(graphs: DataFrame) -> DataFrame:
    """br_uri -> sorted distinct sources over all its graphs (several graphs: union).

    The (br, source) pairs are de-duplicated map-side before the shuffle, so a resource
    with very many graphs is combined per task and its final group holds distinct sources only.
    """
    pairs = _per_graph(graphs).select("br_uri", F.explode("sources").alias("source")).distinct()
    return pairs.groupBy("br_uri").agg(F.array_sort(F.collect_set("source")).alias("sources"))


#: Sources of a mask word, and the most sources that masks are made for (more: ``provenance_table``).
WORD_BITS = 62
MAX_MASK_SOURCES = 64 * WORD_BITS


def source_names(graphs: DataFrame, most: int = MAX_MASK_SOURCES) -> list[str] | None:
    """The dictionary of sources, sorted; None if there are more than ``most``."""
    names = _per_graph(graphs).select(F.explode("sources").alias("source")).distinct().limit(most + 1).collect()
    return sorted(r.source for r in names) if len(names) <= most else None


def _words(names: list[str]) -> list[str]:
    return [f"_w{i}" for i in range(max(1, -(-len(names) // WORD_BITS)))]


def provenance_masks(graphs: DataFrame, names: list[str]) -> DataFrame:
    """br_uri -> its sources as bits of long words (_w0, _w1, ...), by the place of a source in
    ``names``. A graph's mask is made in its own row; masks are united by a partial aggregate of
    longs, so a shuffle holds one row per resource and task, and no source text."""
    known = F.array(*map(F.lit, names)).cast("array<string>")

    def word(i: int) -> Column:
        def added(mask: Column, source: Column) -> Column:
            at = F.array_position(known, source).cast("int") - 1 - i * WORD_BITS
            return F.when((at >= 0) & (at < WORD_BITS), mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))).otherwise(mask)

        return F.aggregate("sources", F.lit(0).cast("long"), added)

    words = _words(names)
    rows = _per_graph(graphs).select("br_uri", *(word(i).alias(w) for i, w in enumerate(words)))
    return rows.groupBy("br_uri").agg(*(F.bit_or(w).alias(w) for w in words))


def mask_label(names: list[str]) -> Column:
    """The sources of a mask, sorted and joined by blanks."""
    words = F.array(*map(F.col, _words(names)))

    def there(_: Column, i: Column) -> Column:
        word = F.get(words, F.floor(i / WORD_BITS).cast("int"))
        return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (i % WORD_BITS).cast("int"))) != 0

    return F.array_join(F.filter(F.array(*map(F.lit, names)).cast("array<string>"), there), " ")


def processed_omids(primary_entities: DataFrame, parts: int | None = None) -> DataFrame:
    """OMID set of the records the mapping processed; with ``parts``, dealt to so many partitions. A join with
    it then has so many tasks, also where Spark joins each part of a union with the whole set."""
    omids = primary_entities.select("omid")
    return (omids if parts is None else omids.repartition(parts, "omid")).distinct()


def type_label(types: Column) -> Column:
    """First ``@type`` that is not fabio:Expression, through the URI table; an unknown URI
    is kept as is; none -> ''."""
    first = F.try_element_at(F.filter(F.coalesce(types, F.array()), lambda t: t != K.FABIO_EXPRESSION), F.lit(1))
    table = F.create_map(*[F.lit(x) for kv in K.URI_TYPE_LABELS.items() for x in kv])
    label = table[first]
    return F.when(first.isNull(), F.lit("")).when(label.isNull() | (label == ""), first).otherwise(label)


def extra_records(br_nodes: DataFrame, omids: DataFrame) -> DataFrame:
    """RDF records missing from the processed OMID set: omid, type, omid_only.

    ``omid_only`` is true when the node has no ``datacite:hasIdentifier``.
    """
    lookup = F.regexp_replace(F.col("@id"), K.META_URI.replace(".", r"\."), "omid:")
    nodes = br_nodes.select(
        lookup.alias("_lookup"),
        F.concat(F.lit("omid:"), strip_prefix(F.col("@id"), K.META_URI)).alias("omid"),
        type_label(F.col("@type")).alias("type"),
        (F.size(F.coalesce(F.col(f"`{K.DATACITE_HAS_IDENTIFIER}`"), F.array())) == 0).alias("omid_only"),
    )
    return (
        nodes.join(omids.select(F.col("omid").alias("_lookup")), "_lookup", "left_anti")
        .select("omid", "type", "omid_only")
    )


def records_to_trace(extra: DataFrame, unmapped: DataFrame) -> DataFrame:
    """Extra records plus the unmapped ones (which carry no ``omid_only``)."""
    u = unmapped.select("omid", F.coalesce(F.col("type"), F.lit("")).alias("type"))
    return extra.select("omid", "type", "omid_only").unionByName(u, allowMissingColumns=True)


def _br_uri(omid: Column) -> Column:
    return F.regexp_replace(omid, "omid:", K.META_URI)


def with_sources(records: DataFrame, prov: DataFrame) -> DataFrame:
    """Records that have provenance, with the label of their sources (sorted, blank-joined)."""
    p = prov.select("br_uri", F.array_join("sources", " ").alias("source"))
    return records.withColumn("br_uri", _br_uri(F.col("omid"))).join(p, "br_uri", "inner").drop("br_uri")


def missing_provenance(records: DataFrame, prov: DataFrame) -> DataFrame:
    """Records with no provenance at all (reported, not counted)."""
    return (
        records.withColumn("br_uri", _br_uri(F.col("omid")))
        .join(prov.select("br_uri"), "br_uri", "left_anti")
        .select("omid", "type")
    )


def _counters() -> list[Column]:
    flag = F.coalesce(F.col("omid_only"), F.lit(False))
    return [F.count(F.when(flag, True)).cast("bigint").alias("omid_only"), F.count(F.when(~flag, True)).cast("bigint").alias("other_pids")]


def _with_totals(counts: DataFrame) -> DataFrame:
    """Totals of a row and of its type, ordered. The totals of types are a partial aggregate that is
    joined back, so no task holds all rows of a type; the order is a range-partitioned sort."""
    counts = counts.withColumn("total", F.col("omid_only") + F.col("other_pids"))
    types = counts.groupBy(F.col("type").alias("_type")).agg(F.sum("total").alias("type_total"))
    return (
        counts.join(types, counts["type"].eqNullSafe(types["_type"])).select(*counts.columns, "type_total")
        .orderBy(F.col("type_total").desc(), F.col("type"), F.col("total").desc(), F.col("source"))
    )


def provenance_counts(records: DataFrame, prov: DataFrame) -> DataFrame:
    """type, source, omid_only, other_pids, and the totals used for ordering.

    Sources by total descending inside a type, types by total descending.
    """
    return _with_totals(with_sources(records, prov).groupBy("type", "source").agg(*_counters()))


def provenance_counts_by_mask(records: DataFrame, masks: DataFrame, names: list[str]) -> DataFrame:
    """As ``provenance_counts``, from ``provenance_masks``: records are counted by type and mask, and a
    mask becomes its label once per counted group."""
    found = records.withColumn("br_uri", _br_uri(F.col("omid"))).join(masks, "br_uri")
    counted = found.groupBy("type", *_words(names)).agg(*_counters())
    return _with_totals(counted.select("type", mask_label(names).alias("source"), "omid_only", "other_pids"))


def provenance_by_type(counts: DataFrame) -> DataFrame:
    """Unmapped per type: omid_only and other_pids sums, total; '' shown as Unspecified."""
    t = F.when(F.col("type") == "", "Unspecified").otherwise(F.col("type"))
    return counts.groupBy(t.alias("type")).agg(
        F.sum("omid_only").cast("bigint").alias("omid_only_sum"),
        F.sum("other_pids").cast("bigint").alias("other_pids_sum"),
        F.sum(F.col("omid_only") + F.col("other_pids")).cast("bigint").alias("n_records"),
    )


UNSPECIFIED = "Unspecified"
OTHER = "other"


def pivot_types() -> list[str]:
    """The named type labels, and Unspecified: the default columns of the pivot."""
    return [*sorted({x for x in K.URI_TYPE_LABELS.values() if x}), UNSPECIFIED]


def provenance_pivot(counts: DataFrame, types: list[str] | None = None) -> DataFrame:
    """source x type, cell = both counters summed, missing = 0.

    ``types`` are the columns (default: the named labels); records of every other type are
    summed into one column ``other``, so no count is lost (the long table keeps each type).
    """
    types = pivot_types() if types is None else types
    t = F.when(F.coalesce(F.col("type"), F.lit("")) == "", UNSPECIFIED).otherwise(F.col("type"))
    t = F.when(t.isin(types), t).otherwise(F.lit(OTHER))
    c = counts.select(t.alias("type"), "source", (F.col("omid_only") + F.col("other_pids")).alias("n"))
    cells = [F.coalesce(F.sum(F.when(F.col("type") == x, F.col("n"))), F.lit(0)).cast("bigint").alias(x)
             for x in [*types, OTHER]]
    return c.groupBy("source").agg(*cells)


def contribution_by_source(counts: DataFrame) -> DataFrame:
    """Per type and single source: total records; a multi-source label counts fully for
    each of its sources."""
    per = counts.select("type", F.explode(F.split("source", " ")).alias("single_source"),
                        (F.col("omid_only") + F.col("other_pids")).alias("n"))
    return per.groupBy("type", "single_source").agg(F.sum("n").cast("bigint").alias("total"))

