"""Near duplicates: SimHash fingerprints linked by Hamming distance, with pivot distance tables.

1. An Arrow pass computes the fingerprint of every whole text; equal fingerprints become one
   class, so copies are never compared. The distances of each class to ``PIVOTS`` reference
   fingerprints are computed once and stored with it, packed into longs that sort by the first
   coordinate, then the second, and so on.
2. The 64 bits are cut into ``max_bits + 3`` blocks. Fingerprints that differ in at most
   ``max_bits`` bits agree on at least three blocks, so every link shows up under one of the
   keys "these three blocks" (20 keys for 3 bits). No pair is lost, and unrelated
   fingerprints share a key only by a chance of 2**-32.
3. By the triangle inequality |d(x,p) - d(y,p)| <= d(x,y) for each pivot p. So under each key the
   members are sorted by their first coordinate and paired only as far as it differs by at most
   ``max_bits``; pairs whose largest difference in any coordinate exceeds that are discarded; the
   survivors are verified bit by bit. Only a spanning forest of the links of a group is emitted: at
   most one row per member, never all pairs. ``pair_counts`` says how many pairs were met,
   discarded and verified.
4. A key with more than ``TILE`` members is cut into tiles along that order. Each tile is searched
   where it is read; pairs of tiles whose coordinate ranges come within ``max_bits`` of each other
   are dealt over the cluster, a pair to a task, the others never meet. So a dense group is
   neither capped nor held by one task. (TILE changes costs, not results: the pairs that remain
   of n members are still of the order of n * n.)
5. Connected components of the links give the component of each class and, by a many-to-one
   join, of each document.

Defined results: a null or empty text has fingerprint zero and is linked like any other;
rows that repeat an id are linked each by its own text; null ids are ignored when the
smallest id of a component is chosen; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pidlink.llm.common import stored
from pidlink.llm.components import components
from pidlink.llm.simhash_fp import fingerprint_batches

SHINGLE_WORDS = 3
MAX_BITS = 3
PIVOTS = 16
TILE = 1024
LINKS = ("a long, b long, key int, part long, tile int, members array<long>, p1 array<long>, p2 array<long>, "
         "low array<int>, high array<int>, pairs long, near long")
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
#: A link (a, b); a tile of a large key with its pivot table; or how many pairs a task met and verified.
_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int32()), ("part", pa.int64()), ("tile", pa.int32()),
                     ("members", _LONGS), ("p1", _LONGS), ("p2", _LONGS), ("low", _INTS), ("high", _INTS),
                     ("pairs", pa.int64()), ("near", pa.int64())])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every row."""
    return docs.select("doc_id", "text").mapInArrow(
        partial(fingerprint_batches, k=shingle_words),
        docs.select("doc_id").schema.add("fp", "long"))


def block_masks(max_bits: int) -> list[int]:
    """Masks of all choices of three blocks, as signed longs."""
    n = max_bits + 3
    edges = [round(i * 64 / n) for i in range(n + 1)]
    blocks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint (uint64) to the reference fingerprints."""
    pivots = np.random.default_rng(64).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def packed(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A pivot table as two longs a row, whose order is that of the coordinates."""
    return tuple(np.ascontiguousarray(half).view(">i8").reshape(-1).astype(np.int64) for half in (table[:, :8], table[:, 8:]))


def unpacked(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    return np.stack([p1, p2], axis=1).astype(">i8").view(np.int8).reshape(-1, PIVOTS)


def add_pivots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fp, first_id) -> the same with the distances to the pivots."""
    for batch in batches:
        p1, p2 = packed(pivot_table(batch.column("fp").to_numpy().view(np.uint64)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p1), pa.array(p2)], ["fp", "first_id", "p1", "p2"])


class Pairs:
    """Filters pairs by the pivot table, verifies the survivors, and counts both."""

    def __init__(self, bits: int):
        self.bits, self.met, self.near = bits, 0, 0

    def verified(self, fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for p in range(PIVOTS):  # the maximum coordinate difference, one coordinate at a time
            near = np.abs(table[i, p] - table[j, p]) <= self.bits
            i, j = i[near], j[near]
            if not len(i):
                return i, j
        self.near += len(i)
        near = np.bitwise_count(fps[i] ^ fps[j]) <= self.bits
        return i[near], j[near]

    def counts(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"pairs": self.met, "near": self.near}], schema=_SCHEMA)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position linked to each of n positions."""
    low = np.arange(n)
    while True:
        was = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = low[low]
        if np.array_equal(low, was):
            return low


def _edges(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A spanning forest of links between positions."""
    if len(i):
        used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        low = _forest(len(used), at[:len(i)], at[len(i):])
        child = np.flatnonzero(low != np.arange(len(used)))
        a, b = fps[used[child]].view(np.int64), fps[used[low[child]]].view(np.int64)
        none = pa.nulls(len(a))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *[none.cast(f.type) for f in list(_SCHEMA)[2:]]], schema=_SCHEMA)


def _group_links(group: np.ndarray, fps: np.ndarray, table: np.ndarray, pairs: Pairs) -> Iterator[pa.RecordBatch]:
    """Links between rows of equal (adjacent) group numbers, sorted by the first coordinate."""
    sizes = np.bincount(group)
    pairs.met += int((sizes * (sizes - 1) // 2).sum())
    found_i, found_j = [], []
    i, step = np.arange(len(fps)), 0
    while True:
        step += 1
        i = i[i + step < len(fps)]
        # beyond the first row that is too far in the first coordinate, all are
        i = i[(group[i] == group[i + step]) & (table[i + step, 0] - table[i, 0] <= pairs.bits)]
        if not len(i):
            break
        a, b = pairs.verified(fps, table, i, i + step)
        found_i.append(a)
        found_j.append(b)
    none = np.zeros(0, dtype=np.int64)
    yield from _edges(fps, np.concatenate([none, *found_i]), np.concatenate([none, *found_j]))


def _tile_row(key: int, part: int, tile: int, fps: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    p1, p2 = packed(table)
    return pa.RecordBatch.from_pylist([{
        "key": key, "part": part, "tile": tile, "members": fps.view(np.int64).tolist(), "p1": p1.tolist(), "p2": p2.tolist(),
        "low": table.min(axis=0).tolist(), "high": table.max(axis=0).tolist()}], schema=_SCHEMA)


def link_groups(batches: Iterable[pa.RecordBatch], bits: int, tile: int = TILE) -> Iterator[pa.RecordBatch]:
    """Rows (key, part, fp, p1, p2), sorted by key, part and coordinates -> links inside each (key,
    part) of up to ``tile`` rows; of larger ones, links inside each tile, and the tiles. Holds a batch
    and a tile at most."""
    key, part, fps = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    table = np.zeros((0, PIVOTS), np.int8)
    pairs = Pairs(bits)
    tiles = 0  # of the group that the held rows begin with

    def finished(upto: int) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(np.concatenate([[0], (np.diff(key[:upto]) != 0) | (np.diff(part[:upto]) != 0)]))
        yield from _group_links(group, fps[:upto], table[:upto], pairs)

    for batch in batches:
        key = np.concatenate([key, batch.column("key").to_numpy()])
        part = np.concatenate([part, batch.column("part").to_numpy()])
        fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
        table = np.concatenate([table, unpacked(batch.column("p1").to_numpy(), batch.column("p2").to_numpy())])
        while len(fps):
            change = np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0)) + 1
            first_end = change[0] if len(change) else len(fps)
            if first_end > tile or (tiles and len(change)):  # the next tile of a large group
                cut = min(first_end, tile)
                yield from finished(cut)
                yield _tile_row(int(key[0]), int(part[0]), tiles, fps[:cut], table[:cut])
                tiles = tiles + 1 if first_end > cut or not len(change) else 0
                key, part, fps, table = key[cut:], part[cut:], fps[cut:], table[cut:]
                continue
            sizes = np.diff(np.concatenate([[0], change]))  # of the groups that are complete
            large = np.flatnonzero(sizes > tile)
            upto = change[large[0] - 1] if len(large) else change[-1] if len(change) else 0
            if not upto:
                break
            yield from finished(upto)
            key, part, fps, table = key[upto:], part[upto:], fps[upto:], table[upto:]
    if len(fps):
        yield from finished(len(fps))
        if tiles:
            yield _tile_row(int(key[0]), int(part[0]), tiles, fps, table)
    yield pairs.counts()


def _numbers(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy()


def link_tiles(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of two tiles of one key -> links between them."""
    pairs = Pairs(bits)
    for batch in batches:
        columns = {name: batch.column(name) for name in ("members", "p1", "p2", "o_members", "o_p1", "o_p2")}
        for row in range(batch.num_rows):
            (x, x1, x2, y, y1, y2) = (_numbers(c, row) for c in columns.values())
            fps = np.concatenate([x, y]).view(np.uint64)
            table = np.concatenate([unpacked(x1, x2), unpacked(y1, y2)])
            pairs.met += len(x) * len(y)
            # the second tile is sorted by its first coordinate: each member meets a stretch of it
            first = len(x) + np.searchsorted(table[len(x):, 0], table[:len(x), 0] - bits, side="left")
            last = len(x) + np.searchsorted(table[len(x):, 0], table[:len(x), 0] + bits, side="right")
            found = [pairs.verified(fps, table, np.full(b - a, i), np.arange(a, b)) for i, (a, b) in enumerate(zip(first, last)) if a < b]
            if found:
                yield from _edges(fps, *(np.concatenate(side) for side in zip(*found)))
    yield pairs.counts()


def link_table(classes: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Links (a, b) and counts (pairs, near) of ``classes`` (fp, p1, p2)."""
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in block_masks(max_bits)])
    keyed = classes.select(F.posexplode(keys).alias("key", "part"), "fp", "p1", "p2")
    grouped = keyed.repartition("key", "part").sortWithinPartitions("key", "part", "p1", "p2", "fp")
    found = stored(grouped.mapInArrow(partial(link_groups, bits=max_bits, tile=tile), LINKS), "near-links")
    tiles = found.where(F.col("members").isNotNull()).select("key", "part", "tile", "members", "p1", "p2", "low", "high")
    names = [c for c in tiles.columns if c not in ("key", "part")]
    other = tiles.withColumnsRenamed({c: f"o_{c}" for c in names})
    apart = F.exists(F.arrays_zip("low", "high", "o_low", "o_high"),
                     lambda r: (r["o_low"] - r["high"] > max_bits) | (r["low"] - r["o_high"] > max_bits))
    # which tiles to compare is decided without their members; those are joined to it, a pair to a row
    slim = tiles.select("key", "part", "tile", "low", "high").join(other.select("key", "part", "o_tile", "o_low", "o_high"), ["key", "part"])
    meet = slim.where((F.col("tile") < F.col("o_tile")) & ~apart).select("key", "part", "tile", "o_tile")
    crossed = meet.join(tiles.drop("low", "high"), ["key", "part", "tile"]).join(other.drop("o_low", "o_high"), ["key", "part", "o_tile"])
    spread = crossed.repartition("key", "part", "tile", "o_tile").select("members", "p1", "p2", "o_members", "o_p1", "o_p2")
    across = spread.mapInArrow(partial(link_tiles, bits=max_bits), LINKS)
    return found.where(F.col("members").isNull()).unionByName(across).select("a", "b", "pairs", "near")


def links(classes: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """A spanning set of the links between distinct fingerprints: (a, b)."""
    return link_table(classes, max_bits, tile).where(F.col("a").isNotNull()).select("a", "b")


def pair_counts(classes: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """One row: met (pairs under a key, those of tiles too far apart left out), discarded (by the pivot
    tables), verified (compared bit by bit) and links."""
    met, near = F.coalesce(F.sum("pairs"), F.lit(0)), F.coalesce(F.sum("near"), F.lit(0))
    return link_table(classes, max_bits, tile).agg(met.alias("met"), (met - near).alias("discarded"), near.alias("verified"),
                                                   F.count("a").alias("links"))


def classes_of(fps: DataFrame) -> DataFrame:
    """One row per distinct fingerprint: fp, first_id, and its pivot distances p1, p2."""
    groups = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    return groups.mapInArrow(add_pivots, StructType([*groups.schema]).add("p1", "long").add("p2", "long"))


def near_components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest id reachable)."""
    fps = stored(fingerprints(docs, shingle_words), "near-fps")
    classes = stored(classes_of(fps), "near-classes")
    roots = components(links(classes, max_bits, tile))
    # a root has no row of its own: it is added as pointing at itself
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    linked = classes.join(roots, classes["fp"] == roots["node"]).select("fp", "root", "first_id")
    least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    linked = linked.join(least, "root").select(F.col("fp").alias("l_fp"), "least_id")
    named = classes.join(linked, classes["fp"] == linked["l_fp"], "left").select(
        F.col("fp").alias("c_fp"), F.coalesce("least_id", "first_id").alias("component_id"))
    return fps.join(named, fps["fp"] == named["c_fp"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents whose id is the smallest of its component, all columns unchanged. Rows
    that share an id are one document and stay or go together. The semi join moves the texts
    once, spread by id."""
    found = near_components(docs, shingle_words, max_bits)
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["_keep"]), "left_semi")
