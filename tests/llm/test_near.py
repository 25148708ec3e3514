import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pidlink.llm import near_dedup
from pidlink.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def component_ids(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def texts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    rows, base = [], [[rng.choice(vocabulary) for _ in range(rng.randint(1, 200))] for _ in range(25)]
    for i in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "A b"), (204, "a B"), (205, "É b c"), (206, "é b c"),
             (207, "x " * 5000), (208, "x y z")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [4, 1024])
def test_components_match_brute_force(make_docs, tile):
    rows = texts()
    got = near_dedup.near_components(make_docs(rows), tile=tile).collect()
    fp = {i: fingerprint(t) for i, t in rows}
    want = component_ids(sorted(fp), lambda a, b: bin(fp[a] ^ fp[b]).count("1") <= 3)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fp[i]:016x}", want[i]) for i in fp}
    assert len(got) == len(rows)


def test_repeated_ids_null_ids_and_empty(make_docs):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "zz yy xx ww"), (None, "a b c d"), (3, "a b c d")]
    got = near_dedup.near_components(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("1", 1), ("1", 1), ("1", 1), ("3", 1), ("None", 1)]
    assert near_dedup.near_components(make_docs([])).count() == 0
    assert near_dedup.drop_near(make_docs([])).count() == 0


def test_drop_near_keeps_columns(make_docs):
    docs = make_docs(texts()).withColumn("fp", F.lit(0)).withColumn("component_id", F.lit("x")).withColumn("_keep", F.lit(1))
    out = near_dedup.drop_near(docs)
    assert out.columns == docs.columns
    fp = {i: fingerprint(t) for i, t in texts()}
    want = component_ids(sorted(fp), lambda a, b: bin(fp[a] ^ fp[b]).count("1") <= 3)
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(want.values()))


def test_pivot_coordinates_never_exceed_the_distance():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))
    gap = np.abs(near_dedup.pivot_table(x).astype(int) - near_dedup.pivot_table(y)).max(axis=1)
    assert (gap <= np.bitwise_count(x ^ y)).all()


def test_packed_tables_sort_by_coordinates():
    table = near_dedup.pivot_table(np.random.default_rng(1).integers(0, 1 << 64, 300, dtype=np.uint64))
    p1, p2 = near_dedup.packed(table)
    assert (near_dedup.unpacked(p1, p2) == table).all()
    order = sorted(range(300), key=lambda i: (p1[i], p2[i]))
    assert [tuple(table[i]) for i in order] == sorted(map(tuple, table))


def groups(edges):
    """Connected groups of at least two."""
    root = {}

    def find(n):
        while root.setdefault(n, n) != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = {}
    for n in root:
        found.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, found.values()))


def hot_key(spark, n, clusters, seed=3):
    """n fingerprints that agree on three blocks, some of them within three bits of another."""
    rng = np.random.default_rng(seed)
    free = np.uint64((1 << 32) - 1)
    base = rng.integers(0, 1 << 64, n - clusters, dtype=np.uint64) & free
    near = base[:clusters] ^ (np.uint64(1) << rng.integers(0, 30, clusters, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 30, clusters, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near])) | np.uint64(0xABCDEF01 << 32)
    rows = spark.createDataFrame([(int(x), i) for i, x in enumerate(fps.view(np.int64))], "fp long, doc_id long")
    return fps, near_dedup.classes_of(rows.repartition(4))


def test_tiles_give_the_links_of_one_group(spark):
    fps, classes = hot_key(spark, 700, 150)
    want = {frozenset((int(x), int(y))) for i, x in enumerate(fps.view(np.int64)) for j, y in enumerate(fps.view(np.int64))
            if i < j and bin(int(fps[i]) ^ int(fps[j])).count("1") <= 3}
    roots = component_ids(sorted(int(x) for x in fps.view(np.int64)), lambda a, b: frozenset((a, b)) in want)
    for tile in (16, 100, 1024):
        found = near_dedup.links(classes, tile=tile).collect()
        linked = {frozenset((r.a, r.b)) for r in found}
        assert component_ids(sorted(roots), lambda a, b, linked=linked: frozenset((a, b)) in linked) == roots
        count = near_dedup.pair_counts(classes, tile=tile).first()
        assert count.met == count.discarded + count.verified and len(want) <= count.verified < 0.5 * count.met
    assert near_dedup.pair_counts(classes, tile=16).first().met < 20 * 700 * 699 // 2  # far tiles never meet


def test_hot_key_of_20000_members(spark):
    """20,000 fingerprints under one key (and, in part, under others): seconds, and tile pairs over many tasks."""
    fps, classes = hot_key(spark, 20_000, 500)
    kept = near_dedup.stored(classes, "hot")
    t0 = time.time()
    linked = near_dedup.links(kept).distinct().collect()
    assert time.time() - t0 < 120
    close = []
    for i in range(0, len(fps), 500):
        a, b = np.nonzero(np.bitwise_count(fps[i:i + 500, None] ^ fps) <= 3)
        close += [(int(fps[i + x].view(np.int64)), int(fps[y].view(np.int64))) for x, y in zip(a, b) if i + x < y]
    assert len(close) >= 400
    assert groups((r.a, r.b) for r in linked) == groups(close)
    plan = near_dedup.links(kept)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "o_tile" in plan[plan.index("REPARTITION_BY_COL") - 200:plan.index("REPARTITION_BY_COL")]


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 101), (105, 100), (300, 200), (300, 200)]
    star = [(1000, k) for k in range(1001, 1100)]
    edges = spark.createDataFrame(chain + star, "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    want = {i: 0 for i in range(1, 61)} | {101: 100, 105: 100, 300: 200} | {k: 1000 for k in range(1001, 1100)}
    assert got == want
    assert components(edges.limit(0)).count() == 0
