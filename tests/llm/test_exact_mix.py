import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pidlink.llm import exact_dedup, mixing


def brute_groups(rows):
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    return by


CASES = {
    "mixed": [(1, "a"), (2, "a"), (5, "a"), (3, "b"), (4, None), (6, ""), (7, "x" * 5000), (8, "x" * 5000),
              (9, "x" * 4999 + "y"), (10, "é"), (11, "é"), (12, "A"), (13, "a ")],
    "repeated_rows": [(1, "a"), (1, "a"), (2, "a"), (2, "a"), (3, "q"), (3, "q"), (3, "r")],
    "null_id": [(None, "a"), (1, "a"), (None, "b"), (None, "b")],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_exact_groups(make_docs, case):
    rows = CASES[case]
    got = exact_dedup.with_digest(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by = brute_groups(rows)
    want = sorted((str(i), str(max((x for x in by[t or ""] if x is not None), default=None)), len(by[t or ""]),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(by) and all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("case", CASES)
def test_drop_exact_keeps_one_row_and_all_columns(make_docs, case):
    rows = CASES[case]
    docs = make_docs(rows).withColumn("_full", F.lit(1)).withColumn("_id", F.lit("x")).withColumn("kept", F.lit(2)).withColumn("_doc_full", F.lit(3))
    out = exact_dedup.drop_exact(docs)
    assert out.columns == docs.columns
    got = out.collect()
    by = brute_groups(rows)
    assert sorted(str((r.doc_id, r.text or "")) for r in got) == sorted(
        str((max((x for x in ids if x is not None), default=None), t)) for t, ids in by.items())


def water_fill(sizes):
    """Targets by the repeated redistribution itself."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: 1 + i % 3 for i, s in enumerate(order)}
    clamped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in clamped]
        rest = total - sum(clamped.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return clamped | share
        clamped |= {s: 3 * sizes[s] for s in over}


MIXES = {
    "even": [(i, "w " * (1 + i % 7), "en", f"s{i % 4}") for i in range(200)],
    "tiny_and_hot": [(i, "w " * 5, "en", "hot") for i in range(300)] + [(1000, "a b", "en", "tiny"), (1001, "c", "en", None)],
    "nulls": [(1, None, None, None), (2, "", "x", "a"), (3, "a b c", "x", "b"), (None, "d e", "x", "b")],
    "repeated": [(7, "a b c d", "x", "s")] * 6 + [(8, "a", "x", "t")] * 3,
    "no_words": [(1, "", "x", "a"), (2, None, "x", "b")],
}


@pytest.mark.parametrize("case", MIXES)
def test_mix(make_docs, case):
    rows = MIXES[case]
    docs = make_docs(rows)
    got = mixing.mixed_sizes(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = water_fill(sizes)
    targets = defaultdict(set)
    for r in got:
        assert r.taken in [k * r.size for k in range(4)]
        targets[r.source_size].add(round(r.target, 6))
    for s, t in want.items():
        assert round(t, 6) in targets[sizes[s]]
    again = mixing.mixed_sizes(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = {r.source: r.n for r in mixed.groupBy("source").agg(
        F.sum(F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), ""))).alias("n")).collect()}
    largest = {s: max(size(r[1]) for r in rows if r[3] == s) for s in sizes}
    if case != "repeated":
        for s, t in want.items():
            assert abs(words.get(s, 0) - t) <= largest[s]


def test_mix_clashing_columns(make_docs):
    docs = make_docs(MIXES["even"]).withColumn("_mix_times", F.lit(1)).withColumn("whole", F.lit("w")).withColumn("last_draw", F.lit(2))
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() > 0


def test_mix_empty(make_docs):
    assert mixing.mixed_sizes(make_docs([])).count() == 0
    assert mixing.mix(make_docs([])).count() == 0


def test_rows_equal_in_id_and_text_are_thinned_to_the_same_row(make_docs):
    """Whatever the order and partitioning of the rows."""
    rows = [(1, "a", "en", f"s{i}", i) for i in range(9)] + [(2, "a", "de", "s", None), (2, "a", None, "s", 3), (3, "b", "en", "x", 1)]
    seen = set()
    for parts in (1, 2, 5):
        for order in (rows, rows[::-1]):
            seen.add(str(sorted(map(str, exact_dedup.drop_exact(make_docs(order, parts=parts)).collect()))))
    assert len(seen) == 1 and seen.pop().count("Row") == 2


def test_refinement_counts(make_docs):
    long = "w " * 20_000
    rows = [(1, "ab"), (2, "ab"), (3, "cd"), (4, "xyz"), (5, None), (6, ""), (7, long), (8, long + "é"), (9, long + "zz"), (10, "q" * 70 + "1"), (11, "q" * 70 + "2")]
    assert exact_dedup.refinement(make_docs(rows)).first().asDict() == {"rows": 11, "same_length": 9, "same_prefix": 8}
    assert exact_dedup.refinement(make_docs([])).first().asDict() == {"rows": 0, "same_length": 0, "same_prefix": 0}
    got = {r.doc_id: r.group_size for r in exact_dedup.exact_groups(make_docs(rows)).collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: 1, 5: 2, 6: 2, 7: 1, 8: 1, 9: 1, 10: 1, 11: 1}


def test_too_many_sources_are_an_error(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    few = [(i, "a b", "en", f"s{i % 3}") for i in range(9)]
    assert mixing.mixed_sizes(make_docs(few)).count() == 9
    with pytest.raises(Exception, match="more than 3 sources"):
        mixing.mixed_sizes(make_docs([*few, (9, "a", "en", "s3")])).collect()
