import random

import pytest
from pyspark.sql import functions as F

from pidlink.llm import substring_dedup


def brute(rows, window):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k:k + window])] < i:
                    gone.update(range(k, k + window))
        out.append((str(i), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


def corpus(seed, window):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["é", "x"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(window - 2, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randint(0, window))]
        if rng.random() < 0.1:
            words += ["same"] * rng.randint(1, 20 * window)
        rows.append((i, rng.choice(["", " "]) + rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(200, None), (201, ""), (202, " "), (None, " ".join(passages[0])), (3, rows[3][1]), (3, rows[3][1]), (5, rows[9][1]),
             (300, "same " * 4000), (301, " ".join(f"v{i}" for i in range(25_000))), (302, " ".join(f"v{i}" for i in range(20_000, 45_000)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window,salt_rows,seed", [(12, 50_000, 1), (12, 3, 2), (5, 3, 3), (50, 50_000, 4)])
def test_matches_brute_force(make_docs, spark, window, salt_rows, seed, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SALT_ROWS", salt_rows)
    rows = corpus(seed, window)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # groups go on over batches
    try:
        got = substring_dedup.without_repeats(make_docs(rows).withColumn("id", F.lit("clash")), window).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    found = sorted((str(r.doc_id), r.n_words, sum(x.end - x.start for x in r.removed), r.kept) for r in got)
    assert found == brute(rows, window)
    for r in got:  # maximal: intervals neither touch nor overlap
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_empty(make_docs):
    assert substring_dedup.without_repeats(make_docs([])).count() == 0
