import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pidlink.llm import source_divergence as S

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_docs, top):
    docs = [((r[2] or ""), (r[3] or ""), TERM.findall((r[1] or "").translate(LOWER))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= min_docs]
        counts = defaultdict(Counter)
        for _, source, terms in mine:
            counts[source].update(t for t in terms if df[t] >= min_docs)
        whole = sum(counts.values(), Counter())

        def p(c, kept=kept):
            n = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // n for t in kept}

        q, ps = p(whole), {s: p(c) for s, c in counts.items()}
        for s in ps:
            pair = [(o, sum(abs(ps[s][t] - ps[o][t]) for t in kept)) for o in ps if o != s]
            term = [(t, ps[s][t] - q[t]) for t in kept if counts[s][t] and ps[s][t] > q[t]]
            for part, items, limit in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, v, i) for i, (item, v) in enumerate(ranked, 1)]
    return sorted(out)


def sample(n, seed=1):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "ÉTÉ", "été", "naïve", "δέλτα", "x", "don't", "a1b2", "Żółć", "日本", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["s1", "s1", "s1", "s2", "é", None, f"rare{rng.randrange(12)}"])
        text = rng.choice([None, "", "1 2 3"]) if rng.random() < 0.1 else rng.choice([" ", "-", "\x00", "\n"]).join(
            rng.choice(words[:rng.randint(3, len(words))]) for _ in range(rng.randint(1, 60)))
        rows.append((i, text, lang, source))
    return rows + rows[:7]


@pytest.mark.parametrize("postings", [1, 50, S.BLOCK_POSTINGS])
def test_matches_brute_force(spark, make_docs, postings):
    rows = sample(300)
    got = S.divergence(make_docs(rows), min_docs=12, top=5, block_postings=postings).collect()
    assert sorted(map(tuple, got)) == brute(rows, 12, 5)


def test_terms_of_many_chunks_and_sources(spark, make_docs):
    """More sources than a chunk holds postings, one of them with a third of the rows."""
    rng = random.Random(2)
    rows = [(i, "common " * rng.randint(1, 4) + f"t{'abcdefgh'[i % 8]} " + "z" * (i % 5), "en",
             "hot" if i % 3 == 0 else f"s{i % 300:03}") for i in range(900)]
    got = S.divergence(make_docs(rows), min_docs=30, block_postings=40).collect()
    assert sorted(map(tuple, got)) == brute(rows, 30, 50)


def test_no_kept_terms_and_empty_table(spark, make_docs):
    rows = [(1, "one", "en", "a"), (2, None, "en", "b"), (3, "", None, None)]
    got = S.divergence(make_docs(rows)).collect()
    assert sorted(map(tuple, got)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert S.divergence(make_docs([])).collect() == []


def test_clashing_columns(spark, make_docs):
    rows = sample(120, seed=3)
    docs = make_docs(rows).drop("n_chars").withColumns({c: F.lit(1) for c in ("term", "value", "rank", "V", "count", "shard", "part")})
    assert sorted(map(tuple, S.divergence(docs, min_docs=8).collect())) == brute(rows, 8, 50)


def test_long_text_is_counted_in_parts():
    text = ("Ab é " * 500_000).encode()
    parts = list(S.text_parts(text))
    assert len(parts) > 2 and sum(len(S._TERM.findall(p.lower())) for p in parts) == 1_000_000
    assert list(S.text_parts(b"q" * (3 << 20))) == [b"q" * (3 << 20)]


def test_probability_is_exact_beyond_doubles(spark):
    rng = random.Random(5)
    rows = [(c, t) for t in (1, 7, 10**9 + 7, 10**15 + 37) for c in [0, t, *(rng.randint(0, t) for _ in range(20))]]
    df = spark.createDataFrame(rows, "c long, t long").select("c", "t", S.probability(F.col("c"), F.col("t")).alias("p"))
    assert all(r["p"] == 1 + 10**9 * r["c"] // r["t"] for r in df.collect())


def test_pair_corrections_are_spilled_by_language(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(S, "PAIR_ENTRIES", 4)
    rng = random.Random(6)
    rows = [(lang, f"t{t:02}", s, rng.randint(1, 99), 5) for lang in ("a", "b") for t in range(30) for s in "vwxyz" if rng.random() < 0.7]
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "term", "source", "p", "p0"), r)) for r in rows])
    got = Counter()
    for out in S.corrected([batch.slice(i, 7) for i in range(0, len(rows), 7)]):
        for r in out.to_pylist():
            got[r["lang"], r["a"], r["b"]] += r["both"]
    want = Counter()
    for lang, t, s, p, p0 in rows:
        for lang2, t2, s2, p2, p02 in rows:
            if (lang, t) == (lang2, t2) and s < s2:
                want[lang, s, s2] += abs(p - p2) - abs(p - p02) - abs(p0 - p2) + abs(p0 - p02)
    assert got == want
