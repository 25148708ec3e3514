import random
import re
from hashlib import sha256
from zlib import crc32

import pytest

from pidlink.llm import periodic_runs as P
from pidlink.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lyndon(s, i):
    return max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j)))


def brute_runs(w):
    out, n = [], len(w)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            part = w[i:i + length]
            if j > i and length >= max(24, 3 * q) and all(part[d:] != part[:-d] for d in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def mixed(rng, n):
    w = []
    while len(w) < n:
        k = rng.choice((1, 2, 3, 50))
        block = [rng.randrange(k) for _ in range(rng.randint(1, 12))]
        w += (block * rng.randint(1, 12))[:rng.randint(1, 90)]
    return [b"w%d" % x for x in w[:n]]


def test_lyndon_array_under_both_orders():
    rng = random.Random(1)
    for _ in range(1500):
        k, n = rng.randint(1, 4), rng.randint(1, 14)
        s = [rng.randrange(k) for _ in range(n)]
        for order in (s, [k - 1 - x for x in s]):
            assert P.lyndon_array(order, k) == [brute_lyndon(order, i) for i in range(n)]


def test_runs_match_brute_force():
    rng, total = random.Random(2), 0
    for _ in range(1500):
        w = mixed(rng, rng.randint(0, 160))
        want = brute_runs(w)
        total += len(want)
        assert P.runs(w) == want
    assert total > 500


def test_no_run_is_lost_between_pieces():
    """Runs of exactly the least length, side by side and apart."""
    for q in range(1, 12):
        length = max(24, 3 * q)
        block = [b"x%d" % i for i in range(q)]
        run = (block * 24)[:length]
        other = [b"y%d" % i for i in range(q)]
        w = [b"a"] + run + [b"b"] + (other * 24)[:length] + [b"c", b"d"] + run[:-1]
        assert P.runs(w) == brute_runs(w) and len(P.runs(w)) == 2


@pytest.mark.parametrize("n", [20_000, 200_000])
def test_long_texts(n):
    rng = random.Random(3)
    block = [b"w%d" % rng.randrange(10**6) for _ in range(n // 5)]
    assert P.runs(block * 5) == [(0, n, n // 5)]
    assert P.runs([b"a"] * n) == [(0, n, 1)]
    assert P.runs([b"w%d" % i for i in range(n)]) == []


def test_longest_run_ties_and_kept_words():
    assert P.longest([]) is None
    assert P.longest([(0, 24, 3), (5, 80, 10), (7, 80, 10)]) == (0, 24, 3)
    words = [b"%d" % i for i in range(60)]
    assert P.kept_words(words, [(0, 30, 10), (20, 30, 5)]) == words[:10] + words[50:]
    assert P.kept_words(words, []) == words


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    h, n = crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join("%d,%d,%d\n" % r for r in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha256(lines.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def test_query_against_brute_force(spark, tmpdir_path, make_docs):
    rng = random.Random(4)
    rows = [(i, " ".join(x.decode() for x in mixed(rng, rng.randint(0, 200)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "é é " * 40), (1003, "é é " * 40), (1004, "a\x0bb " * 30)]
    rows += [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(150))) for i in range(2000, 2060)]
    make_docs(rows).withColumnsRenamed({"lang": "runs", "source": "collapsed"}).write.parquet(f"{tmpdir_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, tmpdir_path).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(brute_row(*r)) for r in rows)
    assert sum(crc32(str(i).encode()) % 10 == 0 for i, t in rows if t) > 20


def test_empty_table(spark, make_docs):
    assert P.periodic_runs(make_docs([])).collect() == []
    assert P.planted(make_docs([])).collect() == []
