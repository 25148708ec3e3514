import random
import re
import string
import time
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from pidlink.llm import queries
from pidlink.llm import secrets as S

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(t):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


def samples(n, seed=3):
    rng = random.Random(seed)
    al = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "apiKey", '"', "'", "=", ":", " ", " ", "\n", "é", "AKIA", "ABCD1234", "0f" * 9,
          "deadbeef", "x", "/+", "ſecret", "toKen", "Bearer", "auth", "abcdefgh", "-._"]
    return ["".join(rng.choice(al) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_base_rules_match_brute_force():
    assert sum(len(brute(t)) for t in samples(20000)) > 3000
    for t in samples(20000):
        assert S.detect(t) == brute(t), t


def test_base_spans_stay_and_added_ones_touch_none():
    for t in samples(5000, seed=4):
        base, spans = S.find(t)
        assert base == brute(t) and set(base) <= set(spans)
        for k, a, b in set(spans) - set(base):
            assert k == "novel" and 0 <= a < b <= len(t) and not any(x < b and a < y for _, x, y in base)


def documents(n, seed=5):
    rng = random.Random(seed)
    names = ["configuration", "request", "session", "handler", "database", "connection", "parameter", "response", "manager", "settings", "storage",
             "customer", "identity", "provider", "registry", "exchange", "transport", "resource", "template", "pipeline"]
    every = [a + b for a in ("", "get_", "set_", "load_", "new_") for b in names] + [x + "_" + y for x in names[:8] for y in names]
    return every, [" ".join(rng.choice(every) for _ in range(rng.randint(20, 60))) for _ in range(n)], rng


DISGUISES = ["Authorization: Bearer {}", "pwd -> {}", "db_password is {}", "credential '{}'", "signing_key({})", "passphrase  {}"]


def test_planted_secrets_are_found_and_names_are_not(spark, make_docs):
    every, texts, rng = documents(400)
    docs = make_docs(list(enumerate(texts)))
    dictionary = S.identifier_dictionary(docs)
    assert 100 < len(dictionary) <= S.DICTIONARY_BYTES
    alphabet = string.ascii_letters + string.digits + "+/"
    found = wrong = total = 0
    for text in texts:
        for plain in (False, True):
            value = ".".join(rng.sample(every, 2)) if plain else "".join(rng.choice(alphabet) for _ in range(rng.randint(14, 40)))
            at = text.index(" ", rng.randrange(len(text) // 2))
            put = rng.choice(DISGUISES).format(value)
            t = text[:at] + " " + put + text[at:]
            a = t.index(value, at)
            base, spans = S.find(t, dictionary)
            hit = any(k == "novel" and x < a + len(value) and a < y for k, x, y in spans)
            found += hit and not plain
            wrong += hit and plain
            total += not plain
    assert found >= 0.95 * total and wrong <= 0.1 * total, (found, wrong, total)


def test_copies_around_do_not_hide_a_secret():
    value = "q7Zk2Lx9Vb4Tn8Rw1Yp6"
    t = f"auth {value} and auth {value} and auth {value}"
    assert [t[a:b] for _, a, b in S.find(t)[1]] == [value] * 3
    assert S.find("the token configuration\nq7Zk2Lx9Vb4Tn8Rw1Yp6")[1] == []  # on another line
    assert S.find("nothing near q7Zk2Lx9Vb4Tn8Rw1Yp6")[1] == []


@pytest.mark.parametrize("text", ["token " * 100_000, "token=" * 100_000, "a" * 1_000_000, "0" * 1_000_000, "auth " + "x9" * 500_000, "secret" + " " * 1_000_000,
                                  "AKIA" * 200_000, "auth\n" * 200_000, "0123456789abcdef" * 2 + " " + "token='abcdefgh1' " * 20_000])
def test_long_texts_take_linear_time(text):
    t0 = time.time()
    S.find(text)
    assert time.time() - t0 < 5


def test_query_nulls_empty_repeats_and_clashes(spark, tmpdir_path, make_docs):
    rows = [(i, t) for i, t in enumerate(samples(200, seed=6))] + [(900, None), (901, ""), (902, "é token = abcdefgh"), (902, "é token = abcdefgh")]
    make_docs(rows).withColumnsRenamed({"lang": "base", "source": "spans"}).write.parquet(f"{tmpdir_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op12_zstd_novelty(spark, tmpdir_path).collect()}
    for doc_id, text in rows:
        r, want = got[doc_id], brute(text or "")
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, _, _ in want) for x in S.BASE]
        assert r["base_sha256"] == sha256(",".join("%s:%d:%d" % s for s in want).encode()).hexdigest()
        assert r["n_added"] == len([s for s in r["spans"].split(",") if s]) - len(want)


def test_empty_table(spark, make_docs):
    assert S.identifier_dictionary(make_docs([])) == b""
    assert S.secret_spans(make_docs([])).collect() == []
    assert S.secret_spans(make_docs([(1, None)]).withColumn("words", F.lit(1))).count() == 1
