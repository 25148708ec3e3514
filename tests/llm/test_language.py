import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pidlink.llm import language_id as L
from pidlink.llm.common import documents


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = L.Network.fresh(["a", "b", "c"], hidden=4)
    for name in ("inputs", "recurrent", "output", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    x = rng.integers(0, 6, (7, 5)).astype(np.int16)
    x[5:, 2] = x[3:, 4] = L.PAD
    y = rng.integers(0, 3, 5)
    _, grads = L.loss_and_gradients(net, x, y)
    for w, g in zip(net.parameters(), grads):
        for _ in range(25):
            at = tuple(int(rng.integers(0, s)) for s in w.shape)
            at = (at[0], at[1] % 6, at[2]) if w is net.inputs else at
            was = w[at]
            w[at] = was + 1e-5
            up = L.loss_and_gradients(net, x, y)[0]
            w[at] = was - 1e-5
            down = L.loss_and_gradients(net, x, y)[0]
            w[at] = was
            assert abs((up - down) / 2e-5 - g[at]) < 1e-8


def test_padding_changes_nothing():
    net = L.Network.fresh(["a", "b"])
    texts = ["abc", "", None, "x" * 200, "é" * 40]
    alone = [L.pooled(net, pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(L.pooled(net, pa.array(texts, pa.string())), alone, atol=1e-6)


def plain_pooled(net, text):
    """The forward pass and the pooling, one byte and one direction at a time."""
    data, hidden = (text or "").encode(), net.recurrent.shape[1]
    total = np.zeros(len(net.langs))
    for a in range(0, len(data), L.SEGMENT):
        part = data[a:a + L.SEGMENT]
        states = []
        for side, read in enumerate((part, part[::-1])):
            h, seen = np.zeros(hidden), []
            for byte in read:
                s = np.tanh(net.inputs[side][byte].astype(float) + h @ net.recurrent[side])
                gate, new = (s[:hidden] + 1) / 2, s[hidden:]
                h = (1 - gate) * h + gate * new
                seen.append(h)
            states.append(seen if side == 0 else seen[::-1])
        for forward, backward in zip(*states):
            z = forward @ net.output[0] + backward @ net.output[1] + net.bias
            total += np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    return total / max(len(data), 1)


def test_forward_pass_and_pooling_match_plain_loops(monkeypatch):
    net = L.Network.fresh(["a", "b", "c"], hidden=5)
    texts = ["", None, "a", "é" * 31, "x" * 64, "y" * 65, "the and of " * 40, "日本" * 100]
    want = [plain_pooled(net, t) for t in texts]
    for together in (1, 3, 1024):
        monkeypatch.setattr(L, "TOGETHER", together)
        assert np.allclose(L.pooled(net, pa.array(texts, pa.string())), want, atol=1e-5)


def test_training_reads_whole_windows(monkeypatch):
    """Windows of three-byte letters are three segments, the last ones included."""
    seen = []
    plain = L.loss_and_gradients
    monkeypatch.setattr(L, "loss_and_gradients", lambda net, x, y: seen.append((x, y)) or plain(net, x, y))
    L.train([("ja", "日" * 63 + "本"), ("en", "abc")], epochs=1)
    x, y = seen[0]
    assert x.shape == (L.SEGMENT, 4) and sorted(y.tolist()) == [0, 1, 1, 1]
    assert (x != L.PAD).sum() == 3 * 64 + 3


def test_memory_of_a_long_text_is_bounded():
    import tracemalloc

    net = L.Network.fresh(["a", "b"])
    texts = pa.array(["abcdefgh" * (1 << 18)])
    tracemalloc.start()
    L.pooled(net, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20  # of 2 MB of text, most of it one block of segments


def test_held_out_accuracy_and_contract(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = {r.doc_id: r for r in L.languages(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    right = []
    for r in rows:
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= g.score <= 1
        if g.held_out:
            right.append(g.lang_pred == r.lang)
    assert np.mean(right) > 0.97


def test_edge_rows(make_docs):
    rows = [(i, ("der die das und nicht " if i % 2 else "the and of that with ") * 5, "de" if i % 2 else "en") for i in range(60)]
    rows += [(100, None, "de"), (101, "", "en"), (102, "12 34 !?", "en"), (103, "the of", None), (None, "the of and that", "en"),
             (3, rows[3][1], "de"), (104, "und nicht " * 20000, "de")]
    got = L.languages(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[103].lang_pred == "en" and by[104].lang_pred == "de" and by[None].lang_pred == "en"
    assert all(r.held_out is not None for r in got)
    nothing = L.languages(make_docs([(1, "abc", None), (2, None, None)])).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert L.languages(make_docs([])).count() == 0


def test_rows_that_repeat_an_id_give_one_sample(make_docs):
    rows = [(i, f"text number {i} of this", "en") for i in range(40)]
    hot = next(r.doc_id for r in make_docs(rows).where(~L.held_out(F.col("doc_id"))).sort("doc_id").collect())
    many = [(hot, f"other text {'x' * n} of one id " * 20, "en") for n in range(300)] + [(hot, None, "en"), (hot, "1 2", "en")]
    got = L.training_windows(make_docs([*rows, *many]))
    once = L.training_windows(make_docs(rows))
    assert len(got) <= len(once) + L.WINDOWS - 1 and {w for _, w in once if f"number {hot} " not in w} <= {w for _, w in got}
