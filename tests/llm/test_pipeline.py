from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from pidlink.llm import common, exact_dedup, near_dedup, quality_model
from pidlink.llm.common import documents, labels

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = documents(spark, SF)
    columns, before = docs.columns, docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = common.stored(stage(spark, before, SF), "test")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns, name
        if name == "quality":
            kept = {r.doc_id for r in quality_model.quality_rows(before, labels(spark, SF)).where("kept").collect()}
            assert {r.doc_id for r in after.collect()} == kept and 0 < len(kept) < before.count()
        if name == "exact_dedup":
            kept = sorted(r.doc_id for r in exact_dedup.exact_groups(before).where("kept").collect())
            assert sorted(r.doc_id for r in after.collect()) == kept
            assert after.select("text").distinct().count() == after.count() < before.count()
        if name == "near_dedup":
            found = near_dedup.near_components(before).collect()
            assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in found})
        if name == "source_mix":
            assert max(Counter(r.doc_id for r in after.collect()).values()) <= 3
        if name == "bpe":
            assert Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in before.collect())
            assert all(len(r.ids) == r.n_tokens for r in after.collect())
        before = after


def test_last_stage_decodes_its_ids(spark, monkeypatch):
    asked = {}
    encoded = corpus_pipeline.bpe_trie.encoded
    monkeypatch.setattr(corpus_pipeline.bpe_trie, "encoded", lambda *a, **k: asked.update(k) or encoded(*a, **k))
    docs = spark.createDataFrame([(1, "a text  of é", "en", "s"), (2, None, "en", "s")], "doc_id long, text string, lang string, source string")
    assert corpus_pipeline.tokens(spark, docs, SF).count() == 2 and asked["verified"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a text", None]})
    enc = corpus_pipeline.bpe_trie.encoder(corpus_pipeline.vocabulary())
    run = lambda: list(corpus_pipeline.bpe_trie.encode_batches([batch], corpus_pipeline.vocabulary(), False, False, True))
    assert len(run()) == 1
    monkeypatch.setattr(enc, "decode", lambda packed: "other")
    with pytest.raises(ValueError):
        run()


def test_stored_tables_are_released(spark, make_docs):
    import os

    from pidlink.session import checkpoint_dir

    with common.released(spark):
        path = make_docs([(1, "a")]).transform(lambda d: common.stored(d, "x")).inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and f"{checkpoint_dir(spark)}/llm-" in path
    assert not os.path.exists(path)
    kept = common.stored(make_docs([(1, "a")]), "x")
    with common.released(spark):
        pass
    assert kept.count() == 1


def test_run_leaves_the_stages_alone(spark):
    import os

    from pidlink.session import checkpoint_dir

    here = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(here))
    assert corpus_pipeline.run(spark, SF).count() > 0
    new = {f.split("-")[0] for f in set(os.listdir(here)) - before}
    assert new == {"pipeline"}


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and rows.count() > 0
