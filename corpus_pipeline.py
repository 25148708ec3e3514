"""From raw documents to token ids: the training-data operators in sequence."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pidlink.llm import bpe_trie, exact_dedup, mixing, near_dedup, quality_model
from pidlink.llm.common import documents, labels, released
from pidlink.llm.queries import vocabulary
from pidlink.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling rejects go."""
    return quality_model.keep_good(docs, labels(spark, sf_dir))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest id."""
    return exact_dedup.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return near_dedup.drop_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, once or more or not at all, until sources have their target sizes."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: doc_id, lang, source, n_tokens, ids. The ids are decoded again and
    held against the text; the decoded text is not stored."""
    return bpe_trie.encoded(docs, vocabulary(), keep=("doc_id", "lang", "source"), verified=True)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", mixed),
    ("bpe", tokens),
]

#: The stages sample, hash and tokenize in ways that SQL has no functions for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written below the shared checkpoint
    folder and read again as the next stage's input. What a stage stores on its way is deleted
    when its result is written."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with released(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
