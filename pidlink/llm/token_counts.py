"""Token counts of whole texts with the tokenizers library: lengths only.

Texts are cut at safe boundaries; the distinct parts of a chunk that are not remembered are
encoded by the library in batches of about equal bytes (sorted by length, so that a batch
holds similar parts), and only their lengths are kept. A text's count is the sum over its
parts. The table of remembered lengths is bounded and only saves time; a task holds one chunk
of texts, one batch of encodings and that table.

Defined results: a null text counts as empty and has no tokens; texts of any length are
counted whole; special strings inside texts are handled by the library's default.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pidlink.llm.boundaries import safe_parts
from pidlink.llm.common import pieces

LIMIT = 1024
REMEMBERED = 400_000
CHUNK_BYTES = 2 << 20
BATCH_BYTES = 64 << 10


class LengthCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def _learn(self, parts: set[str]) -> None:
        batch: list[str] = []
        held = 0
        sized = sorted((len(part.encode("utf-8", "surrogatepass")), part) for part in parts)
        for size, part in [*sized, (0, None)]:
            if batch and (part is None or held + size > BATCH_BYTES):
                found = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
                self.known.update(zip(batch, map(len, found)))
                batch, held = [], 0
            if part is not None:
                batch.append(part)
                held += size

    def lengths(self, texts: list[str | None]) -> list[int]:
        """Number of tokens of each text."""
        rows = []
        for text in texts:
            head, *tail = safe_parts(text or "")
            rows.append((head, tail))
        heads = {h for h, _ in rows}
        spaced = set(chain.from_iterable(t for _, t in rows))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        # a part that is not the first of its text is encoded with the space before it
        self._learn((heads | {" " + p for p in spaced}) - self.known.keys())
        spaced_length = {p: self.known[" " + p] for p in spaced}.__getitem__
        return [self.known[h] + sum(map(spaced_length, t)) for h, t in rows]


@lru_cache(maxsize=2)
def counter(path: str) -> LengthCounter:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core; Spark runs the others
    return LengthCounter(path)


def count_batches(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    count = counter(path)
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        texts = batch.column("text")
        n = pa.array(count.lengths(texts.to_pylist()), pa.int64())
        size = pc.binary_length(texts).fill_null(0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, n], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. ``path`` names a
    tokenizers file that every executor can read."""
    schema = docs.select("doc_id").schema.add("n_bytes", "long").add("n_tokens", "long")
    counted = docs.select("doc_id", "text").mapInArrow(partial(count_batches, path=path), schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
