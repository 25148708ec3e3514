"""64-bit SimHash fingerprints of word shingles (the Arrow side of ``near_dedup``)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash

from pidlink.llm.common import pieces

SEED = 42
#: Shingles whose bits are counted at once (64 bytes each).
CHUNK = 1 << 15


def shingle_hashes(text: str, k: int) -> list[int]:
    """XXH64 of every k-word shingle, repeats included; the whole sequence if it is shorter."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII white space
    n = len(words)
    if n <= k:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if n else []
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[: n - k]]]
    return list(map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in zip(starts, ends[k - 1:])], repeat(SEED)))


def fingerprints(texts: list[str | None], k: int) -> np.ndarray:
    """Fingerprint of each text (uint64): a bit is 1 if set in over half of the hashes."""
    set_bits = np.zeros((len(texts), 64), dtype=np.int64)
    total = np.zeros(len(texts), dtype=np.int64)
    held: list[int] = []
    owner: list[tuple[int, int]] = []  # (text, hashes of it that are held)

    def count() -> None:
        if not held:
            return
        bits = np.unpackbits(np.array(held, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.cumsum([0, *[n for _, n in owner[:-1]]])
        sums = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        for (i, _), s in zip(owner, sums):
            set_bits[i] += s
        held.clear()
        owner.clear()

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, k) if text else []
        total[i] = len(hashes)
        for a in range(0, len(hashes), CHUNK):
            part = hashes[a:a + CHUNK]
            held.extend(part)
            owner.append((i, len(part)))
            if len(held) >= CHUNK:
                count()
    count()
    return np.packbits(2 * set_bits > total[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprint_batches(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (doc_id, fp), fp as the signed long of the same bits."""
    for batch in pieces(batches, "text", 4 << 20, 4096):
        fp = fingerprints(batch.column("text").to_pylist(), k)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])
