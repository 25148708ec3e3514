"""Byte-level BPE encoding and decoding by a prefix trie of the distinct words.

The BPE encoding of a byte string is fixed by its last token and the encoding of what comes
before it, and a sequence of tokens is an encoding if and only if each neighbouring pair is
the encoding of its own bytes. So the state of a prefix is one token: to extend a prefix by a
byte, take the token that ends there and is compatible with the last token of the prefix it
leaves. The distinct words of a chunk of texts are walked as a trie, depth first (sorted
order visits a trie's nodes in that order, and the state stack is kept up to the common
prefix with the word before), so the encoding of a shared prefix is computed once. Per depth
only the last token is kept; its length says where it begins, so the ids of a word are read
off by walking back from its end, and time and memory are linear in the length of a word.

Texts are cut at safe boundaries; the ids of a part are remembered in a table of bounded
size (entries and bytes), which only saves time. A task holds one chunk of texts and these
tables.

Defined results: a null text is encoded as the empty text; a text of any length is encoded
whole; special strings inside texts become their own id, as the library does by default.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pidlink.llm.boundaries import safe_parts
from pidlink.llm.common import pieces

#: Fixed value: the word pattern of this byte-level tokenizer format.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a table of remembered parts or words, and of compatible pairs.
REMEMBERED = 400_000
PAIRS = 300_000
#: Characters of keys and bytes of ids in a table of remembered parts or words.
REMEMBERED_BYTES = 32 << 20
CHUNK_BYTES = 2 << 20


def byte_characters() -> dict[str, int]:
    """Character that stands for each byte in the vocabulary file -> the byte: printable
    Latin-1 characters stand for themselves, the other bytes for U+0100 onwards."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Remembered:
    """A table of bounded size: what was not asked for since it was last half full is forgotten.
    All that one call of ``missing`` asks for stays at hand until the next call."""

    def __init__(self, most: int = REMEMBERED, most_bytes: int = REMEMBERED_BYTES):
        self.most, self.most_bytes, self.now, self.old, self.held = most, most_bytes, {}, {}, 0

    def missing(self, keys: set[str]) -> set[str]:
        if len(self.now) > self.most // 2 or self.held > self.most_bytes // 2:
            self.now, self.old, self.held = {}, self.now, 0
        unknown = keys - self.now.keys()
        back = unknown & self.old.keys()
        self.add((k, self.old[k]) for k in back)
        return unknown - back

    def add(self, items: Iterable[tuple[str, bytes]]) -> None:
        for key, value in items:
            self.now[key] = value
            self.held += len(key) + len(value)


class TrieEncoder:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_characters()

        def raw(token: str) -> bytes:
            return bytes(chars[c] for c in token)

        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in vocab.items():
            self.tokens[i] = raw(token)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(merges):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.single = {self.tokens[i][0]: i for i in vocab.values() if len(self.tokens[i]) == 1}
        # every prefix of a token -> the token's id, or -1 if it is only a prefix
        self.prefixes: dict[bytes, int] = {}
        for i in vocab.values():
            t = self.tokens[i]
            self.prefixes[t] = i
            for n in range(1, len(t)):
                self.prefixes.setdefault(t[:n], -1)
        for text, i in special.items():
            self.tokens[i] = text.encode()
        self.special = special
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(s) for s in special) + ")") if special else None
        self.packed = [np.array([i], "<u4").tobytes() for i in range(len(self.tokens))]
        self.words = regex.compile(WORD_PATTERN)
        self.pairs: dict[int, bool] = {}
        self.known_words = Remembered()
        self.known_heads = Remembered()
        self.known_tails = Remembered()

    def merged(self, data: bytes) -> list[int]:
        """BPE by its definition: merge the pair of least rank until none is left."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            best = min(((self.merge.get(p, (1 << 60, 0)), i) for i, p in enumerate(zip(ids, ids[1:]))), default=None)
            (rank, joined), at = best
            if rank == 1 << 60:
                break
            ids[at:at + 2] = [joined]
        return ids

    def compatible(self, last: int, token: int) -> bool:
        """Whether ``token`` can follow ``last`` (-1: begin a word) in an encoding; remembered."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        want = [token] if last < 0 else [last, token]
        found = self.pairs[last << 20 | token] = self.merged(b"".join(self.tokens[t] for t in want)) == want
        return found

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Packed ids of each distinct word, by a depth-first walk of their trie."""
        begins, packed, pairs, tokens = self.prefixes.get, self.packed, self.pairs, self.tokens
        out: dict[bytes, bytes] = {}
        # by depth: last token, length of the longest suffix that begins a token
        last, reach = [-1], [0]
        before = b""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], reach[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                n = reach[-1] + 1
                token = begins(word[end - n:end])
                while token is None:
                    n -= 1
                    token = begins(word[end - n:end])
                reach.append(n)
                while True:
                    if token is not None and token >= 0:
                        pair = last[end - n] << 20 | token
                        if pairs[pair] if pair in pairs else self.compatible(last[end - n], token):
                            break
                    n -= 1
                    token = begins(word[end - n:end])
                last.append(token)
            ids, end = [], len(word)
            while end:
                token = last[end]
                ids.append(packed[token])
                end -= len(tokens[token])
            ids.reverse()
            out[word] = b"".join(ids)
            before = word
        return out

    def _learn(self, known: Remembered, wanted: set[str], before: str) -> None:
        """Make the ids of all wanted parts known; ``before`` stands before each of them."""
        split = {p: self.words.findall(before + p) for p in known.missing(wanted)}
        words = set().union(*split.values())
        new = {w: w.encode() for w in self.known_words.missing(words)}
        found = self.encode_words(new.values())
        self.known_words.add((w, found[b]) for w, b in new.items())
        get = self.known_words.now.__getitem__
        known.add((p, b"".join(map(get, ws))) for p, ws in split.items())

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Packed little-endian ids of each text."""
        rows: list[list[tuple[str, list[str]] | bytes]] = []
        heads: set[str] = set()
        tails: set[str] = set()
        for text in texts:
            row: list[tuple[str, list[str]] | bytes] = []
            runs = [text or ""]
            if self.special_pattern is not None and self.special_pattern.search(runs[0]):
                runs = self.special_pattern.split(runs[0])
            for run in runs:
                if run in self.special:
                    row.append(self.packed[self.special[run]])
                elif run:
                    head, *tail = safe_parts(run)
                    row.append((head, tail))
                    heads.add(head)
                    tails.update(tail)
            rows.append(row)
        self._learn(self.known_heads, heads, "")
        self._learn(self.known_tails, tails, " ")
        first, other = self.known_heads.now.__getitem__, self.known_tails.now.__getitem__
        return [b"".join([r if isinstance(r, bytes) else first(r[0]) + b"".join(map(other, r[1])) for r in row])
                for row in rows]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def _lists(packed: list[bytes]) -> pa.Array:
    sizes = np.array([len(p) // 4 for p in packed], np.int64)
    flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))


def encode_batches(batches: Iterable[pa.RecordBatch], path: str, packed: bool, decoded: bool,
                   verified: bool = False) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        texts = batch.column("text").to_pylist()
        ids = enc.encode_batch(texts)
        if verified and any(enc.decode(p) != (t or "") for p, t in zip(ids, texts)):
            raise ValueError("ids do not decode to their text")
        sizes = pa.array([len(p) // 4 for p in ids], pa.int64())
        out = [batch.column(c) for c in batch.schema.names if c != "text"]
        names = [c for c in batch.schema.names if c != "text"]
        out += [sizes, pa.array(ids, pa.binary()) if packed else _lists(ids)]
        names += ["n_tokens", "ids"]
        if decoded:
            out.append(pa.array([enc.decode(p) for p in ids], pa.string()))
            names.append("decoded")
        yield pa.RecordBatch.from_arrays(out, names)


def encoded(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), packed: bool = False,
            decoded: bool = False, verified: bool = False) -> DataFrame:
    """The columns ``keep``, n_tokens, ids (array<int>, or little-endian 32-bit integers in a
    binary with ``packed``), and with ``decoded`` the text that the ids decode to. With
    ``verified`` all ids are decoded and must give their text, or the job fails.

    ``path`` names a vocabulary file that every executor can read."""
    schema = T.StructType([docs.schema[c] for c in keep])
    schema = schema.add("n_tokens", "long").add("ids", T.BinaryType() if packed else T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded", "string")
    run: Callable = partial(encode_batches, path=path, packed=packed, decoded=decoded, verified=verified)
    return docs.select(*keep, "text").mapInArrow(run, schema)
