"""Token counts with a whole-token shortcut.

``prove`` encodes every vocabulary string alone, once, on the driver; those that come back as
exactly one token are the whole tokens (about as many as the vocabulary has entries, whatever the
corpus).  A task cuts texts into pre-tokens (spans.py); one that is a whole token counts one without
any merge, and only the rest goes through the tokenizer's merges, each distinct one once: counts are
kept in a table that starts afresh when full.

Rows with characters whose class differs between Unicode versions, or with one of the file's added
tokens, are encoded whole by the library, which treats the added tokens by its default.

Cases: null and empty texts have no bytes and no tokens; repeated rows and ids get one row each; a
very long text is a chunk of its own; an empty table gives no rows; only doc_id and
text are read, whatever other columns are named.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import load_tokenizer
from .spans import CharacterClasses, KnownSpans, per_row, pre_tokens, rows_with, span_hashes
from .textnp import text_chunks

LIMIT = 1024
CACHE_SPANS = 200_000
COUNTS = "doc_id long, n_bytes long, n_tokens long"


def byte_strings(vocab: dict[str, int]) -> dict[int, bytes]:
    """Bytes of every token of a byte-level vocabulary, whose strings show each byte as a printable
    character: itself if printable in Latin-1, else the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown}
    byte_of.update((chr(256 + k), b) for k, b in enumerate(sorted(set(range(256)) - set(shown))))
    return {i: bytes(byte_of[c] for c in token) for token, i in vocab.items() if all(c in byte_of for c in token)}


def added_tokens(tokenizer) -> list[str]:
    """Added tokens of a file that single rows can serve; any other file is refused."""
    spec = json.loads(tokenizer.to_str())
    cut = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError("expected a byte-level file without normalizer or prefix space")
    for t in spec["added_tokens"]:
        if t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]):
            raise ValueError(f"added token {t['content']!r} may reach beyond itself")
    return [t["content"] for t in spec["added_tokens"]]


def prove(path: str) -> frozenset[str]:
    """Vocabulary strings that encode alone as one token."""
    tokenizer = load_tokenizer(path)
    added = set(added_tokens(tokenizer))
    texts = []
    for i, raw in byte_strings(tokenizer.get_vocab(with_added_tokens=False)).items():
        try:
            texts.append(raw.decode())
        except UnicodeDecodeError:
            continue  # part of a character: never a pre-token
    texts = [t for t in texts if not any(a in t for a in added)]
    return frozenset(t for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False))
                     if len(e.ids) == 1)


class TokenCounter:
    """Tokens of texts; ``whole`` are the proven strings.  A span's hash stands for it (64 bits)."""

    def __init__(self, path: str, whole: frozenset[str], limit: int = CACHE_SPANS):
        self.tokenizer, self.limit = load_tokenizer(path), limit
        self.added = [t.encode() for t in added_tokens(self.tokenizer)]
        self.classes = CharacterClasses()
        raw = [t.encode() for t in sorted(whole)]
        at = np.cumsum([0] + [len(x) for x in raw])
        self.whole = np.sort(span_hashes(np.frombuffer(b"".join(raw), np.uint8), at[:-1])) if raw else np.zeros(1, np.uint64)
        self.known = KnownSpans()  # hash to number of tokens

    def _merge(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Tokens of every row."""
        start = pre_tokens(data, offs, self.classes, rows_with(data, offs, self.added))
        if not len(start):
            return np.zeros(len(offs) - 1, np.int64)
        key, first, number = np.unique(span_hashes(data, start), return_index=True, return_inverse=True)
        counts = np.ones(len(key), np.int64)
        rest = np.flatnonzero(self.whole[np.minimum(np.searchsorted(self.whole, key), len(self.whole) - 1)] != key)
        if len(self.known) > self.limit:
            self.known = KnownSpans()
        counts[rest] = self.known.find(key[rest])
        new, end = np.flatnonzero(counts < 0), np.append(start[1:], len(data))
        for lo in range(0, len(new), 5_000):
            at = first[new[lo:lo + 5_000]]
            counts[new[lo:lo + 5_000]] = self._merge([data[a:b].tobytes().decode() for a, b in zip(start[at].tolist(), end[at].tolist())])
        self.known.add(key[new], counts[new])
        return per_row(counts[number], np.searchsorted(start, offs))


def _count(path: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path, shared.value)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offs)), pa.array(counter(data, offs))],
                    names=["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(prove(path))  # bounded by the vocabulary
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_count(path, shared), COUNTS).withColumn("over_limit", F.col("n_tokens") > limit)
