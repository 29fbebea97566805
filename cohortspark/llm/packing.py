"""Packing token sequences by power-of-two decomposition.

A document of n tokens becomes floor(n / 4096) pieces of 4096 tokens and one piece for every set
bit of the rest, longest first.  Pieces of equal length form a bucket, from which batches are
drawn; every sequence is one piece, so none crosses documents and none needs padding.

Tokenizing: spaces and line ends separate pre-tokens of the vocabulary's tokenizer.  A chunk between
them that holds only ASCII and Latin-1 letters, digits and marks is lower-cased and cut into its
pre-tokens by byte classes, in numpy; any other chunk is one span.  Each distinct span is encoded
once and looked up afterwards, and span numbers are expanded to token ids.  A task's cache is
bounded by entries and by ids, starts afresh when full, and goes with the task.

Cases: null text is empty; an empty text has just the end id (one piece of length 1); a very long
text is cut into many pieces within its task; null and repeated doc_ids are carried through; an
empty table gives no pieces; only doc_id and text are read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.session import ensure_checkpoint_dir

from .common import bound_batches, tidy
from .spans import KnownSpans
from .textnp import IS_SPACE, LOWER, Words, text_chunks


def load_tokenizer(path: str):
    # a task has one core, and every further thread would keep memory of its own
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


MAX_LENGTH = 4096
END_ID = 2
CACHE_SPANS, CACHE_IDS = 400_000, 2_000_000
CHUNK = 1 << 19
TOGETHER = 100
#: Single bytes that keep their form under NFC and never join others in a pre-token of another
#: class (fixed values); an apostrophe may begin an ending such as 's, and < a special token.
PLAIN = np.zeros(256, bool)
PLAIN[[x for x in range(0x21, 0x7F) if x not in b"'<"]] = True
#: Latin-1 letters are 0xC3 and one of these bytes; the capitals' lower case is 0x20 further.
LATIN, LATIN_CAPITAL = (np.isin(np.arange(256), [x for x in codes if x not in (0x97, 0xB7)])
                        for codes in (range(0x80, 0xC0), range(0x80, 0x9F)))
SPACE, DIGIT, LETTER, OTHER = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[IS_SPACE] = SPACE
KIND[ord("0"):ord("9") + 1] = DIGIT
KIND[ord("a"):ord("z") + 1] = LETTER
KIND[128:] = LETTER

PIECES = ("doc_id long, start long, length long, bucket int, ids array<int>, ids_crc32 long, doc_tokens long")


def decompose(n: int, longest: int = MAX_LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole ``longest`` ones, then the rest's set bits."""
    out, start = [], 0
    while n - start >= longest:
        out.append((start, longest))
        start += longest
    for bit in range(longest.bit_length() - 1, -1, -1):
        if (n - start) >> bit & 1:
            out.append((start, 1 << bit))
            start += 1 << bit
    return out


class IdPool:
    """Append-only lists of token ids in one growing array; ``gather`` joins lists by number."""

    def __init__(self):
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 14, np.int64)  # at[k]:at[k+1] is list k
        self.n = 0

    def append(self, ids: np.ndarray, lens: np.ndarray) -> None:
        used = int(self.at[self.n])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(lens) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.flat[used:used + len(ids)] = ids
        self.at[self.n + 1:self.n + 1 + len(lens)] = used + np.cumsum(lens)
        self.n += len(lens)

    def gather(self, lists: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the lists in order, and their number between consecutive ``bounds``."""
        starts = self.at[lists]
        lens = self.at[lists + 1] - starts
        total = np.concatenate([[0], np.cumsum(lens)])
        take = np.repeat(starts - total[:-1], lens)
        take += np.arange(total[-1])
        return self.flat[take], np.diff(total[bounds])


def spans(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of a chunk of texts, start and end of its spans, and which of them are
    whole chunks that are not plain (left as they are)."""
    data, n = words.data, len(words.data)
    good = PLAIN[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[LATIN[data[lead + 1]]]
    good[lead] = good[lead + 1] = True
    low = LOWER[data]
    capital = lead[LATIN_CAPITAL[data[lead + 1]]] + 1
    low[capital] += 0x20
    bad = np.flatnonzero(~good & ~IS_SPACE[data])
    odd = np.zeros(len(words.start), bool)
    odd[np.searchsorted(words.start, bad, side="right") - 1] = True
    kind = KIND[low]
    begins = kind == DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    begins &= kind != SPACE
    if odd.any():
        edge = np.zeros(n + 1, np.int8)
        edge[words.start[odd]] += 1
        edge[words.end[odd]] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
        low[inside] = data[inside]
        begins &= ~inside
    chunk = np.zeros(n, bool)
    chunk[words.start] = True
    start = np.flatnonzero(begins | chunk)
    of = np.cumsum(chunk[start]) - 1
    return low, start, np.minimum(np.append(start[1:], n), words.end[of]), odd[of]


class ChunkEncoder:
    """Token ids of whole texts through a cache of their spans."""

    def __init__(self, path: str, limit: int = CACHE_SPANS):
        self.tokenizer = load_tokenizer(path)
        self.limit = limit
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known = KnownSpans()
        self.lists = IdPool()

    def _learn(self, new: list[bytes], plain: bool) -> None:
        """Appends the ids of spans; plain ones are encoded together, ``TOGETHER`` as one text (the
        tokenizer marks the last id of each), any other by itself."""
        texts = [b" ".join(new[k:k + TOGETHER]) for k in range(0, len(new), TOGETHER)] if plain else new
        got = [np.array(x.ids, np.uint32) for x in
               self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        ids = np.concatenate(got)
        lens = np.array([len(x) for x in got])
        if plain:
            lens = np.diff(np.flatnonzero(self.ends_word[ids]) + 1, prepend=0)
            if len(lens) != len(new):
                raise RuntimeError("the tokenizer cuts spans otherwise")
        self.lists.append(ids, lens)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each row, of UTF-8 texts (bytes, row offsets)."""
        words = Words(data, offs)
        if not len(words.start):
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        words.data, words.start, words.end, odd = spans(words)
        key, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.known) > self.limit or self.lists.at[self.lists.n] > CACHE_IDS:
            self.clear()
        lists = self.known.find(key)
        new = np.flatnonzero(lists < 0)
        for plain in (True, False):
            own = new[odd[first[new]] != plain]
            for lo in range(0, len(own), 10_000):
                part = own[lo:lo + 10_000]
                at, lists[part] = first[part], np.arange(self.lists.n, self.lists.n + len(part))
                self._learn([words.data[a:b].tobytes() for a, b in zip(words.start[at].tolist(), words.end[at].tolist())], plain)
        self.known.add(key[new], lists[new])
        return self.lists.gather(lists.astype(np.int64)[number], np.searchsorted(words.start, offs))


def _pieces(path: str, end_id: int, longest: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(1), CHUNK):
                ids, counts = encoder.encode(data, offs)
                names = batch.column(0).slice(lo, hi - lo).to_pylist()
                doc, start, length, total, arrays = [], [], [], [], []
                at = 0
                for name, n in zip(names, counts.tolist()):
                    own = np.append(ids[at:at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for s, size in decompose(n + 1, longest):
                        doc.append(name)
                        start.append(s)
                        length.append(size)
                        total.append(n + 1)
                        arrays.append(own[s:s + size])
                size = np.array(length, np.int64)
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                flat = np.concatenate(arrays).view("<i4") if arrays else np.zeros(0, "<i4")
                bounds = offsets.tolist()
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(bounds, bounds[1:])]  # of the ids that are returned
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(size),
                    pa.array(np.log2(size).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)) if keep_ids
                    else pa.nulls(len(doc), pa.list_(pa.int32())),
                    pa.array(crc, pa.int64()), pa.array(total, pa.int64())],
                    names=["doc_id", "start", "length", "bucket", "ids", "ids_crc32", "doc_tokens"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, longest: int = MAX_LENGTH,
         keep_ids: bool = True) -> DataFrame:
    """One row per sequence, which is one piece of one document: doc_id, start, length, bucket
    (log2 of the length), ids (null unless ``keep_ids``), ids_crc32, doc_tokens, sequence_id,
    offset (always 0)."""
    if longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.mapInArrow(tidy(_pieces(tokenizer_path, end_id, longest, keep_ids)), PIECES)
    return out.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Training files: one folder per bucket, so that a batch is read from equal lengths."""
    pieces.write.partitionBy("bucket").parquet(path)


def pack_buckets(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The sequences of ``docs`` with their ids, written by bucket into the checkpoint folder and
    read from there; the columns of ``pack``."""
    pieces = pack(docs, tokenizer_path)
    path = os.path.join(ensure_checkpoint_dir(docs.sparkSession), "tables", f"packed-buckets-{uuid.uuid4().hex}")
    write_buckets(pieces, path)
    return docs.sparkSession.read.schema(pieces.schema).parquet(path).select(pieces.columns)
