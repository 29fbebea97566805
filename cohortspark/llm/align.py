"""Cross-tokenizer alignment by lockstep vectorised merging.

Every text, with a space before it, is encoded by a byte-level vocabulary (A) and a piece vocabulary
(B).  Both token sequences cover the same bytes, so their ends are merged like two sorted lists: a
link is a pair of tokens that overlap, and a cut is a byte offset where both end.

All documents of a chunk are merged at once: state vectors hold the next A and B token of every
lane; each step emits one link a lane, advances the side (or both) whose token ends first, marks a
cut where both end, and drops lanes that have ended.  A lane is a document, or a stretch of a long
one between two sampled A ends that are B ends as well, so that one long text doesn't leave the
vectors empty.

A block, some chunks in a row, lists its distinct id pairs with the number of its documents that hold
them.  Spark adds these up over all blocks and finds the largest count of every A id; each block gets back the
counts of its own pairs, and its documents look them up by place.  No key of that join holds
more rows than there are blocks.

Texts are cut into spans that each vocabulary encodes independently (spans.py), which are encoded
once and looked up afterwards, in tables bounded by entries and by ids.

Cases: null and empty texts, and texts whose A or B bytes differ from space+text, have no tokens:
zeros and empty groups; repeated rows count as documents of their own; null ids are carried
through; a very long text is a chunk of its own; an empty table gives no rows; only doc_id and text
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .packing import IdPool, load_tokenizer
from .spans import CharacterClasses, KnownSpans, bigram_spans, joined_pairs, per_row, pre_tokens, span_hashes
from .textnp import text_chunks
from .token_counts import byte_strings

CHUNK_BYTES, BLOCK_BYTES = 1 << 19, 16 << 20
SLICE_ROWS = 1_000
LANE = 256
CACHE_SPANS, CACHE_IDS = 200_000, 4_000_000
SPACE = "▁"

#: Rows of documents (keys null) and, one a block, of its distinct pairs (keys set).
ALIGNED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "pos array<int>, times array<int>, keys array<long>, held array<int>")
ALIGNED_NAMES = [x.split()[0] for x in ALIGNED.split(", ")]


def vocabulary_size(path_b: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()


class PairEncoder:
    """Token ids of texts by both vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = load_tokenizer(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.joined = joined_pairs([p for i, p in enumerate(pieces) if not self.b.is_byte(i)], SPACE)
        if self.joined[10].any() or self.joined[:, 10].any():
            raise ValueError("a piece joins line ends with other characters")
        vocab = self.a.get_vocab()
        shown = byte_strings(vocab)
        shown.update((i, token.encode()) for token, i in vocab.items() if i not in shown)
        self.a_bytes = [shown.get(i, b"") for i in range(max(shown) + 1)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.known_a, self.known_b = SpanIds(self.a_bytes), SpanIds(self.b_bytes)

        self.classes = CharacterClasses()

    def _a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]

    def _b(self, texts: list[str]) -> list[list[int]]:
        """The library adds a space before a text; a line end, which no piece joins with anything,
        keeps it apart, and both are taken off again."""
        return [ids[2:] for ids in self.b.encode(["\n" + t for t in texts], num_threads=1)]

    def __call__(self, data: np.ndarray, offs: np.ndarray):
        """A ids, their number per row, B ids, their number per row, and which rows keep their bytes."""
        a, n_a, good_a = self.known_a(data, offs, pre_tokens(data, offs, self.classes), self._a)
        b, n_b, good_b = self.known_b(data, offs, bigram_spans(data, offs, self.joined), self._b)
        return a, n_a, b, n_b, good_a & good_b


class SpanIds:
    """Ids of spans that have been met, bounded by entries and by ids; starts afresh when full."""

    def __init__(self, token_bytes: list[bytes]):
        self.flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.at = np.cumsum([0] + [len(x) for x in token_bytes])
        self.size = np.diff(self.at)
        self.clear()

    def clear(self) -> None:
        self.known, self.ids, self.bad = KnownSpans(), IdPool(), set()

    def _keeps(self, ids: np.ndarray, lens: np.ndarray, data: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which spans (``size`` bytes each, ``data`` together) are spelled by their ids."""
        spelled = self.size[ids]
        bounds = np.concatenate([[0], np.cumsum(lens)])
        total = np.concatenate([[0], np.cumsum(spelled)])
        same = total[bounds[1:]] - total[bounds[:-1]] == size
        if not same.all():  # one by one: the bytes are shifted from here on
            ends = np.cumsum(size)
            word = lambda i: self.flat[self.at[i]:self.at[i + 1]].tobytes()
            return np.array([b"".join(map(word, ids[a:b].tolist())) == data[e - n:e].tobytes()
                             for a, b, e, n in zip(bounds[:-1], bounds[1:], ends, size)], bool)
        wrong = self.flat[np.repeat(self.at[ids] - total[:-1], spelled) + np.arange(total[-1])] != data
        return per_row(wrong, np.concatenate([[0], np.cumsum(size)])) == 0

    def __call__(self, data: np.ndarray, offs: np.ndarray, start: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, their number per row, and whether a row's ids have its bytes."""
        key, at, number = np.unique(span_hashes(data, start), return_index=True, return_inverse=True)
        if len(self.known) > CACHE_SPANS or self.ids.at[self.ids.n] > CACHE_IDS:
            self.clear()
        lists = self.known.find(key)
        new, end = np.flatnonzero(lists < 0), np.append(start[1:], len(data))
        for lo in range(0, len(new), 2_000):
            part = new[lo:lo + 2_000]
            raw = [data[a:b].tobytes() for a, b in zip(start[at[part]].tolist(), end[at[part]].tolist())]
            found = encode([x.decode() for x in raw])
            lens = np.array([len(x) for x in found], np.int64)
            ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lens.sum()))
            keeps = self._keeps(ids, lens, np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw], np.int64))
            self.bad.update((self.ids.n + np.flatnonzero(~keeps)).tolist())
            lists[part] = np.arange(self.ids.n, self.ids.n + len(part))
            self.ids.append(ids, lens)
        self.known.add(key[new], lists[new])
        first = np.searchsorted(start, offs)
        good = np.ones(len(offs) - 1, bool)
        if self.bad:
            good = per_row(np.isin(lists, list(self.bad))[number], first) == 0
        ids, n = self.ids.gather(lists[number], first)
        return ids, n, good


class BlockPairs:
    """Distinct id pairs of a block in the order in which they came, and how many documents hold them."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.sorted, self.place, self.held = (np.zeros(0, np.int64) for _ in range(3))

    def places(self, pairs: np.ndarray) -> np.ndarray:
        """Places of pairs (of one document each), which are counted."""
        keys, inverse, count = np.unique(pairs, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.sorted, keys)
        old = np.zeros(len(keys), bool)
        old[at < len(self.sorted)] = self.sorted[at[at < len(self.sorted)]] == keys[at < len(self.sorted)]
        place = np.empty(len(keys), np.int64)
        place[old] = self.place[at[old]]
        place[~old] = len(self.held) + np.arange(int((~old).sum()))
        self.sorted, self.place = np.insert(self.sorted, at[~old], keys[~old]), np.insert(self.place, at[~old], place[~old])
        self.held = np.concatenate([self.held, np.zeros(int((~old).sum()), np.int64)])
        self.held[place] += count
        return place[inverse]

    def row(self) -> pa.RecordBatch:
        keys = np.empty(len(self.sorted), np.int64)
        keys[self.place] = self.sorted
        lists = [pa.ListArray.from_arrays([0, len(keys)], pa.array(x)) for x in (keys, self.held.astype(np.int32))]
        return pa.RecordBatch.from_arrays([pa.array([self.number]), *[pa.nulls(1, pa.int64())] * 5, pa.nulls(1, pa.string()),
                                           *[pa.nulls(1, pa.list_(pa.int32()))] * 2, *lists], names=ALIGNED_NAMES)


def lockstep(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) in order, and whether both end there, of two sequences of token ends
    over the same bytes."""
    sample = np.append(np.arange(LANE - 1, len(a_end) - 1, LANE), len(a_end) - 1)
    at = np.searchsorted(b_end, a_end[sample])
    both = b_end[np.minimum(at, len(b_end) - 1)] == a_end[sample]
    last_a, last_b = sample[both], at[both]  # lanes end with these tokens
    pa_, pb = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
    stop, place = a_end[last_a], pa_ + pb  # a lane has fewer links than tokens
    link_a = np.full(len(a_end) + len(b_end), -1, np.int32)
    link_b, cut = np.empty_like(link_a), np.zeros(len(link_a), bool)
    ends_a, ends_b = a_end[pa_], b_end[pb]
    while len(pa_):
        link_a[place], link_b[place] = pa_, pb
        meet = ends_a == ends_b
        cut[place] = meet
        pa_, pb, place = pa_ + (ends_a <= ends_b), pb + (ends_b <= ends_a), place + 1
        done = meet & (ends_a == stop)
        if done.any():
            on = ~done
            pa_, pb, place, stop = pa_[on], pb[on], place[on], stop[on]
        ends_a, ends_b = a_end[pa_], b_end[pb]
    made = np.flatnonzero(link_a >= 0)
    return link_a[made], link_b[made], cut[made]


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to size-1, left-aligned, and their number."""
    text = np.arange(size).astype("S")
    table = text.view(np.uint8).reshape(size, -1)
    return table, (table > 0).sum(axis=1)


def group_text(a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray, cut: np.ndarray, links: np.ndarray,
               digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3` of every document as one byte buffer with offsets; ``links`` is the
    number of links of each document."""
    group = np.concatenate([[0], np.cumsum(cut)[:-1]]) if len(cut) else np.zeros(0, np.int64)
    ga, gb = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    ga[link_a], gb[link_b] = group, group
    groups = int(group[-1]) + 1 if len(group) else 0
    upto_a, upto_b = np.searchsorted(ga, np.arange(groups + 1)), np.searchsorted(gb, np.arange(groups + 1))
    ids, sep = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    at_a, at_b = np.arange(len(a)) + upto_b[ga], np.arange(len(b)) + upto_a[gb + 1]
    ids[at_a], ids[at_b] = a, b
    sep[at_a[upto_a[1:] - 1]] = ord("|")
    sep[at_b[upto_b[1:] - 1]] = ord(";")
    table, width = digits
    size = width[ids] + 1
    total = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(int(total[-1]), np.uint8)
    for d in range(table.shape[1]):
        has = np.flatnonzero(size > d + 1)
        out[total[has] + d] = table[ids[has], d]
    out[total[1:] - 1] = sep
    # a document ends with its last group's ';', which is left out
    last = np.cumsum(links)[links > 0] - 1
    closing = total[at_b[link_b[last]] + 1] - 1
    keep = np.ones(len(out), bool)
    keep[closing] = False
    ends = np.zeros(len(links), np.int64)
    ends[links > 0] = closing - np.arange(len(closing))
    return out[keep], np.concatenate([[0], np.maximum.accumulate(ends)])


def _align(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PairEncoder(path_a, path_b)
        base = len(encoder.b_bytes)
        scale = len(encoder.a_bytes) * base
        digits = _digits(max(len(encoder.a_bytes), base))
        block = BlockPairs(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(begin, SLICE_ROWS)
                text = pc.fill_null(part.column(1), "")
                text = pc.binary_join_element_wise(pa.scalar(" ", text.type), text, pa.scalar("", text.type))
                for lo, hi, data, offs in text_chunks(text, CHUNK_BYTES):
                    if block.bytes and block.bytes + len(data) > BLOCK_BYTES:
                        yield block.row()
                        block = BlockPairs(block.number + 1)
                    block.bytes += len(data)
                    yield _aligned_rows(part.column(0).slice(lo, hi - lo), encoder(data, offs), np.diff(offs) > 1, encoder, base, scale, digits, block)
        yield block.row()
    return run


def _aligned_rows(names: pa.Array, tokens, full: np.ndarray, encoder: PairEncoder, base: int, scale: int, digits, block: BlockPairs) -> pa.RecordBatch:
    a, n_a, b, n_b, good = tokens
    good = good & full
    if not good.all():
        a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
    rows = len(names)
    if len(a):
        link_a, link_b, cut = lockstep(np.cumsum(encoder.a_size[a]), np.cumsum(encoder.b_size[b]))
    else:
        link_a, link_b, cut = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, bool)
    doc = np.repeat(np.arange(rows), n_a)[link_a]
    n_links, n_groups = np.bincount(doc, minlength=rows), np.bincount(doc[cut], minlength=rows)
    buffer, at = group_text(a, b, link_a, link_b, cut, n_links, digits)
    own, times = np.unique(doc * scale + a[link_a].astype(np.int64) * base + b[link_b], return_counts=True)
    places = block.places(own % scale).astype(np.int32)
    bounds = pa.array(np.searchsorted(own, np.arange(rows + 1) * scale).astype(np.int32))
    empty = [pa.nulls(rows, pa.list_(kind)) for kind in (pa.int64(), pa.int32())]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(rows, block.number)), names, pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links),
        pa.LargeStringArray.from_buffers(rows, pa.py_buffer(at), pa.py_buffer(buffer)).cast(pa.string()),
        pa.ListArray.from_arrays(bounds, pa.array(places)), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))), *empty],
        names=ALIGNED_NAMES)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The alignment of every document, as a written table.  Rows of documents (``keys`` is null):
    block, doc_id, n_a, n_b, n_groups, n_links, groups (`a1,a2|b1;a3|b2,b3`), and its distinct id
    pairs as places ``pos`` in its block's list with their ``times``; one row per block: its
    pairs' ``keys`` (A id times B's vocabulary size plus B id) and the documents that hold them."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(docs.mapInArrow(_align(path_a, path_b), ALIGNED), "align")


def pair_counts(aligned: DataFrame, b_vocabulary: int) -> DataFrame:
    """key, a_id, b_id, n_docs, best (no pair of that A id is in more documents); a written table."""
    held = aligned.where("keys is not null").select(F.explode(F.arrays_zip("keys", "held")).alias("p"))
    counts = held.groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.held").alias("n_docs"))
    counts = materialize(counts.withColumns({"a_id": F.expr(f"key div {b_vocabulary}"), "b_id": F.expr(f"key % {b_vocabulary}")}),
                         "align-pairs")
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    return materialize(counts.join(most, "a_id").select("key", "a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")),
                       "align-counts")


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and side: a block's counts in the order of their places, then documents."""
    block, parts, counts, best = None, [], None, None
    for batch in batches:
        blocks, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(blocks):
            continue
        edge = np.flatnonzero((blocks[1:] != blocks[:-1]) | (side[1:] != side[:-1])) + 1
        out = []
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(blocks)]):
            part = batch.slice(lo, hi - lo)
            if blocks[lo] != block:
                block, parts, counts = blocks[lo], [], None
            if side[lo] == 0:
                parts.append((part.column(3).to_numpy(), part.column(4).to_numpy(zero_copy_only=False)))
                continue
            if counts is None:
                counts = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
                best = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, bool)
                parts = []
            pos, times = part.column(11), part.column(12)
            bounds = pos.offsets.to_numpy().astype(np.int64)
            first = int(bounds[0])
            pos = pos.values.to_numpy()[first:bounds[-1]]
            times = times.values.to_numpy()[times.offsets[0].as_py():times.offsets[-1].as_py()].astype(np.int64)
            out.append((part, per_row(times * best[pos], bounds - first), per_row(times * counts[pos], bounds - first)))
        for part, n_best, count_sum in out:
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(5, 11)), pa.array(n_best), pa.array(count_sum)],
                                             names=[x.split()[0] for x in SCORED.split(", ")])


SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"


def score_links(aligned: DataFrame, counts: DataFrame, groups=None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum of every document; ``groups``
    may name another column expression (a digest) to carry instead of the text."""
    listed = aligned.where("keys is not null").select("block", F.posexplode("keys").alias("place", "key"))
    none = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string",
            "pos": "array<int>", "times": "array<int>"}
    marks = listed.join(counts.select("key", "n_docs", "best"), "key").select(
        "block", F.lit(0).alias("side"), "place", "n_docs", "best", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    rows = aligned.where("keys is null").withColumn("groups", F.col("groups") if groups is None else groups).select(
        "block", F.lit(1).alias("side"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("n_docs"), F.lit(False).alias("best"), *none)
    both = marks.unionAll(rows).repartition("block").sortWithinPartitions("block", "side", "place")
    return both.mapInArrow(_look_up, SCORED)
