"""Language-model scoring with Brown classes.

P(w_i | history) = P(class(w_i) | class(w_i-1)) * P(w_i | class(w_i)); the end of a text is a token
in a class of its own and also the context of the first word.  Exchange clustering moves words to
the class that raises the class-bigram likelihood most.  It has two parts.  Seeds: the ``TOP`` most
frequent words one by one, and all other words pooled by their last two bytes into ``POOLED`` items,
are clustered one after the other from an item matrix of fixed size.  Then every training word,
however rare, is moved by its own counts of the classes before and behind it, all words of a round
at once against the round's class bigrams (distributed exchange); a round that lowers the
likelihood is taken back and ends the rounds.  Only words that no training text holds keep their pool's class.  Emissions use absolute
discounting (the freed mass of a class goes to its unseen words, taken as one type); transitions are
smoothed towards the class frequencies.

Word statistics cover all training documents and are never held whole anywhere.  The texts are read
once into blocks of bounded size: a block lists its distinct words by falling frequency, and its texts
become places in that list, so that no later pass moves or hashes a text.  A block's words, with their
class contexts, are cut by word hash into shards; a shard adds up its words over all blocks, moves
them and sends every block the class and count of just its own words.  A task holds one block's or
one shard's words.  The number of shards is spark.sql.shuffle.partitions.  Words are compared by a
64-bit hash; lists are compressed by byte planes.

Cases: null text is empty and scores its end token; a null doc_id is held out; repeated rows and
ids get one row each; with no training rows all counts are 0; an empty table gives no rows; only
doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, id_crc, materialize, shuffle_partitions, tidy
from .textnp import Words, text_chunks

FOLDS = 10
TOP, POOLED, CLASSES = 512, 128, 33  # the last class holds the end token alone
ITEMS = TOP + POOLED + 1
END = ITEMS - 1
ROUNDS = 20
WORD_ROUNDS = 2  # of all words
SLICE_ENTRIES = 50_000
HELD_ENTRIES = 2_000_000
BLOCK_TOKENS = 4_000_000  # a longer chunk of texts is a block of its own
BLOCK_STEP = 1_000_003  # from a task's block to its next; more than any stage's tasks


def word_pools(words: Words) -> np.ndarray:
    """The pooled item of every word, from its last two bytes."""
    last = words.data[words.end - 1].astype(np.int64)
    before = np.where(words.end - words.start > 1, words.data[np.maximum(words.end - 2, 0)], 0)
    return (last * 31 + before) % POOLED


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, train, text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_crc() % FOLDS != 0).alias("train"),
                       F.col("text").cast("string").alias("text"))


# --- word counts -----------------------------------------------------------------------------

def _merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their summed counts."""
    key, n = (np.concatenate(x) for x in zip(*parts))
    key, number = np.unique(key, return_inverse=True)
    return key, np.bincount(number, n, len(key)).astype(np.int64)


def _task_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["w", "n"])
    parts: list[tuple] = []
    for batch in batches:
        for _, _, data, offs in text_chunks(batch.column(0)):
            parts.append(np.unique(Words(data, offs, lower=True).hashes(), return_counts=True))
            if sum(len(p[0]) for p in parts) > HELD_ENTRIES:
                parts = [_merged(parts)]
                if len(parts[0][0]) > HELD_ENTRIES // 2:
                    yield emit(*parts.pop())
    if parts:
        yield emit(*_merged(parts))


def word_counts(texts: DataFrame) -> DataFrame:
    """w, c: every training word and its count."""
    rows = texts.where("train").select("text").mapInArrow(tidy(_task_words), "w long, n long")
    return materialize(rows.groupBy("w").agg(F.sum("n").alias("c")), "brown-words")


# --- classes ---------------------------------------------------------------------------------

def items_of(words: Words, h: np.ndarray, top: np.ndarray, item_of_top: np.ndarray) -> np.ndarray:
    """The item of every word; ``top`` are sorted hashes."""
    item = TOP + word_pools(words)
    if len(top):
        at = np.minimum(np.searchsorted(top, h), len(top) - 1)
        known = top[at] == h
        item[known] = item_of_top[at[known]]
    return item


def with_ends(values: np.ndarray, words: Words, end: int) -> np.ndarray:
    """The rows' values one after the other, each row followed by ``end``."""
    rows = len(words.count)
    out = np.full(len(values) + rows, end, values.dtype)
    out[np.arange(len(values)) + words.doc] = values
    return out


def _count_pairs(top: np.ndarray, item_of_top: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ITEMS * ITEMS, np.int64)
        for batch in batches:
            for _, _, data, offs in text_chunks(batch.column(0)):
                words = Words(data, offs, lower=True)
                item = with_ends(items_of(words, words.hashes(), top, item_of_top), words, END)
                last = np.concatenate([[END], item[:-1]])
                counts += np.bincount(last * ITEMS + item, minlength=len(counts))
        pair = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), pa.array(counts[pair])], names=["pair", "n"])
    return run


def _plogp(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(counts: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every item from the matrix of item bigrams; the last item keeps the last class.

    The likelihood is sum plogp(class bigrams) - sum plogp(left totals) - sum plogp(right
    totals).  Items are visited by falling frequency until a round moves none."""
    items = len(counts)
    total = counts.sum(axis=1) + counts.sum(axis=0)
    order = np.argsort(-total[:-1], kind="stable")
    label = np.empty(items, np.int64)
    label[order] = np.arange(items - 1) % (classes - 1)
    label[-1] = classes - 1
    onehot = np.eye(classes)[label]
    grid = onehot.T @ counts @ onehot
    for _ in range(rounds):
        moved = 0
        for w in order:
            if not total[w]:
                continue
            own, a = counts[w, w], label[w]
            right, left = np.bincount(label, counts[w], classes), np.bincount(label, counts[:, w], classes)
            right[a] -= own
            left[a] -= own
            grid[a] -= right
            grid[:, a] -= left
            grid[a, a] -= own
            rows, cols = grid.sum(axis=1), grid.sum(axis=0)
            to, from_ = right.sum() + own, left.sum() + own
            gain = (_plogp(grid + right) - _plogp(grid)).sum(axis=1) + (_plogp(grid.T + left) - _plogp(grid.T)).sum(axis=1)
            d = np.diag(grid)
            gain += _plogp(d + right + left + own) - _plogp(d + right) - _plogp(d + left) + _plogp(d)
            gain -= _plogp(rows + to) - _plogp(rows) + _plogp(cols + from_) - _plogp(cols)
            gain[-1] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            grid[b] += right
            grid[:, b] += left
            grid[b, b] += own
            moved += b != a
            label[w] = b
        if not moved:
            break
    return label


# --- all words -------------------------------------------------------------------------------

GRID, ORDER, WORDS, TEXTS = range(4)  # kinds of rows
CODED = ("block long, kind int, shard int, w binary, label binary, lens binary, ctx binary, n binary, "
         "doc_ids array<long>, held array<boolean>, counts binary, codes binary")
CONTEXTS = "block long, shard int, label binary, lens binary, ctx binary, n binary"
LABELS = "block long, shard int, label binary, old binary, c binary"


def packed(x: np.ndarray) -> bytes:
    """A list, compressed byte plane by byte plane."""
    if not len(x):
        return b""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return np.int64(raw.size).tobytes() + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpacked(raw: bytes, kind) -> np.ndarray:
    if not raw:
        return np.zeros(0, kind)
    size = int(np.frombuffer(raw, np.int64, 1)[0])
    planes = np.frombuffer(pa.decompress(raw[8:], size, "zstd"), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def as_batch(schema: str, rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<boolean>": pa.list_(pa.bool_())}
    columns = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in columns],
                                      names=[name for name, _ in columns])


@dataclass
class Coded:
    """A chunk of texts, its words as places in the block's word list."""
    ids: list
    held: np.ndarray
    count: np.ndarray        # words of every row
    code: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


@dataclass
class Seeds:
    top: np.ndarray          # sorted hashes of the most frequent words
    item_of_top: np.ndarray
    label: np.ndarray        # class of every item


class Contexts:
    """Class bigrams of training texts and, if ``whole``, a block's words with the classes before
    (0..) and behind (CLASSES..) them."""

    def __init__(self, whole: bool):
        self.whole = whole
        self.grid = np.zeros(CLASSES * CLASSES, np.int64)
        self.parts: list[tuple] = []

    def add(self, label: np.ndarray, texts: Coded) -> None:
        seq = with_ends(label[texts.code], texts, CLASSES - 1).astype(np.int64)
        last = np.concatenate([[CLASSES - 1], seq[:-1]])
        used = np.repeat(~texts.held, texts.count + 1)
        self.grid += np.bincount(last[used] * CLASSES + seq[used], minlength=len(self.grid))
        if not self.whole:
            return
        doc = texts.doc
        mine = ~texts.held[doc]
        place = (np.arange(len(doc)) + doc)[mine]
        code = texts.code[mine].astype(np.int64) * 2 * CLASSES
        self.parts.append(np.unique(np.concatenate([code + last[place], code + CLASSES + seq[place + 1]]), return_counts=True))
        if sum(len(x[0]) for x in self.parts[1:]) > HELD_ENTRIES:
            self.parts = [_merged(self.parts)]

    def by_shard(self, block: int, shard_of: np.ndarray, label: np.ndarray) -> Iterator[tuple[np.ndarray, dict]]:
        """The places of a shard's words and their row."""
        code, n = _merged(self.parts) if self.parts else (np.zeros(0, np.int64),) * 2
        self.parts = []
        word, ctx = code // (2 * CLASSES), code % (2 * CLASSES)
        lens = np.bincount(word, minlength=len(label)).astype(np.uint8)  # at most 2 * CLASSES
        order, entry = np.argsort(shard_of, kind="stable"), np.argsort(shard_of[word], kind="stable")
        shards = np.arange(int(shard_of.max(initial=0)) + 2)
        cuts, ends = (np.searchsorted(x, shards) for x in (shard_of[order], shard_of[word][entry]))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            own, ent = order[cuts[k]:cuts[k + 1]], entry[ends[k]:ends[k + 1]]
            yield own, {"block": block, "shard": k, "label": packed(label[own]), "lens": packed(lens[own]),
                        "ctx": packed(ctx[ent].astype(np.uint8)), "n": packed(n[ent].astype(np.uint32))}


def _code(shared, shards: int, size: int):
    """Blocks of texts: the shard of every word (ORDER), the words with their contexts by shard
    (WORDS), the coded texts (TEXTS); a task's class bigrams (GRID, of block -1)."""
    def block_rows(block: int, chunks: list, found: Contexts) -> Iterator[pa.RecordBatch]:
        w, first, at = np.unique(np.concatenate([x[3] for x in chunks]), return_index=True, return_inverse=True)
        label = np.concatenate([x[4] for x in chunks])[first]
        bounds = np.cumsum([0] + [len(x[3]) for x in chunks])
        code = [at[a:b][x[5]] for a, b, x in zip(bounds, bounds[1:], chunks)]
        order = np.argsort(-sum(np.bincount(x, minlength=len(w)) for x in code), kind="stable")
        place = np.empty(len(w), np.uint32)
        place[order] = np.arange(len(w), dtype=np.uint32)
        w, label = w[order], label[order]
        shard_of = (w % np.uint64(shards)).astype(np.uint32)
        rows = [{"block": block, "kind": ORDER, "codes": packed(shard_of)}]
        for (ids, held, count, *_), own in zip(chunks, code):
            texts = Coded(ids, held, count, place[own])
            found.add(label, texts)
            rows.append({"block": block, "kind": TEXTS, "doc_ids": ids, "held": held.tolist(),
                         "counts": packed(count.astype(np.uint32)), "codes": packed(texts.code)})
        rows += [{**row, "kind": WORDS, "w": packed(w[own])} for own, row in found.by_shard(block, shard_of, label)]
        yield as_batch(CODED, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, found = shared.value, Contexts(True)
        block, chunks, held_tokens = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(2)):
                words = Words(data, offs, lower=True)
                h = words.hashes()
                own, at, number = np.unique(h, return_index=True, return_inverse=True)
                label = seeds.label[items_of(words, h, seeds.top, seeds.item_of_top)[at]].astype(np.uint8)
                ids, train = (batch.column(k).slice(lo, hi - lo) for k in (0, 1))
                chunks.append((ids.to_pylist(), ~train.to_numpy(zero_copy_only=False), words.count, own, label,
                               number.astype(np.uint32)))
                held_tokens += len(h)
                if held_tokens >= size:
                    yield from block_rows(block, chunks, found)
                    block, chunks, held_tokens = block + BLOCK_STEP, [], 0
        if chunks:
            yield from block_rows(block, chunks, found)
        yield as_batch(CODED, [{"block": -1, "kind": GRID, "n": packed(found.grid)}])
    return run


def block_rows(coded: DataFrame, labels: DataFrame, *names: str) -> DataFrame:
    """The coded texts by block, behind their words' lists: the columns ``names`` of ``labels``."""
    n = shuffle_partitions(coded.sparkSession)
    rows = coded.where(f"kind in ({ORDER}, {TEXTS})").select("block", "kind", "shard", "doc_ids", "held", "counts", "codes")
    lists = labels.where("block >= 0").select("block", F.lit(WORDS).alias("kind"), "shard", *names)
    rows = rows.unionByName(lists, allowMissingColumns=True)
    part = F.pmod("block", F.lit(n)).cast("int")
    return rows.repartitionById(n, part).sortWithinPartitions("block", "kind", "shard")


def _blocks(batches: Iterator[pa.RecordBatch], **kinds) -> Iterator[tuple[int, np.ndarray, list, Coded]]:
    """(block, shard of its words, their lists named in ``kinds``, a chunk of its texts)."""
    shard_of, parts, lists = np.zeros(0, np.uint32), [], None
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            if row["kind"] == ORDER:
                shard_of, parts, lists = unpacked(row["codes"], np.uint32), [], None
            elif row["kind"] == WORDS:
                parts.append([unpacked(row[name], kind) for name, kind in kinds.items()])
            else:
                if lists is None:
                    order = np.argsort(shard_of, kind="stable")
                    if sum(len(p[0]) for p in parts) != len(order):
                        raise RuntimeError("a block's word list does not cover its texts")
                    lists = []
                    for i, kind in enumerate(kinds.values()):
                        values = np.zeros(len(order), kind)
                        values[order] = np.concatenate([p[i] for p in parts]) if parts else values
                        lists.append(values)
                    parts = []
                yield row["block"], shard_of, lists, Coded(row["doc_ids"], np.array(row["held"], bool),
                                                           unpacked(row["counts"], np.uint32).astype(np.int64),
                                                           unpacked(row["codes"], np.uint32))


def _contexts(whole: bool):
    """Class bigrams of the training texts (a row of block -1) and, if ``whole``, the contexts of the
    blocks' words by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, now = Contexts(whole), None

        def rows() -> Iterator[pa.RecordBatch]:
            if whole and now is not None:
                yield as_batch(CONTEXTS, [row for _, row in found.by_shard(*now)])
        for block, shard_of, (label,), texts in _blocks(batches, label=np.uint8):
            if now is not None and block != now[0]:
                yield from rows()
            now = block, shard_of, label
            found.add(label, texts)
        yield from rows()
        yield as_batch(CONTEXTS, [{"block": -1, "n": packed(found.grid)}])
    return run


def best_classes(grid: np.ndarray, label: np.ndarray, word: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class of every word that raises the likelihood of the class bigrams ``grid`` most.

    Entries (word, ctx, n) are sorted by word: ctx is the class before a word, or CLASSES + the class
    behind it.  Words without entries stay."""
    out = label.copy()
    beside = np.concatenate([grid, grid.T])  # by context, over the word's own class
    rows, cols = grid.sum(axis=1), grid.sum(axis=0)
    ends = np.flatnonzero(np.diff(word, append=-1)) + 1 if len(word) else np.zeros(0, np.int64)
    lo = 0
    while lo < len(word):
        hi = int(ends[max(np.searchsorted(ends, lo + SLICE_ENTRIES, side="right") - 1, np.searchsorted(ends, lo, side="right"))])
        w, m, k = word[lo:hi], n[lo:hi, None].astype(float), ctx[lo:hi]
        head = np.flatnonzero(np.diff(w, prepend=-1))
        own, a = w[head], label[w[head]].astype(np.int64)
        count = np.add.reduceat(np.where(k >= CLASSES, m[:, 0], 0.0), head)[:, None]
        base = beside[k]
        gain = np.add.reduceat(_plogp(base + m) - _plogp(base), head)
        gain -= _plogp(rows + count) - _plogp(rows) + _plogp(cols + count) - _plogp(cols)
        held = beside[k, label[w]]
        each = np.arange(len(own))
        gain[each, a] = np.add.reduceat(_plogp(held) - _plogp(np.maximum(held - m[:, 0], 0)), head)
        less = np.maximum(rows[a] - count[:, 0], 0), np.maximum(cols[a] - count[:, 0], 0)
        gain[each, a] -= _plogp(rows[a]) - _plogp(less[0]) + _plogp(cols[a]) - _plogp(less[1]) - 1e-9
        gain[:, -1] = -np.inf
        out[own] = np.argmax(gain, axis=1)
        lo = hi
    return out


def _move(shared):
    def run(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_pylist()
        of_block = {block: w for block, w in zip(column("block"), column("w")) if w is not None}
        rows = [r for r in zip(*map(column, ("block", "shard", "label", "lens", "ctx", "n"))) if r[2] is not None]
        parts = [[unpacked(x, kind) for x, kind in zip((of_block[r[0]], *r[2:]), (np.uint64, np.uint8, np.uint8, np.uint8, np.uint32))]
                 for r in rows]
        h, label, lens, ctx, n = (np.concatenate(x) for x in zip(*parts))
        word, at, number = np.unique(h, return_index=True, return_inverse=True)
        label = label[at]
        code, n = _merged([(np.repeat(number, lens).astype(np.int64) * 2 * CLASSES + ctx, n)])
        of, ctx = code // (2 * CLASSES), code % (2 * CLASSES)
        count = np.bincount(of[ctx >= CLASSES], n[ctx >= CLASSES], len(word)).astype(np.int64)
        new = best_classes(shared.value, label, of, ctx, n)
        kinds = [np.bincount(x[count > 0], minlength=CLASSES).astype(np.int64) for x in (new, label)]
        bounds = np.cumsum([0] + [len(x[0]) for x in parts])
        out = [{"block": r[0], "shard": r[1], "label": packed(new[number[a:b]]), "old": packed(label[number[a:b]]),
                "c": packed(count[number[a:b]])} for r, a, b in zip(rows, bounds, bounds[1:])]
        out.append({"block": -1, "label": packed(kinds[0]), "old": packed(kinds[1])})
        return pa.Table.from_batches([as_batch(LABELS, out)])
    return run


def likelihood(grid: np.ndarray) -> float:
    """Log likelihood of class bigrams, but for what depends on words alone."""
    return _plogp(grid).sum() - _plogp(grid.sum(axis=1)).sum() - _plogp(grid.sum(axis=0)).sum()


def _summed(rows: DataFrame, name: str, size: int) -> np.ndarray:
    return sum((unpacked(r[0], np.int64) for r in rows.where("block < 0").select(name).collect()), np.zeros(size))


def cluster(texts: DataFrame, seeds: Seeds, size: int) -> tuple[DataFrame, DataFrame, str, np.ndarray, np.ndarray]:
    """The coded texts, every block's words with class and count, the column that holds the class, the
    class bigrams of the training texts and the number of training words by class."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(seeds)
    coded = materialize(texts.mapInArrow(tidy(_code(shared, shuffle_partitions(spark), size)), CODED), "brown-coded")
    grid_of = lambda rows: _summed(rows, "n", CLASSES * CLASSES).reshape(CLASSES, CLASSES).astype(float)
    words, held = coded.where(f"kind = {WORDS}"), "label"
    rows, grid = words.select("block", "shard", "w", "label", "lens", "ctx", "n"), grid_of(coded)
    for k in range(WORD_ROUNDS):
        now = spark.sparkContext.broadcast(grid)
        labels = materialize(rows.groupBy("shard").applyInArrow(_move(now), LABELS), "brown-labels")
        found = block_rows(coded, labels, "label").mapInArrow(tidy(_contexts(k + 1 < WORD_ROUNDS)), CONTEXTS)
        found = materialize(found, "brown-contexts")
        after = grid_of(found)
        if likelihood(after) < likelihood(grid):
            held = "old"
            break
        grid = after
        rows = found.where("block >= 0").unionByName(words.select("block", "shard", "w"), allowMissingColumns=True)
    return coded, labels, held, grid, _summed(labels, held, CLASSES)


@dataclass
class BrownModel:
    step: np.ndarray         # log10 P(class | last class)
    size: np.ndarray         # training tokens of every class
    unseen: np.ndarray       # log10 P(an unseen word | class)
    discount: float
    tokens: int              # N and V of the training tokens, ends included
    types: int
    ends: int


def seed(rows: DataFrame, words: DataFrame) -> Seeds:
    """Clusters the items; what reaches the driver is bounded by their number."""
    best = words.orderBy(F.desc("c"), "w").limit(TOP).select("w").collect()
    top = np.array([r[0] for r in best], np.int64).view(np.uint64)
    rank = np.argsort(top)
    top, item_of_top = top[rank], rank
    texts = rows.where("train").select("text")
    pairs = (texts.mapInArrow(_count_pairs(top, item_of_top), "pair int, n long")
             .groupBy("pair").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(ITEMS * ITEMS)
    counts[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
    return Seeds(top, item_of_top, exchange(counts.reshape(ITEMS, ITEMS)))


def fit(texts: DataFrame, words: DataFrame, size: int) -> tuple[BrownModel, DataFrame, DataFrame, str]:
    """The estimates, the coded texts and the classes of all words by block (see ``cluster``)."""
    coded, labels, held, grid, kinds = cluster(texts, seed(texts, words), size)
    freq = (grid.sum(axis=0) + 0.5) / (grid.sum() + 0.5 * CLASSES)
    step = np.log10((grid + 20.0 * freq) / (grid.sum(axis=1, keepdims=True) + 20.0))
    per = words.agg(F.count("*").alias("types"), F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"),
                    F.count(F.when(F.col("c") == 1, 1)).alias("once"), F.count(F.when(F.col("c") == 2, 1)).alias("twice")).first()
    discount = per["once"] / (per["once"] + 2 * per["twice"]) if per["once"] else 0.5
    size = grid.sum(axis=0)
    ends = int(size[-1])
    return BrownModel(step, size, np.log10((discount * kinds + 1) / (size + 1)), discount, per["tokens"] + ends,
                      per["types"] + (ends > 0), ends), coded, labels, held


# --- scores ----------------------------------------------------------------------------------

SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_texts(model: BrownModel, label: np.ndarray, c: np.ndarray, texts: Coded) -> tuple[np.ndarray, ...]:
    """n_tokens, n_known, base score and model score of every row of a chunk, with the classes and
    counts of the block's words."""
    emit = np.where(c > 0, np.log10(np.maximum(c - model.discount, 1e-9) / (model.size[label] + 1)), model.unseen[label])
    base = np.log10((np.append(c, model.ends) + 0.1) / (model.tokens + 0.1 * (model.types + 1)))
    seq = with_ends(label[texts.code].astype(np.int64), texts, CLASSES - 1)
    last = np.concatenate([[CLASSES - 1], seq[:-1]])
    step = model.step[last, seq]
    bounds = np.concatenate([[0], np.cumsum(texts.count + 1)])
    per_row = lambda x, b: np.diff(np.concatenate([[0.0], np.cumsum(x)])[b])
    own = np.concatenate([[0], np.cumsum(texts.count)])
    known = per_row(c[texts.code] > 0, own).astype(np.int64) + (model.ends > 0)
    return (texts.count + 1, known, per_row(with_ends(base[texts.code], texts, base[-1]), bounds),
            per_row(step, bounds) + per_row(emit[texts.code], own))


def _score(shared, held: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for _, _, (label, c), texts in _blocks(batches, **{held: np.uint8, "c": np.int64}):
            n, known, base, score = score_texts(model, label, c, texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts.ids, pa.int64()), pa.array(texts.held), pa.array(n), pa.array(known),
                 pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(score)],
                names=[x.split()[0] for x in SCORES.split(", ")])
    return run


def score(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    bound_batches(docs.sparkSession)
    texts = prepared(docs)
    model, coded, labels, held = fit(texts, word_counts(texts), block_tokens)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return block_rows(coded, labels, held, "c").mapInArrow(tidy(_score(shared, held)), SCORES)
