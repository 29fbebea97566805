"""Hard-negative mining with segment summaries.

A vector's components become integers, floor(256 x).  It is cut into segments of ``WIDTH``
components, and the mean and the deviation (length of what is left without the mean) of every
segment are stored with it.  Over a segment, the product of two vectors is WIDTH times the product
of the means, plus or minus at most the product of the deviations, so the sums over all segments
bound the score.  Summaries of 4 segments together follow from theirs, which gives a hierarchy of
``LEVELS`` segment widths.

Anchors and rows are dealt into a grid of cells of bounded size.  A task holds a cell's anchors and
streams its rows in tiles: coarse summaries first; anchors and rows whose bounds still reach a wanted
score go on to finer ones, and what is left after the finest is scored exactly.  The wanted scores
of an anchor are windows (lowest, highest, how many): one for its positives, one for each positive's
negatives, whose floor rises to the worst score held once a window is full.  Cells yield at most
that many rows a window, and Spark merges them.  No pair of rows is shuffled; every row travels once
for each block of ``ANCHOR_BLOCK`` anchors, every anchor once for each block of rows.

Cases: null labels, null vectors and vectors with a null or non-finite component take no part; an
empty vector scores 0; a shorter vector counts as if zeros followed; null ids are no anchors and come
last among ties; repeated rows are rows of their own; scores beyond 2**56 are held there; an empty
table gives no rows; only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

WIDTH = 4
LEVELS = (64, 16, 4)
ANCHOR_BLOCK, ROW_BLOCK, LEAST_ROWS, CELLS = 32_768, 262_144, 2_048, 64
TILE_ANCHORS, TILE_ROWS = 256, 4_096
EXACT = 2.0**53
MOST = 2**56

VECTORS = "row long, vec_id long, label int, q array<long>, mean array<double>, dev array<double>"


# --- vectors and summaries -------------------------------------------------------------------

def padded(values: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Matrix of the lists of a flat array, with zeros behind the shorter ones."""
    n = np.diff(bounds)
    out = np.zeros((len(n), width), values.dtype)
    out[np.repeat(np.arange(len(n)), n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def summaries(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every segment of WIDTH components."""
    s = q.astype(np.float64).reshape(len(q), q.shape[1] // WIDTH, WIDTH)
    mean = s.mean(axis=2)
    return mean, np.sqrt(((s - mean[:, :, None]) ** 2).sum(axis=2))


def merged(mean: np.ndarray, dev: np.ndarray, width: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of ``times`` neighbouring segments of ``width`` components together."""
    m = mean.reshape(len(mean), mean.shape[1] // times, times)
    d = dev.reshape(m.shape)
    middle = m.mean(axis=2)
    return middle, np.sqrt((d**2).sum(axis=2) + width * ((m - middle[:, :, None]) ** 2).sum(axis=2))


def _list_values(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    bounds = col.offsets.to_numpy().astype(np.int64)
    return col.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]], bounds - bounds[0]


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, bounds = _list_values(batch.column(3))
        n = np.diff(bounds)
        segments = -(-n // WIDTH)
        q = padded(values, bounds, int(segments.max(initial=0)) * WIDTH)
        mean, dev = summaries(q) if q.size else (np.zeros((len(n), 0)),) * 2
        held = np.arange(mean.shape[1])[None, :] < segments[:, None]
        at = pa.array(np.concatenate([[0], np.cumsum(segments)]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.ListArray.from_arrays(at, pa.array(mean[held])),
                                          pa.ListArray.from_arrays(at, pa.array(dev[held]))], names=[x.split()[0] for x in VECTORS.split(", ")])


def prepared(rows: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """row, vec_id, label, q (integers), mean, dev (per segment) of the rows that take part; written."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("int").alias("label"), whole.alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull()).where(finite)
    # beyond 2**52 a double has no fraction, so the limit changes no smaller component
    part = lambda x: F.floor(F.greatest(F.least(x * 256.0, F.lit(2.0**62)), F.lit(-(2.0**62))))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.transform("x", part).alias("q"))
    return materialize(rows.mapInArrow(_summarise, VECTORS), "mine-vectors")


# --- cells -----------------------------------------------------------------------------------

class Vectors:
    """Vectors of a tile: integers as doubles, and summaries by level from coarse to fine."""

    def __init__(self, row, vec_id, label, q, mean, dev):
        self.row, self.vec_id, self.label, self.q = row, vec_id, label, q
        self.most = float(np.abs(q).max(initial=0))
        self.levels = {WIDTH: (mean, dev)}
        for width in sorted(LEVELS)[1:]:
            times = width // (last := max(self.levels))
            self.levels[width] = merged(*self.levels[last], last, times)

    def part(self, keep) -> Vectors:
        out = object.__new__(Vectors)
        out.row, out.vec_id, out.label, out.q, out.most = self.row[keep], self.vec_id[keep], self.label[keep], self.q[keep], self.most
        out.levels = {w: (m[keep], d[keep]) for w, (m, d) in self.levels.items()}
        return out


def vectors_of(batch: pa.RecordBatch, at: int, dims: int) -> Vectors:
    """Columns row, vec_id, label, q, mean, dev from place ``at`` on; null ids read as the largest."""
    row, label = (batch.column(at + k).to_numpy(zero_copy_only=False) for k in (0, 2))
    vec_id = batch.column(at + 1).fill_null(np.iinfo(np.int64).max).to_numpy()
    q, mean, dev = (padded(*_list_values(batch.column(at + k)), size) for k, size in ((3, dims), (4, dims // WIDTH), (5, dims // WIDTH)))
    return Vectors(row, vec_id, label, q, mean, dev)


def exact_scores(a: Vectors, b: Vectors) -> np.ndarray:
    """Integer inner products; doubles hold them exactly up to 2**53, Python's integers beyond."""
    if a.most * b.most * max(a.q.shape[1], 1) < EXACT:
        return (a.q.astype(np.float64) @ b.q.astype(np.float64).T).astype(np.int64)
    big = a.q.astype(object) @ b.q.astype(object).T
    return np.clip(big, -MOST, MOST).astype(np.int64)


def alive_pairs(a: Vectors, b: Vectors, want: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and rows that still have a wanted pair after all levels; ``low`` and ``high`` are the
    least and the largest score that any window of an anchor wants."""
    at_a, at_b = np.arange(len(a.row)), np.arange(len(b.row))
    if a.most * b.most * max(a.q.shape[1], 1) >= EXACT:
        return at_a, at_b
    for width in LEVELS:
        (mean_a, dev_a), (mean_b, dev_b) = a.levels[width], b.levels[width]
        middle = width * (mean_a[at_a] @ mean_b[at_b].T)
        reach = dev_a[at_a] @ dev_b[at_b].T
        reach += 0.5 + 1e-9 * (np.abs(middle) + reach)  # rounding; scores are integers
        want = want & (middle + reach >= low[at_a, None]) & (middle - reach <= high[at_a, None])
        keep_a, keep_b = want.any(axis=1), want.any(axis=0)
        at_a, at_b, want = at_a[keep_a], at_b[keep_b], want[np.ix_(keep_a, keep_b)]
        if not len(at_a):
            break
    return at_a, at_b


class Windows:
    """Score windows of a tile's anchors and the best rows found for each: higher score first, ties
    by smaller vec_id, then row."""

    def __init__(self, low: np.ndarray, high: np.ndarray, size: int):
        self.low, self.high, self.size = low.copy(), high, size  # anchors x windows
        self.floor = low.copy()
        empty = np.zeros(0, np.int64)
        self.slot, self.score, self.vec_id, self.row = empty, empty, empty, empty

    def reach(self) -> tuple[np.ndarray, np.ndarray]:
        return self.floor.min(axis=1), self.high.max(axis=1)

    def take(self, anchors: np.ndarray, scores: np.ndarray, want: np.ndarray, rows: Vectors) -> None:
        for k in range(self.low.shape[1]):
            hit = want & (scores >= self.floor[anchors, k][:, None]) & (scores <= self.high[anchors, k][:, None])
            i, j = np.nonzero(hit)
            if not len(i):
                continue
            slot = np.concatenate([self.slot, anchors[i] * self.low.shape[1] + k])
            score = np.concatenate([self.score, scores[i, j]])
            vec_id, row = np.concatenate([self.vec_id, rows.vec_id[j]]), np.concatenate([self.row, rows.row[j]])
            order = np.lexsort((row, vec_id, -score, slot))
            slot = slot[order]
            nth = np.arange(len(slot)) - np.searchsorted(slot, slot)
            order = order[nth < self.size]
            self.slot, self.score, self.vec_id, self.row = slot[nth < self.size], score[order], vec_id[order], row[order]
            full = np.flatnonzero(nth == self.size - 1)
            at = slot[full]
            # rows come by vec_id, so a later tie loses
            self.floor.ravel()[at] = np.maximum(self.floor.ravel()[at], score[order[np.searchsorted(self.slot, at, side="right") - 1]] + 1)


FOUND = "anchor long, slot int, vec_id long, row long, score long"


def _cells(dims: int, size: int, same_label: bool):
    """Of rows (cell, side, row, vec_id, label, q, mean, dev, low, high) sorted by cell, side and
    vec_id, the best of every window of every anchor (side 0) among the cell's rows (side 1)."""
    def search(tiles, rows: Vectors) -> None:
        for anchors, windows in tiles:
            want = (anchors.label[:, None] == rows.label[None, :]) == same_label
            want &= anchors.row[:, None] != rows.row[None, :]
            low, high = windows.reach()
            at_a, at_b = alive_pairs(anchors, rows, want, low, high)
            if len(at_a):
                left = rows.part(at_b)
                windows.take(at_a, exact_scores(anchors.part(at_a), left), want[np.ix_(at_a, at_b)], left)

    def finish(tiles):
        for anchors, w in tiles:
            if len(w.slot):
                owner, slot = np.divmod(w.slot, w.low.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(anchors.row[owner]), pa.array(slot.astype(np.int32)), pa.array(w.vec_id, mask=w.vec_id == np.iinfo(np.int64).max),
                                                  pa.array(w.row), pa.array(w.score)], names=[x.split()[0] for x in FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, tiles = None, []
        for batch in batches:
            cells, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(cells):
                continue
            edge = np.flatnonzero((cells[1:] != cells[:-1]) | (side[1:] != side[:-1])) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(cells)]):
                if cells[lo] != cell:
                    yield from finish(tiles)
                    cell, tiles = cells[lo], []
                step = TILE_ROWS if side[lo] else TILE_ANCHORS
                for at in range(lo, hi, step):
                    part = batch.slice(at, min(step, hi - at))
                    vectors = vectors_of(part, 2, dims)
                    if side[lo]:
                        search(tiles, vectors)
                        continue
                    low, high = (_list_values(part.column(k))[0].reshape(part.num_rows, -1) for k in (8, 9))
                    tiles.append((vectors, Windows(low, high, size)))
        yield from finish(tiles)
    return run


def best_in_windows(anchors: DataFrame, rows: DataFrame, size: int, same_label: bool) -> DataFrame:
    """anchor (its row), slot, vec_id, row, score, nth: the first ``size`` rows of every window of the
    anchors (columns of ``rows`` with arrays low and high, equally long in all anchors), of the
    anchor's own label or of others."""
    n = rows.agg(F.count("*"), F.max(F.size("mean"))).first()
    dims = -(-max(n[1] or 0, 1) * WIDTH // max(LEVELS)) * max(LEVELS)
    a = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    r = max(1, -(-n[0] // ROW_BLOCK), min(-(-CELLS // a), -(-n[0] // LEAST_ROWS)))
    block = lambda of: F.pmod(F.xxhash64("row"), F.lit(of))
    columns = ["row", "vec_id", "label", "q", "mean", "dev"]
    blocks = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1))).alias("other")
    asks = anchors.select(blocks(r), *columns, "low", "high").select(
        (block(a) * r + F.col("other")).alias("cell"), F.lit(0).alias("side"), *columns, "low", "high")
    members = rows.select(blocks(a), *columns).select(
        (F.col("other") * r + block(r)).alias("cell"), F.lit(1).alias("side"), *columns,
        *[F.array().cast("array<long>").alias(c) for c in ("low", "high")])
    dealt = asks.unionAll(members).repartitionById(a * r, F.col("cell").cast("int"))
    cells = dealt.sortWithinPartitions("cell", "side", F.col("vec_id").asc_nulls_last())
    found = cells.mapInArrow(_cells(dims, size, same_label), FOUND)
    order = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= size)


# --- operator --------------------------------------------------------------------------------

def mine(rows: DataFrame, label: Column | None = None, vec_id: str = "vec_id", vector: str = "embedding", anchors: str = "vec_id % 50 = 0",
         positives: int = 5, negatives: int = 3, floor_percent: int = 50, cap_percent: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank: for
    every row that the condition ``anchors`` picks, its best ``positives`` rows of the same label and, for each,
    the best ``negatives`` rows of other labels whose score is from ``floor_percent`` to
    ``cap_percent`` percent of the positive's."""
    vectors = prepared(rows, vec_id, vector, F.col("label") if label is None else label)
    picked = vectors.where(anchors)
    every = lambda value: F.array(F.lit(value).cast("long"))
    near = best_in_windows(picked.withColumns({"low": every(-MOST), "high": every(MOST)}), vectors, positives, True)
    near = materialize(near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                                   F.col("nth").alias("positive_rank")), "mine-positives")
    # windows of negatives: floor_percent * p <= 100 * n <= cap_percent * p
    window = near.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("positive_rank", "positive_score"))).alias("p"))
    score = lambda k: F.try_element_at("p", k)
    ranks = F.array(*[F.lit(k) for k in range(1, positives + 1)])
    low = F.transform(ranks, lambda k: F.coalesce(_ceil_percent(score(k), floor_percent), F.lit(MOST + 1)))
    high = F.transform(ranks, lambda k: F.coalesce(_floor_percent(score(k), cap_percent), F.lit(-MOST - 1)))
    asks = picked.join(window, F.col("row") == F.col("anchor")).withColumns({"low": low, "high": high})
    far = best_in_windows(asks.select(*vectors.columns, "low", "high"), vectors, negatives, False)
    far = far.select("anchor", (F.col("slot") + 1).alias("positive_rank"), F.col("nth").alias("rank"), F.col("vec_id").alias("negative_id"),
                     F.col("score").alias("negative_score"))
    names = picked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return far.join(near, ["anchor", "positive_rank"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")


def _floor_percent(score: Column, percent: int) -> Column:
    """Largest n with 100 n <= percent * score."""
    times = score * F.lit(percent).cast("long")
    return F.call_function("div", times - F.pmod(times, F.lit(100)), F.lit(100))


def _ceil_percent(score: Column, percent: int) -> Column:
    """Least n with percent * score <= 100 n."""
    return -_floor_percent(-score, percent)
