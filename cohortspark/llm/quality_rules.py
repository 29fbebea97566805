"""Quality rules: base rules and an n-gram perplexity band per language.

The model is a character trigram model with modified Kneser-Ney smoothing.  UTF-8 bytes fall into
63 classes (letters, one class for capitals, digits, white space, punctuation, high bytes), which
bounds every language's model by 64**3 entries, so it may be broadcast whatever the corpus size.
Each task counts its trigrams in arrays, Spark adds them up over all documents, and the estimates
are stored as sorted key arrays (packed n-gram, probability, back-off weight) that are searched
when a text has an n-gram the task has not yet seen.

A document is rejected if its perplexity lies outside its language's band: the median plus or
minus ``WIDTH`` robust standard deviations (interquartile range / 1.349) of the log perplexities
of all distinct texts of that language that pass the base rules.  Near copies in the middle can
narrow that range, so the deviation has a floor: half of that of the range from 5 to 95 percent,
half of the other languages' median deviation, and ``MIN_SPREAD``.  Model and histogram cover every distinct text once, however many copies it has:
texts are distinct as in exact_dedup, by the digest of what is left without white space.  Texts
whose digest shares no bucket with a repeated one are counted where they are read; only the
others are shuffled, one a digest and task.  Languages beyond the ``MAX_LANGUAGES`` most frequent share one model and band, as do
documents without a language.

Cases: null or empty text has no words and fails the base rules; repeated rows and ids get one
row each; very long texts are chunks of their own; an empty table gives no rows; only doc_id,
text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bound_batches, materialize, tidy
from .textnp import IS_SPACE, Words, _BYTE_CODE, _powers, mix, row_sums, text_chunks, windows

MAX_LANGUAGES = 15
WIDTH = 12.0
BINS_PER_UNIT = 400
MIN_SPREAD = 0.005
COPY_BUCKETS = 1 << 20
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8

BITS, START = 6, 63
SIZE = 1 << 3 * BITS
_PUNCTUATION = b".,;:!?'\"()-"


def _classes() -> np.ndarray:
    c = np.full(256, 41, np.uint32)
    c[128:] = 42 + np.arange(128, 256) % 21
    c[ord("a"):ord("z") + 1] = np.arange(26)
    c[ord("A"):ord("Z") + 1] = 26
    c[ord("0"):ord("9") + 1] = 27
    c[[32, 9, 11, 12, 13]] = 28
    c[10] = 29
    c[list(_PUNCTUATION)] = 30 + np.arange(len(_PUNCTUATION))
    return c


CLASS = _classes()
IS_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def trigrams(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Packed class trigram ending at every byte; two start marks precede each row."""
    c = CLASS[data]
    one, two = np.empty_like(c), np.empty_like(c)
    one[1:], two[2:] = c[:-1], c[:-2]
    two[:2] = START
    head = offs[:-1][np.diff(offs) > 0]
    one[head] = two[head] = START
    second = head + 1
    two[second[second < len(c)]] = START  # a following row's head is START anyway
    return two << 2 * BITS | one << BITS | c


# --- model -----------------------------------------------------------------------------------

def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    n = [int((counts == k).sum()) for k in range(1, 5)]
    if n[0] == 0 or n[1] == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    d = [0.0] + [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return np.clip(d, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.9, 2.9])


def _level(context: np.ndarray, counts: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interpolated probabilities of the n-grams, and the back-off weight of every context."""
    d = _discounts(counts)[np.minimum(counts, 3)]
    total = np.bincount(context, counts).astype(float)
    freed = np.bincount(context, d).astype(float)
    weight = np.divide(freed, total, out=np.ones_like(freed), where=total > 0)
    return (counts - d) / total[context] + weight[context] * lower, weight


class Model:
    """Sorted arrays of one language: trigram and bigram keys with log10 probabilities, and
    back-off weights by context."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.tri, counts = keys[order].astype(np.uint32), counts[order]
        bi_of = self.tri & (1 << 2 * BITS) - 1
        self.bi, bi_count = np.unique(bi_of, return_counts=True)  # distinct left contexts
        uni_of = self.bi & (1 << BITS) - 1
        uni_count = np.bincount(uni_of, minlength=1 << BITS)
        types = len(self.bi)
        seen = uni_count > 0
        d1 = _discounts(uni_count[seen])[np.minimum(uni_count, 3)] * seen
        self.uni = (uni_count - d1) / max(types, 1) + d1.sum() / max(types, 1) / (1 << BITS)
        self.uni = np.maximum(self.uni, 1e-9)
        bi_p, self.uni_weight = _level(self.bi >> BITS, bi_count, self.uni[uni_of])
        tri_context = self.tri >> BITS
        tri_p, weight = _level(tri_context, counts, bi_p[np.searchsorted(self.bi, bi_of)])
        self.context = np.unique(tri_context)
        self.bi_weight = weight[self.context]
        self.bi_p, self.tri_logp = bi_p, np.log10(tri_p)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)

    def log10(self, wanted: np.ndarray) -> np.ndarray:
        """log10 P(last | first two) of packed trigrams, seen or not."""
        at, known = self._find(self.tri, wanted)
        out = np.empty(len(wanted))
        out[known] = self.tri_logp[at[known]]
        new = wanted[~known]
        if len(new):
            middle, last = new >> BITS & (1 << BITS) - 1, new & (1 << BITS) - 1
            weight = np.ones(len(self.uni))
            weight[:min(len(weight), len(self.uni_weight))] = self.uni_weight[:len(weight)]
            p = weight[middle] * self.uni[last]
            at, seen = self._find(self.bi, new & (1 << 2 * BITS) - 1)
            p[seen] = self.bi_p[at[seen]]
            at, seen = self._find(self.context, new >> BITS)
            p[seen] *= self.bi_weight[at[seen]]
            out[~known] = np.log10(np.maximum(p, 1e-12))
        return out


def languages(docs: DataFrame) -> list[str]:
    """The most frequent languages, by count and then name; at most MAX_LANGUAGES."""
    top = (docs.where(F.col("lang").isNotNull()).groupBy("lang").count()
           .orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES))
    return [r[0] for r in top.collect()]


def _language_number(names: list[str]):
    """0 for a language outside ``names`` (or null), else its place from 1."""
    if not names:
        return F.lit(0)
    number = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("lang"))
    return F.coalesce(number, F.lit(0)).cast("int")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((MAX_LANGUAGES + 1) * SIZE, np.int64)
    for batch in batches:
        for lo, hi, data, offs in text_chunks(batch.column(1)):
            lang = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            key = trigrams(data, offs) + np.repeat(lang.astype(np.uint32) * np.uint32(SIZE), np.diff(offs))
            own, n = np.unique(key, return_counts=True)
            counts[own] += n
    key = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array((key // SIZE).astype(np.int32)), pa.array((key % SIZE).astype(np.int32)),
                                      pa.array(counts[key])], names=["lang", "key", "n"])


def _digest(text: Column) -> Column:
    """SHA-256 of a text without its white space; a null text is empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, ""), 256))


def distinct_texts(docs: DataFrame, names: list[str]) -> DataFrame:
    """lang (number), text: one row (the smallest text) per language and digest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(_language_number(names).alias("lang"), text.alias("text"), _digest(text).alias("digest"))
    bucket = F.pmod(F.xxhash64("lang", "digest"), F.lit(COPY_BUCKETS)).cast("int")
    # repeated digests flag at most COPY_BUCKETS buckets; a unique text in one is shuffled for nothing
    flagged = texts.groupBy("lang", "digest").count().where("count > 1").select(bucket.alias("bucket")).distinct()
    flagged = F.broadcast(materialize(flagged, "quality-copied"))
    texts = texts.withColumn("bucket", bucket)
    alone = texts.join(flagged, "bucket", "left_anti").select("lang", "text")
    copied = texts.join(flagged, "bucket", "left_semi").groupBy("lang", "digest").agg(F.min("text").alias("text"))
    return alone.unionByName(copied.select("lang", "text"))


def train(docs: DataFrame, names: list[str]) -> list[Model]:
    """One model per language number; the counts are summed by Spark over all distinct texts."""
    texts = distinct_texts(docs, names)
    counts = texts.mapInArrow(tidy(_count), "lang int, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    got = counts.toPandas()  # at most (MAX_LANGUAGES + 1) * 64**3 rows
    return [Model(part["key"].to_numpy(), part["n"].to_numpy())
            for part in (got[got["lang"] == k] for k in range(MAX_LANGUAGES + 1))]


class Scorer:
    """log10 probabilities per text; trigrams seen before are kept in one table."""

    def __init__(self, models: list[Model]):
        self.models = models
        self.known = np.full(len(models) * SIZE, np.nan, np.float32)

    def __call__(self, data: np.ndarray, offs: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Mean of -log10 P per byte of each row (0 for an empty one)."""
        key = trigrams(data, offs) + np.repeat(lang.astype(np.uint32) * np.uint32(SIZE), np.diff(offs))
        logp = self.known[key]
        new = np.isnan(logp)
        if new.any():
            wanted = np.unique(key[new])
            for k in np.unique(wanted // SIZE):
                own = wanted[wanted // SIZE == k]
                self.known[own] = self.models[k].log10(own % SIZE)
            logp = self.known[key]
        total = np.concatenate([[0.0], np.cumsum(logp, dtype=np.float64)])
        return -(total[offs[1:]] - total[offs[:-1]]) / np.maximum(np.diff(offs), 1)


# --- base rules ------------------------------------------------------------------------------

def _repeats(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which (row, key) pairs occur more than once, and which are first occurrences."""
    both = mix(key ^ mix(row.astype(np.uint64) + np.uint64(1)))
    _, first, number, count = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(key), bool)
    is_first[first] = True
    return count[number] > 1, is_first


def base_statistics(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every row of a chunk."""
    rows = len(offs) - 1
    words = Words(data, offs)
    out = {"n_words": words.count,
           "word_chars": row_sums(~IS_SPACE[data] & ((data & 0xC0) != 0x80), offs),
           "n_symbols": row_sums(IS_SYMBOL[data], offs)}
    # lines: a row's first byte or the byte after a line end, up to the next line end
    ends = np.flatnonzero(data == 10)
    begin = np.concatenate([offs[:-1], ends + 1])
    stop_at = np.concatenate([ends, offs[1:]])
    begin.sort(kind="stable")
    stop_at.sort(kind="stable")
    row = np.searchsorted(offs[1:], stop_at, side="left")
    inside = np.concatenate([[0], np.cumsum(~IS_SPACE[data])])
    full = inside[stop_at] > inside[np.minimum(begin, stop_at)]
    begin, stop_at, row = begin[full], stop_at[full], row[full]
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[:len(data)], out=total[1:])
    line = mix((total[stop_at] - total[begin]) * down[begin] ^ (stop_at - begin).astype(np.uint64))
    _, first = _repeats(line, row)
    out["n_dup_lines"] = np.bincount(row[~first], minlength=rows)
    at, run = windows(words.hashes(), words.first, words.count, REPEAT_WINDOW)
    twice, _ = _repeats(run, words.doc[at])
    cover = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(words.doc[np.cumsum(cover)[:-1] > 0], minlength=rows)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    return out


# --- operator --------------------------------------------------------------------------------

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORES = ", ".join(["doc_id long, language int", "digest binary", *[f"{c} long" for c in COUNTS], "base_failed boolean, log_ppl double"])


def _score(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(models.value)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(2)):
                lang = batch.column(1).slice(lo, hi - lo)
                stats = base_statistics(data, offs)
                ppl = scorer(data, offs, lang.to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), lang, batch.column(3).slice(lo, hi - lo), *[pa.array(stats[c].astype(np.int64)) for c in COUNTS],
                     pa.array(stats["base_failed"]), pa.array(ppl)],
                    names=[x.split()[0] for x in SCORES.split(", ")])
    return run


def scores(docs: DataFrame, names: list[str], models: list[Model]) -> DataFrame:
    """doc_id, language number, digest, base statistics, base_failed, log_ppl of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _language_number(names).alias("language"),
                       F.col("text").cast("string").alias("text"),
                       _digest(F.col("text").cast("string")).alias("digest")).mapInArrow(tidy(_score(shared)), SCORES)


def bands(scored: DataFrame, width: float = WIDTH) -> np.ndarray:
    """(lower, upper) log10 perplexity per language number, from a histogram of all distinct texts
    that pass the base rules; a language without such documents accepts everything."""
    bin_ = F.floor(F.col("log_ppl") * BINS_PER_UNIT).cast("int")
    texts = scored.where("not base_failed").groupBy("language", "digest").agg(F.min(bin_).alias("bin"))
    hist = texts.groupBy("language", "bin").count().toPandas()
    middle, spread = {}, {}
    for k, part in hist.groupby("language"):
        part = part.sort_values("bin")
        share = part["count"].cumsum().to_numpy() / part["count"].sum()
        low, q1, q2, q3, high = ((part["bin"].to_numpy()[np.searchsorted(share, q)] + 0.5) / BINS_PER_UNIT
                                 for q in (0.05, 0.25, 0.5, 0.75, 0.95))
        middle[int(k)], spread[int(k)] = q2, max((q3 - q1) / 1.349, (high - low) / 3.29 / 2)
    out = np.tile([-np.inf, np.inf], (MAX_LANGUAGES + 1, 1))
    for k, q2 in middle.items():
        others = [x for j, x in spread.items() if j != k]
        own = max(spread[k], np.median(others) / 2 if others else 0, MIN_SPREAD)
        out[k] = q2 - width * own, q2 + width * own
    return out


def _band_column(limits: np.ndarray, side: int):
    return F.element_at(F.array(*[F.lit(float(x)) for x in limits[:, side]]), F.col("language") + 1)


def fit(docs: DataFrame) -> tuple[list[str], list[Model], DataFrame, np.ndarray]:
    """Languages, models, the scores of all rows (a written table) and the bands."""
    bound_batches(docs.sparkSession)
    names = languages(docs)
    models = train(docs, names)
    scored = materialize(scores(docs, names, models), "quality-scores")
    return names, models, scored, bands(scored)


def quality(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, language number, base statistics, base_failed, log_ppl, its band, kept."""
    _, _, scored, limits = fit(docs)
    out = scored.withColumns({"lower": _band_column(limits, 0), "upper": _band_column(limits, 1)})
    return out.withColumn("kept", ~F.col("base_failed") & F.col("log_ppl").between(F.col("lower"), F.col("upper")))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; texts are scored again where
    they are read, so none is shuffled."""
    names, models, _, limits = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    columns = docs.columns
    text = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(text)):
                part = batch.slice(lo, hi - lo)
                lang = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False)
                ppl = scorer(data, offs, lang)
                good = ~base_statistics(data, offs)["base_failed"] & (ppl >= limits[lang, 0]) & (ppl <= limits[lang, 1])
                kept = part.filter(pa.array(good))
                yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=columns)
    numbered = docs.withColumn("__language", _language_number(names))
    return numbered.mapInArrow(tidy(run), docs.schema)
