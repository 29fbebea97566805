"""Quality classifier: sparse rule ensemble.

Text statistics are computed once per row.  A random forest of shallow trees is fitted to labelled
rows; every path from a root to a node is a conjunctive rule.  An L1-penalised logistic regression
over the rules' indicators keeps few of them, and those are compiled into one Spark column
expression, 1 / (1 + exp(-(b + sum of the weights of the rules that hold))).

Only rows with crc32(doc_id as text) mod 5 other than 0 are learned from, at most about
``TRAIN_ROWS`` of them (a hash sample of the labelled rows; the bound is a parameter).  Labels,
lang, source and doc_id are no inputs.

Cases: null or empty text has statistics 0 and gets a score; a null doc_id is held out; labels
that are null or contradict each other count by their largest value; with no labels or one class
the score is the smoothed share of label 1; repeated rows get one row each; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_crc, materialize
from .quality_rules import base_statistics
from .textnp import Words, mix, row_sums, text_chunks

FOLDS = 5
TRAIN_ROWS = 50_000
THRESHOLD = 0.3
TREES, DEPTH, PENALTY = 24, 3, 0.0005

STATISTICS = ("n_words", "mean_word", "symbols", "dup_lines", "repeated_words", "capitals", "digits", "marks",
              "high_bytes", "n_lines", "words_per_line", "distinct_words", "same_as_last", "one_char_words", "sentence_ends")
_COUNTED = {"capitals": np.r_[65:91], "digits": np.r_[48:58], "marks": [33, 63, 64, 94, 95, 96, 123, 125, 126],
            "high_bytes": np.r_[128:256], "sentence_ends": [46]}
IS_KIND = {name: np.isin(np.arange(256), values) for name, values in _COUNTED.items()}


def statistics(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Every statistic of every row of a chunk, as doubles."""
    rows = len(offs) - 1
    base = base_statistics(data, offs)
    words = Words(data, offs)
    h = words.hashes()
    n, chars = base["n_words"], np.maximum(base["word_chars"], 1)
    some = np.maximum(n, 1)
    lines = row_sums(data == 10, offs) + 1
    distinct = np.unique(mix(h ^ mix(words.doc.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])
    out = {"n_words": n, "mean_word": chars / some, "symbols": base["n_symbols"] / chars,
           "dup_lines": base["n_dup_lines"] / lines, "repeated_words": base["n_repeat_words"] / some,
           "n_lines": lines, "words_per_line": n / lines,
           "distinct_words": np.bincount(words.doc[distinct], minlength=rows) / some,
           "same_as_last": np.bincount(words.doc[again], minlength=rows) / some,
           "one_char_words": np.bincount(words.doc[words.end - words.start == 1], minlength=rows) / some}
    for name, flag in IS_KIND.items():
        out[name] = row_sums(flag[data], offs) / chars
    return {k: np.asarray(out[k], float) * (n > 0) for k in STATISTICS}


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offs in text_chunks(batch.column(1)):
            stats = statistics(data, offs)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *[pa.array(stats[k]) for k in STATISTICS]],
                                             names=["doc_id", *STATISTICS])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{k} double" for k in STATISTICS))


# --- rules -----------------------------------------------------------------------------------

Rule = tuple[tuple[int, str, float], ...]  # conditions (statistic, "<=" or ">", cut), sorted


def tree_rules(text: str) -> set[Rule]:
    """Conjunctions on the paths of a tree, from Spark's printed form of it."""
    rules, path = set(), []
    for line in text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (int(m[2]), m[3], float(m[4])))]
        rules.add(simplify(tuple(c for _, c in path)))
    return rules


def simplify(conditions: Rule) -> Rule:
    """One bound per statistic and side."""
    tight: dict[tuple[int, str], float] = {}
    for k, side, cut in conditions:
        old = tight.get((k, side), cut)
        tight[k, side] = min(old, cut) if side == "<=" else max(old, cut)
    return tuple(sorted((k, side, cut) for (k, side), cut in tight.items()))


def holds(rule: Rule) -> Column:
    """The rule as a column expression over the statistics."""
    return reduce(lambda a, b: a & b, [F.col(STATISTICS[k]) <= cut if side == "<=" else F.col(STATISTICS[k]) > cut
                                       for k, side, cut in rule])


class Ensemble:
    """Intercept and the weighted rules that the lasso kept."""

    def __init__(self, intercept: float, rules: list[tuple[float, Rule]]):
        self.intercept, self.rules = intercept, rules

    def score(self) -> Column:
        margin = F.lit(self.intercept)
        for weight, rule in self.rules:
            margin = margin + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-margin))


def fit(stats: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Ensemble:
    """Fits the ensemble to the labelled rows of ``stats`` outside the held-out fold."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector

    answers = (labels.where(F.col("quality").isNotNull()).groupBy("doc_id")
               .agg(F.max(F.col("quality").cast("double")).alias("label")))
    train = stats.where(id_crc() % FOLDS != 0).join(answers, "doc_id")
    sizes = train.groupBy("label").count().collect()  # two rows
    total, ones = sum(r["count"] for r in sizes), sum(r["count"] for r in sizes if r["label"] == 1)
    if total == 0 or ones in (0, total):
        return Ensemble(float(np.log((ones + 1) / (total - ones + 1))), [])
    unit = 1 << 20
    if total > rows:
        train = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(unit)) < int(unit * rows / total))
    train = materialize(train.repartition(4), "rules-train")
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(train)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird",
                                    subsamplingRate=0.5, seed=7).fit(vectors)
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in forest.trees)))
    if not rules:
        return Ensemble(float(np.log((ones + 1) / (total - ones + 1))), [])
    flags = train.select("label", array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=True).fit(flags)
    weights = lasso.coefficients.toArray()
    return Ensemble(float(lasso.intercept), [(float(w), r) for w, r in zip(weights, rules) if w])


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    stats = materialize(measured(docs), "rules-statistics")
    score = fit(stats, labels, rows).score()
    out = stats.select("doc_id", (id_crc() % FOLDS == 0).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
