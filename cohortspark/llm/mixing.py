"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Each row has a 60-bit hash of its doc_id.  Sizes are summed by source and leading hash bits;
the cumulative sums of one source's at most 2**12 buckets show in which bucket its budget ends.
Only that bucket is split further (16 more bits per level) until it is one hash value.  The rows
taken are those below the threshold, so no rows are sorted or ranked, and a smaller budget's rows
are a subset of a larger one's.  A source whose target exceeds its size is taken whole as often
as it fits, plus the rows below the threshold of the rest.

Cases: null text has size 0; null source is a source of its own, ordered last; equal doc_ids (and
all null doc_ids) share a hash and are taken or left together; the row at the threshold is taken
when that comes nearer to the target; an empty table gives no rows; only doc_id, text and source
are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialize

LEVELS = (12, 16, 16, 16)
HASH_BITS = sum(LEVELS)
MAX_TIMES = 3


def id_hash():
    """First 60 bits of md5(doc_id as text); the text of a null id is empty."""
    hexed = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.conv(hexed, 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, key (null-safe source), size, h."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    return docs.select("doc_id", "source", key.alias("key"), size.alias("size"), id_hash().alias("h"))


def targets(totals: DataFrame) -> DataFrame:
    """key, source_size, target from (key, source_size): shares 1, 2, 3, repeating by source in
    code point order, null last; no target above MAX_TIMES source sizes, the excess reshared.

    The result of resharing is min(cap, weight * level) with the level that spends the whole
    budget; it is the largest of the levels found with the k most easily capped sources capped.
    The windows here run over one row per source."""
    by_name = W.orderBy(F.col("key") == "n", "key")
    t = totals.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(MAX_TIMES)))
    easy = W.orderBy(F.col("cap") / F.col("weight"), "key")
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    t = (t.withColumn("capped", F.sum("cap").over(easy.rowsBetween(W.unboundedPreceding, -1)))
         .withColumn("open", F.sum("weight").over(easy.rowsBetween(W.currentRow, W.unboundedFollowing)))
         .withColumn("all", F.sum("source_size").over(everything)))
    t = t.withColumn("level", F.max((F.col("all") - F.coalesce("capped", F.lit(0.0))) / F.col("open")).over(everything))
    return t.select("key", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def thresholds(rows: DataFrame, name: str = "mix") -> DataFrame:
    """key, source_size, target, times, upto: rows of the source are taken ``times`` times, and
    once more where h <= upto (-1: none)."""
    shift = HASH_BITS - LEVELS[0]
    hist = materialize(rows.groupBy("key", F.shiftright("h", shift).alias("bucket"))
                       .agg(F.sum("size").alias("size")), f"{name}-hist")
    goal = targets(hist.groupBy("key").agg(F.sum("size").alias("source_size")))
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("times", times)
    goal = materialize(goal.withColumn("rest", F.col("target") - F.col("times") * F.col("source_size")), f"{name}-goal")
    edge = goal.select("key", "rest", F.lit(0).cast("long").alias("before"))
    for level, bits in enumerate(LEVELS):
        if level:
            shift -= bits
            inside = rows.join(edge.select("key", F.col("bucket").alias("parent")), "key") \
                .where(F.shiftright("h", shift + bits) == F.col("parent"))
            hist = inside.groupBy("key", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("size"))
        run = W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        cum = hist.join(edge.select("key", "rest", F.col("before").alias("base")), "key") \
            .withColumn("upto", F.col("base") + F.sum("size").over(run))
        # the bucket in which the budget ends: the first whose sum reaches it
        edge = materialize(
            cum.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")))
            .select("key", "rest", "bucket", (F.col("upto") - F.col("size")).alias("before"), "size"), f"{name}-edge")
    near = 2 * F.col("before") + F.col("size") <= 2 * F.col("rest")
    edge = edge.select("key", F.when(near, F.col("bucket")).otherwise(F.col("bucket") - 1).alias("upto"))
    return materialize(goal.join(edge, "key", "left")
                       .select("key", "source_size", "target", "times", F.coalesce("upto", F.lit(-1)).alias("upto")),
                       f"{name}-thresholds")


def with_times(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds source_size, target and times (how often the row is taken) by its source."""
    limits = limits.withColumnRenamed("times", "whole")
    return (rows.join(limits, "key")
            .withColumn("times", F.col("whole") + (F.col("h") <= F.col("upto")).cast("long")))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, times, taken for every row of ``docs``."""
    rows = materialize(sized(docs), "mix-sized")
    out = with_times(rows, thresholds(rows))
    return out.select("doc_id", "source", "size", "source_size", "target", "times",
                      (F.col("size") * F.col("times")).alias("taken"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as it is taken, with all its columns."""
    limits = thresholds(materialize(sized(docs), "mix-sized"))
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    limits = limits.select(F.col("key").alias("__key"), F.col("times").alias("__whole"), F.col("upto").alias("__upto"))
    taken = docs.withColumns({"__mine": key, "__h": id_hash()}).join(limits, F.col("__mine") == F.col("__key"))
    times = (F.col("__whole") + (F.col("__h") <= F.col("__upto")).cast("long")).cast("int")
    taken = taken.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), times)))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
