"""Exact duplicate removal by a tree merge of sorted digest runs (DataFrame functions only).

Every input partition is a leaf that holds one run per digest: its best row (most code points,
then smallest doc_id, then first row) and the number of rows.  In each round, the nodes of
``FAN_IN`` neighbouring leaves exchange runs: a node is named by the remaining high bits of the
leaf number, and as nodes merge, the digest's leading bits take the place of the dropped leaf
bits, so that the number of shards stays level and no task ever holds all digests.  Each merge
is a sort aggregate over (node, shard, digest): partial results are merged before the exchange,
so a group with a third of all rows reaches a node as one row per task.  The digest is the
SHA-256 of the normalised text; the normalised length is part of the key and is verified with it
at every level.

Cases: null text counts as empty; a null doc_id loses against every id; of rows that agree in
everything, exactly one stays (the first by staged row number); an empty table gives no rows;
only doc_id and text are read, further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, materialize

FAN_BITS = 4
LEAF_BITS = 12


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, row, leaf, points (code points of the text), digest, norm_points per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    norm = F.translate(text, SPACES, "")
    return (docs.select("doc_id", text.alias("text"), norm.alias("norm"))
            .select("doc_id", F.monotonically_increasing_id().alias("row"),
                    F.pmod(F.spark_partition_id(), F.lit(1 << LEAF_BITS)).alias("leaf"),
                    F.length("text").cast("long").alias("points"),
                    F.unhex(F.sha2("norm", 256)).alias("digest"),
                    F.length("norm").cast("long").alias("norm_points")))


def merge_runs(leaves: DataFrame) -> DataFrame:
    """digest, norm_points, best (points, -doc_id, -row), copies: one row per distinct text."""
    runs = leaves.select(
        "digest", "norm_points", "leaf",
        F.conv(F.substring(F.hex("digest"), 1, LEAF_BITS // 4), 16, 10).cast("int").alias("shard"),
        F.struct(F.col("points"), (-F.col("doc_id")).alias("neg_id"), (-F.col("row")).alias("neg_row")).alias("best"),
        F.lit(1).cast("long").alias("copies"))
    for gone in range(FAN_BITS, LEAF_BITS + 1, FAN_BITS):  # the partial merge makes the leaf runs
        node = F.shiftright("leaf", gone)
        shard = F.shiftright("shard", LEAF_BITS - gone)
        runs = (runs.groupBy(node.alias("node"), shard.alias("part"), "digest", "norm_points")
                .agg(F.max("best").alias("best"), F.sum("copies").alias("copies"),
                     F.min("leaf").alias("leaf"), F.min("shard").alias("shard")))
    return runs.select("digest", "norm_points", "best", "copies")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, row, keep_id, group_size, kept, digest for every row of ``docs``."""
    leaves = materialize(digests(docs), "dedup-digests")
    best = materialize(merge_runs(leaves), "dedup-runs")  # winners are read back shuffled by digest
    joined = leaves.select("doc_id", "row", "digest", "norm_points").join(best, ["digest", "norm_points"])
    return joined.select("doc_id", "row", (-F.col("best.neg_id")).alias("keep_id"),
                         F.col("copies").alias("group_size"),
                         (F.col("row") == -F.col("best.neg_row")).alias("kept"), "digest")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay, with all their columns.

    Kept rows are found again by (doc_id, digest of the text, code points); rows that agree in
    all three are repeats of one row, of which one is taken."""
    kept = (exact_duplicates(docs).where("kept")
            .select(F.col("doc_id").alias("__keep_id"), F.col("digest").alias("__keep_digest")))
    kept = materialize(kept, "dedup-kept")
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumns({"__digest": F.unhex(F.sha2(F.translate(text, SPACES, ""), 256)),
                               "__points": F.length(text)})
    found = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("__keep_id"))
                        & (F.col("__digest") == F.col("__keep_digest")), "left_semi")
    nth = F.row_number().over(W.partitionBy("doc_id", "__digest").orderBy(F.desc("__points")))
    return found.withColumn("__nth", nth).where("__nth = 1").drop("__digest", "__points", "__nth")
