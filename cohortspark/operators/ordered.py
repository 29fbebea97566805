"""Order-dependent computations without one-task windows.

``row_number`` / running sums over a large partition group would run in one
task.  Both helpers here split the group by a bucket that is monotone in the
sort order, work per bucket, and add per-bucket offsets computed on a tiny
table (one row per group and bucket).  Results equal the global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bucketed_rank(df: DataFrame, partition_cols: list[str], order_cols: list,
                  bucket, rank_col: str = "rank") -> DataFrame:
    """Exact ``row_number() over (partition by P order by O)`` (1-based).

    ``bucket`` must be non-decreasing along ``order_cols`` inside a partition
    (e.g. a prefix of the first sort key).
    """
    b = "_bucket"
    with_b = df.withColumn(b, bucket)
    counts = with_b.groupBy(*partition_cols, b).agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*partition_cols).orderBy(b) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*partition_cols, b,
                            F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    local = with_b.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*partition_cols, b).orderBy(*order_cols)))
    return local.join(offsets, on=[*partition_cols, b]) \
        .withColumn(rank_col, (F.col("_off") + F.col("_rn")).cast("long")) \
        .drop(b, "_rn", "_off")


def running_totals_before(df: DataFrame, partition_cols: list[str], order_col: str,
                          value_cols: list[str], n_buckets: int = 128) -> DataFrame:
    """For rows with distinct ``order_col`` inside each partition group, add
    ``<v>_before`` = sum of ``v`` over rows with a strictly smaller order value.

    Buckets are equal-count ranges: ``percentile_approx`` gives ``n_buckets-1``
    boundaries per group (a bounded sketch), and a row's bucket is the number
    of boundaries below its value - monotone by construction, so bucket order
    is value order.  Each bucket holds ~1/n_buckets of a group's distinct
    values however skewed the values are.  Without partition columns the
    boundaries are one small array, so no join on a constant key arises.
    """
    b = "_bucket"
    out_cols = list(df.columns)
    x = F.col(order_col)
    probs = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    if partition_cols:
        bnd = df.groupBy(*partition_cols).agg(F.percentile_approx(order_col, probs, 10000).alias("_bounds"))
        base = df.join(bnd, partition_cols)
        bounds = F.col("_bounds")
    else:
        vals = df.agg(F.percentile_approx(order_col, probs, 10000)).first()[0] or []
        base = df
        bounds = F.array(*[F.lit(v) for v in vals]) if vals else F.array().cast(f"array<{df.schema[order_col].dataType.simpleString()}>")
    bucket = F.size(F.filter(bounds, lambda v: v < x)).cast("int")
    with_b = base.withColumn(b, bucket).drop("_bounds")
    totals = with_b.groupBy(*partition_cols, b).agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    # the offset window runs over one row per (group, bucket)
    w_off = (Window.partitionBy(*partition_cols) if partition_cols else Window) \
        .orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*partition_cols, b, *[
        F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0)).alias(f"_o_{v}") for v in value_cols])
    w_loc = Window.partitionBy(*partition_cols, b).orderBy(order_col) \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = with_b.select("*", *[F.coalesce(F.sum(v).over(w_loc), F.lit(0)).alias(f"_l_{v}")
                                 for v in value_cols])
    out = local.join(offsets, [*partition_cols, b])
    return out.select(*out_cols, *[(F.col(f"_o_{v}") + F.col(f"_l_{v}")).alias(f"{v}_before")
                                   for v in value_cols])


def exact_percentile(counts: DataFrame, group_cols: list[str], value_col: str, count_col: str,
                     q: float, out: str = "percentile", n_buckets: int = 128) -> DataFrame:
    """Exact linear-interpolation percentile per group from ``(group, value,
    count)`` rows (one row per distinct value; counts act as frequencies).

    No group is buffered in one task: cumulative counts come from the
    bucketed running sum, and the two order statistics around position
    ``(N - 1) * q`` are picked by a range test on the cumulative counts.
    Equals ``percentile(value, q, count)``.
    """
    cum = running_totals_before(counts, group_cols, value_col, [count_col], n_buckets)
    if group_cols:
        tot = counts.groupBy(*group_cols).agg(F.sum(count_col).alias("_n"))
        x = cum.join(tot, group_cols)
    else:
        x = cum.withColumn("_n", F.lit(counts.agg(F.sum(count_col)).first()[0]))
    h = (F.col("_n") - 1) * F.lit(float(q))
    x = x.withColumn("_lo", F.floor(h)).withColumn("_hi", F.ceil(h)).withColumn("_frac", h - F.floor(h))
    start, stop = F.col(f"{count_col}_before"), F.col(f"{count_col}_before") + F.col(count_col)
    picked = x.where(((F.col("_lo") >= start) & (F.col("_lo") < stop))
                     | ((F.col("_hi") >= start) & (F.col("_hi") < stop)))
    agg = picked.groupBy(*group_cols).agg(
        F.max(F.when((F.col("_lo") >= start) & (F.col("_lo") < stop), F.col(value_col))).alias("_vlo"),
        F.max(F.when((F.col("_hi") >= start) & (F.col("_hi") < stop), F.col(value_col))).alias("_vhi"),
        F.first("_frac").alias("_frac"))
    return agg.select(*group_cols, (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias(out))
