"""Ingest, projection and reshape queries (entry point A and scoring prep)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import reshape as R
from ..operators import stats as ST
from ..sources.tables import Tables
from . import bindings as B
from . import integrate as I
from .registry import register, rounded
from .sql_ctes import cte, with_ctes

# Fixed values of the brand / priority / type domains are read from the data
# on the Spark side; the SQL twins list the same domains by rule.
BRANDS = [f"Brand#{i}" for i in range(1, 26)]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EXPR_PREFIX = "Brand#1"


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def expression_with_ordinals(t: Tables) -> DataFrame:
    return B.expression_long(t).join(J.checked_broadcast(B.cohort_codes(t), J.MAX_REGISTRY), "cohort")


def brand_values(t: Tables) -> list:
    return R.feature_values(t.part, "p_brand")


cte("expr_clean", f"""
SELECT e.cohort, k.ordinal, e.sample_id, e.feature,
       coalesce(CASE WHEN isnan(e.value) THEN NULL ELSE e.value END, 0.0) AS value
FROM expr_long e JOIN cohort_codes k ON e.cohort = k.cohort
WHERE e.feature IS NOT NULL AND e.sample_id IS NOT NULL AND starts_with(e.feature, '{EXPR_PREFIX}')""",
    ("expr_long", "cohort_codes"))
cte("expr_whole", """
SELECT e.cohort, k.ordinal, e.sample_id, e.feature
FROM expr_long e JOIN cohort_codes k ON e.cohort = k.cohort
WHERE e.feature IS NOT NULL AND e.sample_id IS NOT NULL""", ("expr_long", "cohort_codes"))
cte("expr_labels", "SELECT sample_id, arg_max(cohort, ordinal) AS label FROM expr_clean GROUP BY sample_id",
    ("expr_clean",))


@register("integrate_long", with_ctes("""
SELECT c.sample_id, c.feature, round(c.value, 6) AS value, l.label
FROM (SELECT sample_id, feature, avg(value) AS value FROM expr_clean GROUP BY ALL) c
JOIN expr_labels l ON c.sample_id = l.sample_id""", "expr_clean", "expr_labels"))
def q_integrate_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1/P1/P2/P4/P5/P6/J3/U1/A1(long): gene-style integration."""
    t = Tables(spark, sf_dir)
    out = I.integrate_long_labelled(expression_with_ordinals(t), B.cohort_codes(t), prefix=EXPR_PREFIX)
    return rounded(out)


def _pivot_sql(agg: str, cells_cte: str, features: list[str], fill: str = "0.0", rnd: bool = True) -> str:
    cols = []
    for f in features:
        e = f"{agg}(value) FILTER (WHERE feature = '{f}')"
        e = f"coalesce({e}, {fill})"
        if rnd:
            e = f"round({e}, 6)"
        cols.append(f"{e} AS {_q(f)}")
    return f"SELECT sample_id, {', '.join(cols)} FROM {cells_cte} GROUP BY sample_id"


cte("expr_cells_all", """
SELECT sample_id, feature, avg(value) AS value FROM expr_long
WHERE sample_id IS NOT NULL AND feature IS NOT NULL AND value IS NOT NULL GROUP BY ALL""", ("expr_long",))


@register("pivot_mean", with_ctes(
    f"SELECT w.*, l.label FROM ({_pivot_sql('avg', 'expr_long', BRANDS)}) w "
    "JOIN (SELECT sample_id, arg_max(cohort, ordinal) AS label FROM expr_long JOIN cohort_codes USING (cohort) "
    "GROUP BY sample_id) l USING (sample_id)", "expr_long", "cohort_codes"))
def q_pivot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 (wide): sample x brand matrix, mean of duplicates, fill 0, + label."""
    t = Tables(spark, sf_dir)
    labelled = I.integrate_long_labelled(expression_with_ordinals(t), B.cohort_codes(t), coerce=False)
    return rounded(R.pivot_agg(labelled, brand_values(t), "mean", 0.0, ["sample_id", "label"]))


@register("pivot_agg_median", with_ctes(_pivot_sql("median", "mirna_long", PRIORITIES), "mirna_long"))
def q_pivot_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: pivot with a caller-chosen aggregate (median), NULL -> 0."""
    t = Tables(spark, sf_dir)
    vals = R.feature_values(t.orders, "o_orderpriority")
    return rounded(R.pivot_agg(B.mirna_long(t), vals, "median", 0.0))


@register("pivot_presence", with_ctes(
    "SELECT w.*, l.label FROM (" + _pivot_sql("max", "(SELECT DISTINCT sample_id, feature, 1 AS value FROM mut_events)",
                                              TYPES, "0", rnd=False) + ") w "
    "JOIN (SELECT sample_id, arg_max(cohort, ordinal) AS label FROM mut_events JOIN cohort_codes USING (cohort) "
    "GROUP BY sample_id) l USING (sample_id)", "mut_events", "cohort_codes"))
def q_pivot_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3/A5/P7 + J3: mutation-style 0/1 presence matrix with label."""
    t = Tables(spark, sf_dir)
    ev = B.mutation_events(t).join(J.checked_broadcast(B.cohort_codes(t), J.MAX_REGISTRY), "cohort")
    labelled = I.integrate_events_labelled(ev, B.cohort_codes(t))
    types = R.feature_values(t.part, "p_type")
    wide = R.pivot_agg(labelled, types, "max", 0, ["sample_id", "label"])
    return wide.select("sample_id", *[F.col(f"`{c}`").cast("int").alias(c) for c in types], "label")


@register("integrate_events", with_ctes("""
SELECT p.sample_id, p.feature, 1 AS value, l.label
FROM (SELECT DISTINCT sample_id, feature FROM mut_events) p
JOIN (SELECT sample_id, arg_max(cohort, ordinal) AS label FROM mut_events JOIN cohort_codes USING (cohort) GROUP BY sample_id) l
  ON p.sample_id = l.sample_id""", "mut_events", "cohort_codes"))
def q_integrate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L16 (mutation): distinct pairs -> presence 1 (long) + label."""
    t = Tables(spark, sf_dir)
    ev = B.mutation_events(t).join(J.checked_broadcast(B.cohort_codes(t), J.MAX_REGISTRY), "cohort")
    return I.integrate_events_labelled(ev, B.cohort_codes(t)) \
        .select("sample_id", "feature", F.col("value").cast("int").alias("value"), "label")


@register("crosstab_presence", with_ctes("""
SELECT sample_id, feature, count(*) AS n, CAST(count(*) > 0 AS INTEGER) AS present
FROM mut_events WHERE variant_class IN ('A', 'R') GROUP BY sample_id, feature""", "mut_events"))
def q_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 membership filter + A4 crosstab + P19 binarise (long cells)."""
    t = Tables(spark, sf_dir)
    ev = R.filter_in(B.mutation_events(t), "variant_class", ["A", "R"])
    ct = R.crosstab_long(ev, "sample_id", "feature")
    return ct.withColumn("present", R.binarise("n"))


@register("label_counts", with_ctes("""
SELECT label, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM (SELECT sample_id, arg_max(cohort, ordinal) AS label FROM expr_whole GROUP BY sample_id) GROUP BY label""", "expr_whole"))
def q_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label counts and normalised shares of the integrated matrix."""
    t = Tables(spark, sf_dir)
    _, labels = I.integrate_long(expression_with_ordinals(t))
    return rounded(ST.label_counts(labels, "label", normalize=True))


@register("matrix_shape", with_ctes("""
SELECT count(DISTINCT sample_id) AS n_samples, count(DISTINCT feature) AS n_features FROM expr_whole""",
                                    "expr_whole"))
def q_matrix_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix shape of the integrated long table."""
    t = Tables(spark, sf_dir)
    cells, _ = I.integrate_long(expression_with_ordinals(t))
    return ST.matrix_shape(cells)


@register("resolve_cohort_overlap", """
WITH k AS (SELECT cohort, CAST(dense_rank() OVER (ORDER BY cohort) - 1 AS INTEGER) AS ordinal
           FROM (SELECT DISTINCT o_orderpriority AS cohort FROM orders))
SELECT o.o_custkey AS sample_id, arg_max(k.cohort, k.ordinal) AS label, count(DISTINCT k.cohort) AS n_cohorts,
       count(*) AS n_values, round(sum(o.o_totalprice), 2) AS total_value
FROM orders o JOIN k ON o.o_orderpriority = k.cohort GROUP BY o.o_custkey""")
def q_resolve_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3/W5 with overlapping cohorts (a customer orders in several priority
    cohorts): the value is averaged over all, the label is the last cohort."""
    t = Tables(spark, sf_dir)
    o = t.orders.select(F.col("o_custkey").alias("sample_id"), F.col("o_orderpriority").alias("cohort"),
                        F.col("o_totalprice").alias("value"))
    o = J.registry_ordinals(o, "cohort")
    labels = J.resolve_cohort(o)
    # the averaged value is reported as (count, total): prices carry two
    # decimals, so the total rounds exactly where a 6-place mean could sit on
    # a rounding boundary
    stats = o.groupBy("sample_id").agg(F.countDistinct("cohort").alias("n_cohorts"),
                                       F.count(F.lit(1)).alias("n_values"),
                                       F.round(F.sum("value"), 2).alias("total_value"))
    return labels.join(stats, "sample_id")


@register("union_common_columns", with_ctes(
    "SELECT sample_id, " + ", ".join(f"round({_q(p)}, 6) AS {_q(p)}" for p in PRIORITIES[:-1]) + ", label FROM ("
    "SELECT w.*, l.label FROM (" + _pivot_sql("avg", "mirna_long WHERE cohort <> (SELECT max(cohort) FROM mirna_long)",
                                              PRIORITIES, rnd=False) + ") w "
    "JOIN (SELECT sample_id, arg_max(cohort, ordinal) AS label FROM mirna_long JOIN cohort_codes USING (cohort) "
    "WHERE cohort <> (SELECT max(cohort) FROM mirna_long) GROUP BY sample_id) l USING (sample_id)) "
    "UNION ALL SELECT sample_id, " + ", ".join(f"round({_q(p)}, 6)" for p in PRIORITIES[:-1]) + ", label FROM ("
    "SELECT sample_id, " + ", ".join(f"coalesce(avg(value) FILTER (WHERE feature = '{p}'), 0.0) AS {_q(p)}"
                                    for p in PRIORITIES[:-1]) +
    ", min(cohort) AS label FROM mirna_long WHERE cohort = (SELECT max(cohort) FROM mirna_long) GROUP BY sample_id)",
    "mirna_long", "cohort_codes"))
def q_union_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 + L16 (miRNA): four cohorts long -> pivot; the last cohort arrives
    pre-pivoted without its last priority column; union on common columns."""
    t = Tables(spark, sf_dir)
    long = B.mirna_long(t).join(J.checked_broadcast(B.cohort_codes(t), J.MAX_REGISTRY), "cohort")
    codes = B.cohort_codes(t)
    last = codes.agg(F.max("cohort")).first()[0]
    prios = R.feature_values(t.orders, "o_orderpriority")
    long_part = long.where(F.col("cohort") != last)
    wide_cohort = R.pivot_mean(long.where(F.col("cohort") == last), prios[:-1]) \
        .withColumn("label", F.lit(last))
    return rounded(I.integrate_mixed(long_part, wide_cohort, prios))


@register("keep_prefixed_align", """
SELECT vec_id AS sample_id, """ + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS cg{i:02d}"
                                             for i in range(64)) + """, 0.0 AS cg64, 0.0 AS cg65
FROM embeddings""")
def q_keep_prefixed_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P15 + L13 (wide): methylation frame -> key + ``cg*`` columns aligned
    to the saved training probe list of a wider (66-probe) panel; the two
    probes the scoring data lacks are added as 0."""
    t = Tables(spark, sf_dir)
    wide = B.methylation_wide(t)
    saved = B.probe_names(66)
    return rounded(I.prepare_wide(wide, saved))


@register("integrate_wide", """
SELECT vec_id AS sample_id, """ + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS cg{i:02d}"
                                             for i in range(64)) + """, CAST(label AS VARCHAR) AS label
FROM embeddings""")
def q_integrate_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L16 (methylation): one wide frame per cohort (label value), key + probe
    columns + label, union on the common columns."""
    t = Tables(spark, sf_dir)
    wide = B.methylation_wide(t)
    cohorts = [wide.where(F.col("label") == v) for v in J.class_list(wide, "label")]
    return rounded(I.integrate_wide(cohorts))


# ---- keyed / pruned scans, type selection, union over all columns ---------------

@register("keyed_scan", """
SELECT doc_id AS sample_id, quality AS label FROM labels""")
def q_keyed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table without the standard key name -> first column
    becomes ``sample_id``; only key and label are read (pruned scan)."""
    t = Tables(spark, sf_dir)
    from ..functions.schema import ensure_key
    return ensure_key(t.labels, "sample_id").select("sample_id", F.col("quality").alias("label"))


@register("numeric_projection", """
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal FROM customer""")
def q_numeric_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep the numeric columns in frame order, dropping (tolerantly)
    columns that may be absent."""
    from ..functions.schema import drop_if_present, numeric_columns
    t = Tables(spark, sf_dir)
    df = drop_if_present(t.customer, "label", "target")
    return rounded(df.select(*numeric_columns(df)))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("union_all_columns", """
SELECT sample_id, """ + ", ".join(f"round({e}, 6) AS {e}" for e in EVENT_TYPES) + """, category FROM (
  SELECT user_id AS sample_id, 'normal' AS category, """ + ", ".join(
    f"max(value) FILTER (WHERE event_type = '{e}') AS {e}" if e != "error" else "CAST(NULL AS DOUBLE) AS error"
    for e in EVENT_TYPES) + """
  FROM events WHERE event_type <> 'error' GROUP BY user_id
  UNION ALL
  SELECT user_id, 'cancer', """ + ", ".join(
    "max(value) FILTER (WHERE event_type = 'error')" if e == "error" else "CAST(NULL AS DOUBLE)"
    for e in EVENT_TYPES) + """
  FROM events WHERE event_type = 'error' GROUP BY user_id)""")
def q_union_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-category wide frames with different feature columns, united over
    the union of columns (sorted), absent columns NULL."""
    from ..operators.setops import union_all_columns
    t = Tables(spark, sf_dir)
    ev = t.events.select(F.col("user_id").alias("sample_id"), F.col("event_type").alias("feature"), "value")
    normal = ev.where(F.col("feature") != "error")
    cancer = ev.where(F.col("feature") == "error")
    # largest value per cell: an order-free aggregate of two-decimal prices
    wn = R.pivot_agg(normal, R.feature_values(normal), "max", None).withColumn("category", F.lit("normal"))
    wc = R.pivot_agg(cancer, R.feature_values(cancer), "max", None).withColumn("category", F.lit("cancer"))
    u = union_all_columns([wn, wc], key="sample_id")
    return rounded(u.select("sample_id", *EVENT_TYPES, "category"))
