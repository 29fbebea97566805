"""Role bindings: the driver tables read as cohort / modality inputs.

Samples are customers (label = market segment, five classes); modalities are
derived from the order lines a customer bought:

* ``expression``  long  (customer, part brand, quantity), cohort = segment
* ``copy_number`` long  (customer, 'S'||part size, discount; 0 discount = missing)
* ``mutation``    event (customer, part type, class = return flag)
* ``activity``    event (user, event type), covers only the users of ``events``
* ``mirna``       long  (customer, order priority, total price)
* ``methylation`` wide  (embedding id, ``cg00..cg63``), label 0-9
* binary target   ``labels.quality`` per document

All bindings are lazy DataFrames over whole tables; Catalyst prunes their
columns and pushes filters to the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import Tables


def samples(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("sample_id"),
                             F.col("c_mktsegment").alias("label"))


def cohort_codes(t: Tables) -> DataFrame:
    """Cohort registry from the (small) customer side: segment -> alphabetical ordinal."""
    def build():
        segs = t.customer.select(F.col("c_mktsegment").alias("cohort")).distinct()
        codes = segs.select("cohort", (F.dense_rank().over(Window.orderBy("cohort")) - 1)
                            .cast("int").alias("ordinal"))
        # tiny and read by several joins and the broadcast bound check: staged once
        return materialize(codes, "cohort_codes")
    return t.memo("cohort_codes", build)


def _lines(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag")
    o = t.orders.select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def expression_long(t: Tables) -> DataFrame:
    """(cohort, sample_id, feature, value) with cohort = customer segment."""
    p = t.part.select("p_partkey", "p_brand")
    c = t.customer.select("c_custkey", "c_mktsegment")
    x = _lines(t).join(p, F.col("l_partkey") == p.p_partkey) \
        .join(c, F.col("o_custkey") == c.c_custkey)
    return x.select(F.col("c_mktsegment").alias("cohort"), F.col("o_custkey").alias("sample_id"),
                    F.col("p_brand").alias("feature"), F.col("l_quantity").alias("value"))


def copy_number_long(t: Tables) -> DataFrame:
    """(cohort, sample_id, feature, value); a zero discount reads as missing."""
    p = t.part.select("p_partkey", "p_size")
    c = t.customer.select("c_custkey", "c_mktsegment")
    x = _lines(t).join(p, F.col("l_partkey") == p.p_partkey) \
        .join(c, F.col("o_custkey") == c.c_custkey)
    return x.select(F.col("c_mktsegment").alias("cohort"), F.col("o_custkey").alias("sample_id"),
                    F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("feature"),
                    F.nullif(F.col("l_discount"), F.lit(0.0)).alias("value"))


def mutation_events(t: Tables) -> DataFrame:
    """(cohort, sample_id, feature, variant_class)."""
    p = t.part.select("p_partkey", "p_type")
    c = t.customer.select("c_custkey", "c_mktsegment")
    x = _lines(t).join(p, F.col("l_partkey") == p.p_partkey) \
        .join(c, F.col("o_custkey") == c.c_custkey)
    return x.select(F.col("c_mktsegment").alias("cohort"), F.col("o_custkey").alias("sample_id"),
                    F.col("p_type").alias("feature"), F.col("l_returnflag").alias("variant_class"))


def activity_events(t: Tables) -> DataFrame:
    """(sample_id, feature, value): one row per event of a user."""
    return t.events.select(F.col("user_id").alias("sample_id"),
                           F.col("event_type").alias("feature"), F.col("value"))


def mirna_long(t: Tables) -> DataFrame:
    """(cohort, sample_id, feature, value): order priority x total price."""
    o = t.orders.select("o_custkey", "o_orderpriority", "o_totalprice")
    c = t.customer.select("c_custkey", "c_mktsegment")
    x = o.join(c, o.o_custkey == c.c_custkey)
    return x.select(F.col("c_mktsegment").alias("cohort"), F.col("o_custkey").alias("sample_id"),
                    F.col("o_orderpriority").alias("feature"), F.col("o_totalprice").alias("value"))


def probe_names(n: int = 64) -> list[str]:
    return [f"cg{i:02d}" for i in range(n)]


def methylation_wide(t: Tables, n: int = 64) -> DataFrame:
    e = t.embeddings
    return e.select(F.col("vec_id").alias("sample_id"),
                    *[F.col("embedding")[i].cast("double").alias(name)
                      for i, name in enumerate(probe_names(n))],
                    F.col("label").cast("string").alias("label"))


def methylation_long(t: Tables) -> DataFrame:
    """Long form of the probes: ``posexplode`` of the embedding array."""
    e = t.embeddings
    x = e.select(F.col("vec_id").alias("sample_id"), F.col("label").cast("string").alias("label"),
                 F.posexplode("embedding").alias("i", "v"))
    return x.select("sample_id", "label",
                    F.format_string("cg%02d", F.col("i")).alias("feature"),
                    F.col("v").cast("double").alias("value"))


def category_events(t: Tables) -> DataFrame:
    """(sample_id, category, feature, value) for the normal / cancer sample job.

    category: ``cancer`` for error events, ``normal`` otherwise; feature: the
    tens bucket of the ``k`` field of the JSON props (coerced from text).
    """
    e = t.events
    k = F.get_json_object(F.col("props"), "$.k")
    kd = F.when(k.rlike(r"^[0-9]+$"), k.try_cast("int"))
    return e.select(F.col("user_id").alias("sample_id"),
                    F.when(F.col("event_type") == "error", F.lit("cancer"))
                    .otherwise(F.lit("normal")).alias("category"),
                    F.concat(F.lit("k"), F.floor(kd / 10).cast("string")).alias("feature"),
                    F.col("value"))


def binary_documents(t: Tables) -> DataFrame:
    """Labelled documents: (sample_id, label quality 0/1, source, lang)."""
    d = t.documents.select(F.col("doc_id").alias("sample_id"), "source", "lang")
    lab = t.labels.select(F.col("doc_id").alias("sample_id"), F.col("quality").alias("label"))
    return d.join(lab, "sample_id")


def line_modalities(t: Tables) -> DataFrame:
    """Expression and mutation rows from ONE pass over the order lines:
    ``(modality, sample_id, feature, w)``; each line yields an ``expr`` row
    (brand, quantity) and, when its return flag is A or R, a ``mut`` row
    (part type, 1)."""
    p = t.part.select("p_partkey", "p_brand", "p_type")
    x = _lines(t).join(p, F.col("l_partkey") == p.p_partkey)
    rows = F.array(
        F.struct(F.lit("expr").alias("modality"), F.col("p_brand").alias("feature"),
                 F.col("l_quantity").alias("w")),
        F.struct(F.lit("mut").alias("modality"), F.col("p_type").alias("feature"),
                 F.when(F.col("l_returnflag").isin("A", "R"), F.lit(1.0)).alias("w")))
    e = x.select(F.col("o_custkey").alias("sample_id"), F.explode(rows).alias("r"))
    return e.select(F.col("r.modality").alias("modality"), "sample_id",
                    F.col("r.feature").alias("feature"), F.col("r.w").alias("w")) \
        .where(F.col("w").isNotNull())
