import math

from pyspark.sql import functions as F

from cohortspark.functions import scalar as S
from cohortspark.functions import schema as SC


def test_coerce_numeric_tokens(spark):
    toks = ["1d", " 1.5 ", "NaN", "inf", "abc", "1e3", "", "1_000", "0x1F", None]
    df = spark.createDataFrame([(t,) for t in toks], "t string")
    got = [r[0] for r in df.select(S.coerce_numeric("t", 0.0)).collect()]
    assert got[:9] == [0.0, 1.5, 0.0, math.inf, 0.0, 1000.0, 0.0, 0.0, 0.0]
    assert got[9] == 0.0


def test_strip_and_name_rules(spark):
    df = spark.createDataFrame([("\t x \n",), ("pred_gene_BRCA",), ("ENSG1_gene",), ("plain",),
                                ("pred_cnv_cancer_prob",)], "n string")
    rows = df.select(S.strip_ws("n").alias("s"), S.modality_from_suffix("n").alias("suf"),
                     S.modality_from_pred("n").alias("pred"),
                     S.modality_from_binary_pred("n").alias("bin")).collect()
    assert rows[0]["s"] == "x"
    assert rows[1]["pred"] == "gene" and rows[1]["suf"] == "BRCA"
    assert rows[2]["suf"] == "gene" and rows[2]["pred"] == "other_omics"
    assert rows[3]["suf"] == "plain"
    assert rows[4]["bin"] == "cnv"


def test_filename_and_names(spark):
    df = spark.createDataFrame([("oof_preds_gene_binary.csv", 7, "normal")], "f string, s long, c string")
    r = df.select(S.modality_from_filename("f").alias("m"), S.category_sample_id("s", "c").alias("id"),
                  S.pca_component_name("Meth", F.lit(3)).alias("pc")).first()
    assert (r["m"], r["id"], r["pc"]) == ("gene", "7_NORMAL", "Meth_PCA_PC3")


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 3.0)], "id long, cg1 double, x string, cg2 double")
    assert SC.keep_prefixed(df, "id", "cg").columns == ["id", "cg1", "cg2"]
    assert SC.numeric_columns(df) == ["id", "cg1", "cg2"]
    assert SC.ensure_key(df.drop("id").withColumnRenamed("cg1", "k"), "sample_id").columns[0] == "sample_id"
    try:
        SC.model_inputs(df, "pred_")
        raise AssertionError("expected failure")
    except ValueError:
        pass
    try:
        SC.require(df, ["id", "nope"])
        raise AssertionError("expected failure")
    except KeyError:
        pass
