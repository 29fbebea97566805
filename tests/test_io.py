import os

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from cohortspark.sources import ingest as IN
from cohortspark.sources import sinks as SK


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_scan_cohorts_skips_and_normalises(spark, tmpdir_path):
    a = os.path.join(tmpdir_path, "a.csv")
    b = os.path.join(tmpdir_path, "b.csv")
    _write(a, "patient_barcode,gene_id,fpkm\ns1,ENSG1,1.5\ns1,ENSG2,NA\ns2,ENSG1,abc\n")
    _write(b, "patient_barcode,other,fpkm\ns3,ENSG1,2\n")
    srcs = [IN.CohortSource("A", a, "long", "patient_barcode", "gene_id", "fpkm"),
            IN.CohortSource("B", b, "long", "patient_barcode", "gene_id", "fpkm"),
            IN.CohortSource("C", os.path.join(tmpdir_path, "missing.csv"), "long", "patient_barcode", "gene_id", "fpkm")]
    union, rep = IN.scan_cohorts(spark, srcs)
    status = {r["cohort"]: r["status"] for r in rep.collect()}
    assert status == {"A": "ok", "B": "skipped", "C": "skipped"}
    rows = union.orderBy("sample_id", "feature").collect()
    assert len(rows) == 3 and rows[1]["value"] is None and rows[0]["ordinal"] == 0
    try:
        IN.scan_cohorts(spark, srcs, on_error="fail")
        raise AssertionError("expected failure")
    except (KeyError, FileNotFoundError):
        pass


def test_read_feature_list(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "features.txt")
    _write(p, "  ENSG2 \nENSG1\n\n\tENSG3\n")
    got = [(r["pos"], r["feature"]) for r in IN.read_feature_list(spark, p).orderBy("pos").collect()]
    assert got == [(0, "ENSG2"), (1, "ENSG1"), (2, ""), (3, "ENSG3")]


def test_sinks_round_trip(spark, tmpdir_path):
    feats = spark.createDataFrame([(0, "b"), (1, "a")], "pos int, feature string")
    SK.write_feature_list(feats, os.path.join(tmpdir_path, "fl"), "json")
    back = SK.read_feature_table(spark, os.path.join(tmpdir_path, "fl"), "json").orderBy("pos").collect()
    assert [r["feature"] for r in back] == ["b", "a"]
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([0.0]), 0.0), (Vectors.dense([1.0]), 1.0)], ["features", "label"])
    m = LogisticRegression(maxIter=5).fit(df)
    run = os.path.join(tmpdir_path, "run")
    SK.save_run(run, {"lr": m}, {"features": feats}, {"k": 5})
    loaded = SK.load_run(spark, run, {"lr": LogisticRegressionModel})
    assert loaded["meta"] == {"k": 5} and loaded["tables"]["features"].count() == 2
    a = m.transform(df).select("probability").collect()
    b = loaded["models"]["lr"].transform(df).select("probability").collect()
    assert a == b
    SK.write_matrix(df.withColumn("m", F.lit("x")).drop("features"), os.path.join(tmpdir_path, "mx"), "m")
    assert spark.read.parquet(os.path.join(tmpdir_path, "mx")).count() == 2


def test_wide_cohorts_scan_and_common_columns(spark, tmpdir_path):
    from cohortspark.plans.integrate import integrate_wide
    a = os.path.join(tmpdir_path, "wa.csv")
    b = os.path.join(tmpdir_path, "wb.csv")
    _write(a, "patient_barcode,cg2,cg1,other\ns1,0.5,0.1,x\ns2,NA,0.2,y\n")
    _write(b, "patient_barcode,cg1,cg3,cg2\ns3,0.3,0.9,0.7\n")
    srcs = [IN.CohortSource("A", a, "wide"), IN.CohortSource("B", b, "wide")]
    frames, rep = IN.scan_cohorts(spark, srcs)
    assert isinstance(frames, list) and len(frames) == 2
    labelled = [f.withColumn("label", F.col("cohort")) for f in frames]
    u = integrate_wide(labelled, prefix="cg")
    assert u.columns == ["sample_id", "cg2", "cg1", "label"]
    rows = {r["sample_id"]: r for r in u.collect()}
    assert rows["s2"]["cg2"] is None and rows["s3"]["label"] == "B"
