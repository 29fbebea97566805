import json
import os
import subprocess
import sys

from cohortspark.plans import jobs
from cohortspark.sources.ingest import CohortSource


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_integration_expert_stacking_jobs(spark, tmpdir_path):
    import random
    rng = random.Random(1)
    srcs = []
    for c, cohort in enumerate(["A", "B", "C"]):
        lines = ["patient_barcode,gene_id,fpkm"]
        for s in range(25):
            for g in range(6):
                v = rng.gauss(c * (g % 3), 1.0)
                lines.append(f"{cohort}{s},ENSG{g},{v:.4f}" if rng.random() > 0.05 else f"{cohort}{s},ENSG{g},NA")
        p = os.path.join(tmpdir_path, f"{cohort}.csv")
        _write(p, "\n".join(lines) + "\n")
        srcs.append(CohortSource(cohort, p, "long", "patient_barcode", "gene_id", "fpkm"))
    out = jobs.integration_job(spark, srcs, os.path.join(tmpdir_path, "int"), prefix="ENSG")
    assert spark.read.parquet(out["labels"]).count() == 75
    summary = spark.read.parquet(out["summary"]).first()
    assert (summary["n_samples"], summary["n_features"], summary["n_labels"]) == (75, 6, 3)
    ex = jobs.expert_job(spark, out["cells"], out["labels"], "gene", os.path.join(tmpdir_path, "ex"), kind="lr",
                         maxIter=50)
    oof = spark.read.parquet(ex["oof"])
    assert oof.count() == 75 * 3
    ex2 = jobs.expert_job(spark, out["cells"], out["labels"], "rna", os.path.join(tmpdir_path, "ex2"), kind="rf",
                          numTrees=10)
    st = jobs.stacking_job(spark, [ex["oof"], ex2["oof"]], out["labels"], os.path.join(tmpdir_path, "st"), maxIter=3)
    meta = spark.read.parquet(st["meta"])
    assert meta.count() == 75 and len([c for c in meta.columns if c.startswith("pred_")]) == 6
    assert spark.read.parquet(st["report"]).where("class = 'accuracy'").count() == 1


def test_cli_integrate(tmpdir_path):
    a = os.path.join(tmpdir_path, "A.csv")
    b = os.path.join(tmpdir_path, "B.csv")
    _write(a, "patient_barcode,gene,fpkm\ns1,ENSG1,1.5\ns1,ENSG2,2\ns2,ENSG1,NA\n")
    _write(b, "patient_barcode,gene,fpkm\ns3,ENSG1,3\ns1,ENSG2,4\n")
    cfg = {"sources": [{"cohort": "A", "path": a, "feature_col": "gene", "value_col": "fpkm"},
                       {"cohort": "B", "path": b, "feature_col": "gene", "value_col": "fpkm"}],
           "out_dir": os.path.join(tmpdir_path, "out"), "prefix": "ENSG"}
    cp = os.path.join(tmpdir_path, "cfg.json")
    _write(cp, json.dumps(cfg))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run([sys.executable, "-m", "cohortspark", "integrate", "--config", cp, "--master", "local[2]"],
                         cwd=root, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    out = json.loads(res.stdout.strip().splitlines()[-1])
    import duckdb
    rows = duckdb.sql(f"SELECT * FROM read_parquet('{out['labels']}/*.parquet') ORDER BY 1").fetchall()
    assert rows == [("s1", "B"), ("s2", "A"), ("s3", "B")]


def test_save_load_score_identical(spark, tmpdir_path):
    """Integration: expert run saved -> loaded -> scored by the streaming
    micro-batch scorer gives the same probabilities as the fitted model."""
    import random
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F
    from cohortspark.operators import reshape as R
    from cohortspark.sources import sinks as SK
    from cohortspark.streaming.scoring import score_batch
    rng = random.Random(2)
    rows = [(s, f"g{g}", rng.gauss(g * (s % 3), 1.0)) for s in range(60) for g in range(5)]
    cells = spark.createDataFrame(rows, "sample_id long, feature string, value double")
    labels = spark.createDataFrame([(s, "L%d" % (s % 3)) for s in range(60)], "sample_id long, label string")
    cdir, ldir = os.path.join(tmpdir_path, "cells"), os.path.join(tmpdir_path, "labels")
    cells.write.parquet(cdir)
    labels.write.parquet(ldir)
    ex = jobs.expert_job(spark, cdir, ldir, "gene", os.path.join(tmpdir_path, "ex"), kind="lr", maxIter=20)
    run = SK.load_run(spark, ex["run"], {"fold0": LogisticRegressionModel})
    dictionary = run["tables"]["dictionary"]
    model = run["models"]["fold0"]
    d = dictionary.count()
    scored = {r["sample_id"]: r["probability"] for r in score_batch(cells, dictionary, d, model).collect()}
    vec = R.assemble_dense(R.align_long(cells, dictionary), d, 0.0)
    direct = {r[0]: list(r[1]) for r in model.transform(vec).select("sample_id", vector_to_array("probability")).collect()}
    assert scored.keys() == direct.keys()
    for k in direct:
        assert scored[k] == direct[k]


def test_run_loads_by_uri_like_by_path(spark, tmpdir_path):
    from cohortspark.sources import sinks
    sinks.save_run(tmpdir_path, tables={"t": spark.range(3)}, meta={"a": 1})
    for path in (tmpdir_path, f"file://{tmpdir_path}"):
        run = sinks.load_run(spark, path)
        assert run["tables"]["t"].count() == 3 and run["meta"] == {"a": 1}
    assert sinks.load_run(spark, f"file://{tmpdir_path}/none") == {"models": {}, "tables": {}, "meta": None}


def test_scoring_reads_bad_text_as_zero(spark):
    from cohortspark.plans.integrate import prepare_long
    raw = spark.createDataFrame([("s", "f", "abc"), ("s", "g", "2.5")], "sample_id string, feature string, value string")
    names = spark.createDataFrame([("f", 0), ("g", 1)], "feature string, pos int")
    got = {r.feature: r.value for r in prepare_long(raw, names).collect()}
    assert got == {"f": 0.0, "g": 2.5}


def test_small_distinct_variances_stay_apart(spark):
    from cohortspark.operators.stats import variance_threshold
    moments = spark.createDataFrame([(v,) for v in (1e6, 1e-7, 2e-7, 3e-7)], "var_samp double")
    rule, cut = variance_threshold(moments, 0.05)
    assert rule == "quantile" and 1e-7 < cut < 2e-7
