import os

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cohortspark.operators import reshape as R
from cohortspark.streaming.scoring import start_scoring_stream


def test_micro_batch_scoring(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    rows = [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 0.0), (2, "zz", 5.0)]
    spark.createDataFrame(rows, "sample_id long, feature string, value double").write.parquet(os.path.join(src, "p1"))
    dictionary = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, feature string")
    train = R.assemble_dense(spark.createDataFrame([(1, 0, 1.0), (2, 1, 1.0)], "sample_id long, pos int, value double"), 2)
    model = LogisticRegression(maxIter=5).fit(train.withColumn("label", F.col("sample_id").cast("double") - 1))
    sink = os.path.join(tmpdir_path, "out")
    q = start_scoring_stream(spark, os.path.join(src, "*"), dictionary, model, sink, os.path.join(tmpdir_path, "ck"))
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert {r[0] for r in out.select("sample_id").collect()} == {1, 2}
