"""Micro-batch scoring of arriving long-format files.

The reference prepares new samples at scoring time with stateless reshapes
aligned to the saved feature list.  Here the same preparation runs inside a
Structured Streaming ``foreachBatch``: every micro-batch of newly arrived
files is coerced, averaged per cell, aligned to the saved dictionary,
assembled into vectors and scored by a fitted Spark ML model; predictions go to
a folder of the batch's own (``epoch=<n>``) in a parquet sink, so a batch that is
run again writes nothing twice.  Progress lives in the stream checkpoint, so a
restarted query resumes without re-scoring; a sink belongs to one checkpoint.

Assumption: all rows of one sample arrive in the same file (batch), as with
one file per sample or per cohort delivery.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import reshape as R
from ..plans.integrate import prepare_long

LONG_SCHEMA = "sample_id long, feature string, value double"


def score_batch(batch: DataFrame, dictionary: DataFrame, d: int, model) -> DataFrame:
    aligned = prepare_long(batch, dictionary)
    vec = R.assemble_dense(aligned, d, 0.0)
    out = model.transform(vec)
    return out.select("sample_id", F.col("prediction").cast("int").alias("code"),
                      vector_to_array("probability").alias("probability"))


def start_scoring_stream(spark: SparkSession, source_dir: str, dictionary: DataFrame, model,
                         sink_dir: str, checkpoint_dir: str, schema: str | StructType = LONG_SCHEMA,
                         available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``."""
    d = dictionary.count()
    dict_local = dictionary.cache()

    def handle(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        # a batch that is tried again replaces what it wrote before
        score_batch(batch, dict_local, d, model).write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")

    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
