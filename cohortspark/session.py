"""Session construction and lineage helpers.

Configuration follows the public Spark documentation: AQE on (coalesce, skew
join, runtime broadcast of small *measured* sides), UI off, UTC session time
zone, Arrow for pandas transfer.  A cluster supplies its own
``spark.checkpoint.dir``; only when none is configured (local tests) do we
create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "cohortspark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Uses ``spark.checkpoint.dir`` (or an already set context checkpoint dir).
    Only when neither is set and the master is local (local runs, tests) is a
    fresh folder under the system temp directory created; on a cluster a
    missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster; "
                               "a machine-local temporary folder is only used in local mode")
        configured = tempfile.mkdtemp(prefix="cohortspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet into the checkpoint folder.

    A written table survives executor loss (unlike a local checkpoint) and
    gives later stages exact statistics for AQE.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "tables", f"{name or 'tbl'}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: Narrow rows (or cells of vectors) that one task of :func:`spread` takes.
SPREAD_ROWS = 250_000


def spread(df: DataFrame, n_rows: int, *cols, width: int = 1) -> DataFrame:
    """``df`` dealt by ``cols`` to tasks of at most about ``SPREAD_ROWS`` values each; a table that is
    small enough for one task stays as it is.

    Adaptive execution coalesces by the bytes shuffled, and scans are cut by the bytes
    written.  Probabilities and keys compress so well that millions of rows then meet in one
    task; a given number of tasks is not coalesced, so what a task holds stays bounded."""
    tasks = -(-n_rows * width // SPREAD_ROWS)
    return df.repartition(tasks, *cols) if tasks > 1 else df
