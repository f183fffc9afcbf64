"""Session helpers: configuration defaults, the shared checkpoint folder, scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC time (hour-of-week, day keys), AQE for
# runtime re-planning (partition coalescing, skew-join splitting).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "goalcast",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own session."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the defaults to an existing session and make sure a checkpoint folder exists."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage (HDFS / object store) and is used
    as is. Only when it is unset (local tests) a fresh local folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="goalcast-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder for files a job writes and reads back."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/goalcast-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table in the shared checkpoint folder
    and reading it back: one job (a reliable ``checkpoint()`` computes its input twice
    unless cached), survives executor loss (the table is on shared storage), and the
    read-back carries real size statistics for the planner's broadcast decisions."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/goalcast-tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cut_lineage_observed(df: DataFrame, name: str, metrics: dict) -> tuple[DataFrame, dict]:
    """``cut_lineage`` plus aggregate metrics of the written rows, computed by one
    aggregation over the written (column-pruned, often footer-only) table.

    (Spark's ``Observation`` would fold this into the write job, but once a session
    has used it the session object stops being serialisable, which breaks Spark ML
    models whose summaries reference the session.)"""
    out = cut_lineage(df, name)
    row = out.agg(*[col.alias(k) for k, col in metrics.items()]).collect()[0].asDict()  # one row
    return out, row


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def release_tables(spark: SparkSession) -> None:
    """Drop this application's intermediate tables and scratch folders from the shared
    checkpoint folder (the folder is per application) and forget memoised results.
    Call at the end of a run; DataFrames built before the call become unreadable."""
    from goalcast.plans import catalog
    catalog._memo.clear()
    sc = spark.sparkContext
    base = checkpoint_dir(spark).rstrip("/")
    jvm = sc._jvm
    for sub in ("goalcast-tables", "goalcast-scratch"):
        p = jvm.org.apache.hadoop.fs.Path(f"{base}/{sub}")
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        if fs.exists(p):
            fs.delete(p, True)
