"""Session helpers: a local session for tests and the bench, the settings
assumed on a cluster, and cutting lineage into the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "quarry",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session configured the way the library expects: AQE on, UTC
    session time zone, no UI server.  On a cluster use the cluster's session."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(target_partition_mb: int = 256) -> dict[str, str]:
    """Settings the library assumes on a large cluster (pass them to the
    session builder or spark-submit).  Shuffle partitions start high and AQE
    coalesces them to ~``target_partition_mb`` each, so the same jobs fit at
    any scale; skewed join partitions are split at run time; file splits are
    sized so a scan task reads about one target partition."""
    mb = f"{target_partition_mb}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": mb,
        "spark.sql.shuffle.partitions": "20000",
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder where lineage is cut.

    The cluster names it in ``spark.checkpoint.dir``; that value is always
    used when present (read from the session, so it also works without a
    SparkContext, e.g. over Spark Connect).  Where it is unset, a folder
    inside the warehouse is used: the warehouse, too, is shared by the driver
    and all executors.  A machine-local temporary folder is never used."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_quarry_scratch"


def materialize(df: DataFrame, label: str = "step", compression: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` once as Parquet under the checkpoint
    folder (shared storage on a cluster) and reading it back.

    Unlike an eager ``checkpoint()``, which runs the plan once to count and
    again to write the checkpoint files, this computes the input exactly
    once; the read-back frame also carries file-size statistics, so the
    planner can size later joins.  If an executor is lost afterwards, the
    data is re-read from shared storage, never recomputed.

    ``compression`` names a Parquet codec other than the session's.  The folder stays until ``discard`` is called on the returned frame, or is
    left to the retention rule of the checkpoint folder."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path, compression=compression)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(df: DataFrame) -> None:
    """Remove the folder of a frame that ``materialize`` returned, once nothing
    that is still to run reads it.  Other frames are left alone."""
    path = getattr(df, "_written_to", None)
    if path is None:
        return
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
