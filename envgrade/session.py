"""Session settings the package relies on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

REQUIRED_CONF = {
    # Event time is UTC everywhere; a local zone would shift windows and months.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value, as common JSON readers do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A replayed batch replaces only its own partitions.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A few large files are read in more pieces, as parsing costs more than reading.
    "spark.sql.files.openCostInBytes": "1m",
    # Call sites per expression make wide plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "envgrade", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING_CONF, **REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to a session somebody else created."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a private one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="envgrade-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{checkpoint_root(spark)}/envgrade/{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def land(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several branches read to the shared folder, and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
