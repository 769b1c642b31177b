"""A capture as one act: every check passes and it is kept, or nothing is and the attempt is on record.

A capture is written to a folder of its own, which nobody reads until a row of the attempts
table names it. That row is the commit; a fault at any point leaves a row that says so.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.config import Settings
from envgrade.operators.capture import (
    CaptureFault,
    call_status_summary,
    check_breakdowns,
    check_unique,
    drop_count_conflicts,
    retained_stations,
)
from envgrade.operators.reconcile import check_inside_window
from envgrade.sources.pages import read_capture, write_capture

KEPT, VOID = "kept", "void"
ATTEMPTS = (
    "attempt STRING, at TIMESTAMP, window STRING, outcome STRING, fault STRING, "
    "station_rows BIGINT, model_rows BIGINT"
)


def _attempts_path(root: str) -> str:
    return f"{root}/attempts"


def attempts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(ATTEMPTS).parquet(_attempts_path(root))


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def run_capture(
    spark: SparkSession,
    root: str,
    window_name: str,
    gated: DataFrame,
    models: DataFrame,
    resolved: DataFrame,
    cfg: Settings,
    calls: DataFrame | None = None,
) -> str:
    """Check, write and check again; returns the outcome, which is on record by then.

    Rows whose sample count is contradicted by a second route are left out, and then
    the breakdowns have to say so: they are checked against what was written.
    """
    attempt = uuid.uuid4().hex
    folder = f"{root}/{attempt}"
    outcome, fault, rows = KEPT, None, (0, 0)
    try:
        sound = drop_count_conflicts(gated)
        stations = retained_stations(sound)
        for side in (stations, models):
            check_inside_window(side, cfg.window(window_name))
        check_unique(stations, ["station_id", "ts"])
        if calls is not None and call_status_summary(calls).where("void").count():
            raise CaptureFault("a call was not answered")
        write_capture(stations, models, folder, window_name)
        written = read_capture(spark, folder, window_name, cfg)
        check_breakdowns(sound, written[0], resolved)
        rows = (written[0].count(), written[1].count())
    except (ValueError, RuntimeError, PySparkException) as wrong:
        outcome, fault = VOID, type(wrong).__name__
        _remove(spark, folder)
    record = spark.createDataFrame([(attempt, window_name, outcome, fault, *rows)], "attempt STRING, window STRING, "
                                   "outcome STRING, fault STRING, station_rows BIGINT, model_rows BIGINT")
    record.withColumn("at", F.current_timestamp()).select(*[c.split()[0] for c in ATTEMPTS.split(", ")]).coalesce(
        1).write.mode("append").parquet(_attempts_path(root))
    return outcome


def kept_capture(spark: SparkSession, root: str, window_name: str, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """Both sides of the newest kept capture of a window."""
    kept = attempts(spark, root).where((F.col("window") == window_name) & (F.col("outcome") == KEPT))
    newest = kept.agg(F.max_by("attempt", "at").alias("attempt")).first()["attempt"]
    if newest is None:
        raise CaptureFault(f"no capture of {window_name} was kept")
    return read_capture(spark, f"{root}/{newest}", window_name, cfg)
