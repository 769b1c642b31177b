"""Record, raw and quarantine tables on plain Parquet.

A writer is a ``run``: a name that sorts by when the writer was made. Batch numbers
count within a run, so a new checkpoint, which counts from zero again, never touches
what an earlier one wrote. Raw and quarantine batches have a partition of their own:
written again, they replace themselves. Records are merged into the regions and days
that a batch touches (see ``generations``), and read latest-wins, by run and then by
batch. ``compact_records`` keeps the latest row per key of all runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings
from envgrade.sources.generations import children, fold_in
from envgrade.sources.generations import named as partition_name
from envgrade.sources.generations import read as read_generations

VERSION = ("run", "batch_id")
VERSION_FIELDS = [S.T.StructField("run", S.T.StringType()), S.T.StructField("batch_id", S.T.LongType())]
RECORD_TABLE_SCHEMA = S.T.StructType([*S.RECORD_SCHEMA.fields, *VERSION_FIELDS])
# The run of a writer that numbers its batches itself and has no checkpoint.
BATCH_RUN = "0"


class SnapshotFault(RuntimeError):
    """A snapshot that must not be served."""


def _versioned(df: DataFrame, run: str, batch_id: int) -> DataFrame:
    return df.withColumns({"run": F.lit(run), "batch_id": F.lit(int(batch_id)).cast("bigint")})


def _write_batch(df: DataFrame, path: str, *parts: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*VERSION, *parts)
        .parquet(path)
    )


def upsert_records(records: DataFrame, path: str, batch_id: int, run: str = BATCH_RUN) -> None:
    """Merge one batch of records into the regions and days it touches; the same batch of a run again changes nothing."""
    stamped = _versioned(records, run, batch_id).withColumn("written_at", F.current_timestamp())
    fold_in(stamped, path, int(batch_id), run, current_records, repeatable=True)


def read_record_table(
    spark: SparkSession, path: str, written_at: bool = False, folders: list[str] | None = None
) -> DataFrame:
    """Rows of a record table with run and batch, on request with the time of their write too. An overwritten row may
    still be there beside its successor; ``current_records`` tells which counts."""
    extra = [S.T.StructField("written_at", S.T.TimestampType())] if written_at else []
    return read_generations(spark, path, folders, S.T.StructType([*RECORD_TABLE_SCHEMA.fields, *extra]))


def current_records(table: DataFrame) -> DataFrame:
    """Latest row per natural key, by run and then by batch.

    An aggregate rather than a ranking: it combines map-side, so a key rewritten by
    very many batches still reaches its task as one row per input task.
    """
    rest = [c for c in table.columns if c not in S.KEY]
    version = F.struct(*[c for c in VERSION if c in table.columns])
    latest = F.max_by(F.struct(*rest), version)
    return table.groupBy(*S.KEY).agg(latest.alias("_r")).select(*S.KEY, "_r.*")


def compact_records(spark: SparkSession, path: str, into: str) -> None:
    """Write the latest row per key to a new table with one version.

    It carries the newest version of the old table, so later batches still win and
    readers can move to the new folder at any time after this returns.
    """
    table = read_record_table(spark, path)
    newest = table.agg(F.max(F.struct(*VERSION)).alias("v")).first()["v"]
    if newest is not None:
        upsert_records(current_records(table).drop(*VERSION), into, newest["batch_id"], newest["run"])


def served_series(
    spark: SparkSession,
    path: str,
    region: str,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """The read path: one region of a record table, latest row per key, older layouts filled, in window order.

    Windows may be limited to those that start at or after ``start`` and before ``end``. Only the folders of the region
    and of the days in question are listed, and rows lie in window order within their files.
    """
    top = f"{path}/{partition_name(spark, 'region', region)}"
    days = [n for n in children(spark, top) if _in_days(n.removeprefix("window_date="), start, end)]
    rows = read_record_table(spark, path, folders=[f"{top}/{n}" for n in days]).where(F.col("region") == region)
    if start is not None:
        rows = rows.where(F.col("window_start") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("window_start") < F.lit(end))
    return with_legacy_states(current_records(rows)).select(*S.RECORD_COLUMNS).orderBy("window_start")


def _in_days(day: str, start: datetime | None, end: datetime | None) -> bool:
    return (start is None or day >= start.date().isoformat()) and (end is None or day <= end.date().isoformat())


def region_series(table: DataFrame, region: str) -> DataFrame:
    """One region's rows by window start; the region prunes partitions."""
    return table.where(F.col("region") == region).orderBy("window_start")


def with_legacy_states(df: DataFrame) -> DataFrame:
    """Bring rows of any age to the record layout.

    An absent measure stays null. An absent comparison is stated as one that was not
    made, never as one that agreed.
    """
    defaults = {
        "pm25_disagreement": F.lit(S.NOT_COMPARED),
        "provenance_tier": F.lit(S.UNCHECKED),
        "flagged_city_count": F.lit(0),
        "covered_city_count": F.lit(0),
        "city_comparisons": F.array(),
    }
    columns = []
    for field in S.RECORD_SCHEMA.fields:
        have = F.col(field.name) if field.name in df.columns else F.lit(None)
        column = have.cast(field.dataType)
        if field.name in defaults:
            column = F.coalesce(column, defaults[field.name].cast(field.dataType))
        columns.append(column.alias(field.name))
    extra = [c for c in df.columns if c not in S.RECORD_COLUMNS]
    return df.select(*columns, *extra)


def _by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """Bring a partition's rows together before writing, so that files are few.

    A rebalance splits a partition that is too large for one task and joins small
    ones, by the sizes seen at run time.
    """
    return df.hint("rebalance", *columns)


def append_raw(events: DataFrame, path: str) -> None:
    """Append accepted events of every kind, as they are, duplicates included."""
    (
        _by_partition(events.withColumn("event_date", F.to_date("ts")), "event_date", "region")
        .write.mode("append")
        .partitionBy("event_date", "region")
        .parquet(path)
    )


def write_raw_batch(events: DataFrame, path: str, batch_id: int, run: str = BATCH_RUN) -> None:
    """The stream's raw append: a replayed batch replaces its own files."""
    dated = _versioned(events, run, batch_id).withColumn("event_date", F.to_date("ts"))
    _write_batch(_by_partition(dated, "event_date", "region"), path, "event_date", "region")


RAW_SCHEMA = S.T.StructType(
    [
        *[f for f in S.EVENT_SCHEMA.fields if f.name != "region"],
        *VERSION_FIELDS,
        S.T.StructField("event_date", S.T.DateType()),
        S.T.StructField("region", S.T.StringType()),
    ]
)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def write_quarantine(
    rejected: DataFrame, path: str, batch_id: int | None = None, run: str = BATCH_RUN
) -> None:
    """Keep rejected messages; nothing downstream reads this table."""
    if batch_id is None:
        rejected.write.mode("append").partitionBy("reason_code").parquet(path)
        return
    _write_batch(_versioned(rejected, run, batch_id), path, "reason_code")


def fan_out(records: DataFrame, batch_id: int, durable: Callable, serving: Callable) -> None:
    """Durable table first, then the serving one. Both are idempotent, so a retry
    after a failure between them converges."""
    held = records.persist()
    try:
        durable(held, batch_id)
        serving(held, batch_id)
    finally:
        held.unpersist()


def snapshot_report(records: DataFrame, cfg: Settings) -> DataFrame:
    """One row: rows, distinct keys, regions without rows, newest window."""
    by_key = records.groupBy(*S.KEY).agg(F.count(F.lit(1)).alias("n"))
    by_region = by_key.groupBy("region").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), F.max("window_start").alias("newest")
    )
    configured = [F.lit(r) for r in cfg.regions]
    return by_region.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("keys"), F.lit(0)).alias("n_keys"),
        F.max("newest").alias("newest_window_start"),
        # Holds at most one entry per region.
        F.array_except(F.array(*configured), F.collect_set("region")).alias("missing_regions"),
    )


def verify_snapshot(records: DataFrame, cfg: Settings) -> dict:
    report = snapshot_report(records, cfg).first().asDict()
    if report["missing_regions"]:
        raise SnapshotFault(f"no rows for {sorted(report['missing_regions'])}")
    if report["n_rows"] != report["n_keys"]:
        raise SnapshotFault(f"{report['n_rows'] - report['n_keys']} rows repeat a key")
    return report


POINTER = "CURRENT"


def publish_snapshot(records: DataFrame, root: str, version: str, view: str | None, cfg: Settings) -> dict:
    """Write a new version, verify what was written, then point to it. With ``view``, this session's view follows."""
    spark = records.sparkSession
    path = f"{root}/version={version}"
    records.select(*S.RECORD_COLUMNS).write.mode("errorifexists").parquet(path)
    report = verify_snapshot(spark.read.schema(S.RECORD_SCHEMA).parquet(path), cfg)
    point_snapshot(spark, root, version)
    if view:
        read_snapshot(spark, root).createOrReplaceTempView(view)
    return report


def point_snapshot(spark: SparkSession, root: str, version: str) -> None:
    """Make a written version the served one, for every session; older versions stay, so this also rolls back.

    The pointer is written beside its place and renamed over it: readers see the old version or the new one. That is
    one step on HDFS and on local disks; a store without such a rename needs a pointer of its own kind.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(f"{root}/version={version}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise SnapshotFault(f"there is no version {version}")
    fresh, place = jvm.Path(f"{root}/_{POINTER}-{uuid.uuid4().hex}"), jvm.Path(f"{root}/{POINTER}")
    files = jvm.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration())
    out = fresh.getFileSystem(spark._jsc.hadoopConfiguration()).create(fresh)
    out.write(version.encode("utf-8"))
    out.close()
    rename = getattr(jvm, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(fresh, place, options)


def snapshot_version(spark: SparkSession, root: str) -> str:
    """The served version."""
    try:
        found = spark.read.format("binaryFile").load(f"{root}/{POINTER}").select("content").first()
    except AnalysisException as absent:
        raise SnapshotFault(f"nothing has been published under {root}") from absent
    return bytes(found["content"]).decode("utf-8")


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The served version, resolved once: a reader keeps its version while newer ones are published."""
    return spark.read.schema(S.RECORD_SCHEMA).parquet(f"{root}/version={snapshot_version(spark, root)}")
