"""Copy-on-write by region and day, on plain Parquet folders.

A table is split by region, day of the window, run and generation. A batch that touches a region and day reads the
generation that stands there, merges its own rows and writes the result as the next one; the one before it stays until
the batch after has been written, anything older goes. So a partition holds at most two generations however many
batches have touched it, a batch reads and writes only what it touches, and the same batch written again after a
failure starts from the same generation and replaces what its first attempt left.

A run has one writer, and its batches come in order. Several runs never write to one folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = ("region", "window_date", "run", "gen")


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    at, fs = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()) if fs.exists(at) else []


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        at, fs = _folder(spark, folder)
        fs.delete(at, True)


def named(spark: SparkSession, column: str, value) -> str:
    """The folder name of a partition value, as the writer spells it."""
    text = None if value is None else str(value)
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, text)


def touched_days(rows: DataFrame) -> list[tuple]:
    """(region, day) of the windows in a batch. As long as the batch has distinct days, for a backfill too."""
    days = rows.select("region", F.to_date("window_start").alias("window_date")).distinct()
    return sorted((tuple(r) for r in days.collect()), key=repr)


def _generations(spark: SparkSession, path: str, part: tuple, run: str) -> list[tuple[int, str]]:
    """Batch number and folder of the generations of a region and day, oldest first."""
    folder = "/".join([path, named(spark, "region", part[0]), named(spark, "window_date", part[1]), named(spark, "run", run)])
    names = [n for n in children(spark, folder) if n.startswith("gen=")]
    return sorted((int(n.removeprefix("gen=").split("-")[0]), f"{folder}/{n}") for n in names)


def newest(spark: SparkSession, path: str, parts: Iterable[tuple], run: str) -> list[str]:
    """The folder that stands for each region and day."""
    return [found[-1][1] for p in parts if (found := _generations(spark, path, p, run))]


def all_runs(spark: SparkSession, path: str, parts: Iterable[tuple]) -> list[str]:
    """Folders of some regions and days, with all their runs."""
    known: dict = {}
    out = []
    for region, day in parts:
        top = f"{path}/{named(spark, 'region', region)}"
        days = known.setdefault(top, set(children(spark, top)))
        if (name := named(spark, "window_date", day)) in days:
            out.append(f"{top}/{name}")
    return out


def read(spark: SparkSession, path: str, folders: list[str] | None, schema: T.StructType) -> DataFrame:
    """The rows of some folders of a table, or of all of it; nothing else is listed."""
    if folders is not None and not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(with_parts(schema))
    rows = reader.parquet(path) if folders is None else reader.option("basePath", path).parquet(*folders)
    return rows.select(*schema.names)


def with_parts(schema: T.StructType) -> T.StructType:
    kinds = {"region": T.StringType(), "window_date": T.DateType(), "run": T.StringType(), "gen": T.StringType()}
    plain = [f for f in schema.fields if f.name not in kinds]
    return T.StructType([*plain, *[T.StructField(n, k) for n, k in kinds.items()]])


def fold_in(
    rows: DataFrame,
    path: str,
    batch_id: int,
    run: str,
    merge: Callable[[DataFrame], DataFrame],
    repeatable: bool = False,
) -> None:
    """Merge a batch into the regions and days it touches. ``rows`` has region and window_start; ``merge`` gives one
    row per key of its input, with the same columns. A merge that may see a row twice without harm (latest wins; not a
    sum) is ``repeatable``: it takes all older generations, so that batches of a run that come out of order lose nothing.
    """
    spark = rows.sparkSession
    held = rows.persist()
    try:
        base, stale = [], []
        for part in touched_days(held):
            found = _generations(spark, path, part, run)
            older = [f for n, f in found if n < batch_id]
            base += older if repeatable else older[-1:]
            stale += older[:-1] + [f for n, f in found if n == batch_id]
        both = held.unionByName(read(spark, path, base, held.schema)) if base else held
        gen = f"{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        merged = merge(both).withColumns(
            {"window_date": F.to_date("window_start"), "run": F.lit(run), "gen": F.lit(gen)}
        )
        (
            merged.hint("rebalance", "region", "window_date").sortWithinPartitions(*PARTS, "window_start")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)
        )
        remove(spark, stale)
    finally:
        held.unpersist()
