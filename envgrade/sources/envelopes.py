"""Region-keyed JSON envelopes: reading, wrapping and joining sources."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.sources.generations import named


def read_envelopes(
    spark: SparkSession,
    location: str,
    *,
    streaming: bool = False,
    source: str = "text",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages as ``key``, ``value`` text; files hold one message per line.

    ``source="kafka"`` takes the topic as ``location`` and needs the connector on
    the class path; offsets, rate limits and servers come in through ``options``.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(source).options(**(options or {}))
    if source == "kafka":
        loaded = reader.option("subscribe", location).load()
        return loaded.select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
        )
    if streaming and source != "text":
        raise ValueError("file streams read text, one message per line")
    lines = reader.load(location).select("value")
    return lines.select(
        F.get_json_object("value", "$.key").alias("key"), "value"
    )


def wrap_envelopes(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed wide events to ``key``, ``value``: the fields of the kind and no others.

    Columns in ``keep`` stay beside the message.
    """
    payload = F.lit(None).cast("string")
    for event_type, fields in S.PAYLOAD_FIELDS.items():
        columns = [
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts")
            if name == "ts"
            else F.col(name)
            for name, *_ in fields
        ]
        body = F.to_json(
            F.struct(
                F.col("event_type"), F.col("region").alias("key"), F.struct(*columns).alias("payload")
            ),
            {"ignoreNullFields": "false"},
        )
        payload = F.when(F.col("event_type") == event_type, body).otherwise(payload)
    return events.select(*keep, F.col("region").alias("key"), payload.alias("value"))


def union_sources(
    sources: Mapping[str, DataFrame | Callable[[], DataFrame]],
) -> tuple[DataFrame, dict[str, str]]:
    """All sources behind one another, tagged with ``source``, and the failures.

    A source may be given as a function that opens it. One that cannot be opened is
    recorded under its name and does not stop the others. An absent reading is not
    a failure: it is simply no row.
    """
    opened, failures = [], {}
    for name, source in sources.items():
        try:
            df = source() if callable(source) else source
        except (PySparkException, OSError) as fault:
            failures[name] = type(fault).__name__
            continue
        opened.append(df.withColumn("source", F.lit(name)))
    if not opened:
        raise ValueError(f"every source failed: {failures}")
    out = opened[0]
    for df in opened[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out, failures


def land_sources(
    spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], path: str, at_once: int = 4
) -> tuple[DataFrame, dict[str, str]]:
    """All sources as `union_sources` gives them, each landed under ``path`` by a job of its own first.

    A source that cannot be opened, or fails while it is read (a damaged file, a cast that a row refuses), is recorded
    under its name with its fault; what it had written is not read, and the others are complete. Jobs run side by side,
    ``at_once`` of them; a job written again replaces what it left.
    """

    def landed(item: tuple[str, Callable[[], DataFrame]]) -> DataFrame | str:
        name, source = item
        folder = f"{path}/{named(spark, 'source', name)}"
        try:
            df = source()
            df.write.mode("overwrite").parquet(folder)
            return spark.read.schema(df.schema).parquet(folder).withColumn("source", F.lit(name))
        except (PySparkException, Py4JJavaError, OSError) as fault:
            return type(fault).__name__

    with ThreadPoolExecutor(at_once) as jobs:
        done = dict(zip(sources, jobs.map(landed, sources.items())))
    failures = {name: out for name, out in done.items() if isinstance(out, str)}
    whole = [out for out in done.values() if not isinstance(out, str)]
    if not whole:
        raise ValueError(f"every source failed: {failures}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), whole), failures


def failure_rows(spark: SparkSession, failures: Mapping[str, str]) -> DataFrame:
    """What `union_sources` could not open, one row per source: at most as many as were asked for."""
    rows = [(name, fault, 0) for name, fault in sorted(failures.items())]
    return spark.createDataFrame(rows, "source string, fault string, n bigint")
