"""Tables, shared intermediate results and connected components for the operators here."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, label: str) -> DataFrame:
    """The rows with a number ``row`` of their own, written down once, so that every reader sees the same."""
    return cut(df.withColumn("row", F.monotonically_increasing_id()), label)


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python tasks in batches that stay small where rows are whole texts or sets."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def shared_dir(spark: SparkSession) -> str:
    """The folder every machine sees: what the session names, or one of our own on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="envgrade-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back, so that a lost executor costs no recomputation."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs, which stay until the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def content(text: str | Column) -> Column:
    """The text, with an empty one for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def utf8(text: str) -> bytes:
    """UTF-8 bytes; what has no encoding (a lone surrogate) becomes a question mark."""
    return text.encode("utf-8", "replace")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links (a, b): one row (id, root) per linked id, root the smallest id.

    Alternating large-star and small-star rounds. Every round rewrites each link to point at a smaller id and
    is written to the shared folder; rounds grow with the logarithm of the longest chain. A node with very
    many links is split: its links meet only in a minimum, which combines map-side, and in a join that
    adaptive execution splits.
    """
    spark = links.sparkSession
    pairs = links.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    ).distinct()
    pairs, before = cut(pairs, "links"), None
    for _ in range(max_rounds):
        # Large star: each larger neighbour of a node is linked to the node's smallest neighbour.
        both = pairs.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(
            pairs.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        low = both.groupBy("n").agg(F.least(F.min("m"), F.first("n")).alias("root"))
        large = both.join(low, "n").where("m > n and m <> root").select(
            F.col("m").alias("hi"), F.col("root").alias("lo")
        )
        large = cut(large.distinct(), "large")
        # Small star: each node and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("hi").agg(F.min("lo").alias("root"))
        small = large.join(low, "hi")
        pairs = cut(
            low.select("hi", F.col("root").alias("lo"))
            .union(small.where("lo <> root").select(F.col("lo").alias("hi"), F.col("root").alias("lo")))
            .distinct(),
            "links",
        )
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        release(spark)
        if tuple(state) == before:
            return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("root")).union(
                pairs.select(F.col("lo").alias("id"), F.col("lo").alias("root")).distinct()
            )
        before = tuple(state)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
