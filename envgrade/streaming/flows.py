"""Structured Streaming flows. Offsets commit only after a batch has been written.

``stream_raw`` keeps accepted and rejected messages; ``stream_index`` keeps window
state in Spark, so a window that spans many batches counts all of its events;
``stream_reconcile`` attaches comparisons to the windows a batch has touched;
``stream_ingest`` does all of it from one parse, under one commit.

``stream_ingest`` and ``stream_reconcile`` keep mergeable aggregates of their windows
(see ``partials``): a batch reads its own rows and the aggregates of the days it touches.

Late rows: ``stream_index`` drops and counts them. ``stream_ingest`` adds a row to its
window whenever it comes, or, given a late table, writes rows of closed windows there and
adds only the others, under the batch's one commit. ``stream_reconcile`` takes the index records as they are where
it is given their table. What a run adds up is what that run has read: a new checkpoint
that reads all messages again starts from nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from envgrade import schemas as S
from envgrade.config import Settings
from envgrade.operators.gate import split_valid, valid_events, validate_envelopes
from envgrade.operators.index import aggregate_windows, as_records, score_windows, with_windows
from envgrade.operators.reconcile import attach_reconciliation, rollup_region
from envgrade.sources.tables import (
    RECORD_TABLE_SCHEMA,
    current_records,
    upsert_records,
    write_quarantine,
    write_raw_batch,
)
from envgrade.streaming.partials import fold_events, folded_records, records_at, split_late

GATE_METRICS = "gate"


def start(
    writer: DataStreamWriter, checkpoint: str, once: bool = True, interval: str = "30 seconds"
) -> StreamingQuery:
    """Drain what is there and stop, or keep running on an interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint as a writer: when it was made, and its query's id.

    Both are in the checkpoint, so a restart keeps the name and a new one sorts later.
    """
    made = spark.read.format("binaryFile").load(f"{checkpoint}/metadata").select("modificationTime", "content")
    row = made.first()
    return f"{int(row['modificationTime'].timestamp() * 1000):013d}-{json.loads(bytes(row['content']))['id']}"


def _in_run(checkpoint: str, write: Callable[[DataFrame, int, str], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that also tells its run, looked up once."""
    known: list[str] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(run_of(batch.sparkSession, checkpoint))
        write(batch, batch_id, known[0])

    return run


def gated_stream(messages: DataFrame, cfg: Settings) -> DataFrame:
    """Gate with its counters observed, for the telemetry of the query."""
    return validate_envelopes(messages, cfg, metrics=GATE_METRICS)


def stream_raw(
    messages: DataFrame, cfg: Settings, raw_path: str, quarantine_path: str, checkpoint: str, **run
) -> StreamingQuery:
    """One gate, two outputs, from one evaluation of the batch."""

    def write(batch: DataFrame, batch_id: int, run_name: str) -> None:
        held = batch.persist()
        try:
            valid, rejected = split_valid(held)
            write_raw_batch(valid, raw_path, batch_id, run_name)
            write_quarantine(rejected, quarantine_path, batch_id, run_name)
        finally:
            held.unpersist()

    writer = gated_stream(messages, cfg).writeStream.queryName("raw").foreachBatch(_in_run(checkpoint, write))
    return start(writer, checkpoint, **run)


def stream_ingest(
    messages: DataFrame,
    cfg: Settings,
    raw_path: str,
    quarantine_path: str,
    sink: str,
    checkpoint: str,
    partials: str | None = None,
    late_path: str | None = None,
    **run,
) -> StreamingQuery:
    """Raw append, quarantine and reconciled records of a batch, under one offset commit.

    Aggregates of windows lie under ``partials``, beside the sink if not said otherwise. With ``late_path``, accepted
    rows are either counted in their window or, if it was closed when their batch came (see ``split_late``), written to
    the late table there, which has the layout of the raw table; the raw table holds both.
    """
    kept = partials or f"{sink.rstrip('/')}_partials"

    def write(batch: DataFrame, batch_id: int, run_name: str) -> None:
        held = batch.persist()
        try:
            valid, rejected = split_valid(held)
            write_raw_batch(valid, raw_path, batch_id, run_name)
            write_quarantine(rejected, quarantine_path, batch_id, run_name)
            if late_path is not None:
                valid, late = split_late(valid, kept, cfg, batch_id, run_name)
                write_raw_batch(late, late_path, batch_id, run_name)
            windows, cities = fold_events(valid, kept, cfg, batch_id, run_name)
            upsert_records(folded_records(windows, cities, cfg), sink, batch_id, run_name)
        finally:
            held.unpersist()

    writer = gated_stream(messages, cfg).writeStream.queryName("ingest").foreachBatch(_in_run(checkpoint, write))
    return start(writer, checkpoint, **run)


def windowed_stream(events: DataFrame, cfg: Settings) -> DataFrame:
    """Stateful window aggregates; rows later than the watermark are dropped and counted."""
    return aggregate_windows(events.withWatermark("ts", cfg.watermark), cfg)


def stream_index(
    messages: DataFrame,
    cfg: Settings,
    sink: str | Callable[[DataFrame, int], None],
    checkpoint: str,
    **run,
) -> StreamingQuery:
    """Messages to upserted index records. ``sink`` is a table path or a function."""
    def write(batch: DataFrame, batch_id: int, run_name: str) -> None:
        # Scoring is a per-row projection, so it stays outside the state.
        records = as_records(score_windows(batch, cfg))
        if callable(sink):
            sink(records, batch_id)
        else:
            upsert_records(records, sink, batch_id, run_name)

    events = valid_events(gated_stream(messages, cfg))
    writer = windowed_stream(events, cfg).writeStream.queryName("index")
    return start(writer.outputMode("update").foreachBatch(_in_run(checkpoint, write)), checkpoint, **run)


def touched_windows(events: DataFrame, cfg: Settings) -> DataFrame:
    return with_windows(events, cfg.window_minutes).select(*S.KEY).distinct()


def stream_reconcile(
    raw_stream: DataFrame,
    cfg: Settings,
    sink: str,
    checkpoint: str,
    index_path: str | None = None,
    partials: str | None = None,
    **run,
) -> StreamingQuery:
    """Reconciled records follow the raw table, each of whose files is read once. With ``index_path`` the index values
    are those of that table, and a window it does not hold gets no record."""
    kept = partials or f"{sink.rstrip('/')}_partials"

    def write(batch: DataFrame, batch_id: int, run_name: str) -> None:
        held = batch.persist()
        try:
            windows, cities = fold_events(held, kept, cfg, batch_id, run_name, index=index_path is None)
            if index_path is None:
                done = folded_records(windows, cities, cfg)
            else:
                touched = touched_windows(held, cfg)
                rows = records_at(held.sparkSession, index_path, touched, RECORD_TABLE_SCHEMA)
                index = current_records(rows).select(*S.RECORD_COLUMNS).join(touched, S.KEY, "left_semi")
                done = attach_reconciliation(index, rollup_region(cities))
            upsert_records(done, sink, batch_id, run_name)
        finally:
            held.unpersist()

    writer = raw_stream.writeStream.queryName("reconcile").foreachBatch(_in_run(checkpoint, write))
    return start(writer, checkpoint, **run)
