"""Run telemetry of streaming queries: counts, rates and bounds, never payloads."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

METRICS_SCHEMA = (
    "query STRING, run_id STRING, batch_id BIGINT, at STRING, input_rows BIGINT, "
    "rows_per_second DOUBLE, batch_ms BIGINT, state_rows BIGINT, late_rows BIGINT, "
    "watermark STRING, observed STRING"
)


def progress_row(progress) -> tuple:
    """One metrics row from a progress report (its Python object or its dict)."""
    p = progress if isinstance(progress, dict) else json.loads(progress.json)
    state = p.get("stateOperators") or []
    observed = p.get("observedMetrics") or {}
    return (
        p.get("name"),
        str(p.get("runId")),
        int(p.get("batchId", -1)),
        p.get("timestamp"),
        int(p.get("numInputRows") or 0),
        float(p.get("processedRowsPerSecond") or 0.0),
        int(p.get("batchDuration") or 0),
        sum(int(s.get("numRowsTotal") or 0) for s in state),
        sum(int(s.get("numRowsDroppedByWatermark") or 0) for s in state),
        (p.get("eventTime") or {}).get("watermark"),
        json.dumps(observed, sort_keys=True, default=str),
    )


def dropped_rows(metrics: DataFrame, query: str) -> int:
    """Rows a query's state dropped as late, over all its batches in the metrics table.

    Spark drops after its map-side combine, so late rows of one window that met in
    one task count once: zero means none were late, and more is a lower bound.
    ``stream_ingest`` with a late table keeps the rows themselves.
    """
    return metrics.where(F.col("query") == query).agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]


class MetricsListener(StreamingQueryListener):
    """Appends one row per finished batch to a metrics table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until a finished query's last batch is in the table; events come in order, the end last."""
        if not self._end_of(query.runId).wait(seconds):
            raise TimeoutError(f"no end of {query.name} was reported in {seconds} s")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = progress_row(event.progress)
        df = self._spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1)
        df.write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(event.runId).set()
