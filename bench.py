"""Time the headline queries and print one JSON line.

Every query is written to the no-op sink, so all rows and columns are computed. Each is
run three times, and the median counts, so the first, cold run does not. Messages, pages and tables that a
query reads are landed before its clock starts, in as many files as there are cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from envgrade.operators.capture import station_hour_gate  # noqa: E402
from envgrade.operators.gate import validate_envelopes  # noqa: E402
from envgrade.operators.index import compute_records  # noqa: E402
from envgrade.plans import inputs as I  # noqa: E402
from envgrade.plans.queries import CFG, QUERIES  # noqa: E402
from envgrade.session import build_session, scratch_path  # noqa: E402
from envgrade.sources.envelopes import read_envelopes  # noqa: E402
from envgrade.sources.pages import explode_station_hours  # noqa: E402
from envgrade.sources.tables import read_record_table, served_series, upsert_records  # noqa: E402
from envgrade.streaming.flows import stream_index  # noqa: E402

QUERY_KEYS = (
    "a_01_compute_records",
    "a_07_grade_confidence",
    "a_08_city_station_values",
    "a_11_reconcile",
    "a_12_run_summary",
    "a_14_rates_by_domain",
    "a_24_bias_table",
    "a_25_difference_quartiles",
    "a_30_admission_funnel",
    "a_31_monthly_normals",
    "a_32_station_population",
    "j_04_event_to_record",
    "j_07_resolve_sensors",
    "k_04_current_records",
    "g_02_reported_never_resolved",
)
RUNS = 3


def landed(spark: SparkSession, sf_dir: str, cpus: int) -> dict[str, Callable[[], DataFrame]]:
    """Queries whose inputs are written first: the gates, the stream and the read path."""
    messages, lines, pages, table = (scratch_path(spark, n) for n in ("messages", "lines", "pages", "records"))
    rows = I.messages(spark, sf_dir).repartition(cpus)
    rows.write.parquet(messages)
    spark.read.parquet(messages).select("value").write.text(lines)
    I.hour_pages(spark, sf_dir).repartition(cpus).write.parquet(pages)
    upsert_records(compute_records(I.events(spark, sf_dir), CFG), table, 1)

    def gate() -> DataFrame:
        judged = validate_envelopes(spark.read.parquet(messages), CFG)
        return judged.select("event_id", "claimed_type", "reason_code")

    def hours() -> DataFrame:
        gated = station_hour_gate(explode_station_hours(spark.read.parquet(pages), I.hour_locations(spark, sf_dir)))
        return gated.groupBy("location_id", "gate_reason").agg(F.count(F.lit(1)).alias("n"))

    def stream() -> DataFrame:
        path = scratch_path(spark, "index")
        query = stream_index(read_envelopes(spark, lines, streaming=True), CFG, path, scratch_path(spark, "ck"))
        query.awaitTermination()
        return read_record_table(spark, path)

    return {
        "p_01_validate_envelopes": gate,
        "p_10_station_hour_gate": hours,
        "t_02_stream_index": stream,
        "k_05_region_series": lambda: served_series(spark, table, "NAM"),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    work: dict[str, Callable[[], DataFrame]] = {
        key: (lambda query=QUERIES[key]: query(spark, sf_dir)) for key in QUERY_KEYS
    }
    work |= landed(spark, sf_dir, int(cpus))

    def run(name: str) -> float:
        begun = time.perf_counter()
        work[name]().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    seconds = {}
    for name in work:
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events_per_sec_index": round(events / seconds["a_01_compute_records"]),
                "messages_per_sec_gate": round(events / seconds["p_01_validate_envelopes"]),
                "messages_per_sec_stream": round(events / seconds["t_02_stream_index"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
