import pytest
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings
from envgrade.operators.index import compute_records
from envgrade.sources import tables as TB
from envgrade.streaming import flows
from envgrade.streaming.telemetry import MetricsListener, dropped_rows
from envgrade.operators.guards import enforce, same_index
from envgrade.sources.envelopes import read_envelopes, wrap_envelopes
from tests.helpers import frame, satellite, station, weather

CFG = Settings(window_minutes=60)


def _day(hours=range(0, 6), regions=("EUR", "NAM", "AFR", "ASI")):
    rows = []
    for h in hours:
        for i, region in enumerate(regions):
            for m in (5, 20, 50):
                rows.append(weather(f"2026-07-17T{h:02d}:{m:02d}:00", region, 15.0 + h + i + m / 10, m / 10))
            rows.append(satellite(f"2026-07-17T{h:02d}:30:00", region, f"c{i}", pm25=10.0 + h))
            rows += [station(f"2026-07-17T{h:02d}:00:00", region, f"c{i}", f"s{i}{j}", 9.0 + j * 20) for j in range(3)]
    return rows


def test_replay_and_replacement(spark, tmp_path):
    path = str(tmp_path / "t")
    first = compute_records(frame(spark, _day(range(0, 3))), CFG)
    TB.upsert_records(first, path, 1)
    TB.upsert_records(first, path, 1)
    assert TB.read_record_table(spark, path).count() == 12
    changed = first.where("region = 'EUR'").withColumn("impact_index", F.lit(1.0))
    TB.upsert_records(changed, path, 2)
    now = TB.current_records(TB.read_record_table(spark, path))
    assert now.count() == 12
    assert {r.impact_index for r in TB.region_series(now, "EUR").collect()} == {1.0}
    plan = TB.region_series(TB.read_record_table(spark, path), "EUR")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_legacy_rows_state_that_nothing_was_compared(spark):
    old = compute_records(frame(spark, _day(range(1))), CFG).select(*S.KEY, *S.INDEX_COLUMNS[:5])
    row = TB.with_legacy_states(old).first()
    assert (row.model_pm25_ugm3, row.pm25_disagreement, row.provenance_tier) == (None, "NOT_COMPARED", "UNCHECKED")
    assert (row.flagged_city_count, row.city_comparisons) == (0, [])
    assert TB.with_legacy_states(old).schema["city_comparisons"].dataType == S.RECORD_SCHEMA["city_comparisons"].dataType


def test_snapshot_blocks_on_gaps_and_duplicates(spark, tmp_path):
    records = compute_records(frame(spark, _day(range(2))), CFG)
    report = TB.publish_snapshot(records, str(tmp_path), "1", "served", CFG)
    assert (report["n_rows"], report["newest_window_start"].hour) == (8, 1)
    assert spark.table("served").count() == 8
    with pytest.raises(TB.SnapshotFault, match="AFR"):
        TB.publish_snapshot(records.where("region != 'AFR'"), str(tmp_path), "2", "served", CFG)
    with pytest.raises(TB.SnapshotFault, match="repeat"):
        TB.publish_snapshot(records.unionByName(records), str(tmp_path), "3", "served", CFG)
    assert spark.table("served").count() == 8


def test_fan_out_converges_after_a_failure_between_the_tables(spark, tmp_path):
    records = compute_records(frame(spark, _day(range(1))), CFG)
    durable, serving = str(tmp_path / "d"), str(tmp_path / "s")

    def broken(df, i):
        raise OSError("serving table is away")

    with pytest.raises(OSError):
        TB.fan_out(records, 4, lambda df, i: TB.upsert_records(df, durable, i), broken)
    TB.fan_out(
        records, 4, lambda df, i: TB.upsert_records(df, durable, i), lambda df, i: TB.upsert_records(df, serving, i))
    assert TB.read_record_table(spark, durable).count() == TB.read_record_table(spark, serving).count() == 4


@pytest.fixture()
def landed(spark, tmp_path):
    """Three message files that split every window between them."""
    rows = _day()
    folder = tmp_path / "messages"
    for part in range(3):
        batch = wrap_envelopes(frame(spark, rows[part::3])).select("value")
        batch.coalesce(1).write.mode("append").text(str(folder))
    return rows, str(folder)


def test_window_split_over_batches_equals_one_batch(spark, tmp_path, landed):
    rows, folder = landed
    sink, ck = str(tmp_path / "idx"), str(tmp_path / "ck")
    options = {"maxFilesPerTrigger": "1"}
    stream = read_envelopes(spark, folder, streaming=True, options=options)
    q = flows.stream_index(stream, CFG, sink, ck)
    q.awaitTermination()
    table = TB.read_record_table(spark, sink)
    assert table.agg(F.max("batch_id")).first()[0] >= 2
    batch = compute_records(frame(spark, rows), CFG)
    assert enforce(same_index(TB.current_records(table), batch), "stream") == 24
    # Nothing new: a second drain from the same checkpoint changes nothing.
    flows.stream_index(stream, CFG, sink, ck).awaitTermination()
    assert enforce(same_index(TB.current_records(TB.read_record_table(spark, sink)), batch), "again") == 24


def test_crash_between_write_and_commit(spark, tmp_path, landed):
    rows, folder = landed
    sink, ck = str(tmp_path / "idx"), str(tmp_path / "ck")
    state = {"left": 1}

    def write(df, i):
        TB.upsert_records(df, sink, i)
        if state["left"]:
            state["left"] -= 1
            raise RuntimeError("executor and driver lost")

    stream = read_envelopes(spark, folder, streaming=True, options={"maxFilesPerTrigger": "1"})
    with pytest.raises(Exception, match="lost"):
        flows.stream_index(stream, CFG, write, ck).awaitTermination()
    flows.stream_index(stream, CFG, write, ck).awaitTermination()
    batch = compute_records(frame(spark, rows), CFG)
    assert enforce(same_index(TB.current_records(TB.read_record_table(spark, sink)), batch), "replayed") == 24


def test_raw_quarantine_reconcile_and_telemetry(spark, tmp_path, landed):
    rows, folder = landed
    spark.createDataFrame([("{broken",), ('{"event_type":"radar","key":"EUR","payload":{}}',)], "value string").coalesce(1).write.mode("append").text(folder)
    raw, bad, done, metrics = (str(tmp_path / n) for n in ("raw", "bad", "done", "metrics"))
    listener = MetricsListener(spark, metrics)
    spark.streams.addListener(listener)
    try:
        q = flows.stream_raw(read_envelopes(spark, folder, streaming=True), CFG, raw, bad, str(tmp_path / "c1"))
        q.awaitTermination()
        flows.stream_reconcile(
            spark.readStream.schema(TB.RAW_SCHEMA).parquet(raw), CFG, done, str(tmp_path / "c2")).awaitTermination()
        listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    assert TB.read_raw(spark, raw).count() == len(rows)
    assert sorted((r.event_type, r.reason_code) for r in spark.read.parquet(bad).collect()) == [("radar", "schema"), ("unknown", "parse")]
    out = TB.current_records(TB.read_record_table(spark, done))
    batch = compute_records(frame(spark, rows), CFG)
    assert enforce(same_index(out, batch), "reconciled") == 24
    assert {r.covered_city_count for r in out.collect()} == {1}
    seen = spark.read.parquet(metrics).where("query = 'raw'").agg(F.sum("input_rows")).first()[0]
    assert seen == len(rows) + 2


def test_late_rows_are_counted_and_left_out(spark, tmp_path):
    from dataclasses import replace

    cfg = replace(CFG, watermark="1 hour")
    folder = str(tmp_path / "m")

    def add(rows):
        wrap_envelopes(frame(spark, rows)).select("value").coalesce(1).write.mode("append").text(folder)

    sink, ck, metrics = (str(tmp_path / n) for n in ("idx", "ck", "metrics"))
    listener = MetricsListener(spark, metrics)
    spark.streams.addListener(listener)

    def dropped():
        q = flows.stream_index(read_envelopes(spark, folder, streaming=True), cfg, sink, ck)
        q.awaitTermination()
        listener.wait(q)
        return dropped_rows(spark.read.parquet(metrics), "index")

    try:
        add([weather("2026-07-17T01:10:00", "EUR", 20.0), weather("2026-07-17T09:10:00", "EUR", 20.0)])
        assert dropped() == 0
        add([weather("2026-07-17T01:20:00", "EUR", 99.0), weather("2026-07-17T09:20:00", "EUR", 22.0)])
        assert dropped() == 1
    finally:
        spark.streams.removeListener(listener)
    rows = {r.window_start.hour: r for r in TB.current_records(TB.read_record_table(spark, sink)).collect()}
    assert rows[1].temperature_anomaly == pytest.approx(20.0 - 21.1)
    assert rows[9].temperature_anomaly == pytest.approx(21.0 - 21.1)


def test_a_new_checkpoint_keeps_what_an_older_one_wrote(spark, tmp_path):
    """Batch numbers start at 0 again; rows stay, and the newer run wins per key."""
    first, second = _day(range(0, 3)), _day(range(2, 6))
    raw, bad, sink = (str(tmp_path / n) for n in ("raw", "bad", "idx"))
    for n, rows in enumerate((first, second)):
        folder = str(tmp_path / f"m{n}")
        wrap_envelopes(frame(spark, rows)).select("value").coalesce(1).write.text(folder)
        stream = lambda: read_envelopes(spark, folder, streaming=True)
        flows.stream_raw(stream(), CFG, raw, bad, str(tmp_path / f"r{n}")).awaitTermination()
        flows.stream_index(stream(), CFG, sink, str(tmp_path / f"i{n}")).awaitTermination()
    assert TB.read_raw(spark, raw).count() == len(first) + len(second)
    table = TB.read_record_table(spark, sink)
    assert table.select("run").distinct().count() == 2
    now = TB.current_records(table)
    assert now.count() == 24
    newest = table.agg(F.max("run")).first()[0]
    assert now.where("hour(window_start) = 2").select("run").distinct().collect()[0][0] == newest
    into = str(tmp_path / "compact")
    TB.compact_records(spark, sink, into)
    compact = TB.read_record_table(spark, into)
    assert compact.count() == 24 and compact.select(*TB.VERSION).distinct().count() == 1
    changed = compute_records(frame(spark, second), CFG).withColumn("impact_index", F.lit(1.0))
    TB.upsert_records(changed, into, 99, newest)
    assert TB.current_records(TB.read_record_table(spark, into)).where("impact_index = 1.0").count() == 16


def test_read_path_prunes_and_fills(spark, tmp_path):
    path = str(tmp_path / "t")
    TB.upsert_records(compute_records(frame(spark, _day(range(3))), CFG), path, 1)
    out = TB.served_series(spark, path, "EUR")
    assert [r.window_start.hour for r in out.collect()] == [0, 1, 2] and out.columns == list(S.RECORD_COLUMNS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_ingest_writes_all_three_under_one_commit(spark, tmp_path, landed):
    rows, folder = landed
    raw, bad, sink, ck = (str(tmp_path / n) for n in ("raw", "bad", "idx", "ck"))
    stream = read_envelopes(spark, folder, streaming=True, options={"maxFilesPerTrigger": "1"})
    flows.stream_ingest(stream, CFG, raw, bad, sink, ck).awaitTermination()
    assert TB.read_raw(spark, raw).count() == len(rows)
    out = TB.current_records(TB.read_record_table(spark, sink))
    assert enforce(same_index(out, compute_records(frame(spark, rows), CFG)), "ingest") == 24
    assert {r.covered_city_count for r in out.collect()} == {1}


def test_reconcile_keeps_the_index_of_its_table(spark, tmp_path):
    rows = _day(range(2))
    raw, index, sink = (str(tmp_path / n) for n in ("raw", "idx", "out"))
    TB.write_raw_batch(frame(spark, rows), raw, 0)
    early = compute_records(frame(spark, rows), CFG).withColumn("impact_index", F.lit(7.0))
    TB.upsert_records(early, index, 0)
    stream = spark.readStream.schema(TB.RAW_SCHEMA).parquet(raw)
    flows.stream_reconcile(stream, CFG, sink, str(tmp_path / "ck"), index_path=index).awaitTermination()
    out = TB.current_records(TB.read_record_table(spark, sink)).collect()
    assert len(out) == 8 and {r.impact_index for r in out} == {7.0} and {r.covered_city_count for r in out} == {1}
