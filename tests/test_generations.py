import glob

import pytest
from pyspark.sql import functions as F

from envgrade.operators.guards import enforce, same_index
from envgrade.operators.index import compute_records
from envgrade.operators.reconcile import reconcile_rows
from envgrade.sources import generations as G
from envgrade.sources import tables as TB
from envgrade.sources.envelopes import read_envelopes
from envgrade.streaming import flows
from envgrade.streaming.partials import counted_rows, fold_events, folded_records, split_late
from tests.helpers import frame, satellite, station, weather
from tests.test_tables import CFG, _day, landed  # noqa: F401

CITY = "c0"


def _split(rows, n):
    return [rows[i::n] for i in range(n)]


def _whole(spark, rows):
    events = frame(spark, rows)
    kinds = [events.where(F.col("event_type") == k) for k in ("station", "satellite")]
    return reconcile_rows(compute_records(events, CFG), *kinds, CFG)


def _plain(df):
    names = ("region", "window_start", "pm25_disagreement", "flagged_city_count", "covered_city_count", "city_comparisons")
    return sorted(str([r[n] for n in names]) for r in df.collect())


def test_folded_batches_equal_one_pass_and_replays_change_nothing(spark, tmp_path):
    rows, path = _day(range(0, 3)), str(tmp_path / "p")
    parts = _split(rows, 4)
    for batch, part in enumerate(parts):
        fold_events(frame(spark, part), path, CFG, batch, "7")
        # The last batch again, as after a failure between its write and its commit.
        windows, cities = fold_events(frame(spark, part), path, CFG, batch, "7")
    # A batch that touches all windows of the day, by a station alone, gives all of them back.
    late = [station(f"2026-07-17T0{h}:00:00", r, "c9", "s9", 5.0) for h in range(3) for r in ("EUR", "NAM", "AFR", "ASI")]
    windows, cities = fold_events(frame(spark, late), path, CFG, 9, "7")
    got, want = folded_records(windows, cities, CFG), _whole(spark, rows + late)
    assert enforce(same_index(got, want), "folded") == 12
    assert _plain(got) == _plain(want)
    for name in ("index", "cities"):
        assert len(glob.glob(f"{path}/{name}/region=EUR/window_date=2026-07-17/run=7/gen=*")) <= 2


def test_generations_stay_few_and_reads_stay_small(spark, tmp_path):
    many, once = str(tmp_path / "many"), str(tmp_path / "once")
    records = compute_records(frame(spark, _day(range(0, 6))), CFG)
    held = records.where("region in ('EUR', 'NAM')").cache()
    for batch in range(12):
        TB.upsert_records(held.where(f"hour(window_start) = {batch % 6}"), many, batch)
    TB.upsert_records(held, once, 0)
    assert enforce(same_index(TB.served_series(spark, many, "EUR"), TB.served_series(spark, once, "EUR")), "many") == 6
    files = [len(glob.glob(f"{p}/region=EUR/*/*/*/*.parquet")) for p in (many, once)]
    assert files[1] == 1 and files[0] <= 2


def test_a_range_lists_only_its_days(spark, tmp_path):
    from datetime import datetime, timezone

    path = str(tmp_path / "t")
    rows = [weather(f"2026-07-{d:02d}T0{h}:10:00", "EUR", 20.0 + d) for d in range(1, 21) for h in range(4)]
    TB.upsert_records(compute_records(frame(spark, rows), CFG), path, 0)
    low, high = datetime(2026, 7, 5, 2, tzinfo=timezone.utc), datetime(2026, 7, 6, 1, tzinfo=timezone.utc)
    out = TB.served_series(spark, path, "EUR", low, high)
    assert [(r.window_start.day, r.window_start.hour) for r in out.collect()] == [(5, 2), (5, 3), (6, 0)]
    assert {f.split("window_date=")[1][:10] for f in out.inputFiles()} == {"2026-07-05", "2026-07-06"}
    assert TB.served_series(spark, path, "NAM").count() == 0


def test_rows_know_when_they_were_written(spark, tmp_path):
    path = str(tmp_path / "t")
    records = compute_records(frame(spark, _day(range(2))), CFG)
    TB.upsert_records(records.where("hour(window_start) = 0"), path, 0)
    first = TB.read_record_table(spark, path, written_at=True).agg(F.max("written_at")).first()[0]
    TB.upsert_records(records.where("hour(window_start) = 1"), path, 1)
    now = TB.current_records(TB.read_record_table(spark, path, written_at=True))
    times = {r.window_start.hour: r.written_at for r in now.where("region = 'EUR'").collect()}
    assert times[0] <= first < times[1]


def test_reconcile_reads_no_raw_rows_but_its_own(spark, tmp_path):
    """Each batch's raw file is gone when the next one comes."""
    rows, raw, sink, ck = _day(), tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ck")
    for batch, part in enumerate(_split(rows, 3)):
        for old in glob.glob(f"{raw}/**/*.parquet", recursive=True):
            open(old, "wb").close()
        TB.write_raw_batch(frame(spark, part), str(raw), batch)
        flows.stream_reconcile(spark.readStream.schema(TB.RAW_SCHEMA).parquet(str(raw)), CFG, sink, ck).awaitTermination()
    out = TB.current_records(TB.read_record_table(spark, sink))
    assert enforce(same_index(out, _whole(spark, rows)), "reconciled") == 24 and _plain(out) == _plain(_whole(spark, rows))


def test_a_pointer_moves_for_every_session(spark, tmp_path):
    root, other = str(tmp_path / "snap"), spark.newSession()
    records = compute_records(frame(spark, _day(range(2))), CFG)
    with pytest.raises(TB.SnapshotFault, match="nothing"):
        TB.read_snapshot(other, root)
    TB.publish_snapshot(records.where("hour(window_start) = 0"), root, "1", None, CFG)
    old = TB.read_snapshot(other, root)
    TB.publish_snapshot(records, root, "2", None, CFG)
    assert (old.count(), TB.read_snapshot(other, root).count()) == (4, 8)
    TB.point_snapshot(spark, root, "1")
    assert TB.snapshot_version(other, root) == "1" and TB.read_snapshot(other, root).count() == 4
    with pytest.raises(TB.SnapshotFault, match="no version"):
        TB.point_snapshot(spark, root, "9")
    assert [n for n in G.children(spark, root)] == ["version=1", "version=2"]


@pytest.mark.parametrize("cuts", [1, 3])
def test_a_row_is_late_or_counted(spark, tmp_path, cuts):
    """The windows that a batch finds closed depend on its own query's batches alone; none of its rows is lost."""
    path, late, held = str(tmp_path / "p"), [], []
    old = [weather(f"2026-07-17T0{h}:10:00", "EUR", 20.0) for h in range(6)]
    old += [satellite("2026-07-17T01:10:00", "EUR", CITY), station("2026-07-17T01:10:00", "EUR", CITY, "s1", 5.0)]
    new = [weather(f"2026-07-17T1{h}:10:00", "NAM", 20.0) for h in range(6)]
    batches = [new, *_split(old, cuts)]
    for batch, rows in enumerate(batches):
        for _attempt in range(2):
            good, bad = split_late(frame(spark, rows), path, CFG, batch, "7")
            found = (good.count(), bad.count())
            assert sum(found) == len(rows) and good.columns == bad.columns == frame(spark, rows).columns
            fold_events(good, path, CFG, batch, "7")
        held.append(found[0])
        late.append(found[1])
    # 15:10 less six hours: all windows that end by 09:10 are closed.
    assert late == [0, *[len(p) for p in batches[1:]]]
    assert sum(r.counted_rows for r in counted_rows(spark, path).collect()) == sum(held) == len(new)
    assert len(glob.glob(f"{path}/newest/run=7/batch_id=*")) <= 2


def test_a_batch_closes_no_window_for_itself(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = frame(spark, [weather("2026-07-17T00:10:00", "EUR", 1.0), weather("2026-07-18T00:10:00", "EUR", 1.0)])
    assert split_late(rows, path, CFG, 0, "7")[1].count() == 0
    assert split_late(rows.limit(0), path, CFG, 1, "7")[1].count() == 0
    good, bad = split_late(rows, path, CFG, 2, "7")
    assert (good.count(), bad.count()) == (1, 1)
