"""The message files of the streaming queries hold every event, whatever its time."""

import os

import pytest
from pyspark.sql import functions as F

from envgrade.plans import inputs as I
from envgrade.plans import queries as Q

SF_DIR = os.environ.get("ENVGRADE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the analytics tables are not here")


@pytest.fixture
def longer(spark, tmp_path):
    """Events of which some lie before the month, some after it, and some have no time."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    k = F.col("event_id") % 10
    ts = (
        F.when(k == 0, F.col("ts") - F.expr("INTERVAL 40 DAYS"))
        .when(k == 1, F.col("ts") + F.expr("INTERVAL 40 DAYS"))
        .when(k != 2, F.col("ts"))
    )
    kind = events.schema["ts"].dataType
    events.withColumn("ts", ts.cast(kind)).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_all_events_are_streamed_once(spark, longer):
    path, files = Q._timed_messages(spark, longer, I.QUARTERS)
    wanted = I.messages_of(I.table(spark, longer, "events")).select("value")
    got = spark.read.text(path)
    assert got.count() == wanted.count() and got.exceptAll(wanted).isEmpty()
    assert len(got.inputFiles()) == 4 * files
    row = Q.QUERIES["t_09_run_telemetry"](spark, longer).first()
    assert (row.input_rows, row.late_rows, row.batches) == (wanted.count(), 0, 4)


def test_files_follow_the_input(spark, longer):
    rows = I.table(spark, longer, "events")
    rows.repartition(9).write.parquet(f"{longer}/cut/events.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        assert I.table(spark, f"{longer}/cut", "events").rdd.getNumPartitions() == 9
        path, files = Q._timed_messages(spark, f"{longer}/cut", I.QUARTERS)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert files == 9 and len(spark.read.text(path).inputFiles()) == 36


def test_a_span_of_few_rows_has_as_many_files(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").where("ts < '2024-01-02'").limit(3)
    events.write.parquet(f"{tmp_path}/events.parquet")
    path, files = Q._timed_messages(spark, str(tmp_path), I.QUARTERS)
    assert spark.read.text(path).count() == 3 and len(spark.read.text(path).inputFiles()) == 4 * files
