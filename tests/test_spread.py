"""Work per row is dealt over all cores, however few pieces a table's rows come in, and done once."""

import os

import pytest
from pyspark.sql import functions as F

from envgrade.plans import inputs as I
from envgrade.plans import queries as Q
from envgrade.sources import pages as PG

SF_DIR = os.environ.get("ENVGRADE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the analytics tables are not here")


@pytest.fixture
def one_group(spark, tmp_path):
    """Events in one row group, in a file that is read in more pieces than there are cores."""
    table = spark.read.parquet(f"{SF_DIR}/events.parquet")
    table.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    yield str(tmp_path)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _busy(df) -> int:
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


@pytest.mark.parametrize("made", (I.messages, I.hour_pages))
def test_rows_of_one_group_reach_all_cores(spark, one_group, made):
    rows = I.table(spark, one_group, "events")
    assert rows.rdd.getNumPartitions() >= 8 and _busy(rows) == 1
    assert _busy(made(spark, one_group)) >= 8
    assert made(spark, one_group).count() == rows.count()


def test_message_files_of_one_group_hold_equal_shares(spark, one_group):
    path, files = Q._timed_messages(spark, one_group, I.QUARTERS)
    sizes = [r["n"] for r in spark.read.text(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert files >= 8 and max(sizes) <= 2 * sum(sizes) / (4 * files) + files


def test_files_are_as_many_as_cores(spark):
    assert Q._timed_messages(spark, SF_DIR, I.QUARTERS[:1])[1] >= spark.sparkContext.defaultParallelism


def test_a_page_is_read_once(spark):
    rows = PG.explode_station_hours(I.hour_pages(spark, SF_DIR), I.hour_locations(spark, SF_DIR))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils.parseJson") == 1


@pytest.mark.parametrize("key", ("a_28_run_counts", "j_09_cities_without_rows", "j_10_instrument_drift"))
def test_branches_read_a_landed_table(spark, key):
    plan = Q.QUERIES[key](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "parseJson" not in plan
