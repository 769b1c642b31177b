import glob

import pytest
from pyspark.sql import functions as F

from envgrade.sources.envelopes import failure_rows, land_sources


def test_sources_that_fail_while_read_do_not_stop_the_others(spark, tmp_path):
    good, torn = str(tmp_path / "good"), str(tmp_path / "torn")
    spark.range(100).withColumn("v", F.lit(1.5)).write.parquet(good)
    spark.range(100).repartition(2).write.parquet(torn)
    hurt = glob.glob(f"{torn}/*.parquet")[0]
    size = len(open(hurt, "rb").read())
    with open(hurt, "r+b") as f:
        f.truncate(size // 2)
    sources = {
        "good": lambda: spark.read.parquet(good),
        "torn": lambda: spark.read.schema("id long").parquet(torn),
        "cast": lambda: spark.range(5).select(F.concat(F.lit("x"), "id").cast("int").alias("id")),
        "absent": lambda: spark.read.parquet(str(tmp_path / "nothing")),
        "other": lambda: spark.range(7),
    }
    for _ in range(2):
        out, failures = land_sources(spark, sources, str(tmp_path / "landed"))
        assert {r["source"]: r["count"] for r in out.groupBy("source").count().collect()} == {"good": 100, "other": 7}
        assert sorted(failures) == ["absent", "cast", "torn"]
        assert failure_rows(spark, failures).count() == 3
    with pytest.raises(ValueError, match="every source"):
        land_sources(spark, {"absent": sources["absent"]}, str(tmp_path / "landed"))
