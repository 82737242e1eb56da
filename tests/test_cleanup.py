"""Shuffle files go with the table that they were for."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from reviewloom.plans import report as O
from reviewloom.plans.stored_report import StoredReport
from reviewloom.session import CLEANUP, cut_lineage


def shuffles(spark) -> set[str]:
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in root for p in Path(d).rglob("shuffle_*.data")}


def test_shuffle_files_go_when_a_table_is_written(spark):
    before, usual = shuffles(spark), spark.conf.get(CLEANUP)
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    written = cut_lineage(rows.join(rows.withColumnRenamed("n", "m"), "k"))
    assert not shuffles(spark) - before and spark.conf.get(CLEANUP) == usual
    assert written.filter("n = 100 AND m = 100").count() == 100


def _tables(spark):
    review = spark.range(60).select(
        F.concat(F.lit("r"), "id").alias("review_id"), (F.col("id") % 3).alias("business_id"), (F.col("id") % 7).alias("user_id"),
        (F.col("id") % 5 + 1).cast("int").alias("stars"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("good cold tacos").alias("text"), F.struct(F.lit(1).alias("funny"), F.lit(2).alias("useful"), F.lit(0).alias("cool")).alias("votes"))
    business = spark.createDataFrame([(i, f"n{i}", "c", "s") for i in range(4)], "business_id long, name string, city string, state string")
    checkin = spark.createDataFrame([(0, {"1-2": 3})], "business_id long, checkin_info map<string,long>")
    return {"business": business, "review": review, "checkin": checkin}


def test_report_holds_no_shuffles_of_its_parts(spark, tmp_path):
    """The parts were one plan, whose shuffles were on disk together."""
    before = shuffles(spark)
    report = O.report(_tables(spark), "2020-01-05")
    left = shuffles(spark) - before
    stored = StoredReport(spark, str(tmp_path), "a", "2020-01-05", buckets=2)
    stored.write(_tables(spark), ["summary", "count"])
    assert not shuffles(spark) - before - left
    rows = {r.business_id: r for r in report.collect()}
    assert sorted(rows) == [0, 1, 2, 3] and rows[0].checkins == 3 and rows[3].overlap is None
    assert json.loads(rows[0].overlap)["name"] == ["n1", "n2"]
    plan = report._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" not in plan and "Window" not in plan
