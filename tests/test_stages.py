"""Stages of a job: shared where plans are equal, bucketed where joins need it, gone at the end."""

import os

from pyspark.sql import functions as F

from spanbill.catalog.queries import QUERIES
from spanbill.operators.stage import ensure_checkpoint_dir, finish, job, settle, settle_by


def folders(spark):
    path = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(path) if n.startswith(("job-", "stage-"))}


def test_equal_plans_share_a_stage_and_none_stays(spark):
    before = folders(spark)
    with job(spark) as stages:
        rows = spark.range(100).withColumn("k", F.col("id") % 7)
        one, two = settle(rows.filter("k = 1")), settle(spark.range(100).withColumn("k", F.col("id") % 7).filter("k = 1"))
        other = settle(rows.filter("k = 2"))
        assert one is two and one is not other and sorted(stages.readers.values()) == [1, 2]
        assert one.count() == 15 and folders(spark) != before
        by = settle_by(rows, "k")
        assert settle_by(rows, "k") is by and settle(rows) is not by
        tables = list(stages.tables)
    assert folders(spark) == before and not any(spark.catalog.tableExists(t) for t in tables)


def test_stages_of_one_key_meet_without_an_exchange(spark):
    with job(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            left, right = settle_by(spark.range(1000).select("id", (F.col("id") % 50).alias("k")), "k"), settle_by(spark.range(50).withColumnRenamed("id", "k"), "k")
            both = left.join(right, "k").groupBy("k").count()
            assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
            assert {r["count"] for r in both.collect()} == {20} and both.count() == 50
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_queries_leave_nothing(spark, sf_dir):
    before = folders(spark)
    for name in ("build_intervals", "person_term_scores", "attendance_run", "audit_feed_stream"):
        result = QUERIES[name](spark, sf_dir)
        assert result.count() > 0
        assert folders(spark) - before
        finish(result)
        assert folders(spark) == before, name


def exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line for line in plan.splitlines())


def test_reports_per_term_and_year_need_no_exchange(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("person_term", "person_term_scores", "person_year", "post_pass_gpa"):
            result = QUERIES[name](spark, sf_dir)
            assert exchanges(result) == 0, name
            finish(result)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_stage_is_not_written_again(spark):
    with job(spark) as stages:
        stage = settle(spark.range(9))
        assert settle(stage) is stage and len(stages.readers) == 1
