"""Tables that are published whole, sorted tables, and runs that take their own place."""

import pytest
from pyspark.sql import functions as F

from spanbill.functions import fixed
from spanbill.plans.reports import labelled
from spanbill.plans.runs import HEADERS, filed_reports, publish_run
from spanbill.plans.attendance import ReportRun
from spanbill.sources.published import Published, Runs


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}"


def numbers(df):
    return sorted(r.id for r in df.select("id").collect())


def dying(spark):
    return spark.range(1000, numPartitions=4).withColumn("x", F.when(F.col("id") == 999, F.raise_error(F.lit("dies"))).otherwise(1))


def test_a_write_that_dies_leaves_the_old_table(spark, root):
    table = Published(spark, root, "t")
    assert table.version() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.replace(spark.range(5))
    with pytest.raises(Exception, match="dies"):
        table.replace(dying(spark))
    assert table.version() == first and numbers(table.read()) == [0, 1, 2, 3, 4]
    table.replace(spark.range(3))
    assert numbers(table.read()) == [0, 1, 2]
    table.prune()
    assert table.versions() == [table.version()] == table.store.names(f"{table.path}/data")


def test_readers_keep_their_version(spark, root):
    table = Published(spark, root, "t")
    first = table.replace(spark.range(5))
    pinned = table.read()
    table.replace(table.read().filter("id > 2"))  # a table may be rebuilt from itself
    assert numbers(pinned) == numbers(table.read(first)) == [0, 1, 2, 3, 4] and numbers(table.read()) == [3, 4]
    empty = table.replace(spark.range(0))
    assert table.read(empty).count() == 0 and table.read().columns == ["id"]


def test_sorted_table(spark, root):
    rows = [(i * 7919 % 5000, None if i % 50 == 0 else i % 13, f"n{i % 5}") for i in range(5000)]
    table = Published(spark, root, "s")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.replace(spark.createDataFrame(rows, "id long, k int, name string").repartition(6), ["k", "name desc", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, [-ord(c) for c in r[2]], r[0]))
    assert [tuple(r) for r in table.in_order()] == want
    numbered = {r.row_no: (r.id, r.k, r.name) for r in table.numbered().collect()}
    assert [numbered[i + 1] for i in range(5000)] == want
    files = table.read().groupBy("file_no").count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 5000
    assert "SinglePartition" not in table.numbered()._jdf.queryExecution().executedPlan().toString()


def test_a_run_takes_its_own_place(spark, root):
    runs = Runs(spark, root, "r")
    assert runs.ids() == []
    runs.append(spark.range(3), 1)
    runs.append(spark.range(10, 12), 2, ["id"])
    runs.append(spark.range(4), 1)
    assert sorted(runs.ids()) == ["1", "2"]
    assert numbers(runs.read()) == [0, 1, 2, 3, 10, 11] and numbers(runs.read([2])) == [10, 11]


def test_a_run_without_header_is_not_seen(spark, root):
    report = spark.createDataFrame([("b", 1), ("a", 1)], "last_name string, report_id long")
    header = spark.createDataFrame([(1, 20, "me")], "report_id long, cycle_id long, created_by string")
    table = spark.range(2)
    run = ReportRun(table, table, table, header, report)
    publish_run(run, spark, root, "term", 1, ["last_name"])
    Runs(spark, root, "term_report").append(report.withColumn("report_id", F.lit(2).cast("long")), 2)  # died before its header
    assert [tuple(r) for r in filed_reports(spark, root, "term").sort("last_name").collect()] == [(1, "a", 20), (1, "b", 20)]
    assert Runs(spark, root, HEADERS).ids() == ["1"]


def test_labels(spark):
    report = spark.createDataFrame([("G1", "x", 1)], "g_number string, dob string, other int")
    assert labelled(report).columns == [fixed.DISPLAY_LABELS["g_number"], fixed.DISPLAY_LABELS["dob"]]
