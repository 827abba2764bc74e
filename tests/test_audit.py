import pytest
from frames import rows
from pyspark.sql import functions as F

from spanbill.plans.audit import MODES, audit_insert, audit_update, changed
from spanbill.streaming.audit_stream import AuditLog, audit_stream, write_audit

OLD = [(1, None, 1), (2, "", 2), (3, "A", 3), (4, "x", None), (5, "same", 5)]
NEW = [(1, "", 1), (2, "x", 2), (3, "a", 4), (4, None, None), (5, "same", 5), (6, "new", 6)]
SCHEMA = "id long, t string, n int"


def changes(spark, mode, **kw):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    return rows(audit_update(old, new, "id", "bill", mode=mode, changed_by="me", **kw), "id_value", "column_name", "old_value", "new_value")


def test_modes(spark):
    number = (3, "n", "3", "4")
    assert changes(spark, "null_safe") == [(1, "t", None, ""), (2, "t", "", "x"), number, (4, "t", "x", None)]
    assert changes(spark, "length") == [(2, "t", "", "x"), number, (4, "t", "x", None)]
    assert changes(spark, "plain") == [(2, "t", "", "x"), number]
    assert (3, "t", "A", "a") in changes(spark, "null_safe", ignore_case=False)
    assert changes(spark, "plain", exclude=("t",)) == [number]


def test_insert(spark):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    got = rows(audit_insert(old, new, "id", "bill"), "id_value", "column_name", "old_value", "new_value", "action")
    assert got == [(6, "id", None, "6", "INSERT"), (6, "n", None, "6", "INSERT"), (6, "t", None, "new", "INSERT")]


def test_stream_equals_batch(spark, tmp_path):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    feed = old.select("id", F.struct("*").alias("old")).join(new.select("id", F.struct("*").alias("new")), "id").drop("id")
    feed.write.parquet(str(tmp_path / "feed"))
    stream = spark.readStream.schema(feed.schema).parquet(str(tmp_path / "feed"))
    audited = audit_stream(stream, "id", "bill", changed_by="me")
    out = str(tmp_path / "audit")
    write_audit(audited, out, str(tmp_path / "progress"), availableNow=True).awaitTermination(120)
    batch = audit_update(old, new, "id", "bill", changed_by="me")
    columns = ["id_value", "column_name", "old_value", "new_value", "action", "changed_by"]
    assert rows(spark.read.parquet(out), *columns) == rows(batch, *columns)


class Feed:
    """A feed of files of changes, and the log of its audit."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, f"file://{tmp_path}"
        self.schema = "change_id long, old struct<id:long,t:string,n:int>, new struct<id:long,t:string,n:int>"
        self.changes, self.log = [], AuditLog(spark, self.path, "change_id")

    def add(self, n):
        some = [(k, (k % 7, f"a{k}", k), (k % 7, f"b{k}", k + k % 2)) for k in range(len(self.changes), len(self.changes) + n)]
        self.changes += some
        self.spark.createDataFrame(some, self.schema).coalesce(1).write.mode("append").parquet(f"{self.path}/feed")

    def run(self, progress, log=None):
        stream = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/feed")
        audited = audit_stream(stream, "id", "bill", changed_by="me", change_id="change_id")
        (log or self.log).write(audited, f"{self.path}/{progress}", availableNow=True).awaitTermination(120)

    def check(self):
        names = ["change_id", "id_value", "column_name", "old_value", "new_value"]
        batch = self.spark.createDataFrame(self.changes, self.schema)
        assert rows(self.log.read(), *names) == rows(audit_stream(batch, "id", "bill", changed_by="me", change_id="change_id"), *names)


def test_log_holds_each_change_once(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(5)
    feed.add(4)
    feed.run("progress")
    feed.check()
    feed.add(3)
    feed.run("progress")  # goes on where it was
    feed.check()
    assert feed.log.epoch(f"{feed.path}/progress") == 0
    feed.add(2)
    feed.run("other")  # all progress lost: the feed is read from its beginning
    feed.check()
    feed.add(2)
    feed.run("other")
    feed.check()
    assert {r.split("-")[0] for r in feed.log.batches.ids()} == {"000000", "000001"}


def test_log_after_a_crash_between_filing_and_progress(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(5)
    feed.add(4)

    class Crashing(AuditLog):
        def file(self, rows, epoch, batch):
            super().file(rows, epoch, batch)
            if batch == 1:
                raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        feed.run("progress", Crashing(spark, feed.path, "change_id"))
    feed.check()
    feed.run("progress")
    feed.check()
    assert len(feed.log.batches.ids()) == 2


def test_fingerprint_lets_no_change_slip(spark):
    values = [None, "", "a", "A", "aa", "\u0130", "i\u0307", "x"]
    pairs = [(i * 100 + j, a, b) for i, a in enumerate(values) for j, b in enumerate(values)]
    numbers = [None, 0.0, -0.0, 1.0, float("nan")]
    old = spark.createDataFrame([(k, a, numbers[k % 5]) for k, a, _ in pairs], "id long, t string, n double")
    new = spark.createDataFrame([(k, b, numbers[k // 100 % 5]) for k, _, b in pairs], "id long, t string, n double")
    for mode in MODES:
        both = old.withColumnsRenamed({"t": "t0", "n": "n0"}).join(new, "id")
        plain = both.filter(changed(F.col("t0"), F.col("t"), mode, True)).select("id", F.lit("t"))
        plain = plain.union(both.filter(changed(F.col("n0"), F.col("n"), mode, False)).select("id", F.lit("n")))
        found = audit_update(old, new, "id", "bill", ["t", "n"], mode=mode).select("id_value", "column_name")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_replaying_the_audit_gives_the_new_snapshot(spark):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    log = audit_update(old, new, "id", "bill", changed_by="me", ignore_case=False).collect()
    table = {r.id: r.asDict() for r in old.collect()}
    for entry in log:
        value = entry.new_value
        table[entry.id_value][entry.column_name] = int(value) if entry.column_name == "n" and value else value
    assert table == {r.id: r.asDict() for r in new.filter("id < 6").collect()}
