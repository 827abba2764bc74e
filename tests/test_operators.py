import random
from datetime import date, timedelta

import pytest
from frames import rows
from pyspark.sql import functions as F

from spanbill.operators import ordered as O
from spanbill.operators.asof import latest_before, next_after
from spanbill.operators.periods import date_to_period, overlap_join
from spanbill.operators.snapshots import among, apply_changes, changed_only
from spanbill.plans import intervals as I
from spanbill.sources.fixtures import Domain


def skewed(spark, n=400):
    rng = random.Random(5)
    start = date(2014, 1, 1)
    data = [
        (1 if i % 3 == 0 else rng.randint(2, 9), start + timedelta(rng.randint(0, 40)), i, rng.choice([None, i % 7]))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "person_id long, at date, id long, v int")


def take():
    return {
        "number": O.Take("number"),
        "lead": O.Take("lead", F.struct("v", "id")),
        "lag": O.Take("lag", F.struct("v", "id")),
        "last": O.Take("last", F.col("v")),
        "next": O.Take("next", F.col("v")),
        "next_after": O.Take("next_after", F.col("v")),
        "top_after": O.Take("top_after", F.col("v")),
    }


def test_hot_keys_give_the_same_scan(spark):
    df = skewed(spark)
    hot = O.find_hot_keys(df, "person_id", 60)
    assert [r.person_id for r in hot.keys.collect()] == [1]
    plain = O.ordered_scan(df, "person_id", ["at", "id"], take())
    assert hot.chunks == 3
    split = O.ordered_scan(df, "person_id", ["at", "id"], take(), O.HotKeys(hot.keys, 12))
    assert rows(plain) == rows(split)


def test_null_and_a_key_with_half_of_the_rows_are_split(spark):
    owner = F.when(F.col("id") % 2 == 0, F.lit(1)).when(F.col("id") % 3 != 0, F.lit(None)).otherwise(F.col("id"))
    df = spark.range(900).select(
        owner.cast("long").alias("person_id"), F.date_add(F.lit(date(2014, 1, 1)), (F.col("id") % 50).cast("int")).alias("at"),
        "id", F.when(F.col("id") % 4 != 0, F.col("id") % 7).alias("v"),
    )
    hot = O.find_hot_keys(df, "person_id", 65)
    assert {r.person_id for r in hot.keys.collect()} == {1, None}
    assert rows(O.ordered_scan(df, "person_id", ["at", "id"], take(), hot)) == rows(O.ordered_scan(df, "person_id", ["at", "id"], take()))


def test_no_hot_keys(spark):
    assert O.find_hot_keys(skewed(spark), "person_id", 1000) is None


def test_chunks_are_small_even_on_one_day(spark):
    df = spark.range(2000).select(
        F.lit(1).cast("long").alias("person_id"), F.lit(date(2014, 1, 1)).alias("at"), "id", (F.col("id") % 7).alias("v")
    )
    sizes = []
    original = O._plain

    def spy(frame, keys, order, wanted):
        if "_chunk" in keys:
            sizes.extend(r["count"] for r in frame.groupBy(*keys).count().collect())
        return original(frame, keys, order, wanted)

    O._plain = spy
    try:
        hot = O.HotKeys(df.select("person_id").distinct(), 10)
        got = O.ordered_scan(df, "person_id", ["at", "id"], take(), hot)
    finally:
        O._plain = original
    assert len(sizes) >= 8 and max(sizes) <= 600
    assert rows(got) == rows(O.ordered_scan(df, "person_id", ["at", "id"], take()))


def test_intervals_with_hot_people_are_the_same(spark, sf_dir):
    dom = Domain(spark, sf_dir)
    plain = I.build_intervals(dom.status, dom.contact, dom.dims)
    hot = I.build_intervals(dom.status, dom.contact, dom.dims, hot_rows=60)
    counts = dom.status.filter("undone_by is null").groupBy("person_id").count()
    assert 0 < counts.filter("count > 60").count() < counts.count()
    assert rows(plain) == rows(hot)


def test_asof_against_brute_force(spark):
    df = skewed(spark)
    left = df.filter("id % 2 = 0").select("person_id", "at", F.col("id").alias("left_id"))
    right = df.filter("id % 2 = 1").select("person_id", F.col("at").alias("when"), "id", "v")
    ls, rs = left.collect(), right.collect()
    after = {r.left_id: (r.next_date, r.next_id) for r in next_after(left, right, "person_id", "at", "when", "id").collect()}
    events = latest_before(left, right, "person_id", "at", "when", "id", {"got": F.col("id")}).collect()
    before = {r.left_id: r.got for r in events}
    for l in ls:
        mine = [(r.when, r.id) for r in rs if r.person_id == l.person_id]
        assert after[l.left_id] == min((m for m in mine if m[0] >= l["at"]), default=(None, None))
        assert before[l.left_id] == max((m for m in mine if m[0] < l["at"]), default=(None, None))[1]
    assert len(after) == len(ls) == len(before)


def test_same_timestamp_ids_compare_as_numbers(spark):
    left = spark.createDataFrame([(1, date(2014, 2, 1))], "person_id long, end date")
    right = spark.createDataFrame([(1, date(2014, 1, 1), 9), (1, date(2014, 1, 1), 10)], "person_id long, at date, id long")
    got = latest_before(left, right, "person_id", "end", "at", "id", {"got": F.col("id")})
    assert rows(got, "got") == [(10,)]


def test_open_bound_takes_every_event(spark):
    left = spark.createDataFrame([(1, 1, None), (2, 1, date(2999, 1, 1))], "left_id int, person_id long, end date")
    right = spark.createDataFrame([(1, date(2014, 1, 1), 5), (1, date(3001, 5, 1), 6)], "person_id long, at date, id long")
    got = latest_before(left, right, "person_id", "end", "at", "id", {"got": F.col("id")})
    assert rows(got, "left_id", "got") == [(1, 6), (2, 5)]


def test_every_line_is_an_item(spark, sf_dir):
    d = Domain(spark, sf_dir)
    lines, items = d.raw("lineitem"), d.items
    assert items.count() == lines.count() == items.select("item_id").distinct().count()
    want = lines.groupBy("l_orderkey", "l_partkey").count().collect()
    got = items.groupBy("bill_id", "crn").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.fixture(params=["2000", "0"], ids=["array", "buckets"])
def calendar_rows(spark, request):
    spark.conf.set("spark.spanbill.calendarRows", request.param)
    yield request.param
    spark.conf.unset("spark.spanbill.calendarRows")


def test_a_hot_year_is_not_shuffled(spark):
    left = spark.range(50_000).select("id", F.lit(date(2014, 3, 1)).alias("s"), F.lit(date(2014, 9, 1)).alias("e"))
    terms = [(k, date(2014, 1, 1) + timedelta(30 * k), date(2014, 1, 1) + timedelta(30 * k + 29)) for k in range(12)]
    right = spark.createDataFrame(terms, "term int, b date, f date")
    on = (F.col("s") <= F.col("f")) & (F.col("e") >= F.col("b"))
    pairs = overlap_join(left, right, "s", "e", "b", "f", on)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan
    assert rows(pairs.groupBy("term").count()) == [(k, 50_000) for k, b, f in terms if b <= date(2014, 9, 1) and f >= date(2014, 3, 1)]


def test_long_and_nested_ranges(spark, calendar_rows):
    rng, base = random.Random(5), date(2012, 1, 1)
    terms = []
    for k in range(80):
        b = base + timedelta(rng.randint(0, 900))
        terms.append((k, b, b + timedelta(rng.choice([0, 3, 30, 700]))))
    terms += [(90, None, base), (91, base, None)]
    spans = [(i, base + timedelta(rng.randint(-100, 1500)), base + timedelta(rng.randint(-100, 1700))) for i in range(80)]
    left = spark.createDataFrame(spans, "id int, s date, e date")
    on = (F.least("s", "e") <= F.col("f")) & (F.greatest("s", "e") >= F.col("b"))
    got = rows(overlap_join(left, spark.createDataFrame(terms, "term int, b date, f date"), "s", "e", "b", "f", on), "id", "term")
    want = [(i, t) for i, s, e in spans for t, b, f in terms if b and f and min(s, e) <= f and max(s, e) >= b]
    assert got == sorted(want, key=repr)


def test_overlap_join_against_brute_force(spark, calendar_rows):
    rng = random.Random(3)
    base = date(2011, 6, 1)
    spans = []
    for i in range(60):
        s = base + timedelta(rng.randint(0, 3000))
        e = None if i % 9 == 0 else s + timedelta(rng.randint(-40, 900))
        spans.append((i, None if i == 13 else s, e))
    terms = [(k, base + timedelta(200 + 91 * k), base + timedelta(200 + 91 * k + 120)) for k in range(24)]
    left = spark.createDataFrame(spans, "id int, s date, e date")
    right = spark.createDataFrame(terms, "term int, b date, f date")
    on = (F.col("s") <= F.col("f")) & (F.col("e").isNull() | (F.col("e") >= F.col("b")))
    got = rows(overlap_join(left, right, "s", "e", "b", "f", on), "id", "term")
    want = sorted(
        [(i, t) for i, s, e in spans for t, b, f in terms if s and s <= f and (e is None or e >= b)], key=repr
    )
    assert got == want and len(want) > 100


def test_date_to_period(spark, calendar_rows):
    terms = [(1, date(2013, 12, 1), date(2014, 3, 1)), (2, date(2014, 3, 1), date(2014, 6, 1))]
    cal = spark.createDataFrame(terms, "term int, b date, n date")
    days = [date(2013, 11, 30), date(2013, 12, 1), date(2014, 2, 28), date(2014, 3, 1), date(2014, 6, 1), None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(days)], "i int, at date")
    got = dict(date_to_period(df, "at", cal, "term", "b", "n", "found").select("i", "found").collect())
    assert got == {0: None, 1: 1, 2: 1, 3: 2, 4: None, 5: None}


def test_changes(spark):
    old = spark.createDataFrame([(1, 5, "a"), (2, None, "b"), (3, 0, "c")], "id int, n int, t string")
    new = spark.createDataFrame([(1, 5), (2, 0), (3, None)], "id int, n int")
    assert rows(changed_only(old, new, "id", ["n"]), "id") == [(2,), (3,)]
    assert rows(changed_only(old, new, "id", ["n"], null_as=0), "id") == []
    fresh = apply_changes(old, new.filter("id = 3"), "id", ["n"], "now", "me")
    assert rows(fresh, "id", "n", "updated_by") == [(1, 5, None), (2, None, None), (3, None, "me")]


def test_stage_folder_must_be_shared(spark, monkeypatch):
    from spanbill.operators import stage

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError):
        stage.ensure_checkpoint_dir(Session())


def test_rows_among_many_keys(spark):
    """The bit map lets few other rows through before the shuffle, and the result is that of the plain join."""
    df = spark.range(200_000).select(F.concat(F.lit("k"), "id").alias("key"), "id").unionByName(spark.createDataFrame([(None, -1)], "key string, id long"))
    keys = df.filter("id % 40 = 7").select("key")
    want = sorted(r.id for r in df.join(keys, "key", "left_semi").collect())
    for many in (0, 1_000_000):
        assert sorted(r.id for r in among(df, "key", keys, many).collect()) == want
    assert among(df, "key", keys.limit(0), -1).isEmpty()
