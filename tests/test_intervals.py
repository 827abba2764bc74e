import random
from datetime import timedelta

import pytest
from frames import contact, d, dims, rows, status
from pyspark.sql import functions as F

from spanbill.operators.ordered import HotKeys, group_scan
from spanbill.plans import intervals as I

GENERAL = "person_id long, program string, start_date date, exit_date date, end_date date, end_id long, end_note string"
DETAIL = "person_id long, kind int, program string, start_date date, exit_date date, end_date date, end_id long, end_note string"


def crowded(spark, people):
    return HotKeys(spark.createDataFrame([(p,) for p in people], "person_id long"), 3)


def some_spells(seed):
    rng, general, detail = random.Random(seed), [], []
    exits = [None, d("2014-06-01"), d("2015-06-01")]
    for person in (1, 2, None):
        for k in range(30):
            out = rng.choice(exits)
            start = None if k == 7 else d("2014-01-01") + timedelta(rng.randint(0, 40))
            general.append((person, rng.choice(["GtC", "YtC"]), start, out, out, None if out is None else 50 + k, None if out is None else "g"))
            out = rng.choice(exits)
            start = None if k == 9 and seed else d("2014-01-01") + timedelta(rng.randint(-10, 30))
            end = rng.choice([out, d("2014-05-01")])
            detail.append((person, rng.choice([13, 16, 99]), rng.choice(["YtC", "ytc", "GtC"]), start, out, end, None if end is None else k, f"n{k}"))
    return general, detail


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("once", [False, True])
def test_pairs_of_hot_people(spark, seed, once):
    general, detail = some_spells(seed)
    general, detail = spark.createDataFrame(list(dict.fromkeys(general)), GENERAL), spark.createDataFrame(detail, DETAIL)
    kinds = dims(spark).kinds
    plain = I.merge_intervals(general, detail, kinds)
    hot = I.merge_intervals(general, detail, kinds, crowded(spark, [1, None]), once)
    if once:
        assert rows(hot.distinct()) == rows(plain.distinct()) and hot.count() <= plain.count()
    else:
        assert rows(hot) == rows(plain)


def test_pairs_of_a_person_with_10000_rows_on_one_exit(spark):
    out = d("2020-01-01")
    general = [(1, "YtC", d("2014-01-01") + timedelta(k % 1500), out, out, 1, None) for k in range(5_000)]
    detail = [(1, 13, "YtC", d("2010-01-01") + timedelta(k % 1400), out, out, k, None) for k in range(5_000)]
    frames = spark.createDataFrame(general, GENERAL), spark.createDataFrame(detail, DETAIL)
    assert I.merge_intervals(*frames, dims(spark).kinds, crowded(spark, [1]), once=True).count() == 5_000


def test_groups_of_hot_keys_are_added_up_in_parts(spark):
    rng = random.Random(6)
    data = [(rng.choice([1, 2, None]), rng.choice(["a", None]), rng.randrange(100)) for _ in range(500)]
    frame, take = spark.createDataFrame(data, "k long, g string, v int"), {"top": F.max("v"), "n": F.count("v")}
    plain = group_scan(frame, "k", ["k", "g"], take)
    warm = group_scan(frame, "k", ["k", "g"], take, HotKeys(spark.createDataFrame([(1,), (None,)], "k long"), 2))
    assert rows(warm) == rows(plain)
    only = group_scan(frame.filter("k = 1"), "k", ["k", "g"], take, HotKeys(spark.createDataFrame([(1,)], "k long"), 2))
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def build(spark, log, **kw):
    return I.build_intervals(status(spark, log), contact(spark), dims(spark, **kw))


def spans(df):
    return rows(df, "seq", "program", "program_detail", "start_date", "end_date", "exit_type")


def test_enrol_without_exit_stays_open(spark):
    df = build(spark, [(1, 1, 2, "gtc", "2014-01-01")])
    assert spans(df) == [(1, "GtC", "GtC", "2014-01-01", None, "None")]


def test_exit_on_the_enrol_day_counts_and_earlier_exit_does_not(spark):
    log = [(1, 1, 3, "gtc", "2013-12-31"), (2, 1, 2, "gtc", "2014-01-01"), (3, 1, 12, "GTC", "2014-01-01")]
    df = build(spark, log)
    assert spans(df) == [(1, "GtC", "GtC", "2014-01-01", "2014-01-01", "Left PCC Links")]


def test_two_enrols_before_one_exit_are_clipped(spark):
    log = [(1, 1, 2, "gtc", "2014-01-01"), (2, 1, 2, "gtc", "2014-03-01"), (3, 1, 3, "gtc", "2014-06-01")]
    assert spans(build(spark, log)) == [
        (1, "GtC", "GtC", "2014-01-01", "2014-03-01", "Transitioned"),
        (2, "GtC", "GtC", "2014-03-01", "2014-06-01", "Left PCC Links"),
    ]


def test_undone_test_people_and_person_zero_are_ignored(spark):
    log = [
        (1, 1, 2, "gtc", "2014-01-01", 9),
        (2, 2, 2, "gtc", "2014-01-01"),
        (3, 0, 2, "gtc", "2014-01-01"),
        (4, 3, 2, "other", "2014-01-01"),
    ]
    df = I.build_intervals(status(spark, log), contact(spark, (0, 1, 2, 3), test=(2,)), dims(spark))
    assert df.count() == 0


def details(spark, log):
    ended = I.spells(I.timeline(status(spark, log), contact(spark)))
    return rows(I.earliest_end(ended), "kind", "start_date", "exit_date", "end_date", "end_id")


def test_detail_change_ends_the_first_and_a_repeat_does_not(spark):
    log = [
        (1, 1, 13, "ytc", "2014-01-01"),
        (2, 1, 13, "ytc", "2014-02-01"),
        (3, 1, 16, "ytc", "2014-03-01"),
    ]
    assert details(spark, log) == [
        (13, "2014-01-01", None, None, None),
        (13, "2014-02-01", None, "2014-03-01", 0),
        (16, "2014-03-01", None, None, None),
    ]


def test_transition_on_the_exit_day_goes_to_the_exit(spark):
    log = [(1, 1, 13, "ytc", "2014-01-01"), (2, 1, 16, "ytc", "2014-03-01"), (3, 1, 3, "ytc", "2014-03-01")]
    assert details(spark, log)[0] == (13, "2014-01-01", "2014-03-01", "2014-03-01", 3)


def test_transition_on_the_exit_day_wins_when_a_later_exit_follows(spark):
    log = [
        (1, 1, 13, "ytc", "2014-01-01"),
        (2, 1, 16, "ytc", "2014-03-01"),
        (3, 1, 3, "ytc", "2014-03-01"),
        (4, 1, 3, "ytc", "2014-05-01"),
    ]
    assert details(spark, log)[0] == (13, "2014-01-01", "2014-03-01", "2014-03-01", 0)


def test_detail_refines_the_general_enrolment(spark):
    log = [
        (1, 1, 2, "yes", "2014-01-10"),
        (2, 1, 13, "ytc", "2014-01-01"),
        (3, 1, 3, "map", "2014-06-01", None, "left"),
    ]
    df = build(spark, log, reason=[(3, 2), (3, 1)], secondary=[(3, 3), (3, 4)])
    assert spans(df) == [(1, "YtC", "Credit", "2014-01-01", "2014-06-01", "Left PCC Links")]
    assert rows(df, "exit_reason", "secondary_reason", "exit_note") == [("Graduated", "Beta,Alpha", "left")]


def test_open_pair_needs_the_second_program(spark):
    log = [(1, 1, 2, "gtc", "2014-01-01"), (2, 1, 13, "gtc", "2014-02-01")]
    assert spans(build(spark, log)) == [
        (1, "GtC", "GtC", "2014-01-01", "2014-02-01", "Transitioned"),
        (2, "GtC", "Credit", "2014-02-01", None, "None"),
    ]


def test_detail_without_general_enrolment_is_kept(spark):
    log = [(1, 1, 13, "YTC", "2014-01-01"), (2, 1, 3, "ytc", "2014-02-01")]
    assert spans(build(spark, log)) == [(1, "YtC", "Credit", "2014-01-01", "2014-02-01", "Left PCC Links")]


def test_details_of_another_program_are_dropped_when_the_exit_is_shared(spark):
    log = [
        (1, 1, 13, "ytc", "2014-01-01"),
        (2, 1, 2, "gtc", "2014-01-01"),
        (3, 1, 16, "ytc", "2014-02-01"),
        (4, 1, 3, "ytc", "2014-06-01"),
    ]
    # no pair, because the programs differ; not unmatched either, because the exit is shared
    df = build(spark, log)
    assert spans(df) == [(1, "GtC", "GtC", "2014-01-01", "2014-06-01", "Left PCC Links")]


def make_order(spark, raw):
    schema = (
        "person_id long, program_detail string, program string, start_date date, end_date date, end_id long, "
        "end_note string"
    )
    return spark.createDataFrame([(p, x, g, d(s), d(e), i, None) for p, x, g, s, e, i in raw], schema)


def repaired(spark, raw):
    df = I.repair_same_start(I.exit_type(I.clip_to_next(I.order_intervals(make_order(spark, raw)))))
    return rows(df, "seq", "program_detail", "start_date", "end_date")


def test_repair_takes_the_unclipped_end_of_the_predecessor(spark):
    raw = [
        (1, "A", "YtC", "2014-01-01", "2014-03-01", 5),
        (1, "B", "YtC", "2014-01-01", "2014-06-01", 6),
    ]
    assert repaired(spark, raw) == [
        (1, "A", "2014-01-01", "2014-03-01"),
        (2, "B", "2014-03-01", "2014-06-01"),
    ]


def test_repair_moves_a_twin_with_the_same_key_too(spark):
    raw = [
        (1, "A", "YtC", "2014-01-01", "2014-03-01", 5),
        (1, "A", "YtC", "2014-01-01", "2014-06-01", 6),
    ]
    assert repaired(spark, raw) == [
        (1, "A", "2014-03-01", "2014-03-01"),
        (2, "A", "2014-03-01", "2014-06-01"),
    ]


def test_open_predecessor_gives_a_null_start(spark):
    raw = [(1, "A", "YtC", "2014-01-01", None, None), (1, "B", "YtC", "2014-01-01", None, None)]
    assert repaired(spark, raw) == [
        (1, "A", "2014-01-01", "2014-01-01"),
        (2, "B", None, None),
    ]


def test_duplicates_and_status_zero(spark):
    raw = [
        (1, "A", "YtC", "2014-01-01", "2014-03-01", 0),
        (1, "A", "YtC", "2014-01-01", "2014-03-01", None),
    ]
    assert rows(I.order_intervals(make_order(spark, raw)), "seq", "end_id") == [(1, None)]


def test_attributes_hold_before_the_end_day(spark):
    log = [
        (1, 1, 2, "gtc", "2014-01-01"),
        (9, 1, 7, "gtc", "2014-02-01"),
        (10, 1, 7, "gtc", "2014-02-01"),
        (11, 1, 7, "gtc", "2014-06-01"),
        (12, 1, 6, "gtc", "2014-02-01"),
        (13, 1, 6, "gtc", "2014-03-01", 99),
        (20, 1, 3, "gtc", "2014-06-01"),
        (21, 1, 2, "gtc", "2014-07-01"),
    ]
    df = build(
        spark, log, district=[(9, 7, "a"), (10, 8, "b"), (11, 7, "c")], coach=[(12, 1), (13, 2)]
    )
    assert rows(df, "seq", "district_name", "district_student_number", "coach_name") == [
        (1, "South", "b", "Kim"),
        (2, "North", "c", "Kim"),
    ]


def test_current_state(spark):
    log = [
        (1, 1, 2, "gtc", "2014-01-01"),
        (2, 1, 3, "gtc", "2014-02-01"),
        (3, 2, 2, "gtc", "2014-01-01"),
    ]
    assert rows(I.current_state(build(spark, log)), "person_id", "current_status") == [(1, "Exited"), (2, "GtC")]


def test_one_person_only(spark):
    log = [(1, 1, 2, "gtc", "2014-01-01"), (2, 2, 2, "gtc", "2014-01-01")]
    df = I.build_intervals(status(spark, log), contact(spark), dims(spark), person=2)
    assert rows(df, "person_id") == [(2,)]


def test_unrepaired_intervals_do_not_overlap(spark, sf_dir):
    from spanbill.sources.fixtures import Domain

    dom = Domain(spark, sf_dir)
    df = I.build_intervals(dom.status, dom.contact, dom.dims)
    by_person = {}
    for r in df.orderBy("person_id", "seq").collect():
        by_person.setdefault(r.person_id, []).append(r)
    starts = 0
    for spans_ in by_person.values():
        for a, b in zip(spans_, spans_[1:]):
            if a.start_date and b.start_date and a.end_date and a.start_date < b.start_date and a.end_date != b.start_date:
                starts += 1
                assert a.end_date <= b.start_date
    assert starts
