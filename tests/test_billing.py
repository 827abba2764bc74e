from datetime import date
from decimal import Decimal

import pytest
from frames import calendar, d, rows, table
from pyspark.sql import functions as F

from spanbill.plans import attendance as A
from spanbill.plans import status as B
from spanbill.plans import terms as T
from spanbill.plans.billing import exit_group_date
from spanbill.sources.fixtures import Domain

D = Decimal


def bill(i, start, program="Attendance", person=1, term=201401, **kw):
    base = {
        "bill_id": i, "person_id": person, "pidm": person, "g_number": f"G{person}", "program": program, "term": term,
        "start_date": d(start), "include_flag": 1, "district_id": 7,
    }
    return base | kw


def bills(spark, *raw):
    return table(spark, "bills", list(raw))


def cycles(spark, *raw):
    """(id, type, start, term, year, period cap, close)"""
    made = []
    for r in raw:
        r = (*r, *[None] * (7 - len(r)))
        made.append(
            {"cycle_id": r[0], "billing_type": r[1], "start_date": d(r[2]), "term": r[3], "program_year": r[4],
             "max_days_period": D(r[5]) if r[5] and r[1].lower() == "attendance" else None, "close_date": d(r[6]),
             "max_credits": D(36) if r[1] == "Term" else None, "max_days_year": D(175) if r[1] == "Term" else None}
        )
    return table(spark, "cycles", made)


def items(spark, *raw):
    """(id, bill, attendance, credits, percents...)"""
    made = []
    for r in raw:
        pct = dict(zip(A.Scenario.PERCENTS, [D(str(x)) if x is not None else None for x in r[4:]]))
        made.append(
            {"item_id": r[0], "bill_id": r[1], "crn": 5, "include_flag": 1, "attendance": D(str(r[2])), "credits": D(str(r[3]))}
            | pct
        )
    return table(spark, "items", made)


def districts(spark):
    return spark.createDataFrame([(7, "North"), (8, "South")], "district_id int, district_name string")


def profile(spark, people=(1, 2)):
    return spark.createDataFrame([(p, "Ann", f"L{p}") for p in people], "person_id long, first_name string, last_name string")


def test_month_cap_goes_to_the_last_bill_of_the_month(spark):
    b = bills(
        spark,
        bill(1, "2014-04-01", max_days_month=D(3)),
        bill(2, "2014-04-16"),
        bill(3, "2014-05-01", include_flag=0, max_days_month=D(4)),
    )
    c = cycles(
        spark,
        (1, "Attendance", "2014-04-01", 1, "y", 10),
        (2, "attendance", "2014-04-16", 1, "y", 7),
        (3, "Attendance", "2014-05-01", 1, "y", 12),
    )
    got = rows(A.month_cap(b, c), "bill_id", "max_days_period", "max_days_month")
    assert got == [(1, D(10), D(3)), (2, D(7), D(17)), (3, D(12), D(4))]
    legacy = rows(A.month_cap(b, c, included_only=False), "bill_id", "max_days_month")
    assert legacy[2] == (3, D(12))


def test_scope_leaves_other_bills_alone(spark):
    b = bills(spark, bill(1, "2014-04-01"), bill(2, "2014-05-01"), bill(3, "2014-05-01", person=2))
    c = cycles(spark, (1, "Attendance", "2014-04-01", 1, "y", 10), (2, "Attendance", "2014-05-01", 1, "y", 7))
    early = rows(A.month_cap(b, c, until=d("2014-04-30")), "bill_id", "max_days_month")
    assert early == [(1, D(10)), (2, None), (3, None)]
    late = rows(A.month_cap(b, c, since=d("2014-05-01"), person=2), "bill_id", "max_days_month")
    assert late == [(1, None), (2, None), (3, D(7))]


def test_amount_weights(spark):
    b = bills(spark, bill(1, "2014-04-01"))
    i = items(spark, (1, 1, 10, 1, 1, 0, 0, 0), (2, 1, 10, 1, 0, 1, 0, 0), (3, 1, 10, 1, 0, 0, 1, 0), (4, 1, 10, 1, None, 0, 0, 1))
    got = A.billed_amount(i, b, districts(spark)).first()
    assert got.billed == D("10") + D("3.33") + D("2.22") + D("1.67") + D("40") * D("0.0167")


def capped(spark, billed, month, adjusted=None, **kw):
    schema = "bill_id long, billed decimal(28,10), small_hours decimal(20,6), inter_hours decimal(20,6), large_hours decimal(20,6), max_days_month decimal(12,4), adjusted_days decimal(10,4)"
    data = [(1, D(billed), D(1), D(0), D(0), None if month is None else D(month), None if adjusted is None else D(adjusted))]
    return A.apply_cap(spark.createDataFrame(data, schema), **kw).first()


def test_cap_and_overage(spark):
    at_cap = capped(spark, "12", "12")
    assert (at_cap.generated_amount, at_cap.generated_over, at_cap.adjusted_ind_hours) == (D(12), D(0), None)
    above = capped(spark, "12.345", "10")
    assert (above.generated_amount, above.generated_over) == (D(10), D("2.35"))
    assert above.adjusted_ind_hours == D("9.49")  # (10 - 0.3497) / 1.0167
    adjusted = capped(spark, "12", "10", "11")
    assert (adjusted.generated_amount, adjusted.generated_over) == (D(11), D(1))
    legacy = capped(spark, "12", "10", "11", use_adjusted=False)
    assert (legacy.generated_amount, legacy.generated_over, legacy.case_weight) == (D(10), D(2), D("0.0167"))
    free = capped(spark, "12", None)
    assert (free.generated_amount, free.generated_over) == (D(12), D(0))


def test_split_month_links_first_and_last_cycle(spark):
    c = cycles(
        spark,
        (1, "Attendance", "2014-04-01", 1, "y", 10),
        (2, "attendance", "2014-04-16", 1, "y", 7),
        (3, "Attendance", "2014-05-01", 1, "y", 12),
        (4, "Term", "2014-04-01", 1, "y", None),
    )
    got = rows(A.split_month_cycles(c), "cycle_id", "ending_cycle_id", "starting_cycle_id", "bill_on_cycle_id")
    assert got == [(1, 2, None, 2), (2, None, 1, 2), (3, None, None, 3), (4, None, None, 4)]


def test_scenario_change_is_null_safe(spark):
    b = bills(spark, bill(1, "2014-01-01"))
    old = items(spark, (1, 1, 1, 1, 1, 0, 0, 0), (2, 1, 1, 1, None, 0, 0, 0)).withColumn("scenario_name", F.lit("S"))
    by_course = spark.createDataFrame([(5, 201401, 2), (5, 201401, 1)], "crn long, term int, scenario_id int")
    scen = spark.createDataFrame(
        [(1, "S", D(1), D(0), D(0), D(0)), (2, "T", D(0), D(1), D(0), D(0))],
        "scenario_id int, scenario_name string, ind_percent decimal(5,3), small_percent decimal(5,3), inter_percent decimal(5,3), large_percent decimal(5,3)",
    )
    values = A.scenario_values(old, b, by_course, scen, districts(spark))
    fresh = A.refresh_scenario(old, values, by="me")
    assert rows(fresh, "item_id", "ind_percent", "updated_by") == [(1, D("1.000"), None), (2, D("1.000"), "me")]


def test_report_rounds_each_bill_first(spark):
    b = bills(
        spark,
        bill(1, "2014-02-01", generated_amount=D("0.25")),
        bill(2, "2014-02-01", generated_amount=D("0.25"), exit_date=d("2014-03-03")),
        bill(3, "2013-08-01", term=201303, generated_amount=D("1.04"), adjusted_days=D(5)),
        bill(4, "2013-09-01", term=201303, generated_amount=D("0")),
        bill(5, "2013-09-01", term=201303, generated_amount=None),
    )
    got = A.attendance_report(b, profile(spark), districts(spark), calendar(spark)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.february, r.august, r.september) == (D("0.6"), D("1.0"), D(0))
    assert (r.total_attendance, r.total_enrollment) == (D("1.6"), D(5))
    assert (str(r.entry_date), str(r.exit_date), r.program_year) == ("2013-08-01", "2014-03-03", "2013-2014")


def test_report_2017_takes_the_first_amount_that_is_set(spark):
    b = bills(
        spark,
        bill(1, "2014-02-01", generated_amount=D(9), corrected_amount=D(8), final_amount=D(7), post_amount=D(6)),
        bill(2, "2014-02-01", generated_amount=D(0), person=2),
    )
    got = A.attendance_report(b, profile(spark), districts(spark), calendar(spark), legacy_2017=True)
    assert rows(got, "person_id", "total_attendance") == [(1, D("6.0")), (2, D("0.0"))]


def test_exit_group_looks_forward_only(spark):
    b = bills(
        spark,
        bill(1, "2014-01-01", exit_date=d("2014-01-20")),
        bill(2, "2014-02-01"),
        bill(3, "2014-03-01", exit_date=d("2014-03-20")),
        bill(4, "2014-04-01"),
    )
    got = rows(exit_group_date(b), "bill_id", "exit_group_date")
    assert got == [(1, "2014-01-20"), (2, "2014-03-20"), (3, "2014-03-20"), (4, None)]


def year_bills(spark):
    raw = [
        bill(1, "2013-07-01", "Credit", term=201303),
        bill(2, "2013-10-01", "Credit", term=201304),
        bill(3, "2014-01-01", "Credit", term=201401),
        bill(4, "2014-04-01", "Credit", term=201402),
    ]
    return bills(spark, *raw)


def units(spark, credits):
    i = items(spark, *[(n, n, 1, c) for n, c in enumerate(credits, 1)])
    c = cycles(spark, *[(t, "Term", "2014-01-01", t, "2013-2014") for t in (201303, 201304, 201401, 201402)])
    ytd = T.ytd_credits(year_bills(spark), i, calendar(spark))
    return rows(T.term_units(ytd, c), "bill_id", "generated_units", "generated_over_units", "generated_amount")


def test_allowance(spark):
    got = units(spark, [10, 26, 5, 1])
    assert [(g[0], g[1], g[2]) for g in got] == [(1, D(10), D(0)), (2, D(26), D(0)), (3, D(0), D(5)), (4, D(0), D(1))]
    assert got[0][3] == D("48.6111")
    over = units(spark, [10, 30, 5, 1])
    assert [(g[1], g[2]) for g in over] == [(D(10), D(0)), (D(26), D(4)), (D(0), D(5)), (D(0), D(1))]


def test_a_term_is_billed_only_with_the_last_bill_id(spark):
    b = bills(
        spark, bill(9, "2013-07-01", "Credit", term=201303), bill(2, "2013-10-01", "Credit", term=201304),
        bill(12, "2014-01-01", "Credit", term=201401),
    )
    i = items(spark, (1, 9, 1, 3), (2, 2, 1, 4), (3, 12, 1, 5))
    got = rows(T.ytd_credits(b, i, calendar(spark)), "term", "bill_id", "credits_term", "credits_to_date")
    assert got == [(201303, 9, D(3), D(3)), (201401, 12, D(5), D(12))]
    year = rows(T.whole_year_credits(b, i, calendar(spark), districts(spark)), "term", "credits_term", "credits_to_date")
    assert year == [(201401, D(5), D(12))]


def test_other_programs_and_fan_out(spark):
    def paid(i, program, days, term=201401):
        return bill(i, "2014-01-01", program, term=term, generated_units=D(3), generated_over_units=D(0),
                    generated_amount=D(days), generated_over=D(0))

    b = bills(spark, paid(1, "A", 100), paid(2, "B", 40), paid(3, "C Attendance", 50), paid(4, "A", 10, 201402))
    others = rows(T.other_program_days(b, calendar(spark)), "program", "other_days")
    assert others == [("A", D(90)), ("B", D(160)), ("C Attendance", D(150))]
    limits = spark.createDataFrame([("2013-2014", D(175))], "program_year string, max_days_year decimal(10,4)")
    args = (b, profile(spark), districts(spark), calendar(spark), limits)
    got = rows(T.term_report(*args), "program", "winter_days", "spring_days", "year_days", "year_days_billed")
    assert got == [("A", D(100), D(10), D(200), D(175)), ("B", D(40), D(0), D(200), D(175))]
    fan = rows(T.term_report(*args, legacy_fanout=True), "program", "winter_days")
    assert fan == [("A", D(200)), ("B", D(80))]


def test_billing_status(spark):
    b = bills(
        spark,
        bill(1, "2014-01-01", pidm=None),
        bill(2, "2014-01-01", include_flag=0),
        bill(3, "2014-02-01", include_flag=0),
        bill(4, "2014-01-01"),
        bill(5, "2014-02-01"),
        bill(6, "2014-02-01", reviewed_flag=1),
        bill(7, "2014-02-01"),
    )
    c = cycles(spark, (1, "Attendance", "2014-01-01", 1, "y", 10, "2014-03-01"), (2, "Term", "2014-02-01", 1, "y", None, "2014-03-01"))
    i = items(spark, (1, 6, 1, 1), (2, 7, 1, 1))
    assert [r[1] for r in rows(B.billing_status(b, c, i))] == [
        "Missing Banner Attribute", "Excluded", "Excluded from Billing", "Billed", "No Classes", "Reviewed", "In Progress",
    ]


@pytest.mark.parametrize("legacy, want", [(False, "2014-01-10"), (True, None)])
def test_exit_across_december(spark, legacy, want):
    b = bills(spark, bill(1, "2013-12-01", "Credit", end_date=d("2014-02-28"), enrolled_date=d("2013-01-05")))
    spans = spark.createDataFrame(
        [(1, d("2013-01-05"), "CREDIT", d("2014-01-10"), 1)],
        "person_id long, start_date date, program_detail string, end_date date, exit_reason_id int",
    )
    since = B.year_start(calendar(spark), d("2014-02-15"))
    got = rows(B.exit_backfill(b, spans, since, legacy), "exit_date")
    assert got == [(want,)]
    reasons = spark.createDataFrame([(1, "x", 60)], "reason_id int, reason_text string, reason_num int")
    assert rows(B.exit_code_backfill(b, spans, reasons, since), "exit_code") == [(None,)]
    reasons = spark.createDataFrame([(1, "x", 51)], "reason_id int, reason_text string, reason_num int")
    assert rows(B.exit_code_backfill(b, spans, reasons, since), "exit_code") == [(51,)]


def test_whole_runs_register_their_report(spark, sf_dir):
    from spanbill.sources.fixtures import Domain

    m = Domain(spark, sf_dir)
    cycle = {"cycle_id": 20140401, "start_date": d("2014-04-01"), "year_start": d("2013-07-01"), "program_year": "2013-2014"}
    run = A.generate_attendance_billing(
        m.bills, m.items, m.cycles, m.course_scenarios, m.scenario_dim, m.districts, m.profile, m.calendar, cycle, 77, "clerk"
    )
    assert rows(run.header) == [(77, 20140401, "clerk")]
    assert run.cycles.filter("latest_report_id = 77").count() == 1
    report = run.report.agg(F.count("*").alias("n"), F.max("report_id").alias("id"), F.sum("may").alias("may")).first()
    assert report.n > 0 and report.id == 77 and report.may == 0
    late = run.bills.filter("start_date > date'2014-04-01' or start_date < date'2013-07-01'")
    assert late.filter("adjusted_ind_hours is not null or small_weight is not null").count() == 0
    assert run.bills.filter("updated_by = 'clerk'").count() > 0
    assert run.bills.filter("start_date < date'2013-07-01' and updated_by is not null").count() == 0
    billed = run.bills.filter("generated_amount > coalesce(adjusted_days, max_days_month)").filter("program like '%Attendance' and include_flag = 1")
    assert billed.filter("adjusted_ind_hours is not null").count() == 0
    term = {"cycle_id": 201402, "term": 201402, "program_year": "2013-2014"}
    run = T.generate_term_billing(m.bills, m.items, m.cycles, m.districts, m.profile, m.calendar, term, 78, "clerk")
    assert run.report.count() > 0 and rows(run.header)[0][0] == 78
    assert run.bills.filter("updated_by = 'clerk'").count() > 0
    assert run.bills.filter("term > 201402 and updated_by is not null").count() == 0


def test_items_are_refreshed_along_their_bills(spark, sf_dir):
    """The looked-up values are those joined by item id, and no item is shuffled by its id."""
    d = Domain(spark, sf_dir)
    lookups = d.bills.filter(A.in_scope(since=date(2014, 1, 1))), d.course_scenarios, d.scenario_dim, d.districts
    want = A.refresh_scenario(d.items, A.scenario_values(d.items, *lookups), by="me")
    found = A.refreshed_items(d.items, *lookups, by="me")
    assert "hashpartitioning(item_id" not in found._jdf.queryExecution().executedPlan().toString()
    found = found.select(*want.columns)
    assert want.filter("updated_by = 'me'").count() > 0
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    billed = A.refreshed_items(d.items, *lookups, billable_only=True)
    assert billed.join(A.billable(lookups[0], d.districts), "bill_id", "left_anti").isEmpty() and not billed.isEmpty()
