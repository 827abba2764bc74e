"""Attendance billing: weighted hours per bill, capped per month.

All billing dates are computed in one grouped job; there is no loop over the
earlier dates of the year, since a later run simply recomputes them.
"""

from __future__ import annotations

from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanbill.functions import fixed
from spanbill.functions.exprs import any_of, decimal, differs, given, is_attendance
from spanbill.operators.snapshots import apply_changes, stamps, write_new
from spanbill.operators.stage import settle
from spanbill.plans.billing import (
    exit_group_date,
    first_set,
    mark_latest,
    named,
    report_header,
    stamped,
    with_year,
)


class Scenario:
    PERCENTS = ("ind_percent", "small_percent", "inter_percent", "large_percent")
    COLUMNS = ("scenario_name", *PERCENTS)


MONTHS = {
    6: "june", 7: "july", 8: "august", 9: "september", 10: "october", 11: "november", 12: "december",
    1: "january", 2: "february", 3: "march", 4: "april", 5: "may",
}


def in_scope(since: date | None = None, until: date | None = None, person: int | None = None) -> Column:
    """Bills of a run: by start date from ``since`` to ``until``, or of one person."""
    keep = F.lit(True)
    if since is not None:
        keep = keep & (F.col("start_date") >= F.lit(since))
    if until is not None:
        keep = keep & (F.col("start_date") <= F.lit(until))
    return keep & (F.col("person_id") == person) if given(person) else keep


def scenario_values(
    items: DataFrame, bills: DataFrame, course_scenarios: DataFrame, scenarios: DataFrame, districts: DataFrame
) -> DataFrame:
    """Scenario and percentages each included attendance item should carry.

    A course with several scenarios in a term uses the smallest scenario id.
    """
    attended = billable(bills, districts)
    return (
        items.filter("include_flag = 1")
        .select("item_id", "bill_id", "crn")
        .join(attended.select("bill_id", "term"), "bill_id")
        .join(smallest_scenario(course_scenarios), ["crn", "term"])
        .join(scenarios, "scenario_id")
        .select("item_id", *Scenario.COLUMNS)
    )


def smallest_scenario(course_scenarios: DataFrame) -> DataFrame:
    return course_scenarios.groupBy("crn", "term").agg(F.min("scenario_id").alias("scenario_id"))


def refreshed_items(
    items: DataFrame,
    bills: DataFrame,
    course_scenarios: DataFrame,
    scenarios: DataFrame,
    districts: DataFrame,
    now: datetime | None = None,
    by: str | None = None,
    billable_only: bool = False,
) -> DataFrame:
    """As ``refresh_scenario`` over ``scenario_values``.

    The values are looked up along the items themselves, so the items are not
    shuffled once more to meet them by item id. ``billable_only`` drops the
    items of bills that are not billable.
    """
    terms = billable(bills, districts).select("bill_id", F.col("term").alias("_term"))
    one = smallest_scenario(course_scenarios).join(scenarios, "scenario_id")
    one = one.select(F.col("crn").alias("_crn"), F.col("term").alias("_of"), F.struct(*Scenario.COLUMNS).alias("_new"))
    taught = (F.col("include_flag") == 1) & (F.col("crn") == F.col("_crn")) & (F.col("_term") == F.col("_of"))
    rows = items.join(terms, "bill_id", "inner" if billable_only else "left").join(one, taught, "left")
    rows = rows.select(*items.columns, "_new")
    return write_new(rows, list(Scenario.COLUMNS), now, by, only_changed=True)


def refresh_scenario(items: DataFrame, values: DataFrame, now: datetime | None = None, by: str | None = None):
    """Item snapshot with current scenarios; only changed items are stamped."""
    return apply_changes(items, values, "item_id", list(Scenario.COLUMNS), now, by, only_changed=True)


def month_cap(
    bills: DataFrame,
    cycles: DataFrame,
    included_only: bool = True,
    since: date | None = None,
    until: date | None = None,
    person: int | None = None,
) -> DataFrame:
    """Set the period cap, and per person and month the month cap.

    The month cap is the sum of the month's period caps. It is placed on the
    bills of the last billing date of the month; the other bills keep what
    they have, and so do bills and months out of scope.
    """
    attends = is_attendance(F.col("program"))
    caps = (
        cycles.filter(F.lower("billing_type") == "attendance")
        .groupBy("start_date")
        .agg(F.min("max_days_period").alias("_cap"))
    )
    rows = bills.join(caps, "start_date", "left")
    scope = in_scope(since, until, person)
    period = F.when(attends & scope, F.coalesce("_cap", "max_days_period")).otherwise(F.col("max_days_period"))
    rows = rows.withColumn("max_days_period", period).drop("_cap")

    counted = rows.filter(attends & (F.col("include_flag") == 1)) if included_only else rows.filter(attends)
    months = counted.groupBy("person_id", F.trunc("start_date", "month").alias("_month")).agg(
        F.max("start_date").alias("start_date"), F.sum("max_days_period").alias("_total")
    )
    month = F.col("_month")
    if since is not None:
        months = months.filter(month >= F.trunc(F.lit(since), "month"))
    if until is not None:
        months = months.filter(month <= F.trunc(F.lit(until), "month"))
    if given(person):
        months = months.filter(F.col("person_id") == person)
    rows = rows.join(months.drop("_month"), ["person_id", "start_date"], "left")
    total = F.coalesce("_total", "max_days_month").cast("decimal(12,4)")
    return rows.withColumn("max_days_month", total).drop("_total")


HOURS = ["ind_hours", "small_hours", "inter_hours", "large_hours"]


def item_hours(items: DataFrame) -> DataFrame:
    """Hours per bill and group size.

    Items are summed per bill before any join, so the shuffle carries one row
    per bill and task instead of every item.
    """
    none = F.lit(0).cast("decimal(5,3)")
    sums = [
        F.sum(F.col("attendance") * F.coalesce(F.col(percent), none)).cast("decimal(20,6)").alias(name)
        for percent, name in zip(Scenario.PERCENTS, HOURS)
    ]
    return items.filter("include_flag = 1").groupBy("bill_id").agg(*sums)


def weighted() -> Column:
    """Billable amount of a row of hours."""
    ind, small, inter, large = [F.col(h) for h in HOURS]
    amount = (
        ind
        + small * decimal(fixed.SMALL_WEIGHT)
        + inter * decimal(fixed.INTER_WEIGHT)
        + large * decimal(fixed.LARGE_WEIGHT)
        + (ind + small + inter + large) * (decimal(fixed.CASE_SHARE) * decimal(fixed.CASE_WEIGHT))
    )
    return amount.cast("decimal(28,10)")


def billable(bills: DataFrame, districts: DataFrame) -> DataFrame:
    """Attendance bills of a known district."""
    attended = bills.filter(is_attendance(F.col("program")))
    return attended.join(districts.select("district_id"), "district_id", "left_semi")


def billed_amount(items: DataFrame, bills: DataFrame, districts: DataFrame) -> DataFrame:
    """Weighted hours per attendance bill."""
    caps = billable(bills, districts).select("bill_id", "max_days_month", "adjusted_days")
    return item_hours(items).join(caps, "bill_id").withColumn("billed", weighted()).drop("ind_hours")


def cap_columns(use_adjusted: bool = True, round_hours: bool = True) -> dict[str, Column]:
    """The billed and the overage part of ``billed``, and the weights used.

    Without a cap everything is billed. The individual hours that would exactly
    fill the month cap are derived only when the amount exceeds it.
    """
    cap = F.coalesce("adjusted_days", "max_days_month") if use_adjusted else F.col("max_days_month")
    billed, month = F.col("billed"), F.col("max_days_month")
    taught = (
        decimal(fixed.HOURS_SMALL) * F.col("small_hours")
        + decimal(fixed.HOURS_INTER) * F.col("inter_hours")
        + decimal(fixed.HOURS_LARGE) * F.col("large_hours")
    )
    hours = F.when(billed > month, (month - taught).cast("decimal(28,10)") / decimal(fixed.HOURS_DIVISOR))
    hours = F.round(hours, 2).cast("decimal(20,2)") if round_hours else hours.cast("decimal(28,10)")
    over = F.when(billed > cap, billed - cap).otherwise(F.lit(0))
    return {
        "generated_amount": F.round(F.when(billed > cap, cap).otherwise(billed), 2).cast("decimal(20,2)"),
        "generated_over": F.round(over, 2).cast("decimal(20,2)"),
        "small_weight": decimal(fixed.SMALL_WEIGHT),
        "inter_weight": decimal(fixed.INTER_WEIGHT),
        "large_weight": decimal(fixed.LARGE_WEIGHT),
        "case_weight": decimal(fixed.CASE_WEIGHT if use_adjusted else fixed.CASE_WEIGHT_2017),
        "adjusted_ind_hours": hours,
    }


def apply_cap(amounts: DataFrame, use_adjusted: bool = True, round_hours: bool = True) -> DataFrame:
    """Cap the amounts of ``billed_amount``."""
    columns = cap_columns(use_adjusted, round_hours)
    return amounts.select("bill_id", *[c.alias(name) for name, c in columns.items()])


class AttendanceRun(NamedTuple):
    items: DataFrame
    bills: DataFrame


def update_attendance_billing(
    bills: DataFrame,
    items: DataFrame,
    cycles: DataFrame,
    course_scenarios: DataFrame,
    scenarios: DataFrame,
    districts: DataFrame,
    legacy_2017: bool = False,
    since: date | None = None,
    until: date | None = None,
    person: int | None = None,
    changed_at: datetime | None = None,
    changed_by: str | None = None,
) -> AttendanceRun:
    """Scenarios, caps and amounts of every attendance bill in scope.

    ``legacy_2017`` ignores adjusted days and the include flag of the month
    cap, and does not round the adjusted hours.

    Only items and bills whose values change are stamped (values that stay NULL
    do not count as a change); the 2017 form stamps every bill it computes.
    """
    scope = in_scope(since, until, person)
    lookups = bills.filter(scope), course_scenarios, scenarios, districts
    fresh = refreshed_items(items, *lookups, changed_at, changed_by)
    caps = ["max_days_period", "max_days_month"]
    before = bills.withColumn("_caps", F.struct(*caps))
    capped = month_cap(before, cycles, not legacy_2017, since, until, person)
    # hours and the district check join onto the bills, which are read once; only bills that can be written need hours
    hours = item_hours(refreshed_items(items, *lookups, billable_only=True))
    known = districts.select("district_id", F.lit(True).alias("_known"))
    rows = (
        capped.join(hours, "bill_id", "left")
        .join(known, "district_id", "left")
        .withColumn("billed", weighted())
    )
    hit = is_attendance(F.col("program")) & scope & F.col("_known") & F.col("billed").isNotNull()
    new = cap_columns(use_adjusted=not legacy_2017, round_hours=not legacy_2017)
    stored = {c: F.col(c) if c in bills.columns else F.lit(None) for c in new}
    moved = any_of([differs(F.col(f"_caps.{c}"), F.col(c)) for c in caps])
    other = F.lit(True) if legacy_2017 else any_of([differs(stored[c], value) for c, value in new.items()])
    written = moved | (F.coalesce(hit, F.lit(False)) & other)
    out = {c: F.when(hit, value).otherwise(stored[c]) for c, value in new.items()}
    rows = rows.withColumns(out | stamps(bills.columns, written, changed_at, changed_by))
    return AttendanceRun(fresh, rows.drop(*HOURS, "billed", "_known", "_caps"))


def split_month_cycles(cycles: DataFrame) -> DataFrame:
    """Link the first and the last attendance cycle of a month with several.

    ``bill_on_cycle_id`` is the cycle that carries the month: the last one.
    Cycles are compared per program year and calendar month.
    """
    attendance = F.lower("billing_type") == "attendance"
    month = F.month("start_date")
    ends = (
        cycles.filter(attendance)
        .groupBy("program_year", month.alias("_month"))
        .agg(
            F.min(F.struct("start_date", "cycle_id")).alias("_first"),
            F.max(F.struct("start_date", "cycle_id")).alias("_last"),
        )
    )
    rows = cycles.withColumn("_month", F.when(attendance, month)).join(ends, ["program_year", "_month"], "left")
    several = F.col("_first.start_date") < F.col("_last.start_date")
    is_first = several & (F.col("start_date") == F.col("_first.start_date"))
    is_last = several & (F.col("start_date") == F.col("_last.start_date"))
    return rows.withColumns(
        {
            "ending_cycle_id": F.when(is_first, F.col("_last.cycle_id")),
            "starting_cycle_id": F.when(is_last, F.col("_first.cycle_id")),
            "bill_on_cycle_id": F.when(several, F.col("_last.cycle_id")).otherwise(F.col("cycle_id")),
        }
    ).drop("_month", "_first", "_last")


def attendance_report(
    bills: DataFrame,
    profile: DataFrame,
    districts: DataFrame,
    calendar: DataFrame,
    year: str | None = None,
    until: date | None = None,
    legacy_2017: bool = False,
) -> DataFrame:
    """Billed days per fiscal month, June to May, and their totals.

    One row per person, exit group, district, program and program year. Every
    bill is rounded to one decimal before it is added. The 2017 form bills the
    first amount that is set, keeps zero rows, and groups by enrolment date.
    """
    if legacy_2017:
        bills = bills.withColumn("_amount", first_set("post_amount", "final_amount", "corrected_amount", "generated_amount"))
        group, left = "enrolled_date", F.max("exit_date")
    else:
        bills = exit_group_date(bills).withColumn("_amount", F.col("generated_amount"))
        group, left = "exit_group_date", F.first("exit_group_date")
    rows = bills.filter(is_attendance(F.col("program")) & (F.col("include_flag") == 1))
    if not legacy_2017:
        rows = rows.filter("_amount != 0")
    if until is not None:
        rows = rows.filter(F.col("start_date") <= F.lit(until))
    rows = named(with_year(rows, calendar, year), profile, districts)

    rounded = F.round(F.coalesce("_amount", F.lit(0)), 1)
    months = [
        F.sum(F.when(F.month("start_date") == number, rounded).otherwise(0)).alias(name)
        for number, name in MONTHS.items()
    ]
    keys = ["last_name", "first_name", "g_number", group, "district_name", "program", "program_year"]
    report = rows.groupBy(*keys).agg(
        F.min("person_id").alias("person_id"),
        F.min("start_date").alias("entry_date"),
        left.alias("exit_date"),
        *months,
        F.sum(rounded).alias("total_attendance"),
        F.sum(F.coalesce("adjusted_days", "max_days_month", F.lit(0))).alias("total_enrollment"),
    )
    return report.drop(group)


class ReportRun(NamedTuple):
    bills: DataFrame
    items: DataFrame
    cycles: DataFrame
    header: DataFrame
    report: DataFrame


def generate_attendance_billing(
    bills: DataFrame,
    items: DataFrame,
    cycles: DataFrame,
    course_scenarios: DataFrame,
    scenarios: DataFrame,
    districts: DataFrame,
    profile: DataFrame,
    calendar: DataFrame,
    cycle: dict,
    run_id: int,
    created_by: str,
    created_at: datetime | None = None,
    legacy_2017: bool = False,
) -> ReportRun:
    """Update, report and register one attendance billing run.

    ``cycle`` gives cycle_id, start_date, year_start and program_year of the
    billing cycle the run is for; in a split month pass the last one (see
    ``split_month_cycles``). The run recomputes the year up to the cycle; the
    2017 form computes the cycle's own date only.
    """
    since = cycle["start_date"] if legacy_2017 else cycle["year_start"]
    done = update_attendance_billing(
        bills, items, cycles, course_scenarios, scenarios, districts, legacy_2017, since, cycle["start_date"],
        changed_at=created_at, changed_by=created_by,
    )
    done = done._replace(bills=settle(done.bills))  # the report, which is sorted by sampled bounds, and the result
    report = attendance_report(
        done.bills, profile, districts, calendar, cycle["program_year"], cycle["start_date"], legacy_2017
    )
    linked = cycles if legacy_2017 else split_month_cycles(cycles)
    return ReportRun(
        done.bills,
        done.items,
        mark_latest(linked, cycle["cycle_id"], run_id),
        report_header(bills.sparkSession, run_id, cycle["cycle_id"], created_by),
        stamped(report, run_id, created_by, created_at),
    )
