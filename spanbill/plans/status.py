"""Billing status and the reconciliation of exits between bills and intervals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanbill.functions import fixed
from spanbill.functions.exprs import is_attendance, iso
from spanbill.plans.intervals import current_state


def billing_status(bills: DataFrame, cycles: DataFrame, items: DataFrame) -> DataFrame:
    """Seven-way status of every bill."""
    kind = F.when(is_attendance(F.col("program")), "attendance").otherwise("term")
    closed = cycles.groupBy(F.lower("billing_type").alias("_type"), "start_date").agg(
        F.max("close_date").alias("_closed")
    )
    counts = items.groupBy("bill_id").agg(F.count(F.lit(1)).alias("_items"))
    excluded, is_closed = F.col("include_flag") == 0, F.col("_closed").isNotNull()
    status = (
        F.when(F.col("pidm").isNull(), fixed.STATUS_NO_ATTRIBUTE)
        .when(excluded & is_closed, fixed.STATUS_EXCLUDED_CLOSED)
        .when(excluded, fixed.STATUS_EXCLUDED)
        .when(is_closed, fixed.STATUS_BILLED)
        .when(F.col("_items").isNull(), fixed.STATUS_NO_CLASSES)
        .when(F.col("reviewed_flag") == 1, fixed.STATUS_REVIEWED)
        .otherwise(fixed.STATUS_OPEN)
    )
    return (
        bills.withColumn("_type", kind)
        .join(closed, ["_type", "start_date"], "left")
        .join(counts, "bill_id", "left")
        .select("bill_id", status.alias("billing_status"))
    )


def year_start(calendar: DataFrame, as_of: date) -> Column:
    """First day of the program year that is running on a date, as a scalar."""
    running = calendar.filter(F.col("term_begin") <= F.lit(as_of)).agg(F.max("program_year")).scalar()
    return calendar.filter(F.col("program_year") == running).agg(F.min("term_begin")).scalar()


def _fits(legacy_month_only: bool) -> Column:
    """Does the exit fall into the bill's period?

    Attendance bills take the month of their start, term bills the months from
    start to end. ``legacy_month_only`` compares month numbers without the
    year, which also fails for periods across December.
    """
    def month(column: str) -> Column:
        return F.month(column) if legacy_month_only else F.trunc(column, "month")

    out, begin, end = month("i_end"), month("start_date"), month("bill_end")
    return F.when(is_attendance(F.col("program")), out == begin).otherwise(out.between(begin, end))


def _matched(bills: DataFrame, intervals: DataFrame, since: Column, legacy_month_only: bool) -> DataFrame:
    spans = intervals.select(
        "person_id",
        F.col("start_date").alias("enrolled_date"),
        F.lower("program_detail").alias("_program"),
        F.col("end_date").alias("i_end"),
        F.col("exit_reason_id").alias("i_reason"),
    )
    rows = bills.filter(F.col("start_date") >= since).select(
        "bill_id", "person_id", "enrolled_date", "program", "start_date", F.col("end_date").alias("bill_end"),
        F.lower("program").alias("_program"),
    )
    return rows.join(spans, ["person_id", "enrolled_date", "_program"]).filter(_fits(legacy_month_only))


def exit_backfill(bills: DataFrame, intervals: DataFrame, since: Column, legacy_month_only: bool = False) -> DataFrame:
    """Fill missing bill exits from the matching interval (the earliest of several)."""
    found = _matched(bills, intervals, since, legacy_month_only).groupBy("bill_id").agg(F.min("i_end").alias("i_end"))
    return (
        bills.join(found, "bill_id", "left")
        .withColumn("exit_date", F.coalesce("exit_date", "i_end"))
        .drop("i_end")
    )


def exit_code_backfill(
    bills: DataFrame, intervals: DataFrame, reasons: DataFrame, since: Column, legacy_month_only: bool = False
) -> DataFrame:
    """Fill missing exit codes with a billable reason number (the smallest of several)."""
    return backfill_exits(bills, intervals, reasons, since, legacy_month_only, dates=False)


def backfill_exits(
    bills: DataFrame,
    intervals: DataFrame,
    reasons: DataFrame,
    since: Column,
    legacy_month_only: bool = False,
    dates: bool = True,
) -> DataFrame:
    """Exit dates and exit codes in one pass over the matching intervals."""
    numbers = reasons.filter(F.col("reason_num").isin(*fixed.BILL_EXIT_REASONS)).select(
        F.col("reason_id").alias("i_reason"), "reason_num"
    )
    found = (
        _matched(bills, intervals, since, legacy_month_only)
        .join(numbers, "i_reason", "left")
        .groupBy("bill_id")
        .agg(F.min("i_end").alias("_end"), F.min("reason_num").alias("_code"))
    )
    rows = bills.join(found, "bill_id", "left").withColumn("exit_code", F.coalesce("exit_code", "_code"))
    if dates:
        rows = rows.withColumn("exit_date", F.coalesce("exit_date", "_end"))
    return rows.drop("_end", "_code")


def exit_reconcile(
    bills: DataFrame,
    intervals: DataFrame,
    items: DataFrame,
    comments: DataFrame,
    profile: DataFrame,
    districts: DataFrame,
    reasons: DataFrame,
    exit_codes: DataFrame,
    since: Column,
) -> DataFrame:
    """Last included bill per person next to the person's current exit.

    An empty exit note gives way to the latest comment by id.
    """
    # two numbers per person are aggregated by hash; whole rows would have to be sorted
    included = bills.filter("include_flag = 1")
    newest = included.groupBy("person_id").agg(F.max("bill_id").alias("bill_id"))
    last = included.join(newest, ["person_id", "bill_id"], "left_semi")
    hours = items.groupBy("bill_id").agg(F.sum("attendance").alias("attendance"))
    talk = comments.groupBy("person_id").agg(F.max_by("comment_text", "comment_id").alias("_comment"))
    of_exit = ["person_id", "seq", "end_date", "exit_reason_id", "secondary_reason", "exit_note", "program", "program_detail"]
    now = current_state(intervals.select(*of_exit)).select(
        "person_id",
        F.col("end_date").alias("_current_end"),
        F.col("exit_reason_id").alias("current_reason_id"),
        F.col("secondary_reason").alias("current_secondary_reason"),
        F.col("exit_note").alias("_note"),
    )
    named = reasons.select(
        F.col("reason_id").alias("current_reason_id"), F.col("reason_text").alias("current_reason")
    )
    note = F.when(F.length("_note") == 0, F.col("_comment")).otherwise(F.col("_note"))
    return (
        last.filter(F.col("start_date") >= since)
        .join(profile, "person_id")
        .join(now, "person_id")
        .join(hours, "bill_id")
        .join(exit_codes, "exit_code", "left")
        .join(districts, "district_id")
        .join(named, "current_reason_id", "left")
        .join(talk, "person_id", "left")
        .select(
            "bill_id",
            iso(F.col("start_date")).alias("start_date"),
            iso(F.col("end_date")).alias("end_date"),
            iso(F.col("exit_date")).alias("exit_date"),
            "exit_code",
            "exit_code_text",
            "exit_status_reason_id",
            "adjusted_days",
            iso(F.when(F.col("_current_end") >= since, F.col("_current_end"))).alias("current_end"),
            "current_reason_id",
            "current_reason",
            "current_secondary_reason",
            note.alias("current_note"),
            "attendance",
            "program",
            "district_name",
            "first_name",
            "last_name",
            "g_number",
            "person_id",
        )
    )
