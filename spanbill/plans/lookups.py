"""Set-based lookups: latest attribute before a date, current exit, who to bill."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanbill.functions import fixed
from spanbill.functions.exprs import given
from spanbill.operators.asof import latest_per_key
from spanbill.plans.intervals import current_state, reason_list, select_events

__all__ = ["coach_before", "current_exit", "district_before", "reason_list", "students_to_bill"]


def _last_status(status: DataFrame, kind: int, before: date) -> DataFrame:
    events = select_events(status, (kind,)).filter(F.col("status_date") < F.lit(before))
    return latest_per_key(events, "person_id", "status_date", "status_id", [])


def district_before(status: DataFrame, status_district: DataFrame, districts: DataFrame, before: date) -> DataFrame:
    """Each person's last district assignment before a date."""
    last = _last_status(status, fixed.DISTRICT, before)
    return last.join(status_district, "status_id").join(districts, "district_id")


def coach_before(status: DataFrame, status_coach: DataFrame, before: date) -> DataFrame:
    """Each person's last coach before a date."""
    return _last_status(status, fixed.COACH, before).join(status_coach, "status_id")


def current_exit(
    intervals: DataFrame, contact: DataFrame, contact_id: int | None = None, g_number: str | None = None
) -> DataFrame:
    """The current interval of everyone, or of one person or G-number."""
    people = contact.select("person_id", "first_name", "last_name", "g_number")
    if given(contact_id):
        people = people.filter(F.col("person_id") == contact_id)
    elif given(g_number):
        people = people.filter(F.lower("g_number") == g_number.lower())
    now = current_state(intervals).select("person_id", "start_date", "end_date", "program_detail")
    return now.join(people, "person_id").select(
        "person_id", "first_name", "last_name", "g_number", "start_date", "end_date", "program_detail"
    )


def students_to_bill(
    intervals: DataFrame, contact: DataFrame, bills: DataFrame, begin: date, end: date, g_number: str | None = None
) -> DataFrame:
    """Intervals that touch [begin, end), with the person's billing numbers."""
    touching = (F.col("end_date").isNull() | (F.col("end_date") >= F.lit(begin))) & (
        F.col("start_date") < F.lit(end)
    )
    people = contact.select("person_id", "last_name", "first_name", "g_number")
    if given(g_number):
        people = people.filter(F.lower("g_number") == g_number.lower())
    numbers = bills.select("person_id", "pidm").distinct()
    return (
        intervals.filter(touching)
        .drop("g_number")
        .join(people, "person_id")
        .join(numbers, "person_id", "left")
        .select(
            "person_id",
            "seq",
            F.col("program_detail").alias("program"),
            "start_date",
            "last_name",
            "first_name",
            "g_number",
            "end_date",
            "district_name",
            "district_id",
            "pidm",
        )
    )
