"""Reports over a date range.

Optional filters are ``None`` (or 0, or empty) when they do not apply. The chosen interval and
the current one come out of one aggregate per person, so the intervals are read
once and a person with many intervals combines map-side.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanbill.functions import fixed
from spanbill.functions.exprs import given, iso, program_name, same_text
from spanbill.plans.intervals import select_events
from spanbill.plans.lookups import district_before


def labelled(report: DataFrame) -> DataFrame:
    """Report columns under their display labels; other columns are dropped."""
    known = [c for c in report.columns if c in fixed.DISPLAY_LABELS]
    return report.select(*[F.col(c).alias(fixed.DISPLAY_LABELS[c]) for c in known])


PICKED = [
    "seq", "program", "program_detail", "start_date", "end_date", "district_name", "district_student_number",
    "coach_name", "exit_reason", "secondary_reason", "exit_note",
]


def _choice(program, detail, district, coach=None) -> Column:
    keep = F.lit(True)
    if given(program):
        keep = keep & same_text(F.col("program"), F.lit(program))
    if given(detail):
        keep = keep & same_text(F.col("program_detail"), F.lit(detail))
    if given(district):
        keep = keep & (F.col("district_id") == district)
    if given(coach):
        keep = keep & (F.col("coach_id") == coach)
    return keep


def _in_range(intervals: DataFrame, contact: DataFrame, keep: Column, first: bool) -> DataFrame:
    row = F.struct(*PICKED)
    pick = F.min if first else F.max
    people = (
        intervals.groupBy("person_id")
        .agg(pick(F.when(keep, row)).alias("p"), F.max(row).alias("c"))
        .filter(F.col("p").isNotNull())
    )
    status = F.when(F.col("c.end_date").isNull(), F.coalesce("c.program_detail", "c.program")).otherwise(
        fixed.STATUS_EXITED
    )
    return people.join(contact, "person_id").withColumns(
        {
            "current_status": status,
            "current_start": iso(F.col("c.start_date")),
            "current_end": iso(F.col("c.end_date")),
            "start_in_range": iso(F.col("p.start_date")),
            "end_in_range": iso(F.col("p.end_date")),
        }
    )


PERSON = ["person_id", "g_number", "first_name", "last_name", "email_main", "email_alt"]
CURRENT = ["current_status", "current_start", "current_end"]


def active_during(
    intervals: DataFrame, contact: DataFrame, start: date, end: date, program=None, detail=None, district=None
) -> DataFrame:
    """Last interval per person that overlaps [start, end)."""
    overlaps = (F.col("start_date") < F.lit(end)) & (
        F.col("end_date").isNull() | (F.col("end_date") >= F.lit(start))
    )
    rows = _in_range(intervals, contact, overlaps & _choice(program, detail, district), first=False)
    return rows.select(
        *PERSON, F.col("p.district_name"), "ssid", "start_in_range", "end_in_range", "p.program_detail",
        "p.coach_name", *CURRENT, "last_school",
    )


def enrolled_during(
    intervals: DataFrame, contact: DataFrame, start: date, end: date, program=None, detail=None, district=None
) -> DataFrame:
    """First interval per person that starts in [start, end]."""
    starts = F.col("start_date").between(F.lit(start), F.lit(end))
    rows = _in_range(intervals, contact, starts & _choice(program, detail, district), first=True)
    return rows.select(
        *PERSON, "p.district_name", "p.district_student_number", "start_in_range", "p.program_detail", *CURRENT,
        "last_school",
    )


def exit_during(
    intervals: DataFrame,
    contact: DataFrame,
    risks: DataFrame,
    risk_factors: DataFrame,
    start: date,
    end: date,
    program=None,
    detail=None,
    district=None,
    coach=None,
) -> DataFrame:
    """Last interval per person that ends in [start, end], with the risk factors."""
    ends = F.col("end_date").between(F.lit(start), F.lit(end))
    rows = _in_range(intervals, contact, ends & _choice(program, detail, district, coach), first=False)
    listed = F.expr("listagg(risk_name, ',') WITHIN GROUP (ORDER BY risk_name)").alias("risk_factors")
    factors = risks.join(risk_factors, "risk_id").groupBy("person_id").agg(listed)
    return rows.join(factors, "person_id", "left").select(
        *PERSON, "p.district_name", "ssid", "p.exit_reason", "p.secondary_reason", "p.exit_note", "dob",
        "p.coach_name", "end_in_range", "p.program_detail", *CURRENT, "risk_factors",
    )


SCORES = ["interview_score", "essay_score", "grammar_score", "math_score", "reading_score"]


def still_applicant(
    status: DataFrame,
    contact: DataFrame,
    gtc: DataFrame,
    status_district: DataFrame,
    districts: DataFrame,
    start: date,
    end: date,
    district_id: int | None = None,
) -> DataFrame:
    """People who applied in [start, end] and had no later decision in it.

    The score averages add up over several applications of the same day.
    """
    in_range = F.col("status_date").between(F.lit(start), F.lit(end))
    decided = (
        select_events(status, fixed.AFTER_APPLICATION)
        .filter(in_range)
        .groupBy("person_id")
        .agg(F.max("status_date").alias("_decided"))
    )
    applied = (
        select_events(status, (fixed.APPLIED,))
        .filter(in_range & (program_name(F.col("program")) == fixed.PROGRAM_GTC))
        .select("person_id", "status_date", program_name(F.col("program")).alias("program"))
    )
    real = ~F.lower("first_name").isin(*fixed.TEST_FIRST_NAMES) & ~F.lower("last_name").isin(*fixed.TEST_LAST_NAMES)
    district = district_before(status, status_district, districts, end).select(
        "person_id", "district_id", "district_name"
    )
    rows = (
        applied.join(decided, "person_id", "left")
        .filter(F.col("_decided").isNull() | (F.col("_decided") < F.col("status_date")))
        .join(contact.filter(real & (F.col("person_id") > 0)), "person_id")
        .join(gtc, "person_id")
        .join(district, "person_id", "left")
    )
    if given(district_id):
        rows = rows.filter(F.col("district_id") == district_id)
    writing = F.col("grammar_score") + F.col("essay_score")
    everything = writing + F.col("reading_score") + F.col("math_score")
    keys = [*PERSON, "ssid", "program", "status_date", "hs_credits", "hs_gpa", *SCORES]
    return (
        rows.groupBy(*keys)
        .agg(
            F.min("district_name").alias("district_name"),
            F.round(F.sum(writing) / 2, 0).cast("decimal(18,0)").alias("avg_writing"),
            F.round(F.sum(everything) / 4, 0).cast("decimal(18,0)").alias("avg_all"),
        )
        .withColumn("application_date", iso(F.col("status_date")))
        .drop("status_date")
    )
