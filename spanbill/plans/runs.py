"""Runs that end in tables: billing reports with their header, and the rebuild of the reporting tables.

All parts of a run are published whole (see ``sources.published``). Its header comes last, and readers go by headers,
so a run that died on the way is not seen, and the same run again takes its own place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanbill.operators.stage import settle
from spanbill.plans.attendance import ReportRun
from spanbill.plans.warehouse import enroll_exit, person_summary
from spanbill.sources.published import Published, Runs

#: Order in which report rows are filed; the names first.
REPORT_ORDER = ["last_name", "first_name", "g_number", "program_year", "program", "district_name", "exit_date", "entry_date"]
HEADERS = "report_headers"


def publish_run(run: ReportRun, spark: SparkSession, root: str, kind: str, run_id: int, order: list[str] | None = None) -> None:
    """File one billing run: its report rows, the bills, items and cycles after it, then its header."""
    Runs(spark, root, f"{kind}_report").append(run.report, run_id, order or REPORT_ORDER)
    for name in ("bills", "items", "cycles"):
        Published(spark, root, name).replace(getattr(run, name))
    Runs(spark, root, HEADERS).append(run.header, run_id)


def filed_reports(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Report rows of the finished runs of a kind, with the billing cycle each was made for."""
    headers, reports = Runs(spark, root, HEADERS), Runs(spark, root, f"{kind}_report")
    finished = [r for r in headers.ids() if r in set(reports.ids())]
    header = headers.read(finished).select("report_id", "cycle_id")
    return reports.read(finished).join(header, "report_id")


def rebuild_reporting(
    spark: SparkSession, root: str, intervals: DataFrame, contact: DataFrame, profile: DataFrame, calendar: DataFrame, facts: DataFrame
) -> tuple[Published, Published]:
    """Rebuild the interval table and, from its new version, the person table."""
    wide, people = Published(spark, root, "enroll_exit"), Published(spark, root, "person_summary")
    wide.replace(enroll_exit(intervals, contact, profile, calendar, settle(facts)))
    people.replace(person_summary(wide.read()))
    return wide, people


def last_cycle(cycles: DataFrame, kind: str) -> dict:
    """The billing cycle with the largest id of a kind, as a run takes it."""
    same = cycles.filter(F.lower("billing_type") == kind)
    row = same.agg(F.max(F.struct("cycle_id", "start_date", "program_year", "term")).alias("last")).first()["last"]
    cycle = row.asDict()
    cycle["year_start"] = same.filter(F.col("program_year") == cycle["program_year"]).agg(F.min("start_date").alias("d")).first()["d"]
    return cycle
