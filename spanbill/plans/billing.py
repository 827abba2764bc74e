"""Pieces shared by the attendance and the term billing jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def with_year(bills: DataFrame, calendar: DataFrame, year: str | None = None) -> DataFrame:
    """Add the program year of each bill's term; keep one year when it is given."""
    years = calendar.select("term", "program_year").distinct()
    rows = bills.join(years, "term")
    return rows if year is None else rows.filter(F.col("program_year") == year)


def exit_group_date(bills: DataFrame) -> DataFrame:
    """Add the earliest exit among the person's bills from this start onward.

    Bills are reduced to one row per person and start date before the window,
    so a window group holds at most one row per billing date.
    """
    starts = bills.groupBy("g_number", "start_date").agg(F.min("exit_date").alias("_exit"))
    onward = (
        Window.partitionBy("g_number")
        .orderBy(F.col("start_date").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    starts = starts.select("g_number", "start_date", F.min("_exit").over(onward).alias("exit_group_date"))
    return bills.join(starts, ["g_number", "start_date"], "left")


def named(bills: DataFrame, profile: DataFrame, districts: DataFrame) -> DataFrame:
    """Attach names and the district; bills without either are not reported."""
    return bills.join(profile.select("person_id", "first_name", "last_name"), "person_id").join(
        districts, "district_id"
    )


def first_set(*columns: str) -> Column:
    return F.coalesce(*[F.col(c) for c in columns])


def report_header(spark: SparkSession, run_id: int, cycle_id: int, created_by: str) -> DataFrame:
    """The row that registers a report run; append it to the report table."""
    schema = "report_id long, cycle_id long, created_by string"
    return spark.createDataFrame([(run_id, cycle_id, created_by)], schema)


def mark_latest(cycles: DataFrame, cycle_id: Column | int, run_id: int) -> DataFrame:
    """Cycle snapshot in which one cycle points to its latest report."""
    before = F.col("latest_report_id") if "latest_report_id" in cycles.columns else F.lit(None).cast("long")
    latest = F.when(F.col("cycle_id") == cycle_id, F.lit(run_id).cast("long")).otherwise(before)
    return cycles.withColumn("latest_report_id", latest)


def stamped(report: DataFrame, run_id: int, created_by: str, created_at: datetime | None = None) -> DataFrame:
    """Report rows with the run they belong to."""
    rows = report.withColumns({"report_id": F.lit(run_id).cast("long"), "created_by": F.lit(created_by)})
    return rows if created_at is None else rows.withColumn("created_at", F.lit(created_at))
