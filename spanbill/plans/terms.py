"""Term billing: credits of the program year against a yearly allowance."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanbill.functions.exprs import is_attendance
from spanbill.operators.snapshots import apply_changes
from spanbill.plans.attendance import ReportRun
from spanbill.plans.billing import (
    exit_group_date,
    first_set,
    mark_latest,
    named,
    report_header,
    stamped,
    with_year,
)

UNIT_COLUMNS = [
    "generated_units", "generated_over_units", "generated_amount", "generated_over", "max_credits", "max_days_year",
]


def term_credits(bills: DataFrame, items: DataFrame, calendar: DataFrame, by_program: bool = True) -> DataFrame:
    """Included credits and the largest bill id per person (and program) and term."""
    counted = items.filter("include_flag = 1").groupBy("bill_id").agg(F.sum("credits").alias("_credits"))
    billed = bills.filter((F.col("include_flag") == 1) & ~is_attendance(F.col("program")))
    keys = ["person_id", *(["program"] if by_program else []), "program_year"]
    rows = with_year(billed, calendar).join(counted, "bill_id")
    return rows.groupBy(*keys, "term").agg(
        F.sum("_credits").cast("decimal(18,2)").alias("credits_term"), F.max("bill_id").alias("_bill")
    )


def ytd_credits(bills: DataFrame, items: DataFrame, calendar: DataFrame) -> DataFrame:
    """Credits of the year up to each term, per person and program.

    A term is billed only when the largest bill id of the year to date belongs
    to it. The window sees one row per term, so a group is as small as a year.
    """
    terms = term_credits(bills, items, calendar)
    so_far = (
        Window.partitionBy("person_id", "program", "program_year")
        .orderBy("term")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        terms.withColumns(
            {
                "credits_to_date": F.sum("credits_term").over(so_far).cast("decimal(18,2)"),
                "bill_id": F.max("_bill").over(so_far),
            }
        )
        .filter("bill_id = _bill")
        .drop("_bill")
    )


def whole_year_credits(bills: DataFrame, items: DataFrame, calendar: DataFrame, districts: DataFrame) -> DataFrame:
    """2017 form: the whole year of all programs, billed in the last bill's term."""
    known = bills.join(districts.select("district_id"), "district_id", "left_semi")
    terms = term_credits(known, items, calendar, by_program=False)
    last = F.max(F.struct("_bill", "term", "credits_term")).alias("_last")
    return (
        terms.groupBy("person_id", "program_year")
        .agg(F.sum("credits_term").cast("decimal(18,2)").alias("credits_to_date"), last)
        .select(
            "person_id",
            "program_year",
            F.col("_last.term").alias("term"),
            F.col("_last.credits_term").alias("credits_term"),
            "credits_to_date",
            F.col("_last._bill").alias("bill_id"),
        )
    )


def term_units(credits: DataFrame, cycles: DataFrame) -> DataFrame:
    """Billed and overage units, and the days they stand for.

    Once the year reaches the allowance, only what was left before this term is
    billed. Days are units / allowance * days per year, rounded once.
    """
    limits = (
        cycles.filter(F.lower("billing_type") == "term")
        .groupBy("term")
        .agg(F.min("max_credits").alias("max_credits"), F.min("max_days_year").alias("max_days_year"))
    )
    current, allowance = F.col("credits_term"), F.col("max_credits")
    left = allowance - (F.col("credits_to_date") - current)
    units = F.when(F.col("credits_to_date") >= allowance, F.greatest(left, F.lit(0))).otherwise(current)

    def days(column: str) -> Column:
        share = F.try_divide(F.col(column) * F.col("max_days_year"), allowance)
        return F.round(share.cast("decimal(28,10)"), 4).cast("decimal(18,4)")

    return (
        credits.join(limits, "term")
        .withColumn("generated_units", units.cast("decimal(18,4)"))
        .withColumn("generated_over_units", (current - F.col("generated_units")).cast("decimal(18,4)"))
        .withColumns({"generated_amount": days("generated_units"), "generated_over": days("generated_over_units")})
        .select("bill_id", "term", *UNIT_COLUMNS)
    )


def update_term_billing(
    bills: DataFrame, items: DataFrame, calendar: DataFrame, cycles: DataFrame, districts: DataFrame,
    legacy_2017: bool = False, year: str | None = None, until_term: int | None = None,
    changed_at: datetime | None = None, changed_by: str | None = None,
) -> DataFrame:
    """Bill snapshot with the generated units and days of every term in scope.

    Scope is one program year and the terms up to one; both are open when not
    given. The 2017 form updates ``until_term`` alone. Only bills whose values
    change are written and stamped (NULL counts as 0); the 2017 form writes all.
    """
    if legacy_2017:
        credits = whole_year_credits(bills, items, calendar, districts)
    else:
        credits = ytd_credits(bills, items, calendar)
    if year is not None:
        credits = credits.filter(F.col("program_year") == year)
    if until_term is not None:
        credits = credits.filter(F.col("term") == until_term if legacy_2017 else F.col("term") <= until_term)
    missing = [c for c in UNIT_COLUMNS if c not in bills.columns]
    bills = bills.withColumns({c: F.lit(None).cast("decimal(18,4)") for c in missing})
    units = term_units(credits, cycles)
    return apply_changes(
        bills, units, "bill_id", UNIT_COLUMNS, changed_at, changed_by, only_changed=not legacy_2017, null_as=0
    )


def _amounts(bills: DataFrame, legacy_2017: bool) -> DataFrame:
    if not legacy_2017:
        columns = {
            "_credits": F.col("generated_units"),
            "_credits_over": F.col("generated_over_units"),
            "_days": F.col("generated_amount"),
            "_days_over": F.col("generated_over"),
        }
    else:
        columns = {
            "_credits": first_set("final_units", "corrected_units", "generated_units"),
            "_credits_over": first_set("final_over_units", "corrected_over_units", "generated_over_units"),
            "_days": first_set("post_amount", "final_amount", "corrected_amount", "generated_amount"),
            "_days_over": first_set("post_over", "final_over", "corrected_over", "generated_over"),
        }
    rows = bills.filter("include_flag = 1").withColumns(columns)
    return rows.filter((F.col("_days") != 0) | (F.col("_days_over") != 0))


def _days_per_program(rows: DataFrame) -> DataFrame:
    keys = ["person_id", "district_id", "program_year", "program"]
    return rows.groupBy(*keys).agg(F.sum("_days").alias("_own"))


def other_program_days(bills: DataFrame, calendar: DataFrame, legacy_2017: bool = False) -> DataFrame:
    """Days the same person and district were billed in other programs of the year.

    The others are the total less the own program, so no program pairs are
    built; NULL when there is no other program with days.
    """
    own = _days_per_program(with_year(_amounts(bills, legacy_2017), calendar))
    peers = Window.partitionBy("person_id", "district_id", "program_year")
    others = F.count("_own").over(peers) - F.col("_own").isNotNull().cast("int")
    rest = F.sum("_own").over(peers) - F.coalesce("_own", F.lit(0))
    return own.withColumn("other_days", F.when(others > 0, rest)).drop("_own")


def _fanned_days(bills: DataFrame, calendar: DataFrame, legacy_2017: bool) -> DataFrame:
    """Other programs one by one, as the old report joined them."""
    own = _days_per_program(with_year(_amounts(bills, legacy_2017), calendar))
    other = own.select("person_id", "district_id", "program_year", F.col("program").alias("_p"), F.col("_own").alias("other_days"))
    joined = own.join(other, ["person_id", "district_id", "program_year"], "left")
    pairs = joined.filter(F.col("program") != F.col("_p"))
    alone = own.join(pairs, ["person_id", "district_id", "program_year", "program"], "left_anti")
    return pairs.drop("_p", "_own").unionByName(
        alone.drop("_own").withColumn("other_days", F.lit(None).cast(pairs.schema["other_days"].dataType))
    )


def term_report(
    bills: DataFrame,
    profile: DataFrame,
    districts: DataFrame,
    calendar: DataFrame,
    max_days: DataFrame,
    year: str | None = None,
    legacy_2017: bool = False,
    legacy_fanout: bool = False,
) -> DataFrame:
    """Credits, days and overage per quarter, and yearly totals capped at the maximum.

    One row per person, exit group, program, district and program year. Other
    programs' days enter as one number per row (their maximum within the
    group); ``legacy_fanout`` repeats each bill per other program instead and
    so inflates the sums as the old report did. ``max_days`` gives
    ``max_days_year`` per program year.
    """
    group, left = ("enrolled_date", F.max("exit_date")) if legacy_2017 else ("exit_group_date", F.first("exit_group_date"))
    source = bills if legacy_2017 else exit_group_date(bills)
    rows = _amounts(source, legacy_2017).filter(~is_attendance(F.col("program")))
    rows = named(with_year(rows, calendar, year), profile, districts)
    others = _fanned_days(bills, calendar, legacy_2017) if legacy_fanout else other_program_days(bills, calendar, legacy_2017)
    rows = rows.join(others, ["person_id", "district_id", "program_year", "program"], "left")
    rows = rows.join(calendar.select("term", "program_quarter"), "term")

    quarter = F.col("program_quarter")

    def total(number: int, value: Column, name: str) -> Column:
        return F.sum(F.when(quarter == number, value).otherwise(0)).alias(name)

    credits, over = F.col("_credits"), F.col("_credits_over")
    days, days_over = F.col("_days"), F.col("_days_over")
    sums = [total(1, credits, "summer_credits"), total(1, days, "summer_days")]
    for number, name in ((2, "fall"), (3, "winter"), (4, "spring")):
        sums += [
            total(number, credits + over, f"{name}_credits"),
            total(number, over, f"{name}_credits_over"),
            total(number, days + days_over, f"{name}_days"),
            total(number, days_over, f"{name}_days_over"),
        ]
    keys = ["first_name", "last_name", group, "g_number", "program", "district_name", "program_year"]
    if legacy_2017:
        keys.append("other_days")
    other = F.col("other_days") if legacy_2017 else F.sum("other_days") if legacy_fanout else F.max("other_days")
    shown = F.coalesce(F.col("other_days") if legacy_2017 else F.max("other_days"), F.lit(0))
    report = rows.groupBy(*keys).agg(
        F.min("person_id").alias("person_id"),
        F.min("start_date").alias("entry_date"),
        left.alias("exit_date"),
        *sums,
        *([] if legacy_2017 else [other.alias("other_days_billed")]),
        F.sum(credits + over).alias("year_credits"),
        F.sum(credits).alias("year_credits_billed"),
        (F.sum(days + days_over) + shown).alias("year_days"),
        (F.sum(days) + shown).alias("_billed"),
    )
    if legacy_2017:
        report = report.withColumnRenamed("other_days", "other_days_billed")
    billed = F.when(F.col("_billed") > F.col("max_days_year"), F.col("max_days_year")).otherwise(F.col("_billed"))
    return (
        report.join(max_days, "program_year", "left")
        .withColumn("year_days_billed", billed)
        .drop("_billed", "max_days_year", group)
    )


def year_max_days(cycles: DataFrame) -> DataFrame:
    """Yearly day limit per program year."""
    rows = cycles.filter(F.lower("billing_type") == "term")
    return rows.groupBy("program_year").agg(F.max("max_days_year").alias("max_days_year"))


def generate_term_billing(
    bills: DataFrame,
    items: DataFrame,
    cycles: DataFrame,
    districts: DataFrame,
    profile: DataFrame,
    calendar: DataFrame,
    cycle: dict,
    run_id: int,
    created_by: str,
    created_at: datetime | None = None,
    legacy_2017: bool = False,
) -> ReportRun:
    """Update, report and register one term billing run.

    ``cycle`` gives cycle_id, term and program_year of the billing cycle.
    """
    fresh = update_term_billing(
        bills, items, calendar, cycles, districts, legacy_2017, cycle["program_year"], cycle["term"],
        created_at, created_by,
    )
    report = term_report(
        fresh, profile, districts, calendar, year_max_days(cycles), cycle["program_year"], legacy_2017
    )
    return ReportRun(
        fresh,
        items,
        mark_latest(cycles, cycle["cycle_id"], run_id),
        report_header(bills.sparkSession, run_id, cycle["cycle_id"], created_by),
        stamped(report, run_id, created_by, created_at),
    )
