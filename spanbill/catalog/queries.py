"""Every job over the test tables, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from spanbill.functions.exprs import grade_band, program_name, term_label
from spanbill.operators.asof import next_after
from spanbill.operators.ordered import HotKeys, find_hot_keys
from spanbill.operators.periods import date_to_period
from spanbill.operators.snapshots import changed_only
from spanbill.operators.stage import Stages, planning, settle
from spanbill.plans import attendance as A
from spanbill.plans import audit as C
from spanbill.plans import intervals as I
from spanbill.plans import lookups as L
from spanbill.plans import reports as R
from spanbill.plans import runs as W
from spanbill.plans import status as B
from spanbill.plans import terms as T
from spanbill.plans import warehouse as P
from spanbill.plans.billing import exit_group_date, mark_latest, report_header
from spanbill.sources.fixtures import Domain
from spanbill.sources.published import Published
from spanbill.sources.tables import AUDITED as AUDITED_COLUMNS
from spanbill.streaming.audit_stream import AuditLog, audit_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

GTC, YTC = "GtC", "YtC"


def query(job: Callable[[Domain], DataFrame], name: str | None = None) -> Callable[[Domain], DataFrame]:
    """Register a job, by default under its own name; decimals leave as doubles.

    The job's stages come along as ``stages``; ``stage.finish(result)`` removes them after the last action.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with planning(Stages(spark)) as stages:
            domain = Domain(spark, sf_dir)
            domain.stages = stages
            df = job(domain)
        exact = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
        df = df.withColumns({c: F.col(c).cast("double") for c in exact}) if exact else df
        df.stages = stages
        return df

    QUERIES[name or job.__name__] = run
    return job


# --- intervals, stage by stage --------------------------------------------------------


def hot_people(d: Domain) -> HotKeys | None:
    """Counted once a job, over the stage of the log where there is one."""
    if "hot" not in d.__dict__:
        d.hot = find_hot_keys(d.status.filter("undone_by is null"), "person_id")
    return d.hot


def ended(d: Domain) -> tuple[DataFrame, DataFrame]:
    d.store("status")
    rows = settle(I.spells(I.timeline(d.status, d.contact), hot_people(d)))
    return I.general_spells(rows), I.earliest_end(rows)


def merged(d: Domain) -> DataFrame:
    general, detail = ended(d)
    return I.append_unmatched(I.merge_intervals(general, detail, d.kinds, hot_people(d)), general, detail, d.kinds)


def ordered(d: Domain) -> DataFrame:
    return I.order_intervals(merged(d), hot_people(d))


def typed(d: Domain) -> DataFrame:
    return I.exit_type(I.clip_to_next(ordered(d)))


def intervals(d: Domain) -> DataFrame:
    d.store("status")
    return I.build_intervals(d.status, d.contact, d.dims)


@query
def exit_events(d):
    return I.exit_events(d.status)


@query
def enroll_events_no_test(d):
    return I.enroll_events(d.status, d.contact)


@query
def next_exit_asof(d):
    enrolls, exits = I.enroll_events(d.status, d.contact), I.exit_events(d.status)
    return next_after(enrolls, exits, "person_id", "status_date", "status_date", "status_id", hot_people(d))


@query
def detail_enroll_numbered(d):
    return I.number_events(I.detail_events(d.status, d.contact), hot_people(d))


@query
def next_transition(d):
    return I.next_transition(I.detail_events(d.status, d.contact), hot_people(d))


@query
def earliest_end(d):
    return I.earliest_end(I.spells(I.timeline(d.status, d.contact), hot_people(d))).drop("end_note")


@query
def interval_merge(d):
    return I.merge_intervals(*ended(d), d.kinds, hot_people(d)).drop("end_note")


@query
def interval_unmatched_append(d):
    return merged(d).drop("end_note")


@query
def interval_dedupe_number(d):
    return ordered(d).drop("following", "previous", "end_note")


@query
def interval_clip(d):
    return I.clip_to_next(ordered(d)).select(
        "person_id", "seq", "start_date", "raw_end_date", "end_date"
    )


@query
def interval_exit_type(d):
    return typed(d).select("person_id", "seq", "end_date", "exit_type")


@query
def exit_reason_attach(d):
    return I.attach_reason(typed(d), d.dims).select(
        "person_id", "seq", "end_id", "exit_reason_id", "exit_reason", "secondary_reason", "exit_note"
    )


@query
def exit_reasons_all(d):
    return I.attach_reason(typed(d), d.dims, every=True).select(
        "person_id", "seq", "end_id", "exit_reason_id", "exit_reason", "secondary_reason", "exit_note"
    )


@query
def same_start_repair(d):
    return I.repair_same_start(typed(d), hot_people(d)).select(
        "person_id", "seq", "program", "program_detail", "start_date", "end_date"
    )


@query
def asof_district(d):
    return intervals(d).select(
        "person_id", "seq", "end_date", "district_id", "district_name", "district_student_number"
    )


@query
def asof_coach(d):
    return intervals(d).select("person_id", "seq", "end_date", "coach_id", "coach_name")


NEIGHBOURS = ("next_program", "next_detail", "previous_program", "previous_detail")


@query
def build_intervals(d):
    return intervals(d).drop(*NEIGHBOURS)


@query
def current_state(d):
    return I.current_state(intervals(d).drop(*NEIGHBOURS))


# --- lookups and range reports -----------------------------------------------------------


@query
def latest_before_date(d):
    return L.district_before(d.status, d.status_district, d.districts, date(2016, 6, 30))


@query
def coach_before_date(d):
    return L.coach_before(d.status, d.status_coach, date(2016, 6, 30))


@query
def reason_list(d):
    return L.reason_list(d.secondary, d.reasons)


@query
def current_exit(d):
    return L.current_exit(intervals(d), d.contact)


@query
def students_to_bill(d):
    return L.students_to_bill(intervals(d), d.contact, d.bills, date(2013, 1, 1), date(2017, 1, 1))


@query
def active_during(d):
    return R.active_during(intervals(d), d.contact, date(2014, 1, 1), date(2016, 1, 1))


@query
def enrolled_during(d):
    return R.enrolled_during(intervals(d), d.contact, date(2014, 1, 1), date(2016, 1, 1), program="ytc")


@query
def exit_during(d):
    return R.exit_during(intervals(d), d.contact, d.risks, d.risk_factors, date(2014, 1, 1), date(2016, 1, 1))


@query
def still_applicant(d):
    span = date(2017, 1, 1), date(2017, 12, 31)
    return R.still_applicant(d.status, d.contact, d.gtc, d.status_district, d.districts, *span)


# --- attendance billing ---------------------------------------------------------------------


def attended(d: Domain, legacy: bool = False) -> A.AttendanceRun:
    d.store("bills")
    return A.update_attendance_billing(
        d.bills, d.items, d.cycles, d.course_scenarios, d.scenario_dim, d.districts, legacy
    )


def corrected(bills: DataFrame) -> DataFrame:
    """Stored bills of which every third has since got another amount by hand."""
    kind = bills.schema["generated_amount"].dataType
    amount = F.when(F.col("bill_id") % 3 == 0, F.coalesce("generated_amount", F.lit(0)) + 1).otherwise(F.col("generated_amount"))
    return settle(bills.withColumn("generated_amount", amount.cast(kind)))


@query
def attendance_update(d):
    """A second run writes and stamps the corrected bills only; the others keep the first run's stamp."""
    d.store("bills")
    rest = d.cycles, d.course_scenarios, d.scenario_dim, d.districts
    first = A.update_attendance_billing(d.bills, d.items, *rest, changed_by="first")
    again = A.update_attendance_billing(corrected(first.bills), settle(first.items), *rest, changed_by="again")
    return again.bills.select(
        "bill_id", "max_days_period", "max_days_month", "generated_amount", "generated_over", "updated_by"
    )


def amounts(d: Domain, legacy: bool = False) -> DataFrame:
    run = attended(d, legacy)
    capped = A.month_cap(d.bills, d.cycles, included_only=not legacy)
    return A.billed_amount(run.items, capped, d.districts)


@query
def scenario_refresh(d):
    values = A.scenario_values(d.items, d.bills, d.course_scenarios, d.scenario_dim, d.districts)
    return changed_only(d.items, values, "item_id", list(A.Scenario.COLUMNS))


@query
def month_cap(d):
    return A.month_cap(d.bills, d.cycles).select(
        "bill_id", "person_id", "start_date", "max_days_period", "max_days_month"
    )


@query
def billed_amount(d):
    return amounts(d).drop("max_days_month", "adjusted_days")


@query
def cap_overage(d):
    return A.apply_cap(amounts(d))


@query
def cap_overage_2017(d):
    return A.apply_cap(amounts(d, True), use_adjusted=False, round_hours=False)


@query
def split_month_cycles(d):
    return A.split_month_cycles(d.cycles).select(
        "cycle_id", "billing_type", "start_date", "program_year", "ending_cycle_id", "starting_cycle_id",
        "bill_on_cycle_id",
    )


@query
def attendance_report(d):
    return A.attendance_report(attended(d).bills, d.profile, d.districts, d.calendar)


@query
def attendance_report_2017(d):
    return A.attendance_report(attended(d, True).bills, d.profile, d.districts, d.calendar, legacy_2017=True)


@partial(query, name="exit_group_date")
def exit_group(d):
    return exit_group_date(d.bills).select("bill_id", "g_number", "start_date", "exit_group_date")



# --- term billing ----------------------------------------------------------------------------


def term_bills(d: Domain, legacy: bool = False) -> DataFrame:
    d.store("bills")
    return T.update_term_billing(d.bills, d.items, d.calendar, d.cycles, d.districts, legacy)


@query
def ytd_credits(d):
    return T.ytd_credits(d.bills, d.items, d.calendar)


@query
def term_units(d):
    return T.term_units(T.ytd_credits(d.bills, d.items, d.calendar), d.cycles)


@query
def term_units_2017(d):
    return T.term_units(T.whole_year_credits(d.bills, d.items, d.calendar, d.districts), d.cycles)


@partial(query, name="changed_only")
def changed_units(d):
    units = T.term_units(T.ytd_credits(d.bills, d.items, d.calendar), d.cycles)
    return changed_only(d.bills, units, "bill_id", ["generated_amount", "generated_over"], null_as=0)



@query
def term_update(d):
    """As attendance_update, for term bills."""
    d.store("bills")
    rest = d.items, d.calendar, d.cycles, d.districts
    first = T.update_term_billing(d.bills, *rest, changed_by="first")
    again = T.update_term_billing(corrected(first), *rest, changed_by="again")
    return again.select("bill_id", *T.UNIT_COLUMNS, "updated_by")


@query
def other_program_days(d):
    return T.other_program_days(term_bills(d), d.calendar)


@query
def term_report(d):
    return T.term_report(term_bills(d), d.profile, d.districts, d.calendar, T.year_max_days(d.cycles))


@query
def term_report_2017(d):
    bills = term_bills(d, True)
    return T.term_report(bills, d.profile, d.districts, d.calendar, T.year_max_days(d.cycles), legacy_2017=True)


# --- billing status and exits -----------------------------------------------------------------


@query
def billing_status(d):
    return B.billing_status(d.bills, d.cycles, d.items)


def exit_inputs(d: Domain):
    spans = settle(intervals(d))
    since = B.year_start(d.calendar, date(2014, 2, 15))
    return spans, d.enrolled_bills(spans), since


@query
def exit_backfill(d):
    spans, bills, since = exit_inputs(d)
    return B.exit_backfill(bills, spans, since).select("bill_id", "person_id", "program", "start_date", "exit_date")


@query
def exit_code_backfill(d):
    spans, bills, since = exit_inputs(d)
    return B.exit_code_backfill(bills, spans, d.reasons, since).select(
        "bill_id", "person_id", "program", "start_date", "exit_code"
    )


@query
def exit_reconcile(d):
    spans, bills, since = exit_inputs(d)
    bills = B.backfill_exits(bills, spans, d.reasons, since)
    codes = d.reasons.select(F.col("reason_num").alias("exit_code"), F.col("reason_text").alias("exit_code_text"))
    return B.exit_reconcile(bills, spans, d.items, d.comments, d.profile, d.districts, d.reasons, codes, since)


# --- reporting tables ---------------------------------------------------------------------------


def profile(d: Domain) -> DataFrame:
    return P.contact_profile(d.contact, d.gtc, d.ytc, d.yes, d.sis_person, d.courses, d.calendar)


def facts(d: Domain) -> DataFrame:
    return P.term_facts(d.courses, d.calendar)


def scores(d: Domain) -> DataFrame:
    return P.pass_rule(d.ytc, d.yes)


@query
def interval_outcome(d):
    return P.interval_outcome(intervals(d), P.people_passed(scores(d))).select(
        "person_id", "seq", "program", *NEIGHBOURS, "outcome", "basic_outcome"
    )


@query
def term_bounds(d):
    return P.term_bounds(intervals(d), d.calendar, facts(d)).drop("_at_exit")


@query
def first_enroll_drop(d):
    return P.first_enroll_drop(intervals(d)).select(
        "person_id", "seq", "first_enrollment_yn", "dropped_in_30_days_yn"
    )


@query
def age_at(d):
    return P.age_at(intervals(d), d.contact).select("person_id", "seq", "age_at_entry", "age_at_exit")


@query
def person_summary(d):
    spans = settle(intervals(d))
    return P.person_summary(P.enroll_exit(spans, d.contact, profile(d), d.calendar, facts(d)))


@query
def contact_profile(d):
    return profile(d)


@query
def date_to_term(d):
    days = d.order_days.select(F.col("o_orderkey").alias("order_id"), F.col("day").alias("at"))
    return date_to_period(days, "at", d.calendar, "term", "term_begin", "next_begin", "term")


@query
def post_event_gpa(d):
    spans, summary = settle(intervals(d)), facts(d)
    wide = spans.join(P.term_bounds(spans, d.calendar, summary), ["person_id", "seq"], "left")
    rows = P.post_event_gpa(wide, profile(d), summary)
    return rows.select("person_id", "seq", "post_credits", "post_points", "course_rows_in_pass_term")


@query
def interval_by_term(d):
    return P.interval_by_term(intervals(d), d.calendar)


@query
def term_exit_adjust(d):
    spans = settle(intervals(d))
    return P.period_exit(P.interval_by_term(spans, d.calendar), spans, d.calendar, d.term_results)


@query
def person_term(d):
    spans = settle(intervals(d))
    return P.person_term(spans, d.contact, d.calendar, d.courses, d.term_results, GTC)


@query
def running_level(d):
    rows = P.running_level(P.term_summary(d.courses))
    return rows.select("student", "term", "esol_student", "incoming_esol_level")


@query
def first_term(d):
    return P.first_term(intervals(d), d.calendar, d.courses)


@query
def person_term_scores(d):
    spans = settle(intervals(d))
    return P.person_term(spans, d.contact, d.calendar, d.courses, d.term_results, YTC, scores(d))


@query
def pass_rule(d):
    return scores(d)


@query
def post_pass_gpa(d):
    spans = settle(intervals(d))
    rows = P.person_term(spans, d.contact, d.calendar, d.courses, d.term_results, YTC, scores(d))
    return rows.select("person_id", "student", "last_test_date", "term", "post_gpa", "post_terms")


@query
def year_bounds(d):
    return P.year_bounds(d.calendar)


@query
def interval_by_year(d):
    return P.interval_by_year(settle(intervals(d)), d.calendar)


@query
def person_year(d):
    spans = settle(intervals(d))
    return P.person_year(spans, d.contact, d.calendar, d.courses, scores(d), d.sis_person, YTC)


@query
def cohort_term(d):
    return P.cohort_term(d.cohort, d.contact, d.calendar, d.courses, d.term_results)


@query
def course_fact(d):
    courses = d.courses.withColumnRenamed("passed", "course_passed")
    return P.course_fact(d.enroll_results, d.awards, courses)


# --- registration of report runs ----------------------------------------------------------------------


@query
def report_register(d):
    """All cycles with their latest report, after a run of each kind over its last cycle."""
    cycles, headers = d.cycles, []
    for run, kind in enumerate(("Attendance", "Term"), start=1):
        last = d.cycles.filter(F.col("billing_type") == kind).agg(F.max("cycle_id")).first()[0]
        cycles = mark_latest(cycles, last, run)
        headers.append(report_header(d.spark, run, last, "clerk"))
    reports = headers[0].unionByName(headers[1]).select(F.col("report_id").alias("latest_report_id"), "created_by")
    return cycles.join(reports, "latest_report_id", "left").select(
        "cycle_id", "billing_type", "start_date", "latest_report_id", "created_by"
    )


def tables_folder(d: Domain) -> str:
    """Where a query publishes tables; it goes with the query's stages."""
    return f"{d.stages.folder}/tables-{uuid.uuid4().hex}"


def sorted_table(d: Domain, df: DataFrame, order: list[str]) -> Published:
    """A result filed in order, read back by row number."""
    table = Published(d.spark, tables_folder(d), "sorted")
    table.replace(df, order)
    return table


@query
def attendance_report_sorted(d):
    report = A.attendance_report(attended(d).bills, d.profile, d.districts, d.calendar)
    return sorted_table(d, report, W.REPORT_ORDER).numbered()


@query
def active_report(d):
    """Active people under the report's labels, filed by name."""
    report = R.active_during(intervals(d), d.contact, date(2014, 1, 1), date(2016, 1, 1))
    order = ["last_name", "first_name", "person_id"]
    return R.labelled(sorted_table(d, report, order).numbered())


@query
def attendance_run(d):
    """Two runs over the last attendance cycle under one id, filed and read back: the rows of one run."""
    d.store("bills")
    root, cycle = tables_folder(d), W.last_cycle(d.cycles, "attendance")
    for _ in range(2):
        run = A.generate_attendance_billing(
            d.bills, d.items, d.cycles, d.course_scenarios, d.scenario_dim, d.districts, d.profile, d.calendar, cycle, 7, "clerk"
        )
        W.publish_run(run, d.spark, root, "attendance", 7)
    return filed(d, root, "attendance")


@query
def term_run(d):
    """As attendance_run, for term bills."""
    d.store("bills")
    root, cycle = tables_folder(d), W.last_cycle(d.cycles, "term")
    for _ in range(2):
        run = T.generate_term_billing(d.bills, d.items, d.cycles, d.districts, d.profile, d.calendar, cycle, 8, "clerk")
        W.publish_run(run, d.spark, root, "term", 8)
    return filed(d, root, "term")


def filed(d: Domain, root: str, kind: str) -> DataFrame:
    """Report rows with the cycle that points to their run."""
    cycles = Published(d.spark, root, "cycles").read().select("cycle_id", F.col("latest_report_id").alias("report_id"))
    return W.filed_reports(d.spark, root, kind).join(cycles, ["cycle_id", "report_id"])


@query
def reporting_rebuild(d):
    """The person table of a rebuild, read from the published table."""
    spans = settle(intervals(d))
    return W.rebuild_reporting(d.spark, tables_folder(d), spans, d.contact, profile(d), d.calendar, facts(d))[1].read()


# --- change audit ----------------------------------------------------------------------------------


def snapshots(d: Domain) -> tuple[DataFrame, DataFrame]:
    """Orders as bills, and the same after a deterministic edit."""
    o = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    rows = d.raw("orders")
    old = rows.filter(o % 10 != 3).select(
        o.alias("bill_id"),
        F.col("o_orderstatus").alias("state"),
        amount.alias("amount"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").alias("person_id"),
    )
    state = (
        F.when(o % 7 == 0, None)
        .when(o % 7 == 1, F.lower("o_orderstatus"))
        .when(o % 7 == 2, "")
        .otherwise(F.col("o_orderstatus"))
    )
    new = rows.select(
        o.alias("bill_id"),
        state.alias("state"),
        F.when(o % 5 == 0, amount + 1).when(o % 11 != 0, amount).cast("decimal(12,2)").alias("amount"),
        F.when(o % 9 == 0, F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("o_custkey").alias("person_id"),
    )
    return old, new


AUDITED = ["state", "amount", "priority", "person_id"]


def audited(d: Domain, mode: str | tuple[str, ...]) -> DataFrame:
    return C.audit_update(*snapshots(d), "bill_id", "bill", AUDITED, mode=mode, changed_by="clerk").drop("changed_at")


@query
def audit_update(d):
    return audited(d, "null_safe")


@query
def audit_modes(d):
    return audited(d, C.MODES)


@query
def audit_feed(d):
    """The audit of a feed, over the feed read as a batch."""
    feed = C.changes(*snapshots(d), "bill_id")
    return audit_stream(feed, "bill_id", "bill", AUDITED, changed_by="clerk").drop("changed_at")


@query
def audit_feed_stream(d):
    """The audit of a feed read as a stream, twice: the second stream has lost the progress of the first and adds nothing."""
    feed, folder = C.changes(*snapshots(d), "bill_id").withColumnRenamed("_key", "change_id"), tables_folder(d)
    feed.write.parquet(f"{folder}/feed")
    log = AuditLog(d.spark, folder, "change_id")
    for progress in ("first", "second"):
        stream = d.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 8).parquet(f"{folder}/feed")
        rows = audit_stream(stream, "bill_id", "bill", AUDITED, changed_by="clerk", change_id="change_id")
        log.write(rows, f"{folder}/{progress}", availableNow=True).awaitTermination()
    return log.read().drop("change_id", "changed_at")


@query
def audit_insert(d):
    return C.audit_insert(*snapshots(d), "bill_id", "bill", changed_by="clerk").drop("changed_at")


@query
def audit_items(d):
    values = A.scenario_values(d.items, d.bills, d.course_scenarios, d.scenario_dim, d.districts)
    fresh = A.refresh_scenario(d.items, values)
    columns = list(A.Scenario.COLUMNS)
    return C.audit_update(d.items, fresh, "item_id", "item", columns, changed_by="clerk").drop("changed_at")


def audited_wide(d: Domain, table: str, key: str, name: str) -> DataFrame:
    d.store(table)
    old, new = d.audited(table, key)
    return C.audit_update(old, new, key, name, AUDITED_COLUMNS[table], mode="length", changed_by="clerk").drop("changed_at")


@query
def audit_bills_wide(d):
    return audited_wide(d, "bills", "bill_id", "bill")


@query
def audit_items_wide(d):
    return audited_wide(d, "items", "item_id", "item")


# --- scalar rules over whole tables -------------------------------------------------------------------


@partial(query, name="grade_band")
def grade_bands(d):
    return d.contact.select("person_id", "dob", grade_band(F.col("dob"), 2016).alias("grade"))



@query
def program_map(d):
    return d.status.select("status_id", "program", program_name(F.col("program")).alias("program_name"))


@partial(query, name="term_label")
def term_labels(d):
    return d.bills.select("bill_id", "term", term_label(F.col("term")).alias("label"))

