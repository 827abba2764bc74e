"""From a status log to enrolment intervals.

The log holds one row per status change. General enrolments are ended by the
next exit; detailed enrolments (which name the kind of place) are ended by the
next detailed enrolment of another kind or by the next exit, whichever comes
first. The two are merged, ordered per person, clipped at the next start, and
given the exit reason, district and coach that held at their end.

Choices where the source semantics leave a row open:

* ends are cut to a day on both sides before they are compared
* the smallest (date, id) pair wins by number, not by text
* a status with several reasons uses the smallest reason id
* rows that start on the same day are ordered by end (open last), detail,
  program and ending status
* the same-start repair works per (person, program, detail, start); among
  several previous ends the earliest is taken, and an open previous end gives
  a NULL start
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanbill.functions import fixed
from spanbill.functions.exprs import canonical_program, given, program_name, same_text
from spanbill.operators.asof import latest_before
from spanbill.operators.ordered import HotKeys, Take, find_hot_keys, group_scan, ordered_scan
from spanbill.operators.stage import settle


class Dims(NamedTuple):
    """Lookup tables; each of them is keyed by its first column."""

    kinds: DataFrame  # kind, kind_text
    reasons: DataFrame  # reason_id, reason_text, reason_num
    status_reason: DataFrame  # status_id, reason_id
    secondary: DataFrame  # status_id, reason_id
    status_district: DataFrame  # status_id, district_id, district_student_number
    districts: DataFrame  # district_id, district_name
    status_coach: DataFrame  # status_id, coach_id
    coaches: DataFrame  # coach_id, coach_name


def test_people(contact: DataFrame) -> DataFrame:
    named = F.lower("first_name").isin(*fixed.TEST_FIRST_NAMES) | F.lower("last_name").isin(*fixed.TEST_LAST_NAMES)
    return contact.filter(named).select("person_id")


def reports_under(program: Column) -> Column:
    return program_name(program).isin(fixed.PROGRAM_YTC, fixed.PROGRAM_GTC)


def select_events(
    status: DataFrame,
    kinds,
    mapped_program: bool = False,
    exclude_people: DataFrame | None = None,
    person: int | None = None,
) -> DataFrame:
    """Events of some kinds that were not undone.

    ``mapped_program`` keeps programs that report under a name;
    ``exclude_people`` drops these people and person 0.
    """
    rows = status.filter(F.col("kind").isin(*kinds) & F.col("undone_by").isNull())
    if mapped_program:
        rows = rows.filter(reports_under(F.col("program")))
    if exclude_people is not None:
        rows = rows.filter(F.col("person_id") != 0).join(exclude_people, "person_id", "left_anti")
    return rows.filter(F.col("person_id") == person) if given(person) else rows


def exit_events(status: DataFrame, person: int | None = None) -> DataFrame:
    return select_events(status, fixed.EXITS, True, None, person).select("person_id", "status_id", "status_date")


def enroll_events(status: DataFrame, contact: DataFrame, person: int | None = None) -> DataFrame:
    rows = select_events(status, (fixed.ENROLL,), True, test_people(contact), person)
    return rows.select("person_id", program_name(F.col("program")).alias("program"), "status_date", "status_id")


def detail_events(status: DataFrame, contact: DataFrame, person: int | None = None) -> DataFrame:
    rows = select_events(status, fixed.DETAIL_ENROLLS, False, test_people(contact), person)
    return rows.select("person_id", "kind", "program", "status_date", "status_id")


def number_events(events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Number each person's events by date and id."""
    return ordered_scan(events, "person_id", ["status_date", "status_id"], {"seq": Take("number")}, hot)


def next_transition(events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Date of the next event when its kind is another one, else NULL."""
    following = Take("lead", F.struct("status_date", "kind"))
    rows = ordered_scan(events, "person_id", ["status_date", "status_id"], {"_next": following}, hot)
    return rows.withColumn(
        "next_date", F.when(F.col("_next.kind") != F.col("kind"), F.col("_next.status_date"))
    ).drop("_next")


def timeline(status: DataFrame, contact: DataFrame, person: int | None = None) -> DataFrame:
    """All enrol, detailed enrol and exit events in one pass over the log."""
    kind = F.col("kind")
    role = (
        F.when(kind == fixed.ENROLL, "general").when(kind.isin(*fixed.DETAIL_ENROLLS), "detail").otherwise("exit")
    )
    kinds = (fixed.ENROLL, *fixed.EXITS, *fixed.DETAIL_ENROLLS)
    rows = select_events(status, kinds, False, test_people(contact), person)
    return (
        rows.filter(kind.isin(*fixed.DETAIL_ENROLLS) | reports_under(F.col("program")))
        .withColumns({"role": role, "side": kind.isin(*fixed.EXITS).cast("int")})
        .select("person_id", "role", "side", "kind", "program", "status_date", "status_id", "notes")
    )


def spells(events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Each enrolment of a timeline with the end that closes it.

    One scan per person finds the next exit on or after the event, the last
    exit of all and the next detailed enrolment. An exit on the day of an
    enrolment sorts after it and therefore counts.

    A detailed enrolment ends at the earlier of its transition and its exit.
    On the same day the exit is taken, unless a later exit follows: then the
    transition (status 0) is the smallest pair.

    One row per (person, role, kind, program, start) remains, with the
    earliest exit and the earliest end; grouping needs no further shuffle.
    """
    is_exit, is_detail = F.col("role") == "exit", F.col("role") == "detail"
    end = F.struct(F.col("status_date").alias("date"), F.col("status_id").alias("id"), F.col("notes").alias("note"))
    take = {
        "exit": Take("next", F.when(is_exit, end)),
        "last_exit": Take("top_after", F.when(is_exit, F.col("status_date"))),
        "follow": Take("next_after", F.when(is_detail, F.struct("status_date", "kind"))),
    }
    rows = ordered_scan(events, "person_id", ["status_date", "side", "status_id"], take, hot).filter(~is_exit)

    moved = F.when(is_detail & (F.col("follow.kind") != F.col("kind")), F.col("follow.status_date"))
    transition = F.struct(moved.alias("date"), F.lit(0).cast("long").alias("id"), F.lit(None).cast("string").alias("note"))
    first_out = F.col("exit.date")
    closes = (
        F.when(moved.isNotNull() & first_out.isNull(), transition)
        .when(moved < first_out, transition)
        .when((moved == first_out) & (F.col("last_exit") > moved), transition)
        .otherwise(F.col("exit"))
    )
    keys = ["person_id", "role", "kind", "program", "start_date"]
    rows = rows.select(
        "person_id",
        "role",
        F.when(is_detail, F.col("kind")).alias("kind"),
        F.when(is_detail, canonical_program(F.col("program")))
        .otherwise(program_name(F.col("program")))
        .alias("program"),
        F.to_date("status_date").alias("start_date"),
        F.to_date(first_out).alias("exit_date"),
        closes.alias("close"),
    )
    return (
        rows.groupBy(*keys)
        .agg(F.min("exit_date").alias("exit_date"), F.min("close").alias("_close"))
        .select(
            *keys,
            "exit_date",
            F.to_date("_close.date").alias("end_date"),
            F.col("_close.id").alias("end_id"),
            F.col("_close.note").alias("end_note"),
        )
    )


def general_spells(rows: DataFrame) -> DataFrame:
    """One row per general (person, program, start)."""
    return rows.filter("role = 'general'").drop("role", "kind")


def earliest_end(rows: DataFrame) -> DataFrame:
    """One row per detailed (person, kind, program, start) with its earliest end."""
    return rows.filter("role = 'detail'").drop("role")


def merge_intervals(general: DataFrame, detail: DataFrame, kinds: DataFrame, hot: HotKeys | None = None, once: bool = False) -> DataFrame:
    """General enrolments, refined by the detailed ones that share their exit.

    They pair up on the same exit day and program, or when both are still open
    and the general one is of the second program. The earlier start and the
    detailed end win.

    All pairs of a person and exit are the result. Of hot people, general rows
    that start no earlier than any of their details are one row with a count:
    whichever of them is taken, the detail's start and end win. With ``once`` the
    equal pairs that they stand for are given once, else as often.
    """
    if hot is None:
        return _merged(general, detail, kinds).drop("_times")
    listed, same = hot.keys.select(F.col("person_id").alias("_hot")), F.col("person_id").eqNullSafe(F.col("_hot"))
    cold = _merged(general.join(listed, same, "left_anti"), detail.join(listed, same, "left_anti"), kinds).drop("_times")
    few = settle(detail.join(listed, same, "left_semi"))
    warm = _merged(_dominating(general.join(listed, same, "left_semi"), few), few, kinds)
    if not once:
        warm = warm.withColumn("_times", F.explode(F.sequence(F.lit(1), "_times")))
    return cold.unionByName(warm.drop("_times"))


def _pairs_on(open_program: Column, other: Column) -> Column:
    """Which general and detailed rows of a person and exit (``g``, ``d``) belong together."""
    both_open = F.col("g.exit_date").isNull() & F.col("d.exit_date").isNull()
    return (
        (F.col("g.person_id") == F.col("d.person_id"))
        & F.col("g.exit_date").eqNullSafe(F.col("d.exit_date"))
        & F.when(both_open, same_text(open_program, F.lit(fixed.PROGRAM_YTC))).otherwise(same_text(open_program, other))
    )


def _dominating(general: DataFrame, detail: DataFrame) -> DataFrame:
    """General rows that start before some detail they pair with, and one row, with ``_times``, for all others of a person, exit and program."""
    program = F.when(F.col("exit_date").isNotNull(), F.lower("program"))
    latest = F.when(F.count("start_date") == F.count(F.lit(1)), F.max("start_date")).alias("latest")
    last = detail.groupBy("person_id", "exit_date", program.alias("program")).agg(latest).alias("d")
    g = general.alias("g")
    paired = g.join(last, _pairs_on(F.col("g.program"), F.col("d.program")), "left").select("g.*", "d.latest")
    late = F.coalesce(F.col("start_date") >= F.col("latest"), F.lit(False))
    rest = [c for c in general.columns if c not in ("person_id", "exit_date", "program")]
    same = ["person_id", "exit_date", "program", F.when(~late, F.struct(*rest)).alias("_own")]
    kept = paired.groupBy(*same).agg(F.min(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).cast("int").alias("_times"))
    return kept.select("person_id", "exit_date", "program", "_row.*", "_times")


def _merged(general: DataFrame, detail: DataFrame, kinds: DataFrame) -> DataFrame:
    times = "_times" if "_times" in general.columns else F.lit(1).alias("_times")
    g, d, k = general.alias("g"), detail.alias("d"), kinds.alias("k")
    ended = F.col("d.end_date").isNotNull()
    pair = _pairs_on(F.col("g.program"), F.col("d.program"))
    return g.join(d, pair, "left").join(k, F.col("d.kind") == F.col("k.kind"), "left").select(
        "g.person_id",
        F.coalesce("k.kind_text", "g.program").alias("program_detail"),
        "g.program",
        F.least("g.start_date", "d.start_date").alias("start_date"),
        F.coalesce("d.end_date", "g.end_date").alias("end_date"),
        F.coalesce("d.end_id", "g.end_id").alias("end_id"),
        F.when(ended, F.col("d.end_note")).otherwise(F.col("g.end_note")).alias("end_note"),
        times,
    )


def unmatched_details(general: DataFrame, detail: DataFrame, kinds: DataFrame) -> DataFrame:
    """Detailed enrolments without a general one that has the same exit."""
    known = general.filter(
        F.col("exit_date").isNotNull() | same_text(F.col("program"), F.lit(fixed.PROGRAM_YTC))
    ).select("person_id", "exit_date").distinct().alias("g")
    d = detail.alias("d")
    same_exit = (F.col("d.person_id") == F.col("g.person_id")) & F.col("d.exit_date").eqNullSafe(F.col("g.exit_date"))
    return d.join(known, same_exit, "left_anti").join(kinds, "kind").select(
        "person_id",
        F.col("kind_text").alias("program_detail"),
        "program",
        "start_date",
        F.col("exit_date").alias("end_date"),
        "end_id",
        "end_note",
    )


def append_unmatched(merged: DataFrame, general: DataFrame, detail: DataFrame, kinds: DataFrame) -> DataFrame:
    return merged.unionByName(unmatched_details(general, detail, kinds))


def order_intervals(rows: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Distinct intervals, numbered per person, with their neighbours.

    Status 0 marks a transition and becomes NULL.
    """
    known = F.col("end_id") != 0
    rows = rows.withColumns({c: F.when(known, F.col(c)) for c in ("end_note", "end_id")}).distinct()
    rows = rows.withColumn("_open", F.col("end_date").isNull())
    near = F.struct("start_date", "end_date", "program", "program_detail")
    order = ["start_date", "_open", "end_date", "program_detail", "program", "end_id"]
    take = {"seq": Take("number"), "following": Take("lead", near), "previous": Take("lag", near)}
    return ordered_scan(rows, "person_id", order, take, hot).drop("_open")


def clip_to_next(rows: DataFrame) -> DataFrame:
    """Close or shorten an interval at the next start.

    An end past a next start on the same day is left to the repair.
    """
    end, start, upcoming = F.col("end_date"), F.col("start_date"), F.col("following.start_date")
    clipped = F.when(end.isNull(), upcoming).when((end > upcoming) & (start != upcoming), upcoming).otherwise(end)
    return rows.withColumn("raw_end_date", end).withColumn("end_date", clipped)


def exit_type(rows: DataFrame) -> DataFrame:
    ended, last = F.col("end_date").isNotNull(), F.col("following").isNull()
    label = (
        F.when(ended & last, fixed.EXIT_LEFT).when(ended, fixed.EXIT_MOVED).otherwise(fixed.EXIT_NONE)
    )
    return rows.withColumn("exit_type", label)


def reason_list(secondary: DataFrame, reasons: DataFrame) -> DataFrame:
    """Secondary reasons of each status, joined by comma in descending order."""
    named = secondary.filter("status_id != 0").join(reasons, "reason_id")
    texts = F.expr("listagg(reason_text, ',') WITHIN GROUP (ORDER BY reason_text DESC)")
    return named.groupBy("status_id").agg(texts.alias("secondary_reason"))


def attach_reason(rows: DataFrame, dims: Dims, every: bool = False) -> DataFrame:
    """Reason, note and secondary reasons of the ending status.

    A status may have several reasons. The smallest id is used, which keeps
    one row per interval; with ``every`` an interval has a row for each of
    them, and one without a reason keeps its single row.
    """
    found = dims.status_reason.groupBy("status_id", *(["reason_id"] if every else []))
    named = found.agg(F.min("reason_id").alias("exit_reason_id")).drop("reason_id").join(
        dims.reasons.select(F.col("reason_id").alias("exit_reason_id"), F.col("reason_text").alias("exit_reason")),
        "exit_reason_id",
    )
    facts = named.join(reason_list(dims.secondary, dims.reasons), "status_id", "full_outer")
    return (
        rows.join(facts.withColumnRenamed("status_id", "end_id"), "end_id", "left")
        .withColumnRenamed("end_note", "exit_note")
    )


def repair_same_start(rows: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Move intervals that start together with their predecessor to its end."""
    together = F.col("start_date") == F.col("previous.start_date")
    twins = ["person_id", "program", "program_detail", "start_date"]
    take = {"_any": F.max(together), "_moved": F.min(F.when(together, F.col("previous.end_date")))}
    flagged = F.coalesce("_any", F.lit(False)) & F.col("program").isNotNull()
    start = F.when(flagged, F.col("_moved")).otherwise(F.col("start_date"))
    return group_scan(rows, "person_id", twins, take, hot).withColumn("start_date", start).drop("_any", "_moved")


def attribute_as_of_end(rows: DataFrame, status: DataFrame, dims: Dims, hot: HotKeys | None = None) -> DataFrame:
    """District and coach from the last assignment before each interval's end."""
    live = status.filter(
        F.col("kind").isin(fixed.DISTRICT, fixed.COACH) & F.col("undone_by").isNull()
    ).select("person_id", "status_date", "status_id", "kind")
    values = {
        "_district_status": F.when(F.col("kind") == fixed.DISTRICT, F.col("status_id")),
        "_coach_status": F.when(F.col("kind") == fixed.COACH, F.col("status_id")),
    }
    found = latest_before(rows, live, "person_id", "end_date", "status_date", "status_id", values, hot)
    districts = dims.status_district.join(dims.districts, "district_id").withColumnRenamed(
        "status_id", "_district_status"
    )
    coaches = dims.status_coach.join(dims.coaches, "coach_id").withColumnRenamed("status_id", "_coach_status")
    return (
        found.join(districts, "_district_status", "left")
        .join(coaches, "_coach_status", "left")
        .drop("_district_status", "_coach_status")
    )


INTERVAL_COLUMNS = [
    "person_id", "seq", "g_number", "program", "program_detail", "start_date", "end_date", "exit_type",
    "exit_reason_id", "exit_reason", "secondary_reason", "exit_note", "district_id", "district_name",
    "district_student_number", "coach_id", "coach_name", "next_program", "next_detail", "previous_program",
    "previous_detail",
]


def build_intervals(
    status: DataFrame, contact: DataFrame, dims: Dims, person: int | None = None, hot_rows: int | None = None
) -> DataFrame:
    """All enrolment intervals, or those of one person.

    One shuffle by person serves the whole scan of the log. The resulting
    enrolments are settled once, because the merge reads them four times. Repair
    and numbering share the next shuffle, attribution takes the last one by
    person, and descriptive columns are joined on at the end, when the rows no
    longer move by person.
    """
    log = status.filter(F.col("person_id") == person) if given(person) else status
    events = timeline(log, contact)
    hot = find_hot_keys(log.filter(F.col("undone_by").isNull()), "person_id", hot_rows)
    ended = settle(spells(events, hot))
    general, detail = general_spells(ended), earliest_end(ended)
    rows = append_unmatched(merge_intervals(general, detail, dims.kinds, hot, once=True), general, detail, dims.kinds)
    rows = repair_same_start(exit_type(clip_to_next(order_intervals(rows, hot))), hot)
    rows = rows.withColumns(
        {
            "next_program": F.col("following.program"),
            "next_detail": F.col("following.program_detail"),
            "previous_program": F.col("previous.program"),
            "previous_detail": F.col("previous.program_detail"),
        }
    ).drop("following", "previous", "raw_end_date")
    rows = rows.join(contact.select("person_id", "g_number"), "person_id")
    rows = attribute_as_of_end(rows, log, dims, hot)
    return attach_reason(rows, dims).select(*INTERVAL_COLUMNS)


def current_state(intervals: DataFrame) -> DataFrame:
    """The last interval per person and what the person does now."""
    rest = [c for c in intervals.columns if c not in ("person_id", "seq")]
    last = intervals.groupBy("person_id").agg(F.max(F.struct("seq", *rest)).alias("_last"))
    label = F.when(
        F.col("end_date").isNull(), F.coalesce("program_detail", "program")
    ).otherwise(fixed.STATUS_EXITED)
    return last.select("person_id", "_last.*").withColumn("current_status", label)
