"""Wide reporting tables per interval, person, person-term and person-year.

Course rows are always reduced to one row per student and term before they meet
people, so the joins are many-to-one and a group holds at most one row per term
of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanbill.functions import fixed
from spanbill.functions.exprs import (
    all_of,
    char_code,
    char_of,
    esol_level,
    grade_points,
    greatest_if_all,
    is_esol,
    is_graded,
    same_text,
    term_number,
    whole_years,
)
from spanbill.operators.periods import date_to_period, overlap_join
from spanbill.operators.stage import settle, settle_by


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def as_flag(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


# --- scores ---------------------------------------------------------------------


def pass_rule(ytc: DataFrame, yes: DataFrame) -> DataFrame:
    """Last test date and pass mark of both score tables, one row per person.

    The old scale passes when every test reaches its mark and the last test is
    older than the new scale; the new scale has four tests. A missing date
    fails the date test. The last test date of the first table ignores missing
    dates, that of the second needs all five.
    """
    old = ["social", "science", "math", "literature", "writing"]
    new = ["social", "science", "math", "language"]

    def reached(tests, mark):
        return all_of([F.col(f"{t}_score") >= mark for t in tests])

    def last(tests):
        return greatest_if_all(*[F.col(f"{t}_date") for t in tests])

    cut = day(fixed.NEW_TEST_FROM)
    passed = F.when(reached(old, fixed.OLD_PASS_SCORE) & (last(old) < cut), "Passed").when(
        reached(new, fixed.NEW_PASS_SCORE) & (last(new) >= cut), "Passed"
    )
    scores = ["social", "science", "math", "literature", "writing", "language"]
    first = ytc.select(
        "person_id",
        F.greatest(*[F.col(f"{t}_date") for t in scores]).alias("ytc_test_date"),
        passed.alias("ytc_passed"),
        *[F.col(f"{t}_score") for t in scores],
    )
    second = yes.select(
        "person_id",
        last(old).alias("yes_test_date"),
        F.when(reached(old, fixed.OLD_PASS_SCORE), "Passed").alias("yes_passed"),
    )
    return first.join(second, "person_id", "full_outer")


def people_passed(scores: DataFrame) -> DataFrame:
    """Pass flag and last test date per person (inferred from the pass rule)."""
    mark = F.coalesce("ytc_passed", "yes_passed")
    return scores.select(
        "person_id",
        as_flag(mark == "Passed").alias("passed_yn"),
        F.coalesce("ytc_test_date", "yes_test_date").alias("last_test_date"),
    )


# --- intervals ----------------------------------------------------------------------


def interval_outcome(intervals: DataFrame, passed: DataFrame) -> DataFrame:
    """What happened after each interval, by the first rule that applies."""
    reason = F.col("exit_reason")
    follow, program = F.col("next_program"), F.col("program")
    still, graduated = F.col("end_date").isNull(), same_text(reason, F.lit(fixed.REASON_GRADUATED))
    outcome = (
        F.when(still, fixed.OUTCOME_STILL)
        .when(graduated, fixed.OUTCOME_GRADUATED)
        .when(same_text(follow, F.lit(fixed.PROGRAM_YTC)) & (F.col("passed_yn") == "Y"), fixed.OUTCOME_TEST_PASSED)
        .when(same_text(program, follow), F.concat(F.lit(fixed.OUTCOME_AGAIN), program))
        .when(~same_text(program, follow), F.concat(F.lit(fixed.OUTCOME_PROGRAM), follow))
        .when(reason.ilike("%transfer%"), fixed.OUTCOME_SCHOOL)
        .when(same_text(reason, F.lit(fixed.REASON_MOVED)), fixed.OUTCOME_MOVED)
        .when(same_text(reason, F.lit(fixed.REASON_ABSENT)), fixed.OUTCOME_ABSENT)
        .otherwise(fixed.OUTCOME_OTHER)
    )
    basic = F.when(still, fixed.OUTCOME_STILL).when(graduated, fixed.OUTCOME_GRADUATED).otherwise(fixed.OUTCOME_EXITED)
    return (
        intervals.join(passed.select("person_id", "passed_yn"), "person_id", "left")
        .withColumns({"outcome": outcome, "basic_outcome": basic})
        .drop("passed_yn")
    )


def term_summary(courses: DataFrame) -> DataFrame:
    """Courses of a student in a term, as one row."""
    subject, graded = F.upper("subject"), is_graded(F.col("grade"))
    level = F.col("_level")
    courses = courses.withColumn("_level", char_code(esol_level(F.col("subject"), F.col("title"))))
    return courses.groupBy("student", "term").agg(
        F.count(F.lit(1)).alias("course_count"),
        as_flag(F.max(subject.isin(*fixed.ESL_SUBJECTS))).alias("esl_yn"),
        F.max((is_esol(F.col("subject")) & (F.upper("course_level") == "CR"))).alias("credit_esol"),
        F.max(is_esol(F.col("subject"))).alias("has_esol"),
        char_of(F.max(level)).alias("max_esol_level"),
        char_of(F.min(level)).alias("min_esol_level"),
        char_of(F.max(F.when(F.upper("passed") == "Y", level))).alias("max_esol_level_passed"),
        F.count(F.when(graded, 1)).alias("graded_count"),
        F.coalesce(F.sum(F.when(graded, F.col("credits"))), F.lit(0)).alias("graded_credits"),
        F.coalesce(F.sum(grade_points(F.col("grade"), F.col("credits"))), F.lit(0)).alias("points"),
    )


def running_level(summary: DataFrame) -> DataFrame:
    """Add whether a student was in ESOL up to a term, and the highest level before it.

    ``summary`` has one row per student and term, so a window group is at most
    as long as the calendar.
    """
    terms = Window.partitionBy("student").orderBy("term")
    upto = terms.rowsBetween(Window.unboundedPreceding, 0)
    before = terms.rowsBetween(Window.unboundedPreceding, -1)
    return summary.withColumns(
        {
            "esol_student": F.max(F.when(F.col("has_esol"), 1)).over(upto),
            "incoming_esol_level": F.max("max_esol_level").over(before),
        }
    )


TO_DATE = {"to_date_terms": "1", "to_date_count": "graded_count", "to_date_credits": "graded_credits", "to_date_points": "points"}


def term_facts(courses: DataFrame, calendar: DataFrame) -> DataFrame:
    """Course summary per student and term with running results.

    ``to_date_*`` add up the calendar terms up to and including the row's, so
    results between two terms are a difference of two rows and need no range
    join. Terms the calendar lacks keep their row but add nothing.
    """
    rows = running_level(term_summary(courses)).join(calendar.select("term", "term_begin", "program_year"), "term", "left")
    upto = Window.partitionBy("student").orderBy("term").rowsBetween(Window.unboundedPreceding, 0)
    counted = F.col("term_begin").isNotNull()
    return rows.withColumns(
        {name: F.sum(F.when(counted, F.expr(value)).otherwise(0)).over(upto) for name, value in TO_DATE.items()}
    )


def term_bounds(intervals: DataFrame, calendar: DataFrame, facts: DataFrame, grace_days: int = 15) -> DataFrame:
    """First and last term with courses per interval; a start may come late by some days.

    ``facts`` is ``term_facts``; the results up to the last term come along.
    """
    grace = F.date_add("term_begin", grace_days)
    terms = calendar.select("term", "term_begin", F.date_sub(grace, 1).alias("_late"))
    inside = (F.col("start_date") <= F.col("_late")) & (
        F.col("end_date").isNull() | (F.col("end_date") > F.col("term_begin"))
    )
    spans = intervals.select("person_id", "seq", F.col("g_number").alias("student"), "start_date", "end_date")
    taken = overlap_join(spans, terms, "start_date", "end_date", "term_begin", "_late", inside)
    return (
        taken.join(facts.drop("term_begin", "program_year"), ["student", "term"])
        .groupBy("person_id", "seq")
        .agg(
            F.min("term").alias("term_enrolled"),
            F.max("term").alias("term_exit"),
            F.max("esl_yn").alias("esl_class_yn"),
            F.max(F.when(F.col("credit_esol"), F.col("term"))).alias("esol_last_term"),
            F.max_by(F.struct(*TO_DATE), "term").alias("_at_exit"),
        )
    )


def first_enroll_drop(intervals: DataFrame) -> DataFrame:
    """Flag the first interval per person, and whether it ended within a month."""
    first = F.col("seq") == 1
    short = (F.datediff("end_date", "start_date") < 31) | same_text(
        F.col("exit_reason"), F.lit(fixed.REASON_NO_SHOW)
    )
    return intervals.withColumns({"first_enrollment_yn": as_flag(first), "dropped_in_30_days_yn": as_flag(first & short)})


def age_at(intervals: DataFrame, contact: DataFrame) -> DataFrame:
    """Whole years at entry and at exit."""
    return intervals.join(contact.select("person_id", "dob"), "person_id", "left").withColumns(
        {
            "age_at_entry": whole_years(F.col("dob"), F.col("start_date")),
            "age_at_exit": whole_years(F.col("dob"), F.col("end_date")),
        }
    ).drop("dob")


def contact_profile(
    contact: DataFrame,
    gtc: DataFrame,
    ytc: DataFrame,
    yes: DataFrame,
    sis_person: DataFrame,
    courses: DataFrame,
    calendar: DataFrame,
) -> DataFrame:
    """Person, scores, person-level records and ESOL completion.

    Language arts comes from the first score table; the pass flag and date come
    from the pass rule.
    """
    done = same_text(F.col("passed"), F.lit("y")) & F.lower("title").isin(*[t.lower() for t in fixed.FINAL_ESOL_TITLES])
    esol = courses.groupBy(F.col("student").alias("g_number")).agg(as_flag(F.max(done)).alias("esol_completion"))
    sis = sis_person.select(
        F.col("student").alias("g_number"), "overall_gpa", "overall_attempted", "overall_earned", "reported_race"
    ).distinct()
    scores = ["social", "science", "math", "writing"]
    first = ytc.select(
        "person_id", *[F.col(f"{t}_score").alias(f"_y_{t}") for t in scores],
        F.col("completion_date").alias("_y_done"), F.col("language_score").alias("test_language_score"),
    )
    second = yes.select(
        "person_id", *[F.col(f"{t}_score").alias(f"_s_{t}") for t in scores],
        F.col("completion_date").alias("_s_done"),
    )
    rows = (
        contact.join(gtc, "person_id", "left")
        .join(first, "person_id", "left")
        .join(second, "person_id", "left")
        .join(people_passed(pass_rule(ytc, yes)), "person_id", "left")
        .join(sis, "g_number", "left")
        .join(esol, "g_number", "left")
        .withColumn("passed_yn", F.coalesce("passed_yn", F.lit("N")))
        .withColumn("completion_date", F.coalesce("_y_done", "_s_done"))
        .withColumns({f"test_{t}_score": F.coalesce(f"_y_{t}", f"_s_{t}") for t in scores})
    )
    wanted = [
        "person_id", "g_number", "last_name", "first_name", "middle_name", "dob", "gender", "hs_credits", "hs_gpa",
        "last_school", "passed_yn", "last_test_date", "completion_date", *[f"test_{t}_score" for t in scores],
        "test_language_score", "reading_score", "essay_score", "grammar_score", "math_score", "interview_score",
        "overall_gpa", "overall_attempted", "overall_earned", "reported_race", "esol_completion",
    ]
    return date_to_period(
        rows.select(*wanted), "last_test_date", calendar, "term", "term_begin", "next_begin", "passed_term"
    )


def post_event_gpa(bounded: DataFrame, profile: DataFrame, facts: DataFrame) -> DataFrame:
    """Add credits and points after the pass term, up to each interval's last term.

    ``course_rows_in_pass_term`` counts course rows in the pass term itself.
    ``bounded`` carries the columns of ``term_bounds``. The results up to the
    pass term are one row per person, and those up to the last term are already
    on the interval, so no interval meets a course.
    """
    term, passed, last = F.col("term"), F.col("passed_term"), F.col("term_exit")
    marks = profile.select("person_id", F.col("g_number").alias("student"), "passed_term")
    early = term <= passed
    person = (
        facts.join(marks, "student")
        .groupBy("person_id", "passed_term")
        .agg(
            F.sum(F.when(early, F.col("graded_count")).otherwise(0)).alias("_count"),
            F.sum(F.when(early, F.col("graded_credits")).otherwise(0)).alias("_credits"),
            F.sum(F.when(early, F.col("points")).otherwise(0)).alias("_points"),
            F.sum(F.when(term == passed, F.col("course_count")).otherwise(0)).alias("_in_pass"),
        )
    )
    some = (passed < last) & (F.col("_at_exit.to_date_count") > F.col("_count"))
    in_pass = F.when(last.isNull() | (passed <= last), F.col("_in_pass")).otherwise(0)
    return (
        bounded.join(person, "person_id", "left")
        .withColumns(
            {
                "post_credits": F.when(some, F.col("_at_exit.to_date_credits") - F.col("_credits")),
                "post_points": F.when(some, F.col("_at_exit.to_date_points") - F.col("_points")),
                "course_rows_in_pass_term": F.when(F.col("_in_pass").isNotNull(), in_pass),
            }
        )
        .drop("passed_term", "_count", "_credits", "_points", "_in_pass", "_at_exit")
    )


def enroll_exit(
    intervals: DataFrame, contact: DataFrame, profile: DataFrame, calendar: DataFrame, facts: DataFrame
) -> DataFrame:
    """One wide row per interval: outcome, terms, flags, ages and later results."""
    rows = interval_outcome(intervals, profile)
    rows = rows.join(term_bounds(intervals, calendar, facts), ["person_id", "seq"], "left")
    rows = age_at(first_enroll_drop(rows), contact)
    return post_event_gpa(rows, profile, facts)


def person_summary(wide: DataFrame) -> DataFrame:
    """Counts and bounds over a person's intervals, on the current interval's row.

    Later credits and points are summed from the finished interval table.
    """
    of_ytc, of_gtc = F.col("program") == fixed.PROGRAM_YTC, F.col("program") == fixed.PROGRAM_GTC
    kept = [
        "seq", "g_number", "program", "program_detail", "start_date", "end_date", "exit_type", "exit_reason_id",
        "exit_reason", "secondary_reason", "exit_note", "district_id", "district_name", "coach_id", "coach_name",
    ]
    zero = F.lit(0)
    totals = wide.groupBy("person_id").agg(
        F.max(F.struct(*kept)).alias("_last"),
        F.min("start_date").alias("min_start_date"),
        F.max("end_date").alias("max_end_date"),
        F.min("term_enrolled").alias("min_term_enrolled"),
        F.max("term_exit").alias("max_term_exit"),
        F.count(F.lit(1)).alias("enrollments"),
        F.count(F.when(of_ytc, 1)).alias("ytc_enrollments"),
        F.count(F.when(of_gtc, 1)).alias("gtc_enrollments"),
        F.min(F.when(of_ytc, F.col("start_date"))).alias("min_ytc_start"),
        F.max(F.when(of_ytc, F.col("end_date"))).alias("max_ytc_end"),
        F.min(F.when(of_gtc, F.col("start_date"))).alias("min_gtc_start"),
        F.max(F.when(of_gtc, F.col("end_date"))).alias("max_gtc_end"),
        F.sum(F.coalesce("post_credits", zero)).alias("post_credits"),
        F.sum(F.coalesce("post_points", zero)).alias("post_points"),
    )
    status = F.when(F.col("end_date").isNull(), F.coalesce("program_detail", "program")).otherwise(
        fixed.STATUS_EXITED
    )
    return totals.select("*", "_last.*").drop("_last").withColumn("current_status", status)


# --- person x period ------------------------------------------------------------------

TERM_COLUMNS = ["term", "program_year", "term_begin", "term_end", "next_begin"]


def _on_terms() -> Column:
    return (F.col("start_date") <= F.col("term_end")) & (
        F.col("end_date").isNull() | (F.col("end_date") >= F.col("term_begin"))
    )


def _with_terms(intervals: DataFrame, calendar: DataFrame) -> DataFrame:
    spans = intervals.select("person_id", "seq", "program", "start_date", "end_date")
    terms = calendar.select(*TERM_COLUMNS)
    return overlap_join(spans, terms, "start_date", "end_date", "term_begin", "term_end", _on_terms())


def interval_by_term(intervals: DataFrame, calendar: DataFrame, program: str | None = None) -> DataFrame:
    """First and last interval per person, program and overlapping term."""
    rows = intervals if program is None else intervals.filter(same_text(F.col("program"), F.lit(program)))
    return _with_terms(rows, calendar).groupBy("person_id", "program", *TERM_COLUMNS).agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


def _end_of(intervals: DataFrame) -> DataFrame:
    return intervals.select(
        "person_id", F.col("seq").alias("last_seq"), F.col("g_number").alias("student"), "end_date",
        "exit_reason", "secondary_reason",
    )


def attended_terms(term_results: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per student: results of each term, and the calendar terms among them with their begins."""
    begins = calendar.select("term", F.col("term_begin").alias("begin"))
    one = F.struct("term", "begin", *[F.col(c) for c in term_results.columns if c not in ("student", "term")])
    rows = term_results.join(begins, "term", "left").groupBy("student").agg(F.collect_list(one).alias("results"))
    known = F.filter("results", lambda r: r["begin"].isNotNull())
    return rows.withColumn("attended", F.transform(known, lambda r: F.struct(r["term"].alias("term"), r["begin"].alias("begin"))))


def _last_attended(attended: str, end: Column) -> Column:
    """The last attended term that begins by an end; an open end takes them all."""
    reached = F.filter(attended, lambda t: end.isNull() | (end >= t["begin"]))
    return F.array_max(F.transform(reached, lambda t: t["term"]))


def period_exit(
    by_term: DataFrame, intervals: DataFrame, calendar: DataFrame, term_results: DataFrame
) -> DataFrame:
    """Exit of each person-term, kept up to the last term attended.

    An exit after the next term's begin does not belong to the term. When the
    term is the last one attended before a later exit, the exit is moved to the
    term's end. A student's attended terms are one row, so a person's ends
    meet that row alone.
    """
    ends = _end_of(intervals).join(attended_terms(term_results, calendar).select("student", "attended"), "student")
    known = ends.withColumn("max_term", _last_attended("attended", F.col("end_date"))).drop("student", "attended")
    known = known.filter(F.col("max_term").isNotNull())
    end = F.col("end_date")
    in_term = F.when(end <= F.col("next_begin"), end)
    closing = (F.col("term") == F.col("max_term")) & in_term.isNull() & end.isNotNull()
    exit_date = F.when(closing, F.col("term_end")).otherwise(in_term)
    return (
        by_term.join(known, ["person_id", "last_seq"])
        .filter("term <= max_term")
        .withColumn("exit_date", exit_date)
        .withColumns(
            {
                "exit_reason": F.when(F.col("exit_date").isNotNull(), F.col("exit_reason")),
                "secondary_reason": F.when(F.col("exit_date").isNotNull(), F.col("secondary_reason")),
                "is_active": F.col("exit_date").isNull().cast("int"),
            }
        )
        .drop("end_date", "max_term")
    )


def first_term(intervals: DataFrame, calendar: DataFrame, courses: DataFrame) -> DataFrame:
    """First calendar term with any courses that a person's intervals overlap."""
    taught = courses.select("term").distinct()
    return _with_terms(intervals, calendar).join(taught, "term", "left_semi").groupBy("person_id").agg(
        F.min("term").alias("first_term"), F.min("term_begin").alias("first_term_begin")
    )


def post_pass_gpa(rows: DataFrame) -> DataFrame:
    """Add grade average and number of terms from the pass date up to a row's term.

    ``rows`` carries the results up to its term (``to_date_*``) and, for the
    test date in use, the results of the terms that began earlier (``_before``).
    """
    terms = F.col("to_date_terms") - F.col("_before.terms")
    credits = F.col("to_date_credits") - F.col("_before.credits")
    points = F.col("to_date_points") - F.col("_before.points")
    some = F.col("last_test_date").isNotNull() & (terms > 0)
    return rows.withColumns(
        {
            "post_terms": F.when(some, terms),
            "post_gpa": F.when(some, F.round(F.try_divide(points, credits), 2).cast("decimal(10,2)")),
        }
    ).drop("_before", *TO_DATE)


LEVELS = ["max_esol_level", "min_esol_level", "max_esol_level_passed"]
PERSON_FACTS = ["hs_credits", "last_school", "first_name", "last_name"]
TESTS = ["social", "science", "math", "literature", "writing", "language"]


# Everything about a student is kept in two stages bucketed by student: intervals with what is known of the person, and one
# row per student with an array of terms. Reports per term and year are made from these two without an exchange.


def person_spans(intervals: DataFrame, contact: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Intervals with facts and scores of their person."""
    people = contact.select("person_id", "dob", *PERSON_FACTS)
    rows = intervals.join(people, "person_id").withColumnRenamed("g_number", "student")
    return settle_by(rows if scores is None else rows.join(scores, "person_id", "left"), "student")


def student_terms(
    facts: DataFrame, term_results: DataFrame | None, calendar: DataFrame, sis_person: DataFrame | None = None
) -> DataFrame:
    """One row per student: ``terms`` in order (see ``term_facts``), with term results and demographics where wanted.

    A student has at most one entry per term of the calendar.
    """
    one = F.struct("term", *[c for c in facts.columns if c not in ("student", "term")])
    rows = facts.groupBy("student").agg(F.sort_array(F.collect_list(one)).alias("terms"))
    if term_results is not None:
        rows = rows.join(attended_terms(term_results, calendar), "student")
    if sis_person is not None:
        people = sis_person.groupBy("student").agg(*[F.min(c).alias(c) for c in DEMOGRAPHICS])
        rows = rows.join(people, "student", "left")
    return settle_by(rows, "student")


def results_before(date: str, facts: DataFrame) -> Column:
    """Number, credits and points of the calendar terms that begin before a date."""
    kinds = {c: facts.schema[f"to_date_{c}"].dataType for c in ("terms", "credits", "points")}
    values = {"terms": lambda t: F.lit(1), "credits": lambda t: t["graded_credits"], "points": lambda t: t["points"]}
    early = F.filter("terms", lambda t: t["term_begin"] < F.col(date))
    zero = F.struct(*[F.lit(0).cast(kinds[c]).alias(c) for c in values])
    return F.aggregate(early, zero, lambda at, t: F.struct(*[(at[c] + v(t)).cast(kinds[c]).alias(c) for c, v in values.items()]))


ENTRY = {
    "district_name": "district_name", "program_detail": "program_name", "district_student_number": "district_student_number",
    "start_date": "enrolled_date", "coach_name": "coach_name",
}


def _in_periods(spans: DataFrame, calendar: DataFrame, keys: list[str], more: dict[str, Column]) -> DataFrame:
    """First and last interval of each person, program and period, with the person's facts; stays within the student's bucket."""
    pairs = overlap_join(spans, calendar, "start_date", "end_date", "term_begin", "term_end", _on_terms())
    known = ["dob", *PERSON_FACTS, *[c for c in spans.columns if c.endswith(("_score", "_passed", "_test_date"))]]
    rows = pairs.groupBy("student", "person_id", "program", *keys).agg(
        F.min(F.struct("seq", *ENTRY)).alias("_first"),
        F.max(F.struct("seq", "end_date", "exit_reason", "secondary_reason")).alias("_last"),
        F.first(F.struct(*known)).alias("_person"),
        *[value.alias(name) for name, value in more.items()],
    )
    entry = {new: F.col(f"_first.{old}") for old, new in ENTRY.items()}
    person = {c: F.col(f"_person.{c}") for c in known}
    rows = rows.withColumns(entry | person | {c: F.col(f"_last.{c}") for c in ("end_date", "exit_reason", "secondary_reason")})
    return rows.withColumn("age_at_entry", whole_years(F.col("dob"), F.col("enrolled_date"))).drop("dob", "_first", "_last", "_person")


FIRST_TERM = ["first_term", "first_term_begin"]


def _first_taught(spans: DataFrame, taught: DataFrame) -> DataFrame:
    """One row per student: each person's first term with courses over all programs. Only days and terms are paired; stays within the student's bucket."""
    days = spans.select("student", "person_id", "start_date", "end_date")
    pairs = overlap_join(days, taught, "start_date", "end_date", "term_begin", "term_end", _on_terms())
    people = pairs.groupBy("student", "person_id").agg(F.min("term").alias("first_term"), F.min("term_begin").alias("first_term_begin"))
    return people.groupBy("student").agg(F.collect_list(F.struct("person_id", *FIRST_TERM)).alias("_firsts"))


def _only_when_left(rows: DataFrame) -> DataFrame:
    """Reasons belong to an exit; without one the person is active."""
    left = F.col("exit_date").isNotNull()
    return rows.withColumns(
        {
            "exit_reason": F.when(left, F.col("exit_reason")),
            "secondary_reason": F.when(left, F.col("secondary_reason")),
            "is_active": (~left).cast("int"),
        }
    )


TEST_DATES = ["ytc_test_date", "yes_test_date"]


def _scored(rows: DataFrame, facts: DataFrame, begin: str, end: str, label: str) -> DataFrame:
    """Scores known by the end of the period, when the pass happened, and results before the test in use."""
    finish = F.col(end)
    first_known = F.col("ytc_test_date") <= finish
    second_known = F.col("yes_test_date") <= finish
    passed = F.coalesce(F.when(first_known, F.col("ytc_passed")), F.when(second_known, F.col("yes_passed")))
    tested = F.coalesce(F.when(first_known, F.col("ytc_test_date")), F.when(second_known, F.col("yes_test_date")))
    when_passed = (
        F.when(F.col("passed_code").isNull(), "None")
        .when(F.col("_tested") < F.col(begin), f"Prior{label}")
        .when(F.col("_tested").between(F.col(begin), finish), f"During{label}")
        .otherwise("None")
    )
    return (
        rows.withColumns({"passed_code": passed, "_tested": tested})
        .withColumn("completed_code", when_passed)
        .withColumn("last_test_date", F.when(F.col("_tested") < day(fixed.LAST_KNOWN_TEST), F.col("_tested")))
        .withColumn("_before", F.when(first_known, results_before("ytc_test_date", facts)).otherwise(results_before("yes_test_date", facts)))
        .withColumns({f"{t}_score": F.when(first_known, F.col(f"{t}_score")) for t in TESTS})
        .drop("_tested", "ytc_passed", "yes_passed", *TEST_DATES)
    )


def person_term(
    intervals: DataFrame,
    contact: DataFrame,
    calendar: DataFrame,
    courses: DataFrame,
    term_results: DataFrame,
    program: str,
    scores: DataFrame | None = None,
) -> DataFrame:
    """One row per person and attended term of a program.

    Entry facts come from the first interval in the term and the exit from the
    last one. With ``scores`` (see ``pass_rule``) the row also says whether and
    when the tests were passed, and the results since then.
    """
    facts = term_facts(courses, calendar)
    spans, students = person_spans(intervals, contact, scores), student_terms(facts, term_results, calendar)
    terms = calendar.select(*TERM_COLUMNS)
    taught = terms.join(settle(courses.select("term").distinct()), "term", "left_semi")
    mine = spans.filter(same_text(F.col("program"), F.lit(program)))
    rows = _in_periods(mine, terms, TERM_COLUMNS, {}).join(students, "student")
    first = _first_taught(spans, taught)
    own = F.get(F.filter("_firsts", lambda f: f["person_id"].eqNullSafe(F.col("person_id"))), F.lit(0))
    rows = rows.join(first, "student", "left").withColumn("_own", own)
    rows = rows.withColumns({c: F.col(f"_own.{c}") for c in FIRST_TERM}).drop("_firsts", "_own")
    end = F.col("end_date")
    rows = rows.withColumn("max_term", _last_attended("attended", end)).filter("term <= max_term")
    in_term = F.when(end <= F.col("next_begin"), end)
    closing = (F.col("term") == F.col("max_term")) & in_term.isNull() & end.isNotNull()
    rows = _only_when_left(rows.withColumn("exit_date", F.when(closing, F.col("term_end")).otherwise(in_term)))
    here = F.get(F.filter("terms", lambda t: t["term"] == F.col("term")), F.lit(0))
    wanted = [*LEVELS, "esol_student", "incoming_esol_level", *([] if scores is None else TO_DATE)]
    results = F.explode(F.filter("results", lambda r: r["term"] == F.col("term"))).alias("_result")
    rows = rows.withColumn("_fact", here).filter(F.col("_fact").isNotNull()).select("*", results)
    rows = rows.withColumns({c: F.col(f"_fact.{c}") for c in wanted})
    rows = rows.withColumns({c: F.col(f"_result.{c}") for c in term_results.columns if c not in ("student", "term")})
    if scores is not None:
        rows = post_pass_gpa(_scored(rows, facts, "term_begin", "term_end", "Term"))
    return rows.withColumn("is_new", (F.col("term") == F.col("first_term")).cast("int")).drop(
        "program", "term_begin", "term_end", "next_begin", "end_date", "max_term", "terms", "results", "attended", "_fact", "_result"
    )


def year_bounds(calendar: DataFrame) -> DataFrame:
    """First and last day and term of each program year."""
    return calendar.groupBy("program_year").agg(
        F.min("term_begin").alias("year_begin"),
        F.max("term_end").alias("year_end"),
        F.min("term").alias("year_first_term"),
        F.max("term").alias("year_last_term"),
    )


def interval_by_year(intervals: DataFrame, calendar: DataFrame, program: str | None = None) -> DataFrame:
    """First and last interval and term per person, program and program year.

    An exit after the end of the year is not the exit of that year.
    """
    rows = intervals if program is None else intervals.filter(same_text(F.col("program"), F.lit(program)))
    spans = _with_terms(rows, calendar).groupBy("person_id", "program", "program_year").agg(
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.min("term").alias("min_term"),
        F.max("term").alias("max_term"),
    )
    in_year = F.when(F.col("end_date") <= F.col("year_end"), F.col("end_date"))
    return (
        spans.join(year_bounds(calendar), "program_year")
        .join(_end_of(intervals).drop("student"), ["person_id", "last_seq"])
        .withColumn("exit_date", in_year)
        .withColumns(
            {
                "exit_reason": F.when(F.col("exit_date").isNotNull(), F.col("exit_reason")),
                "secondary_reason": F.when(F.col("exit_date").isNotNull(), F.col("secondary_reason")),
                "is_active": F.col("exit_date").isNull().cast("int"),
            }
        )
        .drop("end_date")
    )


DEMOGRAPHICS = ["gender", "reported_race", "asian", "native", "black", "hispanic", "islander", "white"]


def person_year(
    intervals: DataFrame,
    contact: DataFrame,
    calendar: DataFrame,
    courses: DataFrame,
    scores: DataFrame,
    sis_person: DataFrame,
    program: str,
) -> DataFrame:
    """One row per person and program year with courses, with scores and demographics."""
    facts = term_facts(courses, calendar)
    spans, students = person_spans(intervals, contact, scores), student_terms(facts, None, calendar, sis_person)
    terms = calendar.select(*TERM_COLUMNS).join(year_bounds(calendar), "program_year")
    year = ["program_year", "year_begin", "year_end"]
    mine = spans.filter(same_text(F.col("program"), F.lit(program)))
    rows = _in_periods(mine, terms, year, {"min_term": F.min("term"), "max_term": F.max("term")})
    rows = _only_when_left(rows.withColumn("exit_date", F.when(F.col("end_date") <= F.col("year_end"), F.col("end_date"))))
    rows = rows.join(students, "student")
    rows = rows.withColumn("_year", F.filter("terms", lambda t: t["program_year"] == F.col("program_year"))).filter(F.size("_year") > 0)

    def over_year(column: str, pick=F.array_max) -> Column:
        return pick(F.transform("_year", lambda t: t[column]))

    own = {"to_date_terms": "1", "to_date_count": "graded_count", "to_date_credits": "graded_credits", "to_date_points": "points"}
    first = F.get("_year", F.lit(0))
    before = {c: first[c] - (F.lit(1) if v == "1" else first[v]) for c, v in own.items()}
    reached = F.try_element_at(F.filter("_year", lambda t: t["term"] <= F.col("max_term")), F.lit(-1))
    rows = rows.withColumns(
        {c: over_year(c, F.array_min if c.startswith("min") else F.array_max) for c in LEVELS}
        | {"esol_student": over_year("esol_student"), "incoming_esol_level": first["incoming_esol_level"]}
        | {c: F.when(reached.isNull(), before[c]).otherwise(reached[c]) for c in TO_DATE}
    )
    rows = post_pass_gpa(_scored(rows, facts, "year_begin", "year_end", "ProgramYear"))
    return rows.drop("program", "year_begin", "year_end", "end_date", "terms", "_year")


# --- cohorts and course facts -------------------------------------------------------------


def cohort_term(
    cohort: DataFrame, contact: DataFrame, calendar: DataFrame, courses: DataFrame, term_results: DataFrame
) -> DataFrame:
    """Terms with courses of cohort people, from the cohort year's fall on."""
    taken = courses.select("student", "term").distinct().join(term_results, ["student", "term"])
    terms = calendar.select("term", "program_year", "term_begin", "term_end")
    keys = ["person_id", "g_number", "exit_reason", "coach", "program_year", "term", "term_begin", "term_end"]
    rows = (
        cohort.join(contact.select("person_id"), "person_id", "left_semi")
        .join(taken.withColumnRenamed("student", "g_number"), "g_number")
        .filter(F.col("term") >= F.col("cohort") * 100 + 4)
        .join(terms, "term")
        .groupBy(*keys, "gpa", "attempted", "earned")
        .agg(F.min("cohort").alias("cohort"))
    )
    person = Window.partitionBy("person_id")  # at most one row per term and cohort entry
    return rows.withColumns(
        {"first_term": F.min("term").over(person), "first_term_begin": F.min("term_begin").over(person)}
    )


def course_fact(results: DataFrame, awards: DataFrame, courses: DataFrame) -> DataFrame:
    """Enrolment results x award flag x ESL flag x distinct courses."""
    student = F.col("student").alias("g_number")
    earned = awards.groupBy(student).agg(F.max((F.length("major") > 1).cast("int")).alias("_earned"))
    esl = courses.groupBy(student).agg(
        F.max(F.upper("subject").isin(*fixed.ESL_SUBJECTS).cast("int")).alias("esl_check")
    )
    taken = courses.withColumnRenamed("student", "g_number").distinct()
    has_yes = F.length("yes_term") > 0
    pass_term = F.when(has_yes, F.col("yes_term")).otherwise(F.col("ytc_term"))
    return (
        results.join(earned, "g_number", "left")
        .join(esl, "g_number", "left")
        .join(taken, "g_number", "left")
        .withColumns(
            {
                "first_term_number": term_number(F.col("first_term")),
                "last_term_number": term_number(F.col("last_term")),
                "passed": ((F.col("yes_passed") == "Y") | (F.col("ytc_passed") == "Y")).cast("int"),
                "pass_term": pass_term,
                "pass_term_number": term_number(pass_term),
                "earned_award": F.when(F.col("_earned") > 0, 1).otherwise(0),
                "term_number": term_number(F.col("term")),
            }
        )
        .drop("_earned")
    )
