"""The domain tables, expressed over the star-schema test tables.

Dates are moved so that orders and events share the years 2012 to 2018: order
dates by 17 years, event days stretched by 80. Every table is a plain
projection, join or aggregate of the parquet files, so its size follows theirs.
Tables that stand for stored ones but cost a join or an aggregate here are
written as a stage once per query, as several branches read them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanbill.operators.asof import latest_before
from spanbill.operators.stage import settle
from spanbill.plans.attendance import Scenario
from spanbill.plans.intervals import Dims
from spanbill.sources.tables import AUDITED, types


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def pick(key: Column, *values) -> Column:
    """values[key] for a small non-negative integer key."""
    chain = F.when(key == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        chain = chain.when(key == i, value)
    return chain


def dec(column: Column, precision: int = 12, scale: int = 2) -> Column:
    return column.cast(f"decimal({precision},{scale})")


def program_year(date: Column) -> Column:
    first = F.year(date) - (F.quarter(date) < 3).cast("int")
    return F.concat_ws("-", first.cast("string"), (first + 1).cast("string"))


def quarter_start(date: Column) -> Column:
    return F.trunc(date, "quarter")


def g_number(person: Column) -> Column:
    """Eight digits at least; longer ids stay whole."""
    digits = person.cast("string")
    return F.concat(F.lit("G"), F.when(F.length(digits) < 8, F.lpad(digits, 8, "0")).otherwise(digits))


PERCENTS = {  # share of individual, small, inter and large group teaching per part type
    "STANDARD": ("1.000", "0.000", "0.000", "0.000"),
    "ECONOMY": ("0.000", "1.000", "0.000", "0.000"),
    "MEDIUM": ("0.000", "0.000", "1.000", "0.000"),
    "PROMO": ("0.000", "0.000", "0.000", "1.000"),
    "LARGE": ("0.500", "0.500", "0.000", "0.000"),
    "SMALL": (None, "0.000", "0.250", "0.750"),
}


RAW = {  # stated, so that no job has to read footers for a schema
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


#: Columns that only the audit looks at, in words that Spark and plain SQL share. {0} is the row's number.
AUDIT_ONLY = {
    "bills": {
        "adjusted_ind_hours": "CASE WHEN {0} % 23 = 0 THEN {0} % 40 END", "billing_notes": "CASE WHEN {0} % 6 = 0 THEN concat('note ', {0} % 90) END",
        "billing_status": "CASE {0} % 3 WHEN 0 THEN 'IN PROGRESS' WHEN 1 THEN 'COMPLETE' ELSE 'REVIEWED' END",
        "exit_code": "CASE WHEN {0} % 3 = 1 THEN 7 END", "cm_percent": "CASE WHEN {0} % 8 = 0 THEN 0.5 END", "created_by": "concat('u', {0} % 7)",
        "credits_entered": "{0} % 2", "date_created": "start_date", "error_message": "CASE WHEN {0} % 31 = 0 THEN '' WHEN {0} % 37 = 0 THEN 'No match' END",
        "exit_status_reason_id": "CASE WHEN {0} % 4 = 0 THEN {0} % 20 + 1 END", "inter_percent": "CASE WHEN {0} % 8 = 1 THEN 0.25 END",
        "large_percent": "CASE WHEN {0} % 8 = 2 THEN 0.125 END", "small_percent": "CASE WHEN {0} % 8 = 3 THEN 0.375 END", "max_credits": "CASE WHEN {0} % 2 = 0 THEN 12 END",
        "max_days_year": "175", "review_notes": "CASE WHEN {0} % 9 = 0 THEN concat('Seen ', {0} % 5) END", "coach_review_flag": "CASE WHEN {0} % 10 = 0 THEN 1 ELSE 0 END",
        "generated_units": "CASE WHEN {0} % 6 = 1 THEN 1.5 END", "generated_over_units": "CASE WHEN {0} % 6 = 1 THEN 0 END",
    },
    "items": {
        "created_by": "concat('u', {0} % 7)", "course_number": "concat({0} % 300, '')", "date_created": "DATE '2015-01-01'",
        "max_possible_attendance": "CASE WHEN {0} % 5 <> 0 THEN {0} % 50 END", "subject": "CASE {0} % 3 WHEN 0 THEN 'ESOL' WHEN 1 THEN 'MTH' ELSE 'WR' END",
        "taken_previous_term": "CASE WHEN {0} % 12 = 0 THEN 1 ELSE 0 END", "title": "concat('Course ', {0} % 1000)",
    },
}
ROW_NUMBER = {"bills": "bill_id", "items": "(bill_id + crn)"}


def wide_row(table: str) -> dict[str, str]:
    """All audited columns of a table, the added ones cast to their stated types."""
    kinds, added, n = types(table), AUDIT_ONLY[table], ROW_NUMBER[table]
    return {c: f"CAST({added[c].format(n)} AS {SQL_TYPES.get(kinds[c], kinds[c])})" if c in added else c for c in AUDITED[table]}


SQL_TYPES = {"string": "VARCHAR(200)", "long": "BIGINT"}


def edited_row(table: str, key: str) -> dict[str, str]:
    """The audited columns after an edit: each in one row of some hundreds; texts in case only, to nothing, to '' or longer."""
    kinds, n, out = types(table), ROW_NUMBER[table], {}
    for k, c in enumerate(AUDITED[table]):
        kind, name = kinds[c], SQL_TYPES.get(kinds[c], kinds[c])
        if c == key:
            out[c] = c
            continue
        if kind == "string":
            new = f"CASE {n} % 4 WHEN 0 THEN upper({c}) WHEN 1 THEN NULL WHEN 2 THEN '' ELSE concat(coalesce({c}, ''), '!') END"
        else:
            start = "DATE '2015-01-01'" if kind == "date" else "0"
            new = f"CASE WHEN {n} % 2 = 0 THEN NULL ELSE coalesce({c}, {start}) + 1 END"
        out[c] = f"CASE WHEN ({n} + {7 * k}) % 301 = 0 THEN CAST({new} AS {name}) ELSE {c} END"
    return out


class Domain:
    """Domain tables of one test data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.stored: set[str] = set()

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def store(self, *names: str) -> Domain:
        """Write tables as a stage once, for jobs that read them several times."""
        for name in names:
            if name not in self.stored:
                self.__dict__[name] = settle(getattr(self, name))
                self.stored.add(name)
        return self

    # --- people and their status log ------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id"),
            F.col("user_id"),
            F.col("event_type"),
            F.col("ts"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    @cached_property
    def status(self) -> DataFrame:
        e, k = F.col("event_id"), F.col("k")
        kind = (
            F.when(F.col("event_type") == "signup", 2)
            .when(F.col("event_type") == "error", F.when(e % 3 == 0, 12).otherwise(3))
            .when(F.col("event_type") == "purchase", 13 + e % 4)
            .when(F.col("event_type") == "click", 6 + e % 2)
            .otherwise(pick(e % 3, 1, 4, 5))
        )
        program = F.when(k % 20 == 13, "rtp").otherwise(pick(k % 5, "gtc", "ytc", "YES", "Map", "GTC"))
        days = F.datediff(F.to_date("ts"), day("2024-01-01")) * 80 + F.hour("ts")
        return self.events.select(
            e.alias("status_id"),
            F.col("user_id").alias("person_id"),
            kind.cast("int").alias("kind"),
            program.alias("program"),
            F.date_add(day("2012-01-01"), days).alias("status_date"),
            F.when(k % 10 == 0, e).alias("undone_by"),
            F.when(k % 7 == 0, "").when(k % 7 > 1, F.concat(F.lit("note "), k.cast("string"))).alias("notes"),
        )

    @cached_property
    def contact(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.raw("customer").select(
            c.alias("person_id"),
            g_number(c).alias("g_number"),
            F.when(c % 50 == 0, "test").otherwise(F.col("c_mktsegment")).alias("first_name"),
            F.when(c % 50 == 25, "testSD").otherwise(F.col("c_name")).alias("last_name"),
            F.when(c % 3 == 0, "M").alias("middle_name"),
            F.date_add(day("1990-01-01"), (c * 37 % 7000).cast("int")).alias("dob"),
            pick(c % 2, "F", "M").alias("gender"),
            F.concat(F.lit("p"), c.cast("string"), F.lit("@school.example")).alias("email_main"),
            F.concat(F.lit("p"), c.cast("string"), F.lit("@home.example")).alias("email_alt"),
            F.concat(F.lit("S"), c.cast("string")).alias("ssid"),
            F.concat(F.lit("HS "), F.col("c_nationkey").cast("string")).alias("last_school"),
            dec((c % 25).cast("int"), 6).alias("hs_credits"),
            dec((c % 40) * F.lit("0.1").cast("decimal(2,1)"), 4).alias("hs_gpa"),
        )

    @cached_property
    def districts(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("district_id"), F.col("n_name").alias("district_name")
        )

    @cached_property
    def kinds(self) -> DataFrame:
        texts = [
            (13, "YtC Credit"), (14, "YtC ELL Credit"), (15, "YtC ELL Attendance"), (16, "YtC Attendance")
        ]
        return self.spark.createDataFrame(texts, "kind int, kind_text string")

    @cached_property
    def reasons(self) -> DataFrame:
        n = F.col("n_nationkey")
        text = F.when(
            n < 5,
            pick(
                n,
                "Graduated",
                "Moved out of District/State (Specify District/State)",
                "10 Days Absent",
                "Accepted/No Show",
                "Transfer to other school",
            ),
        ).otherwise(F.col("n_name"))
        return self.raw("nation").select(
            (n + 1).alias("reason_id"),
            text.alias("reason_text"),
            F.when(n < 15, n + 1).otherwise(n + 36).alias("reason_num"),
        )

    def _exits(self) -> DataFrame:
        return self.events.filter("event_type = 'error'")

    @cached_property
    def status_reason(self) -> DataFrame:
        first = self._exits().filter("k % 4 != 0").select(
            F.col("event_id").alias("status_id"), (F.col("k") % 20 + 1).alias("reason_id")
        )
        second = self._exits().filter("k % 8 = 1").select(
            F.col("event_id").alias("status_id"), (F.col("k") % 20 + 3).alias("reason_id")
        )
        return first.unionByName(second)

    @cached_property
    def secondary(self) -> DataFrame:
        rows = self._exits().filter("k % 3 = 1")
        reason = F.explode(F.array(F.col("k") % 25 + 1, F.col("k") * 7 % 25 + 1))
        return rows.select(F.col("event_id").alias("status_id"), reason.alias("reason_id"))

    @cached_property
    def status_district(self) -> DataFrame:
        rows = self.events.filter("event_type = 'click' and event_id % 2 = 1")
        return rows.select(
            F.col("event_id").alias("status_id"),
            (F.col("k") % 25).alias("district_id"),
            F.concat(F.lit("D"), F.col("k").cast("string")).alias("district_student_number"),
        )

    @cached_property
    def coaches(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("coach_id"), F.col("s_name").alias("coach_name"))

    @cached_property
    def status_coach(self) -> DataFrame:
        rows = self.events.filter("event_type = 'click' and event_id % 2 = 0")
        return rows.select(F.col("event_id").alias("status_id"), (F.col("event_id") % 10).alias("coach_id"))

    @cached_property
    def dims(self) -> Dims:
        return Dims(
            self.kinds, self.reasons, self.status_reason, self.secondary,
            self.status_district, self.districts, self.status_coach, self.coaches,
        )

    @cached_property
    def risks(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_custkey").alias("person_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("risk_id")
        ).distinct()

    @cached_property
    def risk_factors(self) -> DataFrame:
        return self.raw("orders").select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("risk_id"),
            F.substring("o_orderpriority", 3, 20).alias("risk_name"),
        ).distinct()

    @cached_property
    def comments(self) -> DataFrame:
        return self.events.filter("event_type = 'view'").select(
            F.col("event_id").alias("comment_id"),
            F.col("user_id").alias("person_id"),
            F.concat(F.lit("comment "), F.col("k").cast("string")).alias("comment_text"),
        )

    # --- calendar ------------------------------------------------------------------

    @cached_property
    def order_days(self) -> DataFrame:
        return self.raw("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
            F.add_months(F.to_date("o_orderdate"), 204).alias("day"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        begin = F.col("term_begin")
        quarter = F.quarter(begin)
        return settle(
            self.order_days.select(quarter_start(F.col("day")).alias("term_begin"))
            .distinct()
            .select(
                (F.year(begin) * 100 + quarter).alias("term"),
                program_year(begin).alias("program_year"),
                ((quarter + 1) % 4 + 1).alias("program_quarter"),
                begin,
                F.date_sub(F.add_months(begin, 3), 11).alias("term_end"),
                F.add_months(begin, 3).alias("next_begin"),
            )
        )

    # --- bills and items --------------------------------------------------------------

    @cached_property
    def bills(self) -> DataFrame:
        o, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("day")
        month = F.trunc(d, "month")
        attends = F.substring("o_orderpriority", 1, 1).isin("1", "2")
        half = (F.dayofmonth(d) > 15) & (F.month(d) % 4 == 0)
        start = F.when(attends, F.when(half, F.date_add(month, 15)).otherwise(month)).otherwise(quarter_start(d))
        end = F.when(attends, F.last_day(d)).otherwise(F.date_sub(F.add_months(quarter_start(d), 3), 1))
        program = pick(
            F.substring("o_orderpriority", 1, 1).cast("int") - 1,
            "YtC Attendance", "YtC ELL Attendance", "YtC Credit", "YtC ELL Credit", "GtC",
        )

        def amount(every: int, value: str) -> Column:
            return F.when(o % every == 0, dec(F.lit(value), 10, 4))

        unset = F.lit(None).cast("decimal(10,4)")
        rows = self.order_days.withColumns({"start_date": start, "end_date": end})
        rows = rows.select(
            o.alias("bill_id"),
            c.alias("person_id"),
            F.when(c % 97 != 3, c * 10 + o % 2).alias("pidm"),
            g_number(c).alias("g_number"),
            program.alias("program"),
            (F.year(d) * 100 + F.quarter(d)).alias("term"),
            "start_date",
            "end_date",
            F.date_sub("start_date", (c % 60).cast("int")).alias("enrolled_date"),
            F.when(o % 3 == 0, F.date_add("end_date", (o % 20).cast("int"))).alias("exit_date"),
            F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("include_flag"),
            (o % 2).cast("int").alias("reviewed_flag"),
            F.when(o % 19 == 0, dec(F.lit("5"), 10, 4)).alias("adjusted_days"),
            F.when(o % 5 == 0, dec(F.lit("9"), 10, 4)).alias("max_days_period"),
            F.when(o % 4 == 0, dec(F.lit("15"), 10, 4)).alias("max_days_month"),
            unset.alias("generated_units"),
            unset.alias("generated_over_units"),
            amount(6, "4.5").alias("generated_amount"),
            amount(6, "0").alias("generated_over"),
            amount(11, "3.25").alias("corrected_units"),
            amount(11, "1.5").alias("corrected_over_units"),
            amount(11, "3.25").alias("corrected_amount"),
            amount(11, "0.75").alias("corrected_over"),
            amount(13, "2.5").alias("final_units"),
            amount(13, "0.5").alias("final_over_units"),
            amount(13, "2.55").alias("final_amount"),
            amount(13, "0.25").alias("final_over"),
            amount(17, "1.25").alias("post_amount"),
            amount(17, "0").alias("post_over"),
        )
        where = self.raw("customer").select(
            F.col("c_custkey").alias("person_id"), F.col("c_nationkey").alias("district_id")
        )
        return rows.join(where, "person_id")

    def enrolled_bills(self, spans: DataFrame) -> DataFrame:
        """Bills with the enrolment they were made for: the person's last one that began before the bill's end."""
        o = F.col("bill_id")
        bills = self.bills.select(
            "bill_id", "person_id", "g_number", "start_date", "end_date", "exit_date", "district_id", "include_flag", "adjusted_days"
        )
        starts = spans.filter("start_date is not null")
        made_for = {"_span": F.struct("start_date", "program_detail")}
        rows = latest_before(bills, starts, "person_id", "end_date", "start_date", "seq", made_for)
        return settle(
            rows.filter("_span is not null").select(
                *bills.columns,
                F.col("_span.program_detail").alias("program"),
                F.col("_span.start_date").alias("enrolled_date"),
                F.when(o % 3 == 1, 7).alias("exit_code"),
                F.when(o % 4 == 0, o % 20 + 1).alias("exit_status_reason_id"),
            )
        )

    @cached_property
    def profile(self) -> DataFrame:
        return self.contact.select("person_id", "first_name", "last_name")

    @cached_property
    def cycles(self) -> DataFrame:
        start = F.col("start_date")
        attends = F.col("billing_type") == "Attendance"
        key = F.year(start) * 10000 + F.month(start) * 100 + F.dayofmonth(start)
        return settle(
            self.bills.select(
                F.when(F.col("program").contains("Attendance"), "Attendance").otherwise("Term").alias("billing_type"),
                "start_date",
                "term",
                program_year(start).alias("program_year"),
            )
            .distinct()
            .select(
                F.when(attends, key).otherwise(F.col("term")).alias("cycle_id"),
                "billing_type",
                "start_date",
                "term",
                "program_year",
                F.when(start < day("2016-01-01"), F.date_add(start, 40)).alias("close_date"),
                F.when(attends, dec(10 + F.month(start) % 5, 10, 4)).alias("max_days_period"),
                F.when(~attends, dec(F.lit("12"), 10, 4)).alias("max_credits"),
                F.when(~attends, dec(F.lit("175"), 10, 4)).alias("max_days_year"),
            )
        )

    @cached_property
    def items(self) -> DataFrame:
        """One item per line. Lines of one order may share a number, so the id also counts them."""
        raw = self.raw("lineitem")
        number = ["l_orderkey", "l_linenumber"]
        same = Window.partitionBy(*number).orderBy(*[c for c in raw.columns if c not in number])
        part = F.col("l_orderkey") * 10 + F.col("l_linenumber") + F.col("n") - 1
        rows = raw.withColumn("n", F.row_number().over(same)).select(
            F.concat_ws("-", *number, "n").alias("item_id"),
            F.col("l_orderkey").alias("bill_id"),
            F.col("l_partkey").alias("crn"),
            dec(dec(F.col("l_quantity")) / 10, 12, 3).alias("attendance"),
            dec(F.col("l_linenumber"), 6).alias("credits"),
            F.when(F.col("l_returnflag") == "A", 0).otherwise(1).alias("include_flag"),
            (part % 4).alias("_state"),
        )
        kept = F.col("_state") == 1
        parts = self.scenarios.select(
            F.col("crn"),
            *[F.col(c).alias(f"p_{c}") for c in Scenario.PERCENTS],
            F.col("scenario_name").alias("p_name"),
        )
        return settle(
            rows.join(parts, "crn").select(
                *[c for c in rows.columns if c != "_state"],
                F.when(kept, F.col("p_name")).when(F.col("_state") == 2, "old").alias("scenario_name"),
                *[F.when(kept, F.col(f"p_{c}")).alias(c) for c in Scenario.PERCENTS],
            )
        )

    def audited(self, table: str, key: str) -> tuple[DataFrame, DataFrame]:
        """A table with all audited columns, and the same after an edit."""
        old = getattr(self, table).selectExpr(*[f"{e} AS {c}" for c, e in wide_row(table).items()])
        return old, old.selectExpr(*[f"{e} AS {c}" for c, e in edited_row(table, key).items()])

    @cached_property
    def scenarios(self) -> DataFrame:
        """One scenario per part type, seen per course (part)."""
        kind = F.col("p_type")

        def percent(i: int) -> Column:
            chain = F.when(F.lit(False), None)
            for name, values in PERCENTS.items():
                chain = chain.when(kind == name, F.lit(values[i]))
            return chain.cast("decimal(5,3)")

        return self.raw("part").select(
            F.col("p_partkey").alias("crn"),
            kind.alias("scenario_name"),
            *[percent(i).alias(c) for i, c in enumerate(Scenario.PERCENTS)],
        )

    @cached_property
    def scenario_dim(self) -> DataFrame:
        return self.scenarios.drop("crn").distinct().withColumn("scenario_id", F.col("scenario_name"))

    @cached_property
    def course_scenarios(self) -> DataFrame:
        """Scenario per course and term, for the courses that are taught in it."""
        taught = self.items.filter("crn % 10 != 9").join(self.bills.select("bill_id", "term"), "bill_id")
        return settle(
            taught.select("crn", "term").distinct()
            .join(self.scenarios.select("crn", "scenario_name"), "crn")
            .join(self.scenario_dim.select("scenario_name", "scenario_id"), "scenario_name")
            .select("crn", "term", "scenario_id")
        )

    # --- courses and scores ------------------------------------------------------------

    @cached_property
    def courses(self) -> DataFrame:
        p = F.col("l_partkey")
        subject = pick(p % 6, "ESOL", "ESL", "MTH", "WR", "esol", "RD")
        kind = pick(p % 2, "Reading", "Writing")
        title = F.when(
            p % 6 < 2, F.concat(F.lit("Level "), (p % 9).cast("string"), F.lit(" Academic "), kind)
        ).otherwise(F.concat(F.lit("Course "), p.cast("string")))
        orders = self.order_days.select("o_orderkey", "o_custkey", "day")
        rows = self.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            g_number(F.col("o_custkey")).alias("student"),
            (F.year("day") * 100 + F.quarter("day")).alias("term"),
            p.alias("crn"),
            subject.alias("subject"),
            F.col("l_linenumber").cast("string").alias("course_number"),
            pick(F.col("l_suppkey") % 2, "CR", "NC").alias("course_level"),
            title.alias("title"),
            dec(F.col("l_linenumber"), 6).alias("credits"),
            pick(p % 7, "A", "B", "C", "D", "F", "P").alias("grade"),
            F.when(p % 7 < 4, "Y").otherwise("N").alias("passed"),
        )
        return settle(rows)

    @cached_property
    def term_results(self) -> DataFrame:
        """Attempted and earned credits and a term average per student and term."""
        return self.courses.groupBy("student", "term").agg(
            F.round(F.avg(dec(F.length("title"))), 2).cast("decimal(10,2)").alias("gpa"),
            F.sum("credits").cast("decimal(10,2)").alias("attempted"),
            F.sum(F.when(F.col("passed") == "Y", F.col("credits"))).cast("decimal(10,2)").alias("earned"),
        )

    @cached_property
    def gtc(self) -> DataFrame:
        p = F.col("c_custkey")
        score = {"interview_score": 10, "essay_score": 7, "grammar_score": 5, "math_score": 11, "reading_score": 13}
        return self.raw("customer").filter("c_custkey % 3 != 0").select(
            p.alias("person_id"), *[dec((p % m).cast("int"), 6).alias(name) for name, m in score.items()]
        )

    @cached_property
    def ytc(self) -> DataFrame:
        p = F.col("c_custkey")
        base, s = F.when(p % 2 == 0, 405).otherwise(140), (p % 7).cast("int")
        first = F.date_add(day("2012-03-01"), (p * 13 % 1800).cast("int"))
        other = base + 5 + (p % 2).cast("int")
        return self.raw("customer").filter("c_custkey % 4 != 3").select(
            p.alias("person_id"),
            (base + s).alias("social_score"),
            other.alias("science_score"),
            other.alias("math_score"),
            other.alias("literature_score"),
            other.alias("writing_score"),
            other.alias("language_score"),
            first.alias("social_date"),
            F.date_add(first, 10).alias("science_date"),
            F.date_add(first, 20).alias("math_date"),
            F.when(p % 9 != 4, F.date_add(first, 5)).alias("literature_date"),
            F.date_add(first, 15).alias("writing_date"),
            F.date_add(first, 30).alias("language_date"),
            F.when(p % 5 != 0, F.date_add(first, 45)).alias("completion_date"),
        )

    @cached_property
    def yes(self) -> DataFrame:
        p = F.col("c_custkey")
        score = F.lit(405) + (p % 9).cast("int")
        first = F.date_add(day("2013-01-01"), (p * 7 % 1500).cast("int"))
        return self.raw("customer").filter("c_custkey % 3 = 1").select(
            p.alias("person_id"),
            score.alias("social_score"),
            (score + 1).alias("science_score"),
            (score + 2).alias("math_score"),
            (score + 3).alias("literature_score"),
            (score + 4).alias("writing_score"),
            first.alias("social_date"),
            F.date_add(first, 3).alias("science_date"),
            F.date_add(first, 6).alias("math_date"),
            F.when(p % 10 != 7, F.date_add(first, 9)).alias("literature_date"),
            F.date_add(first, 2).alias("writing_date"),
            F.date_add(first, 12).alias("completion_date"),
        )

    @cached_property
    def sis_person(self) -> DataFrame:
        p = F.col("c_custkey")
        flags = {"asian": 2, "native": 3, "black": 4, "hispanic": 5, "islander": 6, "white": 7}
        return self.raw("customer").filter("c_custkey % 10 != 9").select(
            g_number(p).alias("student"),
            dec((p % 40).cast("int"), 6).alias("overall_gpa"),
            dec((p % 90).cast("int"), 6).alias("overall_attempted"),
            dec((p % 80).cast("int"), 6).alias("overall_earned"),
            F.col("c_mktsegment").alias("reported_race"),
            pick(p % 2, "F", "M").alias("gender"),
            *[F.when(p % m == 0, "Y").otherwise("N").alias(name) for name, m in flags.items()],
        )

    @cached_property
    def awards(self) -> DataFrame:
        p = F.col("c_custkey")
        return self.raw("customer").filter("c_custkey % 5 < 3").select(
            g_number(p).alias("student"), pick(p % 5, F.col("c_mktsegment"), "", F.lit(None)).alias("major")
        )

    @cached_property
    def cohort(self) -> DataFrame:
        p = F.col("c_custkey")
        return self.raw("customer").filter("c_custkey % 3 = 0").select(
            p.alias("person_id"),
            g_number(p).alias("g_number"),
            F.when(p % 2 == 0, "done").alias("exit_reason"),
            (F.lit(2012) + (p % 5).cast("int")).alias("cohort"),
            F.concat(F.lit("Coach "), (p % 10).cast("string")).alias("coach"),
        )

    @cached_property
    def enroll_results(self) -> DataFrame:
        p = F.col("c_custkey")
        return self.raw("customer").select(
            g_number(p).alias("g_number"),
            ((F.lit(2012) + p % 4) * 100 + 1 + p % 4).cast("int").alias("first_term"),
            F.when(p % 6 != 0, ((F.lit(2015) + p % 3) * 100 + 1 + p % 3).cast("int")).alias("last_term"),
            pick(p % 3, "Y", "N").alias("yes_passed"),
            pick(p % 4, "N", "Y", "N").alias("ytc_passed"),
            F.when(p % 3 == 0, "201302").otherwise("").alias("yes_term"),
            F.when(p % 4 == 1, "201403").alias("ytc_term"),
        )
