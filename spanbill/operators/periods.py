"""Joining date ranges with a calendar.

A calendar of up to ``spark.spanbill.calendarRows`` rows becomes one sorted
array, a constant of the plan. Each row finds its part of the array by
two binary searches and generates its pairs from there: no join, no shuffle,
and no year that many rows share.

A larger one is joined through a year bucket: both sides are expanded to the
years they touch, joined on the year, and each pair is kept in exactly one
bucket, the later of the two first years. Both ways give the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALENDAR_ROWS_CONF = "spark.spanbill.calendarRows"
CALENDAR_ROWS_DEFAULT = 2_000
_STEPS = 32  # halvings; those of an empty part change nothing


def _ranges(calendar: DataFrame, begin: str, finish: str) -> Column | None:
    """The calendar as one array in the order of its begins: b, f, the row, and the farthest finish so far.

    A constant of the plan, so no row carries it. None if the calendar has more rows than the limit.
    """
    limit = int(calendar.sparkSession.conf.get(CALENDAR_ROWS_CONF, str(CALENDAR_ROWS_DEFAULT)))
    row = F.struct(*calendar.columns)
    one = F.struct(F.col(begin).alias("b"), F.col(finish).alias("f"), row.alias("row"))
    known = calendar.filter(F.col(begin).isNotNull() & F.col(finish).isNotNull())
    rows = known.select(F.col(begin).alias("b"), F.col(finish).alias("f"), F.to_json(one).alias("one")).limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    ranges, far = [], None
    for r in sorted(rows):
        far = max((r["f"], json.loads(r["one"])["f"]), far) if far else (r["f"], json.loads(r["one"])["f"])
        ranges.append(json.loads(r["one"]) | {"far": far[1]})
    kinds = {f.name: f.dataType.simpleString() for f in calendar.schema.fields}
    fields = ",".join(f"`{c}`:{k}" for c, k in kinds.items())
    kind = f"array<struct<b:{kinds[begin]},f:{kinds[finish]},row:struct<{fields}>,far:{kinds[finish]}>>"
    return F.from_json(F.lit(json.dumps(ranges)), kind)


def _first(ranges: Column, holds: Callable[[Column], Column]) -> Column:
    """Place of the first range for which a test holds; it has to hold for all that follow."""

    def halve(at: Column, _: Column) -> Column:
        middle, open_ = F.shiftright(at["low"] + at["high"], 1), at["low"] < at["high"]
        good = F.coalesce(holds(F.get(ranges, middle)), F.lit(False))
        low = F.when(open_ & ~good, middle + 1).otherwise(at["low"])
        return F.struct(low.alias("low"), F.when(open_ & good, middle).otherwise(at["high"]).alias("high"))

    whole = F.struct(F.lit(0).alias("low"), F.size(ranges).alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(_STEPS)), whole, halve)["low"]


def _part(ranges: Column, low: Column, high: Column, open_end: Column | None = None) -> Column:
    """The ranges that begin by ``high`` from the first that reaches ``low`` on."""
    start = _first(ranges, lambda r: r["far"] >= low)
    stop = _first(ranges, lambda r: r["b"] > high)
    stop = stop if open_end is None else F.when(open_end, F.size(ranges)).otherwise(stop)
    return F.slice(ranges, start + 1, F.greatest(stop - start, F.lit(0)))


def _years(df: DataFrame, low: Column, high: Column, first: str) -> DataFrame:
    return (
        df.withColumn(first, F.year(low))
        .withColumn("_last", F.year(high))
        .filter(F.col(first) <= F.col("_last"))
        .withColumn("_year", F.explode(F.sequence(F.col(first), F.col("_last"))))
        .drop("_last")
    )


def overlap_join(
    left: DataFrame,
    calendar: DataFrame,
    start: str,
    end: str,
    begin: str,
    finish: str,
    on: Column,
) -> DataFrame:
    """Pairs of a left range and a calendar range that satisfy ``on``.

    ``start``/``end`` bound the left range (NULL end: open) and
    ``begin``/``finish`` the calendar range. ``on`` must imply that the ranges
    share a day.
    """
    ranges = _ranges(calendar, begin, finish)
    if ranges is not None:
        ended = F.coalesce(F.col(end), F.col(start))
        low, high = F.least(F.col(start), ended), F.greatest(F.col(start), ended)
        found = F.explode(_part(ranges, low, high, F.col(end).isNull())).alias("_range")
        pairs = left.filter(F.col(start).isNotNull()).select("*", found)
        return pairs.select(*left.columns, "_range.row.*").filter(on)
    return _bucket_join(left, calendar, start, end, begin, finish, on)


def _bucket_join(left: DataFrame, calendar: DataFrame, start: str, end: str, begin: str, finish: str, on: Column) -> DataFrame:
    reach = calendar.agg(F.max(finish)).scalar()
    until = F.coalesce(F.col(end), F.greatest(reach, F.col(start)))
    low, high = F.least(F.col(start), until), F.greatest(F.col(start), until)
    first = calendar.agg(F.min(begin)).scalar()
    spread = _years(
        left.filter(F.col(start).isNotNull()), F.greatest(low, first), F.least(high, reach), "_left_first"
    )
    terms = _years(calendar, F.col(begin), F.col(finish), "_right_first")
    once = F.col("_year") == F.greatest("_left_first", "_right_first")
    return spread.join(terms, "_year").filter(on & once).drop("_year", "_left_first", "_right_first")


def date_to_period(df: DataFrame, date: str, calendar: DataFrame, period: str, begin: str, next_begin: str, name: str):
    """Add the period whose [begin, next begin) holds ``date``; NULL when none does."""
    ranges, at = _ranges(calendar.select(period, begin, next_begin), begin, next_begin), F.col(date)
    if ranges is not None:
        here = F.filter(_part(ranges, at, at), lambda r: r["f"] > at)
        rows = df.select("*", F.explode_outer(F.when(at.isNotNull(), here)).alias("_range"))
        return rows.select(*df.columns, F.col(f"_range.row.{period}").alias(name))
    found = _years(
        calendar.select(period, begin, next_begin), F.col(begin), F.date_sub(F.col(next_begin), 1), "_first"
    ).drop("_first")
    found = found.select("_year", F.col(period).alias(name), F.col(begin).alias("_b"), F.col(next_begin).alias("_n"))
    rows = df.withColumn("_year", F.year(date)).alias("l")
    held = (F.col("l._year") == F.col("r._year")) & (F.col(date) >= F.col("_b")) & (F.col(date) < F.col("_n"))
    return rows.join(found.alias("r"), held, "left").select(
        *[F.col(f"l.{c}") for c in df.columns], F.col(name)
    )
