"""Column expressions shared by the jobs. None of them needs a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanbill.functions import fixed


def given(value) -> bool:
    """Is an optional filter set? None, empty text, 0 and ``"0"`` mean no filter."""
    return value not in (None, "", 0, "0")


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def program_name(program: Column) -> Column:
    """Map a raw program code to the program it reports under."""
    code = F.lower(program)
    return (
        F.when(code.isin(*fixed.GTC_NAMES), fixed.PROGRAM_GTC)
        .when(code.isin(*fixed.YTC_NAMES), fixed.PROGRAM_YTC)
        .otherwise(fixed.PROGRAM_NONE)
    )


def canonical_program(program: Column) -> Column:
    """One spelling per program code, since codes are compared without case."""
    code = F.lower(program)
    names = (fixed.PROGRAM_YTC, fixed.PROGRAM_GTC)
    return reduce(lambda chain, n: F.when(code == n.lower(), n).otherwise(chain), names, code)


def same_text(left: Column, right: Column) -> Column:
    """Text equality without case."""
    return F.lower(left) == F.lower(right)


def is_attendance(program: Column) -> Column:
    return program.ilike("%attendance%")


def term_label(term: Column) -> Column:
    """``201704`` becomes ``201704-Fall``; NULL for an unknown season digit."""
    digit = F.right(term.cast("string"), F.lit(1)).cast("int")
    season = reduce(
        lambda chain, item: chain.when(digit == item[0], item[1]),
        list(fixed.SEASONS.items())[1:],
        F.when(digit == 1, fixed.SEASONS[1]),
    )
    return F.concat(term.cast("string"), season)


def term_number(term: Column) -> Column:
    """Consecutive term index: four per year plus the season digit; unreadable text counts as 0."""
    text = term.cast("string")
    zero = F.lit(0)
    year = F.coalesce(F.left(text, F.lit(4)).try_cast("int"), zero)
    digit = F.coalesce(F.right(text, F.lit(1)).try_cast("int"), zero)
    return F.when(text.isNotNull(), year * 4 + digit)


def grade_band(dob: Column, year: Column | int) -> Column:
    """School grade in a school year from the age on 1 September.

    Over 21 is out of school, 17 to 21 is grade 12, and each year younger is
    one grade lower down to 9; younger people have no band.
    """
    year = F.lit(year) if isinstance(year, int) else year
    turned = year - F.year(dob) - (F.month(dob) >= 9).cast("int")
    return (
        F.when(turned >= 21, "Over")
        .when(turned >= 17, "12")
        .when(turned >= 14, (turned - 5).cast("string"))
    )


def whole_years(start: Column, end: Column) -> Column:
    """Whole years from one date to another."""
    return F.timestamp_diff("YEAR", start.cast("timestamp_ntz"), end.cast("timestamp_ntz")).cast("int")


def iso(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def grade_points(grade: Column, credits: Column) -> Column:
    """Credits times the points of a letter grade; NULL for other marks."""
    points = F.create_map(*[F.lit(v) for kv in fixed.GRADE_POINTS.items() for v in kv])
    return credits * F.try_element_at(points, F.upper(grade))


def is_graded(grade: Column) -> Column:
    return F.upper(grade).isin(*fixed.GRADE_POINTS)


def is_esol(subject: Column) -> Column:
    return F.upper(subject) == fixed.ESOL


def esol_level(subject: Column, title: Column) -> Column:
    """The level digit of an ESOL title such as ``Level 8 Academic Reading``."""
    named = is_esol(subject) & (F.lower(F.left(title, F.lit(5))) == "level")
    return F.when(named, F.substring(title, 7, 1))


def char_code(char: Column) -> Column:
    """A string of at most one character as a number of the same order: smallest and largest of numbers need no sort."""
    return F.conv(F.hex(F.concat(F.lit("!"), char)), 16, 10).cast("long")


def char_of(code: Column) -> Column:
    """The string of a ``char_code``."""
    return F.substring(F.unhex(F.hex(code)).cast("string"), 2, 1)


def differs(old: Column, new: Column) -> Column:
    """Null-safe inequality."""
    return ~old.eqNullSafe(new)


def greatest_if_all(*dates: Column) -> Column:
    """Largest value, or NULL as soon as one of them is missing."""
    return F.when(all_of([d.isNotNull() for d in dates]), F.greatest(*dates))


def decimal(text: str, scale: int | None = None) -> Column:
    places = len(text.split(".")[1]) if scale is None else scale
    return F.lit(text).cast(f"decimal({places + 4},{places})")
