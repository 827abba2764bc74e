"""Small hand-made domain tables."""

from __future__ import annotations

from datetime import date

from spanbill.plans.intervals import Dims
from spanbill.sources.tables import SCHEMAS


def d(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def table(spark, name: str, rows: list[dict]):
    """Rows as dicts; missing columns are NULL."""
    schema = spark.createDataFrame([], SCHEMAS[name]).schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def status(spark, rows):
    """(id, person, kind, program, date[, undone, notes]) tuples; dates stay dates."""
    filled = [(*r, *[None] * (7 - len(r))) for r in rows]
    return spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], d(r[4]), r[5], r[6]) for r in filled],
        "status_id long, person_id long, kind int, program string, status_date date, undone_by long, notes string",
    )


def contact(spark, people=(1, 2, 3), test=()):
    rows = [
        {"person_id": p, "g_number": f"G{p}", "first_name": "TEST" if p in test else "Ann", "last_name": f"L{p}",
         "dob": d("2000-02-29")}
        for p in people
    ]
    return table(spark, "contact", rows)


def dims(spark, reason=(), secondary=(), district=(), coach=()):
    kinds = [(13, "Credit"), (14, "ELL Credit"), (15, "ELL Attendance"), (16, "Attendance")]
    reasons = [(1, "Graduated", 1), (2, "Moved", 2), (3, "Alpha", 60), (4, "Beta", 4)]
    return Dims(
        spark.createDataFrame(kinds, SCHEMAS["kinds"]),
        spark.createDataFrame(reasons, SCHEMAS["reasons"]),
        spark.createDataFrame(list(reason), SCHEMAS["status_reason"]),
        spark.createDataFrame(list(secondary), SCHEMAS["secondary"]),
        spark.createDataFrame(list(district), SCHEMAS["status_district"]),
        spark.createDataFrame([(7, "North"), (8, "South")], SCHEMAS["districts"]),
        spark.createDataFrame(list(coach), SCHEMAS["status_coach"]),
        spark.createDataFrame([(1, "Kim"), (2, "Lee")], SCHEMAS["coaches"]),
    )


def calendar(spark):
    """Quarters of 2012 to 2018; the program year starts in summer."""
    rows = []
    for y in range(2012, 2019):
        for q in range(1, 5):
            begin = date(y, 3 * q - 2, 1)
            following = date(y + (q == 4), 1 if q == 4 else 3 * q + 1, 1)
            end = date.fromordinal(following.toordinal() - 11)
            first = y if q > 2 else y - 1
            rows.append((y * 100 + q, f"{first}-{first + 1}", (q + 1) % 4 + 1, begin, end, following))
    return spark.createDataFrame(rows, SCHEMAS["calendar"])


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(str(v) if isinstance(v, date) else v for v in r) for r in picked.collect()), key=repr)
