"""As-of matching: one shuffle by key, no pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanbill.operators.ordered import HotKeys, Take, ordered_scan


def next_after(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_date: str,
    right_date: str,
    right_id: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """For each left row the earliest right row on or after its date.

    Adds ``next_date`` and ``next_id`` (NULL when there is none). A right row
    on the same date counts; ties go to the lowest id.
    """
    rows = left.select(
        key,
        F.col(left_date).alias("_at"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(right.schema[right_id].dataType).alias("_id"),
        F.struct(*left.columns).alias("_row"),
    ).unionByName(
        right.select(key, F.col(right_date).alias("_at"), F.lit(1).alias("_side"), F.col(right_id).alias("_id")),
        allowMissingColumns=True,
    )
    found = F.when(F.col("_side") == 1, F.struct(F.col("_at").alias("date"), F.col("_id").alias("id")))
    scanned = ordered_scan(rows, key, ["_at", "_side", "_id"], {"_next": Take("next", found)}, hot)
    return scanned.filter(F.col("_side") == 0).select(
        "_row.*", F.col("_next.date").alias("next_date"), F.col("_next.id").alias("next_id")
    )


def latest_before(
    left: DataFrame,
    events: DataFrame,
    key: str,
    bound: str,
    event_date: str,
    event_id: str,
    values: dict[str, Column],
    hot: HotKeys | None = None,
) -> DataFrame:
    """For each left row the last event strictly before ``bound``.

    ``values`` names what to bring: each is a column over ``events`` that is
    NULL for events which do not count, so one pass can look up several
    attributes. A NULL bound takes the latest event of all.
    """
    id_type = events.schema[event_id].dataType
    rows = left.select(
        key,
        F.col(bound).isNull().alias("_open"),
        F.col(bound).alias("_at"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(id_type).alias("_id"),
        F.struct(*left.columns).alias("_row"),
    ).unionByName(
        events.select(
            key,
            F.lit(False).alias("_open"),
            F.col(event_date).alias("_at"),
            F.lit(1).alias("_side"),
            F.col(event_id).alias("_id"),
            *[value.alias(name) for name, value in values.items()],
        ),
        allowMissingColumns=True,
    )
    # open bounds sort behind every event; side 0 sorts first on a shared date, so events of that date come later
    take = {f"_{name}": Take("last", F.col(name)) for name in values}
    scanned = ordered_scan(rows, key, ["_open", "_at", "_side", "_id"], take, hot)
    return scanned.filter(F.col("_side") == 0).select(
        "_row.*", *[F.col(f"_{name}").alias(name) for name in values]
    )


def latest_per_key(events: DataFrame, key: str, event_date: str, event_id: str, values: list[str]) -> DataFrame:
    """The last event per key; a plain aggregate, so hot keys combine map-side."""
    best = F.max(F.struct(event_date, event_id, *values)).alias("_best")
    return events.groupBy(key).agg(best).select(key, "_best.*")
