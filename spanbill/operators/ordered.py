"""Looking forwards and backwards along one key's ordered rows.

A window partitioned by a key sends all rows of that key to one task, which
breaks when one key owns a large part of the table. ``ordered_scan`` keeps the
plain window for ordinary keys. The rows of keys above a row limit are range
partitioned on the whole order, ids included, so even one crowded day is cut
into chunks of about that limit. The window then runs per (key, chunk), one
summary row per chunk carries what the neighbouring chunks know, and a join on
(key, chunk) fills in the edges. Both ways give the same rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanbill.operators.stage import settle

HOT_ROWS_CONF = "spark.spanbill.hotKeyRows"
HOT_ROWS_DEFAULT = 2_000_000


class Take(NamedTuple):
    """One result of a scan.

    ``number``      position of the row, from 1
    ``lead``/``lag``  value of the next / previous row (pass a struct, so that
                    a missing row differs from a row of NULLs)
    ``last``        last value that is set, up to and including the row
    ``next``        first value that is set, from the row on
    ``next_after``  first value that is set, strictly after the row
    ``top_after``   largest value from the row on
    """

    kind: str
    value: Column | None = None


class HotKeys(NamedTuple):
    """Keys with too many rows for one task, and how many chunks their rows need."""

    keys: DataFrame
    chunks: int


def find_hot_keys(df: DataFrame, key: str, limit: int | None = None) -> HotKeys | None:
    """Keys with more than ``limit`` rows, or None.

    This counts one pruned column with map-side combine. Only the total of the
    hot rows comes to the driver; the list is written as a stage, and Spark
    chooses how to join it from its size. NULL is a key like any other.
    """
    spark = df.sparkSession
    if limit is None:
        limit = int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
    total = counts.agg(F.sum("n").alias("n")).first()["n"]
    if total is None:
        return None
    return HotKeys(settle(counts.select(key)), max(2, math.ceil(total / limit)))


def _windows(keys, order):
    forward = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
    backward = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return forward, backward


def _local(take: Take, forward, backward) -> Column:
    # "from here on" is a running frame over the reversed order: a frame that
    # ends at the last row would be recomputed for every row
    start = Window.unboundedPreceding
    return {
        "number": lambda: F.row_number().over(forward),
        "lead": lambda: F.lead(take.value).over(forward),
        "lag": lambda: F.lag(take.value).over(forward),
        "last": lambda: F.last(take.value, True).over(forward.rowsBetween(start, 0)),
        "next": lambda: F.last(take.value, True).over(backward.rowsBetween(start, 0)),
        "next_after": lambda: F.last(take.value, True).over(backward.rowsBetween(start, -1)),
        "top_after": lambda: F.max(take.value).over(backward.rowsBetween(start, 0)),
    }[take.kind]()


def _summary(take: Take, order) -> Column:
    place = F.struct(*order)
    if take.kind == "number":
        return F.count(F.lit(1))
    if take.kind == "top_after":
        return F.max(take.value)
    if take.kind == "lead":
        return F.min_by(take.value, place)
    if take.kind == "lag":
        return F.max_by(take.value, place)
    seen = F.when(take.value.isNotNull(), place)
    return F.max_by(take.value, seen) if take.kind == "last" else F.min_by(take.value, seen)


def _carry(take: Take, name: str, forward, backward) -> Column:
    before, value = Window.unboundedPreceding, F.col(name)
    return {
        "number": lambda: F.sum(value).over(forward.rowsBetween(before, -1)),
        "lead": lambda: F.lead(value).over(forward),
        "lag": lambda: F.lag(value).over(forward),
        "last": lambda: F.last(value, True).over(forward.rowsBetween(before, -1)),
        "next": lambda: F.last(value, True).over(backward.rowsBetween(before, -1)),
        "next_after": lambda: F.last(value, True).over(backward.rowsBetween(before, -1)),
        "top_after": lambda: F.max(value).over(backward.rowsBetween(before, -1)),
    }[take.kind]()


def _combine(take: Take, local: Column, carried: Column) -> Column:
    if take.kind == "number":
        return (local + F.coalesce(carried, F.lit(0))).cast("int")
    if take.kind == "top_after":
        return F.greatest(local, carried)
    return F.coalesce(local, carried)


def _plain(df: DataFrame, keys, order, take: dict[str, Take]) -> DataFrame:
    forward, backward = _windows(keys, order)
    return df.withColumns({name: _local(t, forward, backward) for name, t in take.items()})


def _chunked(df: DataFrame, key: str, order, take: dict[str, Take], chunks: int) -> DataFrame:
    # the chunk number becomes data once the stage is written, so every branch
    # below and every retry sees the same chunks
    ranged = df.repartitionByRange(chunks, key, *order)
    rows = settle(ranged.withColumn("_chunk", F.spark_partition_id()))

    scanned = _plain(rows, [key, "_chunk"], order, take)
    edges = rows.groupBy(key, "_chunk").agg(
        *[_summary(t, order).alias(f"_{name}") for name, t in take.items()]
    )
    forward, backward = _windows([key], ["_chunk"])
    edges = edges.select(
        F.col(key).alias("_edge_key"), F.col("_chunk").alias("_edge_chunk"), *[_carry(t, f"_{name}", forward, backward).alias(f"_{name}") for name, t in take.items()]
    )
    joined = scanned.join(edges, F.col(key).eqNullSafe(F.col("_edge_key")) & (F.col("_chunk") == F.col("_edge_chunk")))
    return joined.withColumns(
        {name: _combine(t, F.col(name), F.col(f"_{name}")) for name, t in take.items()}
    ).drop("_chunk", "_edge_key", "_edge_chunk", *[f"_{name}" for name in take])


def ordered_scan(
    df: DataFrame, key: str, order: list[str], take: dict[str, Take], hot: HotKeys | None = None
) -> DataFrame:
    """Add the results of ``take``, looking along ``order`` within ``key``.

    ``order`` names columns that give a total order per key.
    """
    if hot is None:
        return _plain(df, [key], order, take)
    listed, same = hot.keys.select(F.col(key).alias("_hot")), F.col(key).eqNullSafe(F.col("_hot"))
    cold = _plain(df.join(listed, same, "left_anti"), [key], order, take)
    warm = _chunked(df.join(listed, same, "left_semi"), key, order, take, hot.chunks)
    return cold.unionByName(warm.select(*cold.columns))


def group_scan(df: DataFrame, key: str, group: list[str], take: dict[str, Column], hot: HotKeys | None = None) -> DataFrame:
    """Add aggregates over whole groups, which lie within ``key``, to each of their rows.

    Ordinary keys take a plain window. Groups of hot keys are aggregated with
    partial results per task, one row a group, and joined back, so that no
    task gets a whole group.
    """
    window = Window.partitionBy(*group)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumns({name: value.over(window) for name, value in take.items()})

    if hot is None:
        return plain(df)
    listed, same = hot.keys.select(F.col(key).alias("_hot")), F.col(key).eqNullSafe(F.col("_hot"))
    cold = plain(df.join(listed, same, "left_anti"))
    warm = settle(df.join(listed, same, "left_semi"))
    told = warm.groupBy(*group).agg(*[value.alias(name) for name, value in take.items()])
    told = told.withColumnsRenamed({c: f"_of_{c}" for c in group})
    of_group = F.lit(True)
    for c in group:
        of_group = of_group & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    back = warm.join(told, of_group).select(*cold.columns)
    return cold.unionByName(back)
