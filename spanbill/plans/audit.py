"""Column-level change audit between two snapshots, or over a change feed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, StringType

from spanbill.functions.exprs import differs
from spanbill.operators.snapshots import among
from spanbill.operators.stage import settle

MODES = ("null_safe", "length", "plain")
STAMPS = ("updated_at", "updated_by")
#: From so many columns on, rows are told apart by fingerprints before they are shuffled.
WIDE = 12
AUDIT_COLUMNS = [
    "table_name", "id_column", "id_value", "column_name", "old_value", "new_value", "action", "changed_at",
    "changed_by",
]


def changed(old: Column, new: Column, mode: str, is_text: bool, ignore_case: bool = True) -> Column:
    """Did a value change?

    ``null_safe``  values differ or exactly one is NULL
    ``length``     values differ, or their text lengths differ with NULL as
                   empty: NULL and ``''`` are the same
    ``plain``      both are set and differ
    """
    left, right = (F.lower(old), F.lower(new)) if is_text and ignore_case else (old, new)
    if mode == "null_safe":
        return differs(left, right)
    unequal = F.coalesce(left != right, F.lit(False))
    if mode == "plain":
        return unequal
    empty = F.lit("")
    return unequal | (
        F.length(F.coalesce(old.cast("string"), empty)) != F.length(F.coalesce(new.cast("string"), empty))
    )


def fingerprint(side: str, columns: list[str], types: dict, ignore_case: bool) -> Column:
    """128 bits of a row's compared values. Equal values hash alike, NULL apart from any value; two rows that differ share
    both hashes once in 2**128 rows."""
    values = []
    for name in columns:
        value = F.col(f"{side}.{name}")
        values += [value.isNull(), F.lower(value) if ignore_case and isinstance(types[name], StringType) else value]
        if isinstance(types[name], (StringType, FractionalType)):
            values.append(F.length(value.cast("string")))  # what lower case or a signed zero can hide
    return F.struct(F.xxhash64(*values), F.xxhash64(F.lit(1), *values))


def audit_rows(
    pairs: DataFrame,
    key: str,
    table: str,
    columns: list[str],
    mode: str | tuple[str, ...],
    changed_at: datetime | Column,
    changed_by: str | Column,
    ignore_case: bool = True,
    keep: list[str] = (),
) -> DataFrame:
    """One row per changed column of rows that carry ``old`` and ``new`` structs.

    A single generator per input row: no join, no shuffle, and it runs the same
    over a batch and over a stream. Several modes are judged in the same pass;
    the result then has a column ``mode`` and a row for each that sees a change.

    Most rows of a wide table do not change. So a row's columns are compared
    only where its fingerprint, a hash of old and one of new values, has
    moved; the others drop out before the wide comparison. Columns in ``keep``
    come along.
    """
    modes = [mode] if isinstance(mode, str) else list(mode)
    if not set(modes) <= set(MODES):
        raise ValueError(f"mode must be one of {MODES}")
    types = {f.name: f.dataType for f in pairs.schema["new"].dataType.fields}
    entries = []
    for name in columns:
        old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
        is_text = isinstance(types[name], StringType)
        seen = [F.when(changed(old, new, m, is_text, ignore_case), F.lit(m)) for m in modes]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                old.cast("string").alias("old_value"),
                new.cast("string").alias("new_value"),
                F.array_compact(F.array(*seen)).alias("_modes"),
            )
        )
    moved = F.filter(F.array(*entries), lambda e: F.size(e["_modes"]) > 0)
    rows = (
        pairs.filter(fingerprint("old", columns, types, ignore_case) != fingerprint("new", columns, types, ignore_case))
        .select("new", *keep, F.explode(moved).alias("_e"))
        .select(
            *keep,
            F.lit(table).alias("table_name"),
            F.lit(key).alias("id_column"),
            F.col(f"new.{key}").alias("id_value"),
            "_e.column_name",
            "_e.old_value",
            "_e.new_value",
            F.lit("UPDATE").alias("action"),
            (changed_at if isinstance(changed_at, Column) else F.lit(changed_at)).alias("changed_at"),
            (changed_by if isinstance(changed_by, Column) else F.lit(changed_by)).alias("changed_by"),
            "_e._modes",
        )
    )
    if isinstance(mode, str):
        return rows.drop("_modes")
    return rows.withColumn("mode", F.explode("_modes")).drop("_modes")


def audited_columns(df: DataFrame, columns: list[str] | None, exclude) -> list[str]:
    return [c for c in (columns or df.columns) if c not in exclude]


def audit_update(
    old: DataFrame,
    new: DataFrame,
    key: str,
    table: str,
    columns: list[str] | None = None,
    exclude=STAMPS,
    mode: str | tuple[str, ...] = "null_safe",
    changed_at: datetime | Column | None = None,
    changed_by: str | Column | None = None,
    ignore_case: bool = True,
) -> DataFrame:
    """Audit rows for the keys that both snapshots hold.

    Of wide snapshots only keys and fingerprints are shuffled first; whole rows are
    fetched for the keys whose fingerprint moved.
    """
    names = audited_columns(new, columns, exclude)
    if len(names) > WIDE:
        kinds = {f.name: f.dataType for f in new.schema.fields}
        before, after = (
            df.select(F.col(key), F.struct("*").alias(side)).select(key, fingerprint(side, names, kinds, ignore_case).alias(side))
            for side, df in (("old", old), ("new", new))
        )
        moved = settle(before.join(after, key).filter(F.col("old") != F.col("new")).select(key))
        old, new = among(old, key, moved), among(new, key, moved)
    return audit_rows(changes(old, new, key), key, table, names, mode, changed_at, changed_by, ignore_case)


def changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows with ``old`` and ``new`` structs for the keys that both snapshots hold."""
    return old.select(F.col(key).alias("_key"), F.struct(*old.columns).alias("old")).join(
        new.select(F.col(key).alias("_key"), F.struct(*new.columns).alias("new")), "_key"
    )


def audit_insert(
    old: DataFrame,
    new: DataFrame,
    key: str,
    table: str,
    columns: list[str] | None = None,
    exclude=(),
    changed_at: datetime | None = None,
    changed_by: str | None = None,
) -> DataFrame:
    """One row per column of the keys that only the new snapshot holds."""
    names = audited_columns(new, columns, exclude)
    added = new.join(old.select(key), key, "left_anti")
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("new_value")) for c in names]
    return added.select(F.col(key).alias("id_value"), F.explode(F.array(*entries)).alias("_e")).select(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("id_column"),
        "id_value",
        "_e.column_name",
        F.lit(None).cast("string").alias("old_value"),
        "_e.new_value",
        F.lit("INSERT").alias("action"),
        F.lit(changed_at).alias("changed_at"),
        F.lit(changed_by).alias("changed_by"),
    )
