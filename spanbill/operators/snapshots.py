"""Keyed updates as joins: a new snapshot instead of a row changed in place."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanbill.functions.exprs import any_of, differs


#: From so many keys on, rows are told apart by a bit map before they are shuffled. A bit map has 8 bits a key, at most 2**28 (32 MB).
MANY_KEYS = 20_000
_MOST_BITS, _WORDS = 28, 32


def among(df: DataFrame, key: str, keys: DataFrame, many: int = MANY_KEYS) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys`` (distinct, and read more than once).

    With many keys the rows would be shuffled to meet them. So a bit map of the keys' hashes, of bounded
    size, goes to all tasks first, and only the rows whose bit is set are shuffled.
    """
    count = keys.count()
    if count <= many:
        return df.join(keys, key, "left_semi")
    bits = min(2**_MOST_BITS, 2 ** max(16, math.ceil(math.log2(8 * max(count, 1)))))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    block, word, bit = F.expr(f"_at div {64 * _WORDS}"), F.expr(f"cast(_at div 64 % {_WORDS} as int)"), F.expr("cast(_at % 64 as int)")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = [F.coalesce(F.bit_or(F.when(word == i, one)), F.lit(0).cast("long")) for i in range(_WORDS)]
    taken = keys.select(place.alias("_at")).groupBy(block.alias("_block")).agg(F.array(*words).alias("_bits"))
    rows = df.withColumn("_at", place).join(F.broadcast(taken), block == F.col("_block"))
    rows = rows.filter(F.getbit(F.get("_bits", word), bit) == 1).select(*df.columns)
    # a semi join would be moved ahead of the bit map
    return rows.join(keys.distinct(), key).select(*df.columns)


def _moved(old: str, new: str, cols: list[str], null_as):
    def value(name):
        column = F.col(name)
        return column if null_as is None else F.coalesce(column, F.lit(null_as))

    return any_of([differs(value(f"{old}.{c}"), value(f"{new}.{c}")) for c in cols])


def changed_only(old: DataFrame, new: DataFrame, key: str, cols: list[str], null_as=None) -> DataFrame:
    """Rows of ``new`` whose value differs from ``old`` in any of ``cols``.

    ``null_as`` gives a value that counts as equal to NULL.
    """
    before = old.select(key, *cols).alias("o")
    return (
        new.alias("n")
        .join(before, F.col(f"n.{key}") == F.col(f"o.{key}"))
        .filter(_moved("o", "n", cols, null_as))
        .select("n.*")
    )


def stamps(columns: list[str], hit: Column, changed_at=None, changed_by=None) -> dict[str, Column]:
    """When and by whom, for the rows that are hit; other rows keep what they have."""
    out = {}
    for name, value in (("updated_at", changed_at), ("updated_by", changed_by)):
        if value is not None:
            before = F.col(name) if name in columns else F.lit(None)
            out[name] = F.when(hit, F.lit(value)).otherwise(before)
    return out


def apply_changes(
    old: DataFrame,
    changes: DataFrame,
    key: str,
    cols: list[str],
    changed_at=None,
    changed_by=None,
    only_changed: bool = False,
    null_as=None,
) -> DataFrame:
    """``old`` with ``cols`` replaced for the keys in ``changes`` (one row per key).

    A changed row takes the new value even when that is NULL. With
    ``changed_at`` / ``changed_by`` the rows written are stamped. One join does
    it all: with ``only_changed`` a row is written and stamped only when a
    value differs (see ``changed_only``).
    """
    fresh = changes.select(F.col(key).alias("_key"), F.struct(*cols).alias("_new"))
    joined = old.join(fresh, F.col(key) == F.col("_key"), "left").drop("_key")
    return write_new(joined, cols, changed_at, changed_by, only_changed, null_as)


def write_new(
    rows: DataFrame, cols: list[str], changed_at=None, changed_by=None, only_changed: bool = False, null_as=None
) -> DataFrame:
    """As ``apply_changes``, for rows that carry their new values as a struct ``_new`` (NULL: no change)."""
    columns = [c for c in rows.columns if c != "_new"]
    types = {f.name: f.dataType for f in rows.schema["_new"].dataType.fields}
    missing = {c: F.lit(None).cast(types[c]) for c in cols if c not in columns}
    base = rows.withColumns(missing) if missing else rows
    joined = base.withColumn("_old", F.struct(*cols))
    hit = F.col("_new").isNotNull()
    if only_changed:
        hit = hit & _moved("_old", "_new", cols, null_as)
    out = {c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in cols}
    out |= stamps(columns, hit, changed_at, changed_by)
    return joined.withColumns(out).drop("_new", "_old")
