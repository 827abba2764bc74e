"""Reproducible shuffle and sharding: a Feistel permutation, with cycle walking, of global row numbers.

Every row gets its number in the table's order; the permutation sends that number to a
place in 0..n-1; place modulo shards is the shard, place divided by shards the slot. Counts
of shards differ by one at most and slots have no gaps. With the row count and the seed
alone, :func:`locate` tells where a row went and :func:`row_at` which row is at a place.

Nulls, empty and very long texts only change the size. Rows equal in all order columns are
numbered in the order read; they differ in nothing that the order sees. An empty table gives
an empty result. Extra columns are carried along; a column with the name of a result column
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanbill.llm.common import mix64
from spanbill.operators.stage import settle

ROUNDS = 6
_LOW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def _keys(seed: int) -> np.ndarray:
    return mix64(np.uint64(seed) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _half_bits(n: int) -> int:
    return max(1, ((n - 1).bit_length() + 1) // 2)


def _once(x: np.ndarray, bits: int, keys: np.ndarray, back: bool) -> np.ndarray:
    half, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    left, right = x >> half, x & mask
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mix64(left ^ key) & mask), left
        else:
            left, right = right, left ^ (mix64(right ^ key) & mask)
    return (left << half) | right


def permute(x: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """The place of each number in 0..n-1, or with back the number at each place.

    The network permutes a power of four that is less than 4 n (4 at least); a result beyond n is sent
    through again until it falls inside, which keeps the whole a permutation of 0..n-1.
    """
    bits, keys = _half_bits(n), _keys(seed)
    out = _once(np.asarray(x, dtype=np.uint64), bits, keys, back)
    while (far := out >= n).any():
        out[far] = _once(out[far], bits, keys, back)
    return out.astype(np.int64)


def locate(row: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of a row number."""
    slot, shard = divmod(int(permute(np.array([row]), n, seed)[0]), shards)
    return shard, slot


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """Row number at a shard's slot."""
    return int(permute(np.array([slot * shards + shard]), n, seed, back=True)[0])


def number_rows(df: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """df with row_no, 0 to n-1 in the given order, and n.

    One range shuffle of the rows, which are written once; what is added up over partitions is
    one count each. A last order column, the place at which a row was read, lets a run of equal rows
    be split over several partitions.
    """
    keys = [f"o{i}" for i in range(len(order))]
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    salted = df.select(whole, *[o.alias(k) for o, k in zip(order, keys, strict=True)], F.monotonically_increasing_id().alias("read"))
    ranked = salted.repartitionByRange(*keys, "read").sortWithinPartitions(*keys, "read")
    rows = settle(ranked.select("row", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", _LOW_BITS)
    counts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = F.col("place") - F.shiftleft(part, _LOW_BITS)
    numbered = rows.withColumn("part", part).join(F.broadcast(starts), "part").select("row", (F.col("start") + inside).alias("row_no"))
    return numbered.select("row.*", "row_no"), rows.count()


def shard_rows(df: DataFrame, shards: int, order: list[Column], seed: int) -> DataFrame:
    """df with row_no, shard (int) and slot (long)."""
    df = df.drop("row_no", "shard", "slot")
    numbered, n = number_rows(df, order)

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(permute(rows.to_numpy(), max(n, 1), seed))

    placed = numbered.select(F.struct(*[F.col(f"`{c}`") for c in numbered.columns]).alias("row"), place("row_no").alias("to"))
    spot = F.struct(F.pmod("to", F.lit(shards)).cast("int").alias("shard"), F.expr(f"`to` div {shards}").alias("slot"))
    return placed.select("row", spot.alias("spot")).select("row.*", "spot.*")


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size and CRC of each text (a null text counts as empty), and a hash that orders rows of one id."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("_hash"),
    )


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 20_011) -> DataFrame:
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("_hash")]
    placed = shard_rows(document_sizes(docs), shards, order, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_no"
    )
