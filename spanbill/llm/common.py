"""Pieces that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table is broadcast only when its measured size stays under this.
BROADCAST_BYTES = 48 << 20
#: Bytes of rows that an executor hands its Python worker at once, while a stage of texts is written. Each holds them whole.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_row(docs: DataFrame, without: list[str] = ()) -> DataFrame:
    """doc_id, text, and the row itself as one struct, so that none of its columns can clash with an operator's own."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("row"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters untouched. Text of ASCII alone takes the quick built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def text_hash(text: Column) -> Column:
    """Tells apart rows that share an id; null and empty differ."""
    return F.xxhash64(text.isNull(), text)


def bounded(df: DataFrame, size: Column) -> DataFrame:
    """df marked for broadcast if its rows, each of `size` bytes, stay under the limit; otherwise left to the shuffle join."""
    total = df.agg(F.sum(size + 48).alias("b")).first()["b"] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Stages written inside go to the Python workers in batches of BATCH_BYTES, or one row if that is more, instead of 10,000 rows or 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    size = int(before.rstrip("bB")) if before.rstrip("bB").isdigit() else None  # a size with a unit is somebody's own choice
    if size is not None and size > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def match_pieces(text: Column, pattern: str, kind: int, context: Callable[[Column], Column] | None = None) -> Column:
    """All matches of a pattern, left to right: array of (kind, n, gap, hit), gap the code points since the last match's end.

    With context, ctx holds that function of the text since the last match. Texts without the pattern are scanned once. Positions
    are running sums of gaps and hits, taken over rows later, so that many matches in one text cost no more than their number.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"))

    def row(p: Column, i: Column) -> Column:
        more = [context(p["gap"]).alias("ctx")] if context else []
        return F.struct(F.lit(kind).alias("kind"), i.alias("n"), F.length(p["gap"]).cast("long").alias("gap"), p["hit"].alias("hit"), *more)

    return F.when(text.rlike(pattern), F.transform(pairs, row))


def tagged_pieces(
    text: Column, patterns: dict[str, str], context: Callable[[Column], Column] | None = None, wanted: list[Column] | None = None
) -> Column:
    """match_pieces of several kinds in one array, kinds numbered in order; a kind is matched only in rows where it is wanted."""
    none = F.array().cast(f"array<struct<kind:int,n:int,gap:bigint,hit:string{',ctx:string' if context else ''}>>")

    def pieces(i: int, pattern: str) -> Column:
        found = match_pieces(text, pattern, i, context)
        return found if wanted is None else F.when(wanted[i], found)

    return F.concat(*[F.coalesce(pieces(i, p), none) for i, p in enumerate(patterns.values())])


def kind_count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_text(spans: Column, kinds: list[str]) -> Column:
    """Array of (start, kind, end), sorted, as kind:start:end with commas between."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))



def slices(batch: pa.RecordBatch, column: str, rows: int = 256, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most so many rows and, unless it is one row, so many bytes of a text column."""
    sizes, begin, held = [0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()], 0, 0
    for i, n in enumerate(sizes):
        if i > begin and (i - begin >= rows or held + n > limit):
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield batch.slice(begin)
