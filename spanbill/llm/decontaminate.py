"""Benchmark decontamination: windows of benchmark words, broadcast as a hash set, found in documents.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, after A-Z are
lower-cased. A benchmark item's windows are its runs of `size` words; an item with fewer words is one window.
The distinct windows go out in blocks of a fixed greatest size, each block broadcast for a pass
over the documents: every position of a document is hashed over as many words as windows have, looked
up, and a hit is confirmed on the words themselves. Words inside any occurrence are hit.

Null and empty texts have no words and are clean; so are all documents where the benchmark is empty. Rows with the
same id are judged each for themselves. Repeated items each count as long as their ids differ. Very long texts are searched whole. An
empty table of documents gives an empty result. Extra columns are not read, and kept by ``remove_spans``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanbill.llm.common import ascii_lower, bounded, text_hash, with_row
from spanbill.operators.stage import settle

SIZE = 10
#: Windows to a broadcast: about 300 bytes each.
BLOCK = 100_000
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATOR, -1), "")


def window_hash(ws: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(ws, at + i) for i in range(size)])


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, win), a row for each window of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("ws") - size + 1, F.lit(1))))
    return items.select("item_id", "ws", starts.alias("at")).select("item_id", F.slice("ws", F.col("at"), size).alias("win"))


def find_windows(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """Rows (doc, th, n_words, pos, len, win_id): one with pos -1 for each document, and one for each occurrence."""
    pairs = settle(benchmark_windows(benchmark, size).withColumn("win_id", F.xxhash64(F.lit("win"), "win")).distinct())
    distinct = settle(pairs.select("win", "win_id").distinct())
    lengths = sorted(r[0] for r in distinct.select(F.size("win")).distinct().collect())  # `size` values at most
    blocks = -(-distinct.count() // block)
    docs = docs.select(F.col("doc_id").alias("doc"), text_hash(F.col("text")).alias("th"), words(F.col("text")).alias("ws"))
    docs = docs.withColumn("n_words", F.size("ws"))
    parts = []
    for b in range(max(blocks, 1)):
        first = F.lit(-1 if b == 0 else 0)
        last = F.greatest(F.col("n_words") - (lengths[0] if lengths else 1), F.lit(-1) if b == 0 else F.lit(0))
        steps = docs if b == 0 else docs.where(F.col("n_words") > 0)
        steps = steps.select("*", F.explode(F.sequence(first, last)).alias("pos"))
        if len(lengths) > 1:
            steps = steps.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("len"))
        else:
            steps = steps.withColumn("len", F.lit(lengths[0] if lengths else 1))
        # a window must end inside the document; the place -1 stands for the document itself
        fits = (F.col("pos") >= 0) & (F.col("pos") + F.col("len") <= F.col("n_words"))
        hashed = functools.reduce(lambda a, n: F.when(F.col("len") == n, window_hash(F.col("ws"), F.col("pos"), n)).otherwise(a), lengths, F.lit(None).cast("long"))
        steps = steps.withColumn("h", F.when(fits, hashed))
        wins = distinct.where(F.pmod("win_id", F.lit(max(blocks, 1))) == b)
        wins = wins.select("win", "win_id", functools.reduce(lambda a, n: F.when(F.size("win") == n, window_hash(F.col("win"), F.lit(0), n)).otherwise(a), lengths, F.lit(None).cast("long")).alias("wh"))
        same_words = F.slice("ws", F.greatest(F.col("pos") + 1, F.lit(1)), F.col("len")) == F.col("win")
        marker = (F.col("pos") == -1) & (F.col("len") == (lengths[0] if lengths else 1))
        met = steps.join(F.broadcast(wins), (F.col("h") == F.col("wh")) & same_words, "left").where(marker | F.col("win_id").isNotNull())
        parts.append(met.select("doc", "th", F.col("n_words").cast("long").alias("n_words"), "pos", "len", "win_id"))
    return settle(functools.reduce(DataFrame.unionByName, parts)), pairs


def hit_count(spans: Column) -> Column:
    """Words covered by a set of (pos, len)."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(acc, s):
        end = F.greatest(acc["end"], s["pos"] + s["len"])
        return F.struct((acc["n"] + end - F.greatest(acc["end"], s["pos"])).alias("n"), end.alias("end"))

    return F.aggregate(F.sort_array(spans), zero, step)["n"].cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """doc_id, th, n_words, n_hit, n_items, items (sorted ids), spans, contaminated for every row."""
    rows, pairs = find_windows(docs, benchmark, size, block)
    every, hits = rows.where("pos = -1").select("doc", "th", "n_words"), rows.where("pos >= 0")
    spans = hits.groupBy("doc", "th").agg(F.collect_set(F.struct("pos", "len")).alias("spans"))
    items = hits.select("doc", "th", "win_id").distinct().join(pairs.select("win_id", "item_id"), "win_id").select("doc", "th", "item_id").distinct()
    items = items.groupBy("doc", "th").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    keys = [F.col("doc").alias("_doc"), F.col("th").alias("_th")]
    spans = spans.select(*keys, "spans")
    items = items.select(F.col("doc").alias("_doc2"), F.col("th").alias("_th2"), "items")
    told = spans.join(items, spans["_doc"].eqNullSafe(items["_doc2"]) & (spans["_th"] == items["_th2"])).drop("_doc2", "_th2")
    joined = every.join(told, every["doc"].eqNullSafe(told["_doc"]) & (every["th"] == told["_th"]), "left")
    n_hit = F.coalesce(hit_count(F.col("spans")), F.lit(0))
    return joined.select(
        F.col("doc").alias("doc_id"), "th", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans", (n_hit > 0).alias("contaminated"),
    )


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """docs without the hit words, each removed with the characters up to the next word. Clean rows stay as they are."""
    found = contamination(docs.select("doc_id", "text"), benchmark, size).where("contaminated")
    found = settle(found.select(F.col("doc_id").alias("doc"), "th", "spans").dropDuplicates(["doc", "th"]))
    found = bounded(found, 24 * F.size("spans") + 16)
    keyed = with_row(docs).withColumn("h", text_hash(F.col("text")))
    joined = keyed.join(found, keyed["doc_id"].eqNullSafe(found["doc"]) & (keyed["h"] == found["th"]), "left")
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))
    parts = (
        joined.withColumn("words", F.when(F.col("spans").isNotNull(), F.array_remove(F.split("text", ANY_SEPARATOR, -1), "")))
        .withColumn("gaps", F.when(F.col("spans").isNotNull(), F.split("text", ANY_WORD, -1)))
        .withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("words") - 1), hit))
    )
    rest = F.concat(F.get("gaps", F.lit(0)), F.array_join(F.transform("stay", lambda i: F.concat(F.get("words", i), F.get("gaps", i + 1))), ""))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(rest)
    return parts.select(F.col("row").withField("text", text).alias("row")).select("row.*")
