"""Line deduplication with levelled sorted runs of line hashes.

Documents arrive in batches. A batch is reduced to one row per line key (two 64-bit hashes): in how many
of its documents the key stands and the largest id among them. The batch is merge-joined with the
runs written so far: keys without a match (the anti join) are new; the others continue the count
of the newest run that holds them. All rows of the batch then form a run of their own. A run is a table bucketed
and sorted by the key, so neither the lookup nor a merge shuffles it again. When a level holds `fanout` runs,
they are merged into one run of the next level, of which the newest row of a key stays.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. Keys of at least
`min_chars` code points found in at least `min_docs` documents lose all their lines except those
in the largest doc_id. Each row counts as one document; all rows that carry the largest id keep their lines. A null id
is smaller than any other; a key that only null ids hold keeps its lines. A null or empty text is one
empty line. Very long texts and lines count whole. Repeated rows get equal results. An empty table gives an empty result. Extra columns
are not touched.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanbill.llm.common import ascii_lower, bounded, text_hash, with_row
from spanbill.operators.stage import ensure_checkpoint_dir, settle

MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 40, 5, 4, 3
KEY = ["h1", "h2"]
_BLANKS = " \t\n\x0b\x0c\r"


class LineRuns:
    """Runs by level, each (h1, h2, n_docs, last_doc, is_new), newest last."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = [[]]
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = ensure_checkpoint_dir(spark)

    def add(self, batch: DataFrame) -> str:
        """Adds a batch of (h1, h2, doc), one row per key and document; returns the name of its run."""
        found = batch.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc"))
        for i, run in enumerate(reversed(self.runs)):
            old = self.spark.table(run).select(*KEY, F.col("n_docs").alias(f"n{i}"), F.col("last_doc").alias(f"d{i}"))
            found = found.join(old.hint("merge"), KEY, "left")
        known = range(len(self.runs))
        before = F.coalesce(*[F.col(f"n{i}") for i in known], F.lit(0)) if known else F.lit(0)
        last = functools.reduce(lambda a, i: F.greatest(a, F.col(f"d{i}")), known, F.col("last_doc"))
        name = self._write(
            found.select(*KEY, (F.col("n_docs") + before).cast("long").alias("n_docs"), last.alias("last_doc"), (before == 0).alias("is_new"))
        )
        self.levels[0].append(name)
        self._compact()
        return name

    @property
    def runs(self) -> list[str]:
        """Oldest first: higher levels hold older rows."""
        return [r for level in reversed(self.levels) for r in level]

    def at_least(self, n: int) -> DataFrame:
        """Keys found in n documents or more, with their count and largest id."""
        parts = [self.spark.table(r).where(F.col("n_docs") >= n).select(*KEY, "n_docs", "last_doc") for r in self.runs]
        whole = functools.reduce(DataFrame.unionByName, parts)
        return whole.groupBy(*KEY).agg(F.max("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def drop(self) -> None:
        for r in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {r}")

    def _compact(self) -> None:
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                olds = self.levels[level]
                merged = self.spark.table(olds[0])
                for r in olds[1:]:
                    a, b = merged.alias("a"), self.spark.table(r).alias("b")
                    merged = a.hint("merge").join(b.hint("merge"), KEY, "full").select(
                        *KEY,
                        F.coalesce("b.n_docs", "a.n_docs").alias("n_docs"),
                        F.coalesce("b.last_doc", "a.last_doc").alias("last_doc"),
                        F.coalesce("a.is_new", "b.is_new").alias("is_new"),
                    )
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(merged))
                self.levels[level] = []
                for r in olds:
                    self.spark.sql(f"DROP TABLE {r}")

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).format("parquet")
        writer.option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name


def line_keys(text: Column) -> Column:
    """Keys of all lines, in order."""
    return F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS)))


def line_rows(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """One row per long line: batch, doc, text hash, position, the key's hashes, and whether it is the first of its key."""
    hashed = F.transform(
        line_keys(F.col("text")),
        lambda k, i: F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("line"), k).alias("h2"), i.alias("pos"), (F.length(k) >= min_chars).alias("long")),
    )
    ordered = F.sort_array(F.filter(hashed, lambda x: x["long"]))
    rows = docs.select(F.col("doc_id").alias("doc"), text_hash(F.col("text")).alias("th"), ordered.alias("keys"))
    rows = rows.select("doc", "th", "keys", F.posexplode("keys").alias("i", "key"))
    earlier = F.get("keys", F.col("i") - 1)
    first = (F.col("i") == 0) | (earlier["h1"] != F.col("key.h1")) | (earlier["h2"] != F.col("key.h2"))
    batch = F.pmod(F.xxhash64("doc", "th"), F.lit(batches)).cast("int")
    return rows.select("doc", "th", "key.h1", "key.h2", "key.pos", first.alias("first"), batch.alias("batch"))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc, th, dropped): the positions of lines to drop, for rows that lose any."""
    lines = settle(line_rows(docs, min_chars, batches))
    runs = LineRuns(docs.sparkSession, fanout)
    for b in range(batches):
        runs.add(lines.where((F.col("batch") == b) & F.col("first")).select(*KEY, "doc"))
    common = settle(runs.at_least(min_docs))
    runs.drop()
    earlier = (F.col("doc") < F.col("last_doc")) | (F.col("doc").isNull() & F.col("last_doc").isNotNull())
    gone = lines.select("doc", "th", "pos", *KEY).join(bounded(common, F.lit(32)), KEY).where(earlier)
    return settle(gone.groupBy("doc", "th").agg(F.collect_set("pos").alias("dropped")))


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """docs with kept_text, n_lines and n_dropped."""
    gone = dropped_lines(docs.select("doc_id", "text"), **options)
    gone = bounded(gone, 4 * F.size("dropped") + 16)
    keyed = with_row(docs, ["kept_text", "n_lines", "n_dropped"]).withColumn("h", text_hash(F.col("text")))
    joined = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["doc"]) & (keyed["h"] == gone["th"]), "left")
    joined = joined.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    told = F.struct(
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept_text"),
    )
    return joined.select("row", told.alias("told")).select("row.*", "told.*")


__all__ = ["LineRuns", "line_keys", "line_rows", "dropped_lines", "drop_lines"]
