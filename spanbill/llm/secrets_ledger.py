"""Secret scans with an incremental ledger of blobs.

A text is a blob, addressed by its SHA-256; the rows of a table are the paths that hold it, and a path may come
again with another text (a later version). A rule has a name and a version. The ledger records which pairs
of blob and rule version have been scanned and what was found. A scan addresses all rows, scans only the pairs
that the ledger lacks, each blob once however many paths hold it, adds the results, and joins the
findings of the current rule versions back to all paths.

A null text is an empty blob. Rows with the same id are paths of their own. Spans are in code points,
end exclusive. Very long texts are scanned whole. An empty table leaves the ledger as it is and returns no rows. Extra columns are not
read.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanbill.llm.common import kind_count, span_text, tagged_pieces
from spanbill.operators.stage import ensure_checkpoint_dir, settle


@dataclass(frozen=True)
class Rule:
    """`fits` decides on a match's text; a match that fails is dropped, and its text is not searched again."""

    name: str
    version: int
    pattern: str
    fits: Callable[[Column], Column] | None = None


#: Fixed values of the rule contract: the three base rules. Runs of hexadecimal or access-key characters need no check of
#: their length, since the shortest length in the pattern gives the same matches.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}$"""
BASE_RULES = [
    Rule("assign", 1, ASSIGN, lambda hit: hit.rlike(_VALUE)),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}"),
]
#: What the ledger's rules add to the base: keys that name their issuer, and private key headers.
MORE_RULES = [Rule("issued", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----|(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})")]
RULES = BASE_RULES + MORE_RULES


def blob_address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class SecretLedger:
    """Folder `scanned` holds (blob, rule, version), folder `findings` holds spans of those pairs."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"

    def _table(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    @property
    def scanned(self) -> DataFrame:
        return self._table("scanned", "blob binary, rule string, version int")

    @property
    def findings(self) -> DataFrame:
        return self._table("findings", "blob binary, rule string, version int, start bigint, end bigint")

    def add(self, docs: DataFrame, rules: list[Rule] = RULES) -> None:
        """Scans the pairs of blob and rule version that the ledger lacks.

        Copies of a blob are dropped before and after the one shuffle of texts. Findings are written before the pairs are marked as
        scanned, so that a run that dies half-way is repeated; findings are read without repeats.
        """
        blobs = docs.select(blob_address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
        versions = [f"{r.name}@{r.version}" for r in rules]
        done = self.scanned.select("blob", F.concat_ws("@", "rule", F.col("version").cast("string")).alias("pair")).where(F.col("pair").isin(versions))
        done = done.groupBy("blob").agg(F.collect_set("pair").alias("_done"))
        todo = blobs.join(done, "blob", "left").withColumn("_done", F.coalesce("_done", F.array().cast("array<string>")))
        todo = todo.where(F.size("_done") < len(rules))
        unseen = [~F.array_contains("_done", F.lit(v)) for v in versions]
        new = tagged_pieces(F.col("text"), {r.name: r.pattern for r in rules}, wanted=unseen)
        marked = todo.select("blob", "_done", F.explode_outer(new).alias("p"))
        found = settle(marked.select("blob", "_done", "p.*"))
        by = Window.partitionBy("blob", "kind").orderBy("n")
        ends = F.sum(F.col("gap") + F.length("hit")).over(by)
        hits = found.where("kind is not null").withColumn("end", ends)
        hits = hits.withColumn("start", F.col("end") - F.length("hit"))
        name, version = F.array(*[F.lit(r.name) for r in rules]), F.array(*[F.lit(r.version) for r in rules])
        fits = functools.reduce(lambda a, i: F.when(F.col("kind") == i, rules[i].fits(F.col("hit")) if rules[i].fits else F.lit(True)).otherwise(a), range(len(rules)), F.lit(False))
        hits = hits.where(fits).select("blob", F.get(name, F.col("kind")).alias("rule"), F.get(version, F.col("kind")).alias("version"), "start", "end")
        hits.write.mode("append").parquet(f"{self.path}/findings")
        pairs = found.groupBy("blob").agg(F.first("_done").alias("_done"))
        missing = F.explode(F.filter(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.lit(v).alias("pair")) for r, v in zip(rules, versions, strict=True)]), lambda x: ~F.array_contains("_done", x["pair"])))
        pairs.select("blob", missing.alias("m")).select("blob", "m.rule", "m.version").write.mode("append").parquet(f"{self.path}/scanned")

    def by_path(self, docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
        """doc_id, blob and spans (start, kind by the order of the rules, end) for every row; null where nothing was found."""
        order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"{r.name}@{r.version}"), F.lit(i))])
        current = self.findings.withColumn("kind", order[F.concat_ws("@", "rule", F.col("version").cast("string"))]).where("kind is not null")
        each = current.groupBy("blob").agg(F.collect_set(F.struct("start", "kind", "end")).alias("spans"))
        paths = docs.select("doc_id", blob_address(F.col("text")).alias("blob"))
        return paths.join(each, "blob", "left")


def scan_documents(docs: DataFrame, rules: list[Rule] = RULES, ledger: SecretLedger | None = None) -> DataFrame:
    """Adds the rows to the ledger and returns, per row, counts and digests of its spans."""
    ledger = ledger or SecretLedger(docs.sparkSession)
    ledger.add(docs, rules)
    kinds, none = [r.name for r in rules], F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    rows = ledger.by_path(docs, rules).withColumn("all", F.coalesce("spans", none))
    base = F.filter("all", lambda s: s["kind"] < len(BASE_RULES))
    count = [kind_count(F.col("all"), i).alias(f"n_{kinds[i]}") for i in range(len(BASE_RULES))]
    return rows.select("doc_id", *count, F.sha2(span_text(base, kinds), 256).alias("base_sha256"), span_text(F.col("all"), kinds).alias("spans"))
