"""Documents to training tokens in five stages, each written and read again before the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents. Rows with a null text count as empty; the classifier scores them like any text. Documents with
the same id are rows of their own throughout.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanbill.llm import bpe_tree, decontaminate, line_runs, near_copies, pu_quality
from spanbill.llm.common import read
from spanbill.operators.stage import ensure_checkpoint_dir

VOCABULARY = "word_bpe_49k.json"


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, n_chars brought up to date."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def _whole(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the row itself, so that no column of it can clash with an operator's."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = pu_quality.fit(docs, read(spark, sf_dir, "labels"))
    return pu_quality.score(_whole(docs), model, ["_row"]).where("predicted = 1").select("_row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines found in many documents stay in one of them; documents stay, even if no line does."""
    kept = line_runs.drop_lines(_whole(docs))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _sized(kept.select("_row.*", text.alias("_text")).withColumn("text", F.col("_text")), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest id, and of rows that share it the first text."""
    return near_copies.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark passages are removed; the rest of the document stays."""
    return _sized(decontaminate.remove_spans(docs, read(spark, sf_dir, "benchmark")), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the token ids, digest of the decoded text, and the ids."""
    return bpe_tree.encode_documents(docs, public_tokenizers.path(VOCABULARY), with_ids=True)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminated", decontaminated), ("tokens", tokens)]

#: No SQL: the classifier is trained and the tokenizer is a library. tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
