"""The dealt operators over the given tables, with the parameters they would have in production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanbill.llm import (
    boilerplate, bpe_tree, decontaminate, line_runs, near_copies, pii_bootstrap, pu_quality, quality_rules, ranked_search, secrets_ledger, sharding,
    turn_repair, wavelet,
)
from spanbill.llm.common import read

VOCABULARY = "word_bpe_49k.json"
#: Ends each document in the token files.
END_ID = 2
#: The contract of the registered query; the pipeline keeps the operator's own five words.
PAIRS = near_copies.Likeness(words=2, percent=80)


def op1_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), shards=40)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules.apply_rules(docs, quality_rules.fit_trees(docs, read(spark, sf_dir, "labels")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.drop_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_ledger.scan_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.encode_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = boilerplate.main_text(read(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(read(spark, sf_dir, "documents"), PAIRS).select("doc_id", "n_shingles", "component_id", "kept")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.find_personal(read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = wavelet.write_files(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), END_ID)
    return wavelet.read_files(wavelet.with_starts(files))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.report(read(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_feistel_shards, op2_quality_rules, op3_line_dedup, op4_secret_scan, op5_decontamination, op6_pu_quality, op7_bpe_tree,
        op8_main_text, op9_near_copies, op10_personal_data, op11_ranked_search, op12_wavelet_files, op13_turn_repair,
        pipeline,
    )
}
