"""The pipeline's stages against plain versions, each on what its predecessor kept."""

from __future__ import annotations

from collections import Counter

import brute
import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from spanbill.llm import bpe_tree, decontaminate, line_runs, near_copies, pu_quality, sharding


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id: r for r in docs.collect()}
        after = kept[name]
        if name != "tokens":
            assert docs.columns == columns and all(r.n_chars == len(r.text) for r in after.values())
        if name == "quality":
            model = pu_quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
            whole = pu_quality.score(spark.read.parquet(f"{sf_dir}/documents.parquet"), model, ["doc_id"]).collect()
            assert set(after) == {r.doc_id for r in whole if r.predicted}
        if name == "lines":
            want = brute.line_dedup(list(before.items()))
            assert Counter((i, brute.sha(r.text)) for i, r in after.items()) == Counter((k[0], k[3]) for k in want.elements())
        if name == "near_duplicates":
            assert set(after) == {r[0] for r in brute.near(sorted(before.items()), 5) if r[3]}
        if name == "decontaminated":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            windows = brute.windows_of(items)
            for i, t in before.items():
                n, hit, *_ = brute.contaminated(t, windows)
                assert len(brute.plain_words(after[i].text)) == n - hit and (hit or after[i].text == t)
        if name == "tokens":
            tok = bpe_tree.tokenizer(public_tokenizers.path(corpus_pipeline.VOCABULARY))
            assert all(list(after[i].ids) == tok.encode(t, add_special_tokens=False).ids for i, t in before.items())


def test_clashing_columns(spark, docs, sf_dir):
    frame = docs.selectExpr("*", "1 AS n_chars", "2 AS predicted", "3 AS score", "4 AS kept_text", "5 AS n_lines", "6 AS _spans0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, sf_dir).columns == frame.columns
        stage(spark, frame, sf_dir).write.format("noop").mode("overwrite").save()


NAMES = ["_h", "_r", "_k", "_doc", "_th", "_spans", "_words", "_gaps", "_stay", "_lines", "_dropped", "_part", "_place", "_row", "_read", "_rows", "_start", "_to",
         "row", "h", "r", "k", "doc", "th", "spans", "words", "gaps", "stay", "lines", "dropped", "part", "place", "read", "start", "to", "o0", "node", "comp"]


def test_columns_with_internal_names_keep_their_values(spark, docs, benchmark):
    frame = docs.select("doc_id", "text", *[F.lit(f"own {n}").alias(n) for n in NAMES])
    made = {
        "keep_one": near_copies.keep_one(frame),
        "remove_spans": decontaminate.remove_spans(frame, benchmark),
        "drop_lines": line_runs.drop_lines(frame),
        "shard_rows": sharding.shard_rows(frame, 3, [F.col("doc_id"), F.xxhash64("text")], 1),
    }
    for name, out in made.items():
        values = out.select(*NAMES).distinct().collect()
        assert [list(v) for v in values] == [[f"own {n}" for n in NAMES]], name


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
