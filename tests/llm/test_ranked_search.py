"""Scores of many queries against a plain evaluation, and what the queries share."""

import random
from collections import Counter

import brute
import numpy as np

from spanbill.llm import ranked_search


def got(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def test_ranks(docs, rows, benchmark):
    items = [tuple(r) for r in benchmark.collect()] + [("q6", "the the the the one two words words"), ("q6", "the the the")]
    queries = docs.sparkSession.createDataFrame([(i, t, 1, 2.0) for i, t in items], "item_id string, text string, doc_id int, score double")
    want = brute.ranked(rows, items)
    assert got(ranked_search.rank(docs, queries)) == want
    assert got(ranked_search.rank(docs, queries, pass_bytes=200, block_terms=3)) == want
    assert got(ranked_search.rank(docs, queries, top=2)) == brute.ranked(rows, items, 2)


def test_many_equal_documents(spark):
    rows = [(i, "same words here") for i in range(300)] + [(None, "same words here")] * 3 + [(1000 + i, f"other {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    items = [(1, "same words"), (2, "Same WORDS, same"), (3, "other 7"), (4, "other"), (None, "here")]
    assert got(ranked_search.rank(docs, spark.createDataFrame(items, "item_id int, text string"))) == brute.ranked(rows, items)


def test_empty_tables(spark, none, docs):
    no_items, item = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "one")], "item_id long, text string")
    for found in (ranked_search.rank(docs, no_items), ranked_search.rank(none, item), ranked_search.rank(none, no_items)):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "..")], "doc_id long, text string")
    assert ranked_search.rank(blank, item).count() == 0


def test_shared_sums():
    rng = random.Random(4)
    common, items = list(range(20)), []
    for i in range(60):
        private = [100 + 5 * i + k for k in range(5)]
        items.append({t: rng.choice([1, 1, 1, 2, 3, 12]) for t in [*rng.sample(common, 12), *common[:4], *private]})
    dag = ranked_search.SharedSums([*items, {}, items[0]])
    terms, docs = sorted({t for i in items for t in i}), 7
    value = np.array([[rng.randrange(1000) for _ in range(docs)] for _ in terms])
    where = [(t, d, value[k, d]) for k, t in enumerate(terms) for d in range(docs) if rng.random() < 0.8]
    score = dag.scores(*(np.array(x, np.int64) for x in zip(*where, strict=True)), docs)
    held = {(t, d): int(v) for t, d, v in where}
    for i, item in enumerate([*items, {}, items[0]]):
        assert score[i].tolist() == [sum(n * held.get((t, d), 0) for t, n in item.items()) for d in range(docs)]


def test_sums_are_shared():
    whole = [{t: 1 for t in range(30)} for _ in range(50)]
    assert ranked_search.SharedSums(whole).additions == 31
    halves = [{**{t: 1 for t in range(30)}, 100 + i: 1} for i in range(50)]
    assert ranked_search.SharedSums(halves).additions == 30 + 50 + 1 + 50
