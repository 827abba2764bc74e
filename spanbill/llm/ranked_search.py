"""Ranked lexical search of many queries at once, with the sums that queries share evaluated once.

A document's score for an item is a sum over the item's terms, so items that share terms share partial sums. The terms of a block
of items are mined for shared sets: terms that stand in exactly the same items form one set, found by grouping terms on their
lists of items. Items are then written as chains of sets, the most shared sets first, and equal beginnings of chains become one
node. The sets and nodes are the query-sharing DAG: for each document the accumulator of a set is added up once, each node adds one
set to its parent, and an item's score is read at the node where its chain ends.

Documents are cut into terms once for each pass over the queries, and only the counts of query terms are written. A
pass holds items up to a stated number of bytes of terms, which bounds what is sent to the tasks, and is evaluated block by block, which
bounds the accumulators. Each task keeps the best of each item; the rest is a ranking of those few rows. All scores are exact.

A null or empty text has no terms: such an item finds nothing, such a document is found by none and counts in no
statistic. Very long texts are read whole, one row at a time. Equal scores rank by ascending id, null ids last, and documents that
share an id rank as rows of their own. Every row of the items is a query of its own, also if ids repeat. Without documents, items or
terms the result is empty. Extra columns of either table are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from spanbill.llm.common import slices
from spanbill.operators.stage import settle

#: Bytes of terms in a pass (sent to every task), terms in a block of items, and numbers held at once in a block's accumulators.
PASS_BYTES, BLOCK_TERMS, CELLS = 16 << 20, 50_000, 4_000_000
#: Share of a text's length, in percent, that lowers the weight of its occurrences.
LENGTH_SHARE = 75

_KEEP = [b for b in range(256) if b >= 0x80 or chr(b).isalnum()]
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _KEEP else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return [] if text is None else text.encode().translate(_FOLD).split()


class SharedSums:
    """The DAG of a block of items, each a count for each term number."""

    def __init__(self, items: list[dict[int, int]]):
        holders = defaultdict(list)  # an atom is a term times a power of two, so that a count of three shares with a count of one
        for i, counts in enumerate(items):
            for term, n in counts.items():
                for bit in range(n.bit_length()):
                    if n >> bit & 1:
                        holders[term, bit].append(i)
        sets = defaultdict(list)
        for atom, where in holders.items():
            sets[tuple(where)].append(atom)
        by_use = sorted(sets, key=lambda where: (-len(where), where))
        chains = [[] for _ in items]
        for k, where in enumerate(by_use):
            for i in where:
                chains[i].append(k)
        nodes, ends = {}, []
        for chain in chains:
            at = (0, 0)  # depth and number
            for k in chain:
                at = nodes.setdefault((at, k), (at[0] + 1, len(nodes) + 1))
            ends.append(at[1])
        deep = sorted((*at, parent[1], k) for (parent, k), at in nodes.items())
        place = {0: 0} | {number: i + 1 for i, (_, number, _, _) in enumerate(deep)}
        self.parent = np.array([place[p] for _, _, p, _ in deep], np.int64)
        self.adds = np.array([k for *_, k in deep], np.int64)
        levels = Counter(d for d, *_ in deep)
        self.levels = np.cumsum([0, *(levels[d] for d in sorted(levels))])
        self.end = np.array([place[e] for e in ends], np.int64)
        self.sets = len(by_use)
        atoms = sorted((term, bit, k) for k, where in enumerate(by_use) for term, bit in sets[where])
        self.term, self.bit, self.set = (np.array([a[j] for a in atoms], np.int64) for j in range(3))

    @property
    def additions(self) -> int:
        """Sums for one document that holds every term."""
        return len(self.term) + len(self.adds)

    def scores(self, term: np.ndarray, doc: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
        """Items by documents, from the value of each term in each document."""
        first, last = np.searchsorted(self.term, term), np.searchsorted(self.term, term, "right")
        many = last - first
        which = np.repeat(np.arange(len(term)), many)
        atom = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[which]
        sums = np.zeros(self.sets * docs, np.int64)
        np.add.at(sums, self.set[atom] * docs + doc[which], value[which] << self.bit[atom])
        sums, at = sums.reshape(self.sets, docs), np.zeros((len(self.adds) + 1, docs), np.int64)
        for low, high in zip(self.levels, self.levels[1:], strict=False):
            at[low + 1 : high + 1] = at[self.parent[low:high]] + sums[self.adds[low:high]]
        return at[self.end]


@dataclass
class Pass:
    """Items evaluated in one reading of the documents: their ids, the number of each term, and (first item, DAG) of each block."""

    ids: list
    vocabulary: dict[bytes, int]
    blocks: list[tuple[int, SharedSums]]


def passes(items: DataFrame, pass_bytes: int, block_terms: int) -> Iterator[Pass]:
    """Reads the items a partition at a time; what is held is one pass."""
    ids, vocabulary, blocks, block, first, held = [], {}, [], [], 0, 0

    def closed() -> Pass:
        return Pass(ids, vocabulary, [*blocks, (first, SharedSums(block))] if block else blocks)

    for row in items.select("item_id", "text").toLocalIterator():
        counts = Counter(terms_of(row["text"]))
        size = sum(len(t) + 64 for t in counts)
        if ids and held + size > pass_bytes:
            yield closed()
            ids, vocabulary, blocks, block, first, held = [], {}, [], [], 0, 0
        if block and sum(map(len, block)) + len(counts) > block_terms:
            blocks.append((first, SharedSums(block)))
            block, first = [], len(ids)
        ids.append(row["item_id"])
        block.append({vocabulary.setdefault(t, len(vocabulary)): n for t, n in counts.items()})
        held += size
    if ids:
        yield closed()


def term_counts(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n (all terms), and the numbers and counts of the query terms, for every document that has a term."""
    ints = pa.list_(pa.int32())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for batch in batches:
            for some in slices(batch, "text"):
                lengths, numbers, counts = [], [], []
                for text in some.column("text").to_pylist():
                    words = terms_of(text)
                    known, times = np.unique(np.array([x for x in map(get, words) if x is not None], np.int32), return_counts=True)
                    lengths.append(len(words))
                    numbers.append(known)
                    counts.append(times.astype(np.int32))
                columns = [some.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(numbers, ints), pa.array(counts, ints)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(count, f"doc_id {id_type}, n bigint, terms array<int>, times array<int>")
    return counted.where("n > 0")


def _best_of_task(queries, weights, total: int, length: int, top: int, id_type: pa.DataType, item_type: pa.DataType):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, blocks, weight = *queries.value, np.array(weights.value, np.int64)
        found, least = [[] for _ in ids], np.ones(len(ids), np.int64)

        def take(doc_ids: list, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> None:
            slow = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * total // length for n in lengths.tolist()], np.int64)
            value = weight[term] * ((1_000_000_000 * times) // (1_000 * times + 8 * slow[doc]))
            for first, dag in blocks:
                step = max(1, CELLS // (dag.sets + len(dag.adds) + len(dag.end) + 1))
                for low in range(0, len(doc_ids), step):
                    a, b = np.searchsorted(doc, [low, low + step])
                    score = dag.scores(term[a:b], doc[a:b] - low, value[a:b], min(step, len(doc_ids) - low))
                    good = np.nonzero(score >= least[first : first + len(score), None])
                    for i, d, s in zip(*(x.tolist() for x in good), score[good].tolist(), strict=True):
                        key, row = doc_ids[low + d], found[first + i]
                        row.append((-s, key is None, key))
                        if len(row) >= 4 * top:
                            found[first + i] = row = heapq.nsmallest(top, row)
                            least[first + i] = -row[-1][0]

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                terms, times = (some.column(c) for c in ("terms", "times"))
                doc = np.repeat(np.arange(some.num_rows), np.diff(terms.offsets.to_numpy()))
                numbers = (some.column("doc_id").to_pylist(), some.column("n").to_numpy(), doc)
                take(*numbers, *(x.flatten().to_numpy().astype(np.int64) for x in (terms, times)))
        rows = [(i, ids[i], key, -s) for i, row in enumerate(found) for s, _, key in heapq.nsmallest(top, row)]
        for at in range(0, len(rows), 65_536):
            columns = list(zip(*rows[at : at + 65_536], strict=True))
            kinds = [pa.int32(), item_type, id_type, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item", "item_id", "doc_id", "score"])

    return best


def rank(docs: DataFrame, items: DataFrame, top: int = 10, pass_bytes: int = PASS_BYTES, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of each item with a score above 0."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    doc_type, item_type = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = f"item int, item_id {item_type.simpleString()}, doc_id {doc_type.simpleString()}, score bigint"
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = spark.createDataFrame([], schema).select("item_id", F.lit(0).alias("rank"), "doc_id", "score")
    for one in passes(items, pass_bytes, block_terms):
        counted = settle(term_counts(docs, send(one.vocabulary)))
        total, length = counted.agg(F.count("*"), F.sum("n")).first()
        holders = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # a row for each query term
        weights = [math.floor(1000 * math.log((2 * total + 2) / (2 * holders.get(t, 0) + 1))) for t in range(len(one.vocabulary))]
        best = _best_of_task(send((one.ids, one.blocks)), send(weights), total, length, top, to_arrow_type(doc_type), to_arrow_type(item_type))
        ranked = counted.mapInArrow(best, schema).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
        out = out.unionByName(ranked.select("item_id", "rank", "doc_id", "score"))
    return out
