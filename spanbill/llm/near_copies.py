"""Near-duplicate documents: one-permutation hashing, densification, banded buckets, star-shaped candidates.

A document's set is its distinct shingles of `words` words. Rows with equal sets are one node. Each node is hashed
once: a shingle's hash gives its bin and its value, a bin keeps the least value, and an empty bin borrows from
the first filled bin in an order drawn for it (optimal densification). Bands of bins make bucket keys. In a bucket the
smallest node is the centre of a star: one candidate edge for each other member. Candidates are confirmed
on the full sets. Where a bucket's members then still lie in several components, pairs from different
components are sought among their differences from a common centre, of which a link must share a stated number; this
is exact, so no bucket is cut, and pairs inside a component are not compared again. Components
come from label propagation with jumps.

Two documents of similarity 0.8 share no bucket with a probability of about 5 in a million (40 bands of 6).
Documents without words (null, empty) have an empty set and are linked with nothing. Rows with the same id are rows
of their own; null ids are never a component's id unless it has no other. Very long texts give all their shingles. An empty table gives
an empty result. Extra columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanbill.llm.common import bounded, mix64, slices, small_batches, text_hash
from spanbill.operators.stage import settle, settle_few

BANDS, ROWS = 40, 6
#: Words whose hashes a task holds before it forgets them. Hashing a word again costs less than a large store's memory: 50,000 are no slower than 500,000.
CACHED = 50_000
#: Pairs that a task confirms at least, unless there are as few as cores; each brings two whole sets.
TASK_PAIRS = 250
#: Rows of a file of texts or sketches, and of a file of whole sets, unless there are as few files as cores.
TEXT_ROWS, SET_ROWS = 20_000, 2_000


@dataclass(frozen=True)
class Likeness:
    """Link where 100 * |both| >= percent * |either|, on shingles of so many words."""

    words: int = 5
    percent: int = 80


class ShingleHasher:
    """Texts to sorted arrays of distinct shingle hashes."""

    def __init__(self, k: int):
        self.k, self.known = k, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words, known = (text or b"").lower().split(), self.known
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > CACHED:
            known.clear()
        try:
            codes = [known[w] for w in words]
        except KeyError:
            known.update((w, xxhash.xxh3_64_intdigest(w)) for w in set(words) if w not in known)
            codes = [known[w] for w in words]
        h = np.array(codes, np.uint64)
        width = min(self.k, len(h))
        out = np.full(len(h) - width + 1, width, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(width):
                out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i])
        return np.unique(out)


class Bins:
    """One-permutation hashing of a sorted set into bands of bins."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        n = bands * rows
        self.shape, self.edges = (bands, rows), (np.arange(n + 1, dtype=np.float64) / n * 2.0**64)[:-1].astype(np.uint64)
        draw = mix64(np.arange(n * n, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)).reshape(n, n)
        self.rank = draw.argsort(1).argsort(1).astype(np.int16)  # of each bin in each other bin's order
        self.salt = mix64(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """A key for each band."""
        first = np.searchsorted(hashes, self.edges)
        value = hashes[np.minimum(first, len(hashes) - 1)]
        end = np.append(first[1:], len(hashes))
        full = first < end
        if not full.all():
            filled = np.flatnonzero(full)
            empty = np.flatnonzero(~full)
            value[empty] = value[filled[self.rank[empty][:, filled].argmin(1)]]
        with np.errstate(over="ignore"):
            key = (mix64(value.reshape(self.shape)) * self.salt).sum(1, dtype=np.uint64)
            return mix64(key + np.arange(1, self.shape[0] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def sketch(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, n_shingles, node (128 bits of the set; null if empty) and bands for every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bins = ShingleHasher(like.words), Bins()
        for batch in batches:
            for some in slices(batch, "_text"):
                sets = [hasher(x.as_py()) for x in some.column("_text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([bins(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "node", "bands"],
                )

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_shingles bigint, node binary, bands array<bigint>")


def shingle_sets(docs: DataFrame, like: Likeness, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted nodes, each once. `wanted` has one row (doc_id, node) for each, a row that holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(like.words)
        for batch in batches:
            for some in slices(batch, "_text", 64):
                sets = [hasher(x.as_py()) for x in some.column("_text")]
                nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"])

    wanted = wanted.select(F.col("doc_id").alias("_want"))
    wanted = bounded(wanted.distinct(), F.lit(16))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["_want"]), "left_semi").select("_text")
    return texts.mapInArrow(run, "node binary, shingles array<bigint>").where("node is not null")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for all ends of links (a, b): the smallest node that can be reached.

    Each round takes the least label among the neighbours, then the label's own label. Labels are written
    after each round; rounds grow with the logarithm of a component's width in the usual case. links is a stage.
    """
    many = 2 * links.count()
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = settle_few(both, many)
    labels = settle_few(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), many)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = step.join(jump, "comp", "left").select("node", F.least("comp", F.coalesce("far", "comp")).alias("comp"), "old")
        new = settle_few(new, many)
        if new.where("comp <> old").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, comp) after more links. Only the components that they join take part, each pair once, however many links it has."""
    if labels is None:
        return components(links)
    at = [labels.select(F.col("node").alias(k), F.col("comp").alias(f"{k}_comp")) for k in "ab"]
    ends = links.join(at[0], "a", "left").join(at[1], "b", "left")
    ends = ends.select("a", "b", F.coalesce("a_comp", "a").alias("ca"), F.coalesce("b_comp", "b").alias("cb"))
    ends = ends.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).where("a <> b")
    ends = settle_few(ends, links.count())
    if ends.isEmpty():
        return labels
    joined = components(ends)
    fresh = joined.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    every = labels.union(joined.select("node", F.col("node").alias("comp"))).groupBy("node").agg(F.min("comp").alias("comp"))
    return settle_few(every.join(fresh, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), labels.count() + 2 * ends.count())


class Buckets:
    """Members of the buckets that hold two nodes or more, and the search for links in them."""

    def __init__(self, docs: DataFrame, rows: DataFrame, like: Likeness):
        self.docs, self.like = docs, like
        named = rows.where("node is not null")
        keys = named.select(F.explode("bands").alias("key"), "node", F.col("n_shingles").alias("n"))
        short = F.xxhash64("node")
        texts = rows.count()
        ends = keys.groupBy("key").agg(F.min(short).alias("lo"), F.max(short).alias("hi"), F.count("*").alias("many")).where("lo <> hi")
        crowded = settle_few(ends.select("key", "many"), texts * BANDS // 2)
        most = crowded.agg(F.sum("many")).first()[0] or 0
        self.members = settle_few(keys.join(bounded(crowded.select("key"), F.lit(8)), "key").distinct(), most)
        self.n_members = self.members.count()
        nodes = self.members.select("node").distinct()
        held = named.select("node", "doc_id").join(nodes, "node", "left_semi")
        held = settle_few(held.groupBy("node").agg(F.min("doc_id").alias("doc_id")), min(texts, self.n_members))
        self.n_nodes = held.count()
        sets = shingle_sets(docs, like, held).join(nodes, "node", "left_semi").dropDuplicates(["node"])
        with small_batches(docs.sparkSession):
            self.sets = settle_few(sets, self.n_nodes, SET_ROWS)
        empty = self.members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        self.tried, self.links, self.labels = empty, empty, None

    def linked(self) -> DataFrame:
        """(node, comp) of all nodes with a link. Links come by the stars, by edges to the hub of a bucket's largest component, and by differences from the hub."""
        self._test(self._stars(), self.n_nodes)
        self._test(self._edges(self._outside(self.labels)), self.n_members)
        held = settle_few(self._outside(self.labels), self.n_members)
        self._test(self._edges(held).union(self._across(held)))
        return self.labels

    def _stars(self) -> DataFrame:
        """An edge (x, y) from each node to the centre, the smallest node, of the largest bucket that holds it."""
        stars = self.members.groupBy("key").agg(F.count("*").alias("many"), F.min(F.struct("node", "n")).alias("y"))
        own = self.members.join(stars, "key").groupBy("node", "n").agg(F.max(F.struct("many", "y")).alias("s"))
        return own.where("s.y.node <> node").select(F.struct("node", "n").alias("x"), "s.y")

    def _outside(self, labels: DataFrame) -> DataFrame:
        """(c, c_n, node, n, comp, main): members of the buckets that hold several components. c is the hub of the bucket's
        largest component, the node with most links so far: a text near to many is a short way from each."""
        known = settle_few(self.members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")), self.n_members)
        shares = known.groupBy("key", "comp").count().groupBy("key")
        main = shares.agg(F.max(F.struct("count", "comp")).alias("m"), F.count("*").alias("comps")).where("comps > 1")
        held = known.join(main.select("key", F.col("m.comp").alias("main")), "key").select("main", "node", "n", "comp").distinct()
        ends = self.links.select(F.col("a").alias("node")).union(self.links.select(F.col("b").alias("node")))
        degree = known.select("node", "n", "comp").distinct().join(ends.groupBy("node").agg(F.count("*").alias("many")), "node", "left")
        hubs = degree.groupBy(F.col("comp").alias("main")).agg(F.max(F.struct(F.coalesce("many", F.lit(0)).alias("many"), "node", "n")).alias("h"))
        return held.join(hubs, "main").select(F.col("h.node").alias("c"), F.col("h.n").alias("c_n"), "node", "n", "comp", "main")

    def _edges(self, held: DataFrame) -> DataFrame:
        """An edge (x, y) from each node outside the largest component of a bucket to that component's hub."""
        return held.where("comp <> main").select(F.struct("node", "n").alias("x"), F.struct(F.col("c").alias("node"), F.col("c_n").alias("n")).alias("y"))

    def _across(self, held: DataFrame) -> DataFrame:
        """Edges (x, y) that may link different components which share a bucket.

        Such a bucket is put down to its largest component, whose hub is a node, c. A pair needs one end x outside it, and x is either
        linked to c (an edge for each x) or not. Then, with D(x) what tells x from c, the rare first, a
        link of x and y takes t = (|D(x)| + |D(y)| - most) / 2 common members of D(x) and D(y), t >= 1, where `most`
        is the number of shingles in which documents of these sizes may differ; so their first common member stands
        among the first |D| - t + 1 of either. Copies with changes of their own share no such member.
        """
        p = self.like.percent
        sized = held.where("c <> node").join(self.sets, "node")
        centre = self.sets.select(F.col("node").alias("c"), F.col("shingles").alias("cs"))
        told = F.concat(F.array_except("shingles", "cs"), F.array_except("cs", "shingles"))
        apart = sized.join(centre, "c").select(F.xxhash64("c").alias("c"), "node", (F.col("comp") != F.col("main")).alias("out"), "comp", "n", told.alias("d"))
        told = settle(apart.select("c", "node", "out", "comp", "n", F.size("d").alias("dn"), F.explode("d").alias("e")))
        # members of one D alone come first and meet nothing; of the others, the rare ones come first
        common = told.groupBy("c", "e").agg(F.count("*").alias("many")).where("many > 1")
        own = Window.partitionBy("c", "node")
        rare = own.orderBy("many", "e")
        first = told.join(common, ["c", "e"]).withColumn("at", F.col("dn") - F.count("*").over(own) + F.row_number().over(rare) - 1)
        first = settle_few(first.where(F.col("at") <= F.col("n") * (100 - p) / p), told.count())
        x = first.where("out").select("c", "e", *[F.col(k).alias(f"x_{k}") for k in ("node", "comp", "n", "dn", "at")])
        y = first.select("c", "e", *[F.col(k).alias(f"y_{k}") for k in ("node", "comp", "n", "dn", "at")])
        most = F.floor((F.col("x_n") + F.col("y_n")) * (100 - p) / (100 + p))
        t = F.ceil((F.col("x_dn") + F.col("y_dn") - most) / 2)
        fits = (F.col("x_at") <= F.col("x_dn") - t) & (F.col("y_at") <= F.col("y_dn") - t)
        sizes = 100 * F.least("x_n", "y_n") >= p * F.greatest("x_n", "y_n")
        met = x.alias("x").join(y.alias("y"), (F.col("x.c") == F.col("y.c")) & (F.col("x.e") == F.col("y.e")) & (F.col("x_comp") != F.col("y_comp")) & fits & sizes)
        return met.select(*[F.struct(F.col(f"{k}_node").alias("node"), F.col(f"{k}_n").alias("n")).alias(k) for k in "xy"])

    def _test(self, edges: DataFrame, most: int | None = None) -> None:
        """Confirms untried edges, at most so many, on the full sets; sets too different in size can't be alike and aren't fetched."""
        p = self.like.percent
        ends = edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        ends = ends.select(F.col("x.node").alias("a"), F.col("x.n").alias("na"), F.col("y.node").alias("b"), F.col("y.n").alias("nb"))
        close = ends.where(100 * F.least("na", "nb") >= p * F.greatest("na", "nb"))
        close = close.join(self.tried, ["a", "b"], "left_anti")
        close = settle(close) if most is None else settle_few(close, most)
        pairs = close.join(self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        pairs = pairs.join(self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        shared = F.size(F.array_intersect("sa", "sb"))
        found = pairs.select("a", "b", "na", "nb", shared.alias("both"))
        found = found.where(100 * F.col("both") >= p * (F.col("na") + F.col("nb") - F.col("both")))
        linked = settle_few(found.select("a", "b"), close.count(), TASK_PAIRS)
        self.tried = self.tried.union(close.select("a", "b"))
        self.links = self.links.union(linked)
        self.labels = merged(self.labels, linked)


def near_copies(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, node, component_id and kept for every row."""
    docs = docs.select("doc_id", "text")
    with small_batches(docs.sparkSession):
        rows = settle_few(sketch(docs, like), docs.count(), TEXT_ROWS)
    labels = Buckets(docs, rows, like).linked()
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = nodes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = settle_few(named.select("node", "comp", "least"), rows.count())
    comps = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = named.join(comps, "comp").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), "node")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:  # noqa: B008
    """The rows of docs that stay: of each component one row, that with the smallest id, and of rows which share that
    id the one with the least text hash. Rows without words stay, each one. Repeated equal rows of a component
    count as copies, so one stays."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # texts are written once
    keyed = docs.select(row, text_hash(F.col("text")).alias("h"), F.monotonically_increasing_id().alias("r"))
    keyed = settle_few(keyed, docs.count(), TEXT_ROWS)
    doc_id = F.col("row.doc_id")
    found = near_copies(keyed.select(F.struct(doc_id.isNull().alias("z"), doc_id.alias("doc_id"), "h", "r").alias("doc_id"), F.col("row.text").alias("text")), like)
    stay = found.where("kept").select(F.col("doc_id.r").alias("k"))
    return keyed.join(stay, F.col("r") == F.col("k"), "left_semi").select("row.*")
