"""Personal data by bootstrapped contextual extraction.

Seeds are what four base patterns find: e-mail and IP addresses, card and phone numbers. The word before an
identifier is a lexical pattern, whatever the identifier looks like. Spark scores the graph of patterns and instances in
rounds: a pattern's confidence is the weight of its accepted instances over all places where an identifier or
candidate stands behind its word, an instance's score the noisy-or of what supports it. A pattern also needs enough distinct
accepted instances, and has to have one behind its word clearly more often than words in general have a seed, so that
frequent words that stand before seeds by chance extract nothing. Confident patterns extract all that stands behind their
word; shapes (runs of digits and letters) that they extract, and that stand mostly behind such words, support further instances
in the next round, and those further patterns.

Spans are in code points, end exclusive. Null and empty texts have none. Rows with the same id are searched each
for themselves; repeated rows count as further places. An empty table gives an empty result. A failing match
is dropped and its text not searched again for that kind. Extra columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanbill.llm.common import ascii_lower, bounded, kind_count, span_text, tagged_pieces
from spanbill.operators.stage import settle

#: Fixed values of the contract: the base patterns. Possessive parts and looks behind keep them linear on long runs; they match
#: what the plain forms match, since a failure at the start of a run means failure within it.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What may be an identifier: a run of identifier characters with at least four digits.
CANDIDATE = r"(?<![A-Za-z0-9._@+-])(?=(?:[A-Za-z._@+-]*+[0-9]){4})[A-Za-z0-9._@+-]*[A-Za-z0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
KINDS = [*BASE, "context"]
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

ROUNDS, MIN_INSTANCES, MIN_CONFIDENCE = 3, 3, 0.6
#: A pattern's word has accepted instances behind it so many times as often as words in general have seeds, or at such a share
#: of its places.
MIN_LIFT, OFTEN = 3.0, 0.3


def luhn(digits: Column) -> Column:
    """The card check sum, from the last digit leftwards."""

    def add(total, k):
        d = F.substr(digits, F.length(digits) - k + 1, F.lit(1)).cast("int")
        twice = F.when(k % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return total + twice

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_holds(kind: Column, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    card = F.length(digits).between(12, 19) & luhn(F.when(F.length(digits).between(12, 19), digits).otherwise(F.lit("1")))
    return (
        F.when(kind == 0, True)
        .when(kind == 1, hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == 2, card)
        .when(kind == 3, F.length(digits).between(9, 15))
        .otherwise(F.lit(None).cast("boolean"))
    )


def shape(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, "[A-Za-z]+", "a"), "[0-9]+", "9")


def context_words(text: Column) -> Column:
    """All words of a text in the form that contexts have."""
    return F.transform(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+", -1), lambda w: F.rtrim(w, F.lit(":=#")))


def last_word(gap: Column) -> Column:
    """The last word of what stands before a match, whole, over blanks and breaks of line; empty where there is none."""
    word = F.regexp_extract(gap, r"(?s)^.*(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+\z", 1)
    return F.rtrim(ascii_lower(word), F.lit(":=#"))


def found_pieces(docs: DataFrame) -> DataFrame:
    """A row for each match of a base pattern or candidate, one with kind null for each document without any; with positions."""
    text = F.col("text")
    pieces = tagged_pieces(text, {**BASE, "candidate": CANDIDATE}, context=last_word)
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    rows = settle(rows.select("row", "doc_id", F.explode_outer(F.when(text.isNotNull(), pieces)).alias("p")).select("row", "doc_id", "p.*"))
    by = Window.partitionBy("row", "kind").orderBy("n")
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(by))
    return placed.withColumn("start", F.col("end") - F.length("hit"))


def score_patterns(edges: DataFrame, cover: DataFrame, rate: float, rounds: int = ROUNDS) -> DataFrame:
    """ctx of the confident patterns.

    From edges (ctx, shape, value, n, seed), the places of each ctx (found: with an instance behind; places: in the corpus), and the
    number of seeds to a word of the corpus.
    """
    edges = settle(edges.join(bounded(cover, F.octet_length("ctx")), "ctx"))
    seeds = edges.where("seed").select("value", F.lit(1.0).alias("score")).distinct()
    fresh, scores = edges.where(~F.col("seed")), seeds
    for step in range(1, rounds + 1):
        weight = F.sum(F.col("n") * F.col("score"))
        patterns = edges.join(scores, "value").groupBy("ctx").agg(
            (weight / F.max("found")).alias("conf"), (weight / F.max("places")).alias("often"), F.count("*").alias("instances")
        )
        good = (F.col("conf") >= MIN_CONFIDENCE) & (F.col("instances") >= MIN_INSTANCES) & (F.col("often") >= min(MIN_LIFT * rate, OFTEN))
        strong = settle(patterns.where(good).select("ctx", F.least("conf", F.lit(1.0)).alias("conf")))
        if step == rounds:
            break
        near = bounded(strong, F.octet_length("ctx"))
        behind = F.col("conf").isNotNull()
        shapes = fresh.join(near, "ctx", "left").groupBy("shape").agg(
            (F.sum(F.when(behind, F.col("n")).otherwise(0)) / F.sum("n")).alias("conf"), F.countDistinct(F.when(behind, F.col("value"))).alias("instances")
        )
        shapes = settle(shapes.where((F.col("conf") >= MIN_CONFIDENCE) & (F.col("instances") >= MIN_INSTANCES)).select("shape", "conf"))
        alike = fresh.select("shape", "value").distinct().join(bounded(shapes, F.octet_length("shape")), "shape")
        support = edges.join(near, "ctx").select("value", "conf").union(alike.select("value", "conf"))
        noisy = support.groupBy("value").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("conf"), F.lit(1e-9)))))).alias("score"))
        scores = settle(seeds.union(noisy).groupBy("value").agg(F.max("score").alias("score")))
    return strong.select("ctx")


def find_personal(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans, for every row."""
    docs = docs.select("doc_id", "text")
    rows = found_pieces(docs)
    candidate = len(BASE)
    rows = rows.withColumn("holds", base_holds(F.col("kind"), F.col("hit")))
    # a match that fails becomes a row without a kind, so that its document stays
    rows = rows.withColumn("kind", F.when(F.col("holds") | (F.col("kind") == candidate), F.col("kind")))
    base_end, base_start = F.when(F.col("kind") < candidate, F.col("end")), F.when(F.col("kind") < candidate, F.col("start"))
    order = Window.partitionBy("row").orderBy("start", "kind", "end")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("reach", F.max(base_end).over(before)).withColumn("next", F.min(base_start).over(after))
    # a match that starts where the candidate starts sorts before it
    clash = (F.col("kind") == candidate) & (F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("end"), F.lit(False)))
    rows = rows.withColumn("kind", F.when(~clash, F.col("kind")))
    rows = settle(rows.select("row", "doc_id", "kind", "start", "end", F.col("hit").alias("value"), "ctx", shape(F.col("hit")).alias("shape")))
    seen = rows.where(F.col("kind").isNotNull() & (F.col("ctx") != ""))
    edges = settle(seen.groupBy("ctx", "shape", "value").agg(F.count("*").alias("n"), F.max(F.col("kind") < candidate).alias("seed")))
    # a pattern needs so many instances, so words with fewer can't give one
    words = edges.groupBy("ctx").agg(F.count("*").alias("v"), F.sum("n").alias("found")).where(F.col("v") >= MIN_INSTANCES)
    words = settle(words.select("ctx", "found"))
    places = docs.where("text is not null").select(F.explode(context_words(F.col("text"))).alias("ctx")).where("ctx <> ''")
    marked = places.join(bounded(words, F.octet_length("ctx")), "ctx", "left")
    # the words that can give no pattern are one row, of null
    cover = settle(marked.groupBy(F.when(F.col("found").isNotNull(), F.col("ctx")).alias("ctx"), "found").agg(F.count("*").alias("places")))
    total = cover.agg(F.sum("places").alias("n")).first()["n"] or 1
    rate = (edges.where("seed").agg(F.sum("n").alias("n")).first()["n"] or 0) / total
    strong = score_patterns(edges, cover.where("ctx is not null"), rate, rounds).withColumn("strong", F.lit(True))
    spans = rows.join(bounded(strong, F.octet_length("ctx")), "ctx", "left")
    kept = F.when(F.col("kind").isNotNull() & ((F.col("kind") < candidate) | F.col("strong")), F.struct("start", "kind", "end"))
    told = spans.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.collect_list(kept).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < candidate)
    count = [kind_count(F.col("all"), i).alias(f"n_{k}") for i, k in enumerate(BASE)]
    return told.select("doc_id", *count, F.sha2(span_text(base, KINDS), 256).alias("base_sha256"), span_text(F.col("all"), KINDS).alias("spans"))

