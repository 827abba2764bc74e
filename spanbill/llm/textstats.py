"""Statistics of one text, for the two quality models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the rule contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3

RULE_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "chars_per_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "mark_share", "pipe_share", "distinct_share", "adjacent_share", "lines_per_word", "other_share", "longest_word",
]

_IS = {name: np.zeros(256, bool) for name in ("space", "symbol", "upper", "digit", "mark", "follow")}
for _name, _chars in (("space", b" \t\n\v\f\r"), ("symbol", SYMBOLS), ("upper", bytes(range(65, 91))), ("digit", b"0123456789"), ("mark", b"!?"), ("follow", bytes(range(128, 192)))):
    _IS[_name][list(_chars)] = True


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    _, pair = np.unique(ids[:-2] * len(known) + ids[1:-1], return_inverse=True)
    _, where, count = np.unique(pair.astype(np.int64) * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[where] > 1
    hit = np.zeros(n, bool)
    for shift in range(WINDOW):
        hit[shift : n - WINDOW + 1 + shift] |= twice
    return int(hit.sum())


def text_stats(text: bytes | None) -> tuple[list[int], list[float]]:
    """The rule statistics and the model's features of a whole text; null counts as empty."""
    text = text or b""
    words = text.split()
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    count = {name: int(histogram[where].sum()) for name, where in _IS.items()}
    chars = len(text) - count["follow"]
    word_chars, n = chars - count["space"], len(words)
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    dup_lines, repeats = len(lines) - len(set(lines)), repeated_words(words)
    distinct = len(set(words))
    adjacent = sum(a == b for a, b in zip(words, words[1:], strict=False))
    w, c = max(n, 1), max(word_chars, 1)
    features = [
        np.log1p(n), word_chars / w, count["symbol"] / c, dup_lines / max(len(lines), 1), repeats / w, count["upper"] / c,
        count["digit"] / c, count["mark"] / c, int(histogram[124]) / c, distinct / w, adjacent / w, len(lines) / w,
        (c - count["upper"] - count["digit"] - int(histogram[97:123].sum())) / c, np.log1p(max(map(len, words), default=0)),
    ]
    return [n, word_chars, count["symbol"], dup_lines, repeats], features


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns to keep, the rule statistics, and the features as an array; texts go no further than their task."""
    fields = docs.select(*keep).schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"{x} bigint" for x in RULE_STATS), "features array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_stats(x.as_py()) for x in batch.column("_text")]
            columns = [batch.column(k) for k in keep]
            columns += [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(len(RULE_STATS))]
            columns.append(pa.array([r[1] for r in rows], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *RULE_STATS, "features"])

    return docs.select(*keep, F.col("text").cast("binary").alias("_text")).mapInArrow(run, schema)


def voted_labels(labels: DataFrame, target: str, allowed: Column | None = None) -> DataFrame:
    """doc_id and y of every labelled document.

    Repeated labels of a document count by their majority, ties as 0; null ids and null labels
    are left out.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    rows = rows if allowed is None else rows.where(allowed)
    return rows.groupBy("doc_id").agg((F.avg(F.col(target).cast("double")) > 0.5).cast("int").alias("y"))


def label_sample(labels: DataFrame, target: str, most: int, allowed: Column | None = None) -> DataFrame:
    """At most `most` labelled documents (doc_id, y), chosen by a hash of the id; labels as in `voted_labels`."""
    return voted_labels(labels, target, allowed).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
