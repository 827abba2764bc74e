"""BPE encoding and decoding, long texts by tree concatenation.

Short texts are encoded word by word, and each worker process keeps the words it has met: no token of this vocabulary spans ASCII white
space, so the ids of a text are the ids of its words. A text beyond `long_chars` is halved until its leaves are short; the
leaves are rows of their own, dealt over all tasks and encoded in parallel. Neighbours are then joined pair by
pair, level by level: a window around the join is encoded again and widened until its tokens agree
with the left half's on one side and with the right half's on the other. Where agreement never comes, the window
ends up as the whole pair, which is exact as well.

Null counts as empty; an empty text has no tokens. Rows with the same id are encoded each for themselves. Strings
of special tokens in a text become those tokens, as the library has it. The library's ids and decoded
text are matched exactly. An empty table gives an empty result. Extra columns are not touched.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanbill.llm.common import slices

LONG_CHARS, LEAF_CHARS = 32_768, 16_384
#: Words that a worker's store holds before it is emptied, and the longest word that is kept.
CACHED, CACHED_BYTES = 150_000, 64
FIRST_WINDOW, AGREE = 64, 4

#: Tokens as three arrays of equal length: ids, first character, end character.
Tokens = tuple[np.ndarray, np.ndarray, np.ndarray]


@lru_cache(2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


#: How the vocabulary's tokenizer cuts text; fixed values of its file. Other tokenizers encode whole texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
#: Latin-1: letters that have one lower-case letter of one byte, and bytes whose normal form is their lower case.
_UPPER = bytes([*range(0x41, 0x5B), *(x for x in range(0xC0, 0xDF) if x != 0xD7)])
_LOWER = bytes.maketrans(_UPPER, bytes(x + 32 for x in _UPPER))
_EASY = bytes([*range(0x1C), *range(0x20, 0x80), *(x for x in range(0xC0, 0x100) if x not in (0xD7, 0xF7))])
_LETTER = rb"a-z\xdf-\xf6\xf8-\xff"
#: A run of marks, no apostrophe among them, between a letter or digit and a blank: a piece of its own.
_MARKS = re.compile(rb"[!-&(-/:-@\[-`{-~](?<=[0-9" + _LETTER + rb"].)[!-&(-/:-@\[-`{-~]*(?=[\t-\r ])")
_PIECE = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[" + _LETTER + rb"]+|[0-9]|[^\t-\r 0-9" + _LETTER + rb"]+")
_BLANKS = re.compile(r"[\t-\r ]+")


class WordEncoder(dict):
    """Texts to ids, each as the bytes of little-endian 32-bit integers.

    Where the tokenizer cuts at blanks and puts a mark on each word's end, texts are encoded word by word: the easy words (whose
    normal form is their lower case) lower-cased and cut into pieces, others whole by the library. The encoder is the store of
    words met so far, easy ones as bytes; a word that it lacks is looked for among those it held before it was last emptied, and
    else encoded.
    """

    def __init__(self, path: str, keep: int = CACHED):
        super().__init__()
        self.tok, self.old, self.keep = tokenizer(path), {}, keep
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        steps = [*(said["normalizer"] or {}).get("normalizers", []), *(said["pre_tokenizer"] or {}).get("pretokenizers", [])]
        cut = [x for x in steps if x["type"] == "Split"]
        self.by_word = [x["type"] for x in steps] == STEPS and cut[0]["pattern"] == {"Regex": SPLIT} and bool(said["model"]["end_of_word_suffix"])
        self.byte_names, self.tokenize = str.maketrans(_byte_names()), self.tok.model.tokenize

    def __missing__(self, word: bytes | str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._encode(word)
        if len(word) <= CACHED_BYTES:
            self[word] = ids
            if len(self) > self.keep:
                self.old = dict(self)
                self.clear()
        return ids

    def _encode(self, word: bytes | str) -> bytes:
        if type(word) is str:
            return array("I", self.tok.encode(word, add_special_tokens=False).ids).tobytes()
        if word.isalpha():  # ASCII letters, one piece
            return array("I", [t.id for t in self.tokenize(word.decode())]).tobytes()
        names = (p.decode("latin-1").encode().decode("latin-1").translate(self.byte_names) for p in _PIECE.findall(word))
        return array("I", [t.id for name in names for t in self.tokenize(name)]).tobytes()

    def _words(self, text: str) -> list:
        """Easy words as bytes, others as text."""
        data = _latin(text)
        if data is not None:
            return _MARKS.sub(rb" \g<0>", data.translate(_LOWER)).split()
        out = []
        for word in _BLANKS.split(text):
            data = _latin(word)
            if data is None:
                out.append(word)
            elif word:
                out += _MARKS.sub(rb" \g<0>", data.translate(_LOWER) + b" ").split()
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return [b"".join(map(self.__getitem__, self._words(t))) for t in texts]


def _latin(text: str) -> bytes | None:
    """The text in Latin-1 if all of it is easy."""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if data.translate(None, _EASY) or b"<|" in data else data


def _byte_names() -> dict[str, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): chr(b) for b in prints} | {chr(b): chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(2)
def word_encoder(path: str, keep: int = CACHED) -> WordEncoder:
    """One encoder, and so one store of words, for each worker process."""
    return WordEncoder(path, keep)


@lru_cache(2)
def names_of_ids(path: str) -> tuple[list[str], list[str], bool]:
    """Each id as decimal text and as token; whether decoding is just these tokens with blanks between."""
    tok = tokenizer(path)
    count = max(tok.get_vocab().values()) + 1
    return [str(i) for i in range(count)], [tok.id_to_token(i) or "" for i in range(count)], tok.decoder is None


def render(path: str, ids: list[int]) -> tuple[int, str, str]:
    """Number of ids, ids joined by blanks, decoded text."""
    numbers, tokens, plain = names_of_ids(path)
    decoded = " ".join([tokens[i] for i in ids]) if plain else tokenizer(path).decode(ids, skip_special_tokens=False)
    return len(ids), " ".join([numbers[i] for i in ids]), decoded


def spans(tok, text: str, start: int = 0) -> Tokens:
    e = tok.encode(text, add_special_tokens=False)
    at = np.array(e.offsets, np.int64).reshape(-1, 2) + start
    return np.array(e.ids, np.int64), at[:, 0], at[:, 1]


def _part(t: Tokens, where: slice) -> Tokens:
    return t[0][where], t[1][where], t[2][where]


def _agreement(a: Tokens, b: Tokens) -> tuple[int, int] | None:
    """First place at which AGREE tokens in a row are the same in both, ids and places."""
    places = {s: i for i, s in enumerate(b[1].tolist())}
    for i, s in enumerate(a[1][: max(len(a[1]) - AGREE + 1, 0)].tolist()):
        j = places.get(s)
        if j is not None and j + AGREE <= len(b[0]) and all((a[k][i : i + AGREE] == b[k][j : j + AGREE]).all() for k in range(3)):
            return i, j
    return None


def join_halves(left: Tokens, right: Tokens, low: int, middle: int, high: int, encode: Callable[[int, int], Tokens]) -> Tokens:
    """Tokens of text[low:high] from those of text[low:middle] and text[middle:high]; encode(a, b) gives those of text[a:b]."""
    width = FIRST_WINDOW
    while True:
        i = int(np.searchsorted(left[1], middle - width))
        whole_left, whole_right = middle - width <= low or i in (0, len(left[1])), middle + width >= high
        begin, end = low if whole_left else int(left[1][i]), high if whole_right else middle + width
        window = encode(begin, end)
        if whole_left and whole_right:
            return window
        nearby = int(np.searchsorted(right[1], end))
        from_left = (0, 0) if whole_left else _agreement(window, _part(left, slice(i, None)))
        from_right = (len(window[0]), len(right[0])) if whole_right else _agreement(window, _part(right, slice(0, nearby)))
        if from_left is not None and from_right is not None:
            head = _part(left, slice(0, 0 if whole_left else i + from_left[1]))
            core, tail = _part(window, slice(from_left[0], from_right[0])), _part(right, slice(from_right[1], None))
            return tuple(np.concatenate([head[k], core[k], tail[k]]) for k in range(3))
        width *= 2


def join_leaves(leaves: list[tuple[int, int, Tokens]], encode: Callable[[int, int], Tokens]) -> Tokens:
    """Joins (start, end, tokens) of neighbouring leaves pair by pair until one is left."""
    while len(leaves) > 1:
        pairs = [leaves[i : i + 2] for i in range(0, len(leaves), 2)]
        leaves = [
            (p[0][0], p[1][1], join_halves(p[0][2], p[1][2], p[0][0], p[0][1], p[1][1], encode)) if len(p) == 2 else p[0] for p in pairs
        ]
    return leaves[0][2]


def _digest(n: int, ids: str, decoded: str) -> tuple[int, str, str]:
    return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


RESULT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, long_chars: int = LONG_CHARS, leaf_chars: int = LEAF_CHARS, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row; with_ids adds the ids as an array."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>" if with_ids else ""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))

    def columns(found: list[bytes]) -> list[pa.Array]:
        ids = [np.frombuffer(x, "<u4") for x in found]
        digests = [_digest(*render(path, x.tolist())) for x in ids]
        out = [pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests]), pa.array([d[2] for d in digests])]
        if with_ids:
            out.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
        return out

    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            for some in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), *columns(encoder(some.column("text").to_pylist()))], names=["doc_id", *names])

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, ints = tokenizer(path), pa.list_(pa.int32())
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                found = [spans(tok, p.as_py(), s.as_py()) for p, s in zip(some.column("piece"), some.column("start"), strict=True)]
                tokens = [pa.array([f[k] for f in found], ints) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*some.columns, *tokens], names=[*some.schema.names, "ids", "starts", "ends"])

    def tree(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tok, group = tokenizer(path), group.sort_values("start")
        whole = "".join(group["piece"])
        leaves = [(r.start, r.start + len(r.piece), (np.asarray(r.ids), np.asarray(r.starts), np.asarray(r.ends))) for r in group.itertuples()]
        ids = join_leaves(leaves, lambda a, b: spans(tok, whole[a:b], a))[0].tolist()
        found = render(path, ids)
        doc_id = group["doc_id"].iloc[0]
        out = [None if pd.isna(doc_id) else doc_id, *_digest(*found), *([ids] if with_ids else [])]
        return pd.DataFrame([out], columns=["doc_id", *names])

    schema = f"doc_id {id_type}, {RESULT}{more}"
    is_long = F.length("text") > long_chars
    brief = rows.where(~is_long).mapInArrow(short, schema)
    starts = F.explode(F.sequence(F.lit(0), F.length("text") - 1, F.lit(leaf_chars)))
    pieces = rows.where(is_long).withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", starts.alias("start"), "text")
    pieces = pieces.select("doc_id", "row", F.col("start").cast("long").alias("start"), F.substring("text", F.col("start") + 1, F.lit(leaf_chars)).alias("piece"))
    leaf_type = f"doc_id {id_type}, row bigint, start bigint, piece string, ids array<int>, starts array<int>, ends array<int>"
    leaves = pieces.repartition("row", "start").mapInArrow(leaf, leaf_type)
    return brief.unionByName(leaves.groupBy("row").applyInPandas(tree, schema))
