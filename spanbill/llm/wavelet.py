"""Token ids as files: each shard is a wavelet matrix, one compressed run of bytes.

A wavelet matrix keeps a sequence of numbers as bit planes, from the highest bit to the lowest; between two planes the sequence
is parted, zeros before ones, order kept. Ranks on the planes give the number at a place, the count of a number up to
a place, and the place of a number's k-th occurrence, each in one step a plane, without unpacking the rest.

A file holds a header, for each plane the number of its zeros and a directory with the place and the count of ones before every chunk,
the chunks of 32,768 bits, each packed by zstd, and the ends of the documents. Reading a place unpacks one chunk a plane.

Documents are range partitioned on their id, cut into ids task by task, and written in ascending order: a shard is closed when it
holds `shard_ids` ids, a document is never cut. Ids of rows before it follow from one sum a partition. Null ids come first. A null or
empty text has the end id alone, and so has a text that the tokenizer drops. Very long texts are encoded one at a time and make a long
shard. Rows with the same document id keep their own entries, in the order of a hash of their texts; equal rows are alike.
An empty table has no files. Extra columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanbill.llm.bpe_tree import word_encoder
from spanbill.llm.common import slices
from spanbill.operators.stage import settle

MAGIC, VERSION = b"WVMX", 1
#: Bits of a chunk, and ids after which a shard is closed.
CHUNK, SHARD_IDS = 32_768, 1 << 20
#: Words that a worker process keeps while it writes files.
KEPT_WORDS = 300_000
_HEADER = struct.Struct("<4sIQQIQ")  # magic, version, ids, documents, planes, bytes of the ends


def build(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """The file of a sequence of ids and of the place after each document's last id."""
    n, planes = len(ids), max(1, int(ids.max()).bit_length()) if len(ids) else 1
    now = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    heads, bodies, pack = [], [], zstandard.ZstdCompressor(level=1)
    for bit in range(planes - 1, -1, -1):
        ones = (now & (1 << bit)) != 0
        packed = np.packbits(ones, bitorder="little")
        body = [pack.compress(packed[at : at + CHUNK // 8].tobytes()) for at in range(0, len(packed), CHUNK // 8)]
        places = np.cumsum([0, *map(len, body)])
        counts = [int(np.bitwise_count(packed[at : at + CHUNK // 8]).sum()) for at in range(0, len(packed), CHUNK // 8)]
        before = np.cumsum([0, *counts])
        heads.append(struct.pack("<Q", n - int(before[-1])) + places.astype("<u8").tobytes() + before.astype("<u8").tobytes())
        bodies.append(b"".join(body))
        if bit:
            zeros = n - int(before[-1])
            after = np.empty_like(now)  # by places: twice as quick as by masks
            now.take(np.flatnonzero(~ones), out=after[:zeros], mode="clip")
            now.take(np.flatnonzero(ones), out=after[zeros:], mode="clip")
            now = after
    last = pack.compress(np.diff(ends, prepend=0).astype("<u8").tobytes())
    return b"".join([_HEADER.pack(MAGIC, VERSION, n, len(ends), planes, len(last)), *heads, *bodies, last])


class WaveletFile:
    """Access to one file's bytes."""

    def __init__(self, data: bytes):
        magic, version, self.n, self.documents, self.planes, last = _HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a wavelet matrix file of this version")
        self.data, self.chunks, self.unpack = data, -(-self.n // CHUNK), zstandard.ZstdDecompressor().decompress
        at, step, self.zeros, self.places, self.ones = _HEADER.size, 8 * (self.chunks + 1), [], [], []
        for _ in range(self.planes):
            self.zeros.append(struct.unpack_from("<Q", data, at)[0])
            self.places.append(np.frombuffer(data, "<u8", self.chunks + 1, at + 8).astype(np.int64))
            self.ones.append(np.frombuffer(data, "<u8", self.chunks + 1, at + 8 + step).astype(np.int64))
            at += 8 + 2 * step
        for places in self.places:
            places += at
            at = int(places[-1])
        self.ends = np.cumsum(np.frombuffer(self.unpack(data[at : at + last]), "<u8").astype(np.int64))
        self.kept = {}

    def _bits(self, plane: int, chunk: int) -> np.ndarray:
        if (plane, chunk) not in self.kept:
            if len(self.kept) >= 4 * self.planes:
                self.kept.clear()
            raw = self.unpack(self.data[self.places[plane][chunk] : self.places[plane][chunk + 1]])
            size = min(CHUNK, self.n - chunk * CHUNK)
            self.kept[plane, chunk] = np.unpackbits(np.frombuffer(raw, np.uint8), count=size, bitorder="little")
        return self.kept[plane, chunk]

    def _ones_before(self, plane: int, place: int) -> int:
        chunk, rest = divmod(place, CHUNK)
        return int(self.ones[plane][chunk]) + (int(self._bits(plane, chunk)[:rest].sum()) if rest else 0)

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        starts = self.ones[plane] if bit else np.minimum(np.arange(self.chunks + 1) * CHUNK, self.n) - self.ones[plane]
        chunk = int(np.searchsorted(starts, k, "right")) - 1
        return chunk * CHUNK + int(np.flatnonzero(self._bits(plane, chunk) == bit)[k - int(starts[chunk])])

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        out = 0
        for plane in range(self.planes):
            bit, ones = int(self._bits(plane, place // CHUNK)[place % CHUNK]), self._ones_before(plane, place)
            out, place = out << 1 | bit, self.zeros[plane] + ones if bit else place - ones
        return out

    def _range(self, number: int, low: int, high: int) -> tuple[int, int]:
        if number >> self.planes:
            return 0, 0
        for plane in range(self.planes):
            a, b = self._ones_before(plane, low), self._ones_before(plane, high)
            low, high = (self.zeros[plane] + a, self.zeros[plane] + b) if number >> self.planes - 1 - plane & 1 else (low - a, high - b)
        return low, high

    def count(self, number: int, low: int = 0, high: int | None = None) -> int:
        """How often an id stands in places low to high, end exclusive."""
        a, b = self._range(number, max(low, 0), self.n if high is None else min(high, self.n))
        return max(b - a, 0)

    def find(self, number: int, k: int) -> int | None:
        """Place of an id's k-th occurrence, from 0; None if there are fewer."""
        low, high = self._range(number, 0, self.n)
        if not 0 <= k < high - low:
            return None
        place = low + k
        for plane in range(self.planes - 1, -1, -1):
            bit = number >> self.planes - 1 - plane & 1
            place = self._find(plane, bit, place - self.zeros[plane] if bit else place)
        return place

    def occurrences(self, number: int) -> list[int]:
        return [self.find(number, k) for k in range(self.count(number))]

    def ids(self) -> np.ndarray:
        """The whole sequence, plane by plane from the lowest."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for plane in range(self.planes - 1, -1, -1):
            raw = b"".join(self.unpack(self.data[a:b]) for a, b in zip(self.places[plane], self.places[plane][1:], strict=False))
            ones = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").view(bool)
            now, zeros = np.empty_like(out), self.zeros[plane]
            now[np.flatnonzero(~ones)], now[np.flatnonzero(ones)] = out[:zeros], out[zeros:] | kind(1 << self.planes - 1 - plane)
            out = now
        return out.astype(np.uint32)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, by access alone."""
        return np.array([self.access(p) for p in range(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))], np.uint32)


def write_files(docs: DataFrame, path: str, end_id: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """One row for each file, written as a stage: part and number order the files, offset counts the ids of its part before it.

    doc_ids are the documents of the file in order; content is the file. Any store that Spark writes to will do.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("place"))
    order = ["doc_id", "tie", "place"]  # the last lets a run of equal rows be split
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number, offset = word_encoder(path, KEPT_WORDS), TaskContext.get().partitionId(), 0, 0
        doc_ids, found, held, stop = [], [], 0, np.array([end_id], "<u4").tobytes()

        def shard() -> pa.RecordBatch:
            ids, ends = np.frombuffer(b"".join(found), "<u4"), np.cumsum([len(x) // 4 for x in found])
            columns = [[part], [number], [offset], [len(ids)]]
            keys = pa.ListArray.from_arrays(pa.array([0, sum(map(len, doc_ids))], pa.int32()), pa.concat_arrays(doc_ids))
            made = [*(pa.array(c, pa.int64()) for c in columns), keys, pa.array([build(ids, ends)], pa.binary())]
            return pa.RecordBatch.from_arrays(made, names=["part", "number", "offset", "n_ids", "doc_ids", "content"])

        for batch in batches:
            for some in slices(batch, "text"):
                begin = 0
                for i, made in enumerate(encode(some.column("text").to_pylist())):
                    found.append(made + stop)
                    held += len(found[-1]) // 4
                    if held >= shard_ids:
                        doc_ids.append(some.column("doc_id").slice(begin, i + 1 - begin))
                        yield shard()
                        begin, number, offset, doc_ids, found, held = i + 1, number + 1, offset + held, [], [], 0
                doc_ids.append(some.column("doc_id").slice(begin))
        if found:
            yield shard()

    kind = f"part bigint, number bigint, offset bigint, n_ids bigint, doc_ids array<{id_type}>, content binary"
    return settle(rows.mapInArrow(pack, kind))


def with_starts(files: DataFrame) -> DataFrame:
    """The files with start, the ids of all files before: one sum for each part, then the place within it."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    begins = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("begin"))
    return files.join(F.broadcast(begins), "part").withColumn("start", F.col("begin") + F.col("offset")).drop("begin")


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files' content."""
    id_type = files.schema["doc_ids"].dataType.elementType.simpleString()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                file, first = WaveletFile(row.column("content")[0].as_buffer().to_pybytes()), row.column("start")[0].as_py()
                ids, ends = file.ids().astype("<u4").tobytes(), file.ends
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                columns = [row.column("doc_ids").flatten(), pa.array(begins + first), pa.array(ends - begins), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("start", "doc_ids", "content").mapInArrow(unpack, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
