"""Wavelet matrix files against the plain sequence, and the query's numbers against the library."""

import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from spanbill.llm import bpe_tree, wavelet
from spanbill.llm.queries import END_ID, VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)


@pytest.mark.parametrize("n,most", [(0, 1), (1, 1), (5, 3), (1_000, 70), (70_000, 49_408), (100_000, 200_000)])
def test_file(n, most):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, most, n)
    ends = np.unique(np.append(rng.integers(0, n + 1, 5), n)) if n else np.array([], np.int64)
    file = wavelet.WaveletFile(wavelet.build(ids, ends))
    assert (file.ids() == ids).all() and (file.ends == ends).all() and file.documents == len(ends)
    for p in rng.integers(0, n, 40).tolist() if n else []:
        assert file.access(p) == ids[p]
    for v in [*ids[:20].tolist(), 2 * most + 5]:
        where = np.flatnonzero(ids == v)
        assert file.count(v) == len(where) and file.count(v, n // 3, n // 2) == (ids[n // 3 : n // 2] == v).sum()
        assert [file.find(v, k) for k in range(min(len(where), 5))] == where[:5].tolist() and file.find(v, len(where)) is None
    if n == 1_000:
        assert file.occurrences(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()
        assert file.document(1).tolist() == ids[ends[0] : ends[1]].tolist()
    with pytest.raises(IndexError):
        file.access(n)


def test_planes_are_parted_by_places():
    """Building and reading a whole file take less time than parting and merging its planes by masks alone would."""
    ids = np.random.default_rng(1).integers(0, 1 << 16, 1 << 19).astype(np.uint16)
    ends = np.array([len(ids)])

    def by_masks():
        now, planes = ids, []
        for bit in range(15, -1, -1):
            ones = (now & (1 << bit)).astype(bool)
            planes.append(ones)
            now = np.concatenate([now[~ones], now[ones]])
        for ones in planes[::-1]:
            before, zeros = np.empty_like(now), len(ids) - int(ones.sum())
            before[~ones], before[ones] = now[:zeros], now[zeros:]
            now = before
        return now

    def seconds(f):
        times = []
        for _ in range(4):
            begin = time.process_time()
            assert (f() == ids).all()
            times.append(time.process_time() - begin)
        return min(times)

    assert seconds(lambda: wavelet.WaveletFile(wavelet.build(ids, ends)).ids()) < 0.85 * seconds(by_masks)


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        wavelet.WaveletFile(b"x" * 100)


@pytest.mark.parametrize("shard_ids", [wavelet.SHARD_IDS, 100, 1])
def test_documents(docs, rows, shard_ids):
    tok = bpe_tree.tokenizer(PATH)
    files = wavelet.write_files(docs, PATH, END_ID, shard_ids)
    out = wavelet.read_files(wavelet.with_starts(files)).collect()
    ids = [(i, [*tok.encode(t or "", add_special_tokens=False).ids, END_ID]) for i, t in rows]
    sums = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == sums
    at, by_place = 0, sorted(out, key=lambda r: r.start)
    for r in by_place:
        assert r.start == at
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in by_place]
    assert order == sorted(order)
    if shard_ids == 100:
        assert files.count() > files.select("part").distinct().count()


def test_many_rows_of_one_id(spark):
    docs = spark.createDataFrame([(7, "same text")] * 4_000 + [(8, f"text {i}") for i in range(100)], "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = wavelet.write_files(docs, PATH, END_ID)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files.select("part").distinct().count() > 1
    starts = sorted(r.start for r in wavelet.read_files(wavelet.with_starts(files)).where("doc_id = 7").collect())
    assert starts == list(range(0, 3 * 4_000, 3))


def test_no_documents(none):
    out = wavelet.read_files(wavelet.with_starts(wavelet.write_files(none, PATH, END_ID)))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == 0
