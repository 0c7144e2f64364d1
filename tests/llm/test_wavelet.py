"""Wavelet shards: round trip, and rank, select and access against numpy."""

import zlib

import numpy as np
import pytest

from ordermart.llm import wavelet

from .test_packing import ids_of


@pytest.mark.parametrize("n,high", [(0, 1), (1, 1), (511, 5), (512, 300), (513, 50_000), (4000, 70_000)])
def test_matrix(n, high):
    a = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
    m = wavelet.WaveletMatrix.build(a)
    m, docs, missing, lengths = wavelet.WaveletMatrix.load(m.dump(np.array([5]), np.array([0]), np.array([n])))
    assert (docs.tolist(), missing.tolist(), lengths.tolist()) == ([5], [False], [n])
    assert np.array_equal(m.decode(), a)
    for i in range(0, n, max(1, n // 50)):
        assert m.access(i) == a[i]
    for c in {0, 1, high, *a[:5].tolist()}:
        assert m.count(c) == (a == c).sum() and m.rank(c, n // 2) == (a[:n // 2] == c).sum()
        assert np.array_equal(m.positions(c), np.flatnonzero(a == c))


def expected(docs):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, ids_of(r.text, 2)) for r in docs), key=lambda r: r[:2])
    return [(r[1] if r[0] else None, r[2]) for r in rows]


def test_files_of_documents(documents):
    found = sorted(wavelet.token_files(documents, shard_tokens=3000).collect(), key=lambda r: r.start)
    at = 0
    for r, (doc, ids) in zip(found, expected(documents.collect()), strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (doc, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_odd_rows(odd_documents, no_documents):
    found = sorted(wavelet.token_files(odd_documents).collect(), key=lambda r: r.start)
    want = expected(odd_documents.select("doc_id", "text").collect())
    assert [r.doc_id for r in found] == [doc for doc, _ in want]
    key = lambda doc, n, crc: (doc is None, doc or 0, n, crc)
    assert sorted(key(r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == sorted(
        key(doc, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for doc, x in want)
    ends = [r.start + r.n_tokens for r in found]
    assert [r.start for r in found] == [0, *ends[:-1]]
    assert wavelet.token_files(no_documents).count() == 0
