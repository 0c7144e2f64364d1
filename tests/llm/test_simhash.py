"""SimHash: fingerprints, bit-sliced comparison and components by brute force."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ordermart.llm import simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=2):
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            label[y] = x
    return [find(x) for x in range(len(fps))]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6, 7])
def test_close_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2 ** 63, 40).astype(np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (5, 100)).astype(np.uint64), axis=0)
    fps = np.unique(np.concatenate([base, base[rng.integers(0, 40, 100)] ^ flips]))
    got = set(zip(*(x.tolist() for x in simhash.close_pairs(fps, radius))))
    assert got == {(a, b) for a, b in combinations(range(len(fps)), 2) if (int(fps[a]) ^ int(fps[b])).bit_count() <= radius}


def test_documents(documents):
    docs = sorted(documents.collect(), key=lambda r: r.doc_id)
    fps = [brute_fingerprint(r.text) for r in docs]
    want = {r.doc_id: (f"{f:016x}", docs[c].doc_id) for r, f, c in zip(docs, fps, brute_components(fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents).collect()}
    assert got == want
    kept = simhash.one_of_each(documents)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})


@pytest.mark.parametrize("block", [8, 2048])
def test_links_of_a_dense_group_and_chains(spark, block):
    """Many fingerprints that share bands: chains of links, in split groups."""
    rng = np.random.default_rng(1)
    fps = {0, 2 ** 64 - 1}
    for start in rng.integers(0, 2 ** 63, 4).tolist():
        x = start
        for _ in range(60):
            x ^= (1 << int(rng.integers(0, 64))) | (1 << int(rng.integers(0, 64)))
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "_fp long")
    roots = {r.a: r.b for r in simhash.components(simhash.links(df, block=block)).collect()}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    label = brute_components(fps)
    groups = {}
    for k, s in enumerate(signed):
        groups.setdefault(label[k], set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_odd_rows(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {(r.fingerprint, r.component_id) for r in rows if r.doc_id in (0, 1, 2)} == {("0" * 16, 0)}
    assert {r.component_id for r in rows if r.doc_id in (7, 8)} == {7}
    kept = simhash.one_of_each(odd_documents)
    assert kept.dtypes == odd_documents.dtypes
    assert kept.count() == len({r.component_id for r in rows})
    assert simhash.near_duplicates(no_documents).count() == 0 and simhash.one_of_each(no_documents).count() == 0
    assert simhash.near_duplicates(odd_documents.filter(F.col("doc_id").isNull())).filter("component_id is null").count() == 2
