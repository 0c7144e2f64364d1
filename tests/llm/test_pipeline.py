"""The pipeline: each stage on its predecessor's rows, against brute force."""

from collections import Counter

import pytest

import corpus_pipeline as P
from ordermart.llm import mixing
from ordermart.llm.common import table, written

from .test_line_dedup import brute as brute_lines
from .test_packing import ids_of
from .test_quality import brute as brute_measures
from .test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def stages(spark, small_dir):
    docs = table(spark, small_dir, "documents")
    out = [docs]
    for _, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], small_dir), "test-stage"))
    return out


def test_order_and_columns(stages):
    assert [name for name, _ in P.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "mixing", "packing"]
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_quality_rules(spark, small_dir, stages):
    labels = {r.doc_id: r.quality for r in table(spark, small_dir, "labels").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    for r in stages[0].collect():
        m = brute_measures(r.text)
        if m[0] < 20 or 100 * m[4] > 30 * m[0]:
            assert r.doc_id not in kept
        elif labels.get(r.doc_id) == 1:
            assert r.doc_id in kept
    assert stages[1].subtract(stages[0]).count() == 0


def test_line_dedup(stages):
    before = sorted(stages[1].collect(), key=lambda r: r.doc_id)
    want = [t for _, t in brute_lines([(r.source, r.text) for r in before], 0.02, 3.0)]
    after = sorted(stages[2].collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.text, r.n_chars) for r in after] == [(r.doc_id, t, len(t)) for r, t in zip(before, want)]


def test_near_duplicates(stages):
    docs = sorted(stages[2].collect(), key=lambda r: r.doc_id)
    label = brute_components([brute_fingerprint(r.text) for r in docs])
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({docs[k].doc_id for k in label})


def test_mixing(stages):
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    before, after = stages[3].collect(), stages[4].collect()
    assert abs(words(after) - 1.5 * words(before)) <= len({r.source for r in before})
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text in texts[r.doc_id] and r.n_chars == len(r.text) for r in after)


def test_packing(stages):
    want = Counter()
    for r in stages[4].collect():
        want[r.doc_id] += len(ids_of(r.text))
    got = Counter()
    for r in stages[5].collect():
        got[r.doc_id] += r.length
    assert got == want


def test_packed_windows_come_from_mixed_sources(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").filter("doc_id % 4 = 0")
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    mixed = written(P.mix_sources(spark, docs, None), "test-mixed")
    blocks = sum(len(r.text.split()) for r in mixed.select("text").collect()) / mixing.BLOCK_WORDS
    first = P.pack_documents(spark, mixed, None).filter("offset = 0").select("sequence_id", "doc_id").orderBy("sequence_id").collect()
    runs = sum(source[a.doc_id] != source[b.doc_id] for a, b in zip(first, first[1:]))
    assert runs > 0.8 * blocks > 100


def test_odd_tables(spark, small_dir, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in P.STAGES:
            after = written(stage(spark, docs, small_dir), "test-odd")
            assert name == "packing" or after.dtypes == docs.dtypes
            if name != "packing":
                docs = after
