"""Packing: every id in exactly one piece, windows gapless and nearly full."""

import zlib
from collections import defaultdict
from functools import cache

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermart.llm import packing, tokens


@cache
def plain_model():
    model = Tokenizer.from_file(tokens.default_path())
    return model


def ids_of(text, end=0):
    return plain_model().encode(text or "", add_special_tokens=False).ids + [end]


def check(docs, window=1024, **options):
    rows = packing.pack(docs, window=window, **options).collect()
    wanted = sorted((r.doc_id is None, r.doc_id or 0, tuple(ids_of(r.text))) for r in docs.select("doc_id", "text").collect())
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
        assert len(r.ids) == 4 * r.length
    for own in windows.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    got = []
    for doc, own in pieces.items():           # repeated documents: as many pieces of each start as there are rows
        starts = defaultdict(list)
        for r in own:
            starts[r.start].append(r)
        while starts:
            at, ids = 0, []
            while at in starts:
                r = starts[at].pop()
                if not starts[at]:
                    del starts[at]
                ids += np.frombuffer(r.ids, "<u4").tolist()
                at += r.length
            assert ids
            got.append((doc is None, doc or 0, tuple(ids)))
    assert sorted(got) == wanted
    fills = sorted(sum(r.length for r in own) for own in windows.values())
    assert all(n == window for n in fills[1:])
    return rows


def test_whole_table(documents):
    check(documents)


def test_many_partitions_merge_in_rounds(documents, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 3)
    check(documents.limit(60).repartition(20), window=64, open_windows=2)


def test_odd_rows(odd_documents, no_documents):
    docs = odd_documents.filter(~F.col("doc_id").isin(7))     # repeats of one id are told apart below
    check(docs.coalesce(1))
    repeats = odd_documents.filter("doc_id = 7")
    assert packing.pack(repeats).agg(F.sum("length")).first()[0] == 3 * len(ids_of(repeats.first().text))
    empty = packing.pack(no_documents)
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_query_digests(spark, small_dir, documents):
    from ordermart.llm.queries import QUERIES
    rows = QUERIES["op8_packing"](spark, small_dir).filter("doc_id < 20").collect()
    texts = {r.doc_id: ids_of(r.text) for r in documents.filter("doc_id < 20").collect()}
    for r in rows:
        part = np.array(texts[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(texts[r.doc_id])


def test_best_fit_and_top_up():
    out = []
    w = packing.Windows(10, 2, lambda pieces, left: out.append((pieces, left)))
    for doc, n in enumerate([6, 7, 3, 5]):    # 3 best fits the 7; 5 fits none: the fullest (6) is topped up
        w.add(doc, 0, np.arange(n, dtype="<u4"), n)
    assert [[(p[0], len(p[2])) for p in pieces] for pieces, _ in out] == [[(1, 7), (2, 3)]]
    w.add(4, 0, np.arange(9, dtype="<u4"), 9)
    assert [(p[0], len(p[2])) for p in out[1][0]] == [(0, 6), (4, 4)]
