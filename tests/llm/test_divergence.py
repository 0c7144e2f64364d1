"""Source divergence: row accumulation and the whole audit by brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ordermart.llm import divergence


def brute(rows, min_docs):
    """The contract over dense counts. rows: (text, lang, source)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, holds, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((a or "", b or "", c or "") for a, b, c in rows):
        terms = [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        groups[lang].add(source)
        count[lang, source].update(terms)
        holds[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in holds[lang].items() if n >= min_docs]

        def p_of(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}
        p = {s: p_of(count[lang, s]) for s in sources}
        q = p_of(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:50]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(found)]
    return sorted(out)


def audited(df, min_docs):
    return sorted(map(tuple, divergence.audit(df, min_docs).select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("seed", range(4))
def test_accumulate(seed):
    rng = np.random.default_rng(seed)
    groups, terms = 7, 50
    dense = np.where(rng.random((groups, terms)) < 0.3, rng.integers(1, 10 ** 9, (groups, terms)), -1)
    dense[:, 0], dense[0], dense[2] = 5, 7, -1              # a group with every term, one without any
    zero = rng.integers(1, 10 ** 8, groups)
    g, t = np.nonzero(dense >= 0)
    got = np.stack(list(divergence.accumulate(g, t, dense[g, t], zero, np.arange(groups))))
    full = np.where(dense >= 0, dense, zero[:, None])
    want = np.abs(full[:, None, :] - full[None, :, :]).sum(axis=2)
    assert (got == want).all()


@pytest.mark.parametrize("slice_, rows", [((50_000, 4_000_000), 512), ((1, 40), 2)])
def test_documents(documents, monkeypatch, slice_, rows):
    monkeypatch.setattr(divergence, "SLICE", slice_)
    monkeypatch.setattr(divergence, "ROWS", rows)
    rows = [(r.text, r.lang, r.source) for r in documents.collect()]
    want = brute(rows, 5)
    assert audited(documents, 5) == want and {r[2] for r in want} == {"pair", "term"}


def test_bounded_dictionaries_and_segments(documents, monkeypatch):
    whole = audited(documents, 5)
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "SEGMENT", 16)
    few = documents.limit(40)
    rows = [(r.text, r.lang, r.source) for r in few.collect()]
    text = "One, two; thrée four-five sixsixsixsixsixsixsix\u2028x 7 " * 5
    want = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.replace("O", "o"))
    assert [t.decode() for x in divergence._segments(text.encode()) for t in divergence._terms(x)] == want
    assert audited(few, 3) == brute(rows, 3) and whole


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r.text, r.lang, r.source) for r in odd_documents.collect()]
    for least in (1, 2, 1000):                              # with 1000 no term is kept
        assert audited(odd_documents, least) == brute(rows, least)
    assert divergence.audit(no_documents).count() == 0
    rows = [("Ä ä É Ab aB 1a2", "x", s) for s in ("é", "z", "😀", "￿", "a")] + [("", "x", "none"), ("only", "one", "host")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert audited(df, 1) == brute(rows, 1)
