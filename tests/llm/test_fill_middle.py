"""Fill-in-middle: cuts by brute force, round trips and odd rows."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermart.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    """The contract, unit by unit over code points."""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10_000), st.lists(st.sampled_from(["a", "word", "é", "😀", " ", "\n", "\x0b", "\x85", "<", "P>", "<S", " x"]),
                                         max_size=60), st.sampled_from([1, 2, 3, 7, 64]))
def test_reorder(doc_id, pieces, block):
    text = "".join(pieces)
    n, form, a, m, out = fill_middle.reorder(doc_id, text.encode(), block=block)
    assert (n, form, a, m, out.decode()) == brute(doc_id, text)


@pytest.mark.parametrize("block", [1, 5, 16])
def test_every_cut(block):
    text = "  éin wörd\n\nund 😀 noch\tmehr wörter  \n"
    units, tree = UNIT.findall(text), fill_middle.BlockTree(text.encode(), block)
    assert tree.n_units == len(units)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert tree.cut(k) == (len(head.encode()), len(head))


def test_long_text(monkeypatch):
    monkeypatch.setattr(fill_middle, "SEGMENT", 4 * fill_middle.BLOCK)
    text = "ein wörd 😀\n" * 20_000
    for doc_id in range(8):
        n, form, a, m, out = fill_middle.reorder(doc_id, text.encode())
        assert (n, form, a, m, out.decode()) == brute(doc_id, text)


def restored_texts(cut):
    back = fill_middle.restored(cut["output"], cut["form"])
    return sorted(((r.doc_id, r.back) for r in cut.select("doc_id", back.alias("back")).collect()), key=str)


def test_documents(documents):
    cut = fill_middle.transform(documents)
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in cut.collect()}
    assert got == {i: brute(i, t or "") for i, t in texts.items()}
    assert {x[1] for x in got.values()} == {"plain", "psm", "spm"}
    assert restored_texts(cut) == sorted(((i, t or "") for i, t in texts.items()), key=str)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = odd_documents.select("doc_id", "text").collect()
    cut = fill_middle.transform(odd_documents)
    want = sorted(((r.doc_id, *brute(r.doc_id, r.text or "")) for r in rows), key=str)
    assert sorted(map(tuple, cut.collect()), key=str) == want
    assert restored_texts(cut) == sorted(((r.doc_id, r.text or "") for r in rows), key=str)
    marked = spark.createDataFrame([(i, f"one <{c}> two") for i in range(30) for c in "PSMX"], "doc_id long, text string")
    cut = fill_middle.transform(marked)
    assert {r.form for r in cut.filter("output not like '%<X>%'").collect()} == {"plain"}
    assert {r.form for r in cut.filter("output like '%X>%'").collect()} > {"plain"}
    assert fill_middle.transform(no_documents).count() == 0
