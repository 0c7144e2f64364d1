"""Line dedup against brute force; host names."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ordermart.llm import line_dedup


def brute(rows, ratio, sure):
    pages = defaultdict(set)
    for host, text in rows:
        if text is not None:
            pages[host].add(text)
    drop = {}
    for host, texts in pages.items():
        n = Counter(x for t in texts for x in set(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", x))
        drop[host] = {x for x, k in n.items() if k > 1 and k > ratio * len(texts) + sure * (ratio * len(texts)) ** 0.5}
    return [(host, None if t is None else "\n".join(x for x in t.split("\n") if x not in drop[host])) for host, t in rows]


def check(docs, ratio=0.02, sure=3.0):
    rows = [(r.source, r.text) for r in docs.select("source", "text").collect()]
    got = line_dedup.drop_boilerplate(docs, "source", ratio=ratio, sure=sure, measures=True).collect()
    key = lambda x: (x[0] or "", x[0] is None, x[1] or "", x[1] is None)
    want = sorted(brute(rows, ratio, sure), key=key)
    assert sorted(((r.source, r.text) for r in got), key=key) == want
    lines = Counter(len(t.split("\n")) if t is not None else 0 for _, t in rows)
    assert Counter(r.n_lines for r in got) == lines
    return sum(r.n_dropped for r in got)


def test_documents(spark):
    assert check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")) > 50


def test_copies_of_a_page_are_one_page(spark):
    rows = [("a", "same\ntext")] * 50 + [("a", f"own {i}\nfooter") for i in range(6)] + [(None, f"x {i}\nfooter\n\n ") for i in range(6)]
    docs = spark.createDataFrame(rows, "source string, text string")
    assert check(docs, 0.5, 0.0) == 12                                       # the footers, not the copied page


def test_small_hosts(spark):
    """Three pages with a footer lose it; two near copies among fifty pages keep their lines, a footer of a tenth goes."""
    rows = [("three", f"own {i}\nfooter") for i in range(3)] + [("one", "page\npage")]
    rows += [("fifty", f"own {i}" + "\nshared by two" * (i < 2) + "\nfooter" * (i < 5)) for i in range(50)]
    docs = spark.createDataFrame(rows, "source string, text string")
    assert check(docs) == 3 + 5
    left = {(r.source, r.text) for r in line_dedup.drop_boilerplate(docs, "source").collect()}
    assert {("three", "own 0"), ("one", "page\npage"), ("fifty", "own 0\nshared by two"), ("fifty", "own 4")} <= left


def test_odd_rows(odd_documents, no_documents):
    check(odd_documents, 0.0, 0.0)
    check(odd_documents)
    kept = line_dedup.drop_boilerplate(odd_documents, "source")
    assert kept.dtypes == odd_documents.dtypes and kept.count() == odd_documents.count()
    assert line_dedup.drop_boilerplate(no_documents, "source").count() == 0


def test_host_of(spark):
    urls = ["http://u:p@M.th.example.net:80/en/25#top", "https://a.org?x", "x", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(line_dedup.host_of(F.col("u")).alias("h"))
    assert [r.h for r in df.collect()] == ["m.th.example.net", "a.org", None, None]
