"""How far the sources of a language differ in the terms they use.

Terms are counted in one scan: every task adds up the terms of each (lang,
source) group in dictionaries of bounded size and hands on partial sums.
Terms in enough documents of a language are kept; a group gives each of them
a smoothed probability, as an exact integer.

The distance of two groups is the sum over all kept terms of the difference
of their probabilities. It is accumulated row by row, as Gustavson multiplies
sparse matrices: the kept counts are an index by term (the groups that have
it) and by group (the terms it has). A group's row is a dense array with one
cell per peer. It starts from baselines, the distance as if the groups shared
no term, in which every absent count stands at the probability of zero; then
each of the group's terms is looked up in the term-major index and scattered
to the peers that have it too, where it replaces what the baselines said
about that term. No pair of postings is ever a row. The index is cut into
slices of terms, each worked by one task, and a slice's baselines cover its
own terms, so rows of all slices add up to the whole.

Rows: null text, lang and source count as ''; a group without terms is a
group with zero counts; a language in which no term is kept has distance 0
between all its groups; a language with one group has no pairs; repeated
rows are documents of their own; an empty table gives no rows. Texts of any
length are read in segments. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import importable, written

MIN_DOCS = 30               # documents of a language that must hold a term
SMOOTH, SCALE = 5, 1_000_000_000
TOP = 50                    # terms reported for a group
HELD = 1_000_000            # terms that a task adds up before it hands on partial sums, about 250 MB
SEGMENT = 1 << 22           # bytes of a text that are split into terms together
SLICE = (50_000, 4_000_000)  # least and most postings of a slice
ROWS = 512                  # groups whose rows one task accumulates
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")    # what stands between terms
_SPACED = bytes(0x20 if _BREAK.match(bytes([b])) else ord(chr(b).lower()) if b < 0x80 else b for b in range(256))
_ROOM = 1 << 31             # over any probability


def _terms(text: bytes) -> list[bytes]:
    """The terms in order, lower-cased: all else becomes white space."""
    return text.translate(_SPACED).split()


def _segments(text: bytes) -> Iterator[bytes]:
    """The text in pieces that end between terms."""
    start = 0
    while len(text) - start > SEGMENT:
        cut = _BREAK.search(text, start + SEGMENT)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def partial_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it), summed
    by each task; a row with a null term stands for the group itself."""
    importable(docs.sparkSession)
    texts = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, holding = defaultdict(Counter), defaultdict(Counter)
        for b in batches:
            names = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            for group, text in zip(names, b.column(2).cast(pa.large_binary())):
                seen: set[bytes] = set()
                for segment in _segments(text.as_py()):
                    terms = _terms(segment)
                    number[group].update(terms)
                    seen.update(terms)
                holding[group].update(seen)
            if sum(map(len, number.values())) > HELD:
                yield from flush(number, holding)
        yield from flush(number, holding)

    def flush(number: dict, holding: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in number.items():
            keys = [None, *terms]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array([source] * len(keys), pa.string()),
                 pa.array(keys, pa.binary()), pa.array([0, *terms.values()], pa.int64()),
                 pa.array([0, *map(holding[lang, source].__getitem__, terms)], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        number.clear()
        holding.clear()

    out = texts.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return out.withColumn("term", F.col("term").cast("string"))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """The kept terms of each group, as lang, source, term, n, lang_n (in the
    whole language), first (1 on one row of each term of a language); and all
    groups, as lang, source."""
    counts = written(partial_counts(docs).groupBy("lang", "source", "term")
                     .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    term = Window.partitionBy("lang", "term")
    kept = (counts.filter("term is not null")
            .withColumns({"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term),
                          "first": (F.row_number().over(term.orderBy("source")) == 1).cast("int")})
            .filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "first"))
    return written(kept, "kept-terms"), counts.filter("term is null").select("lang", "source")


def _p(n: str, total: str) -> F.Column:
    """The probability of a count, exact: 1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * V))."""
    return F.expr(f"1 + cast((cast({n} + {SMOOTH} as decimal(20,0)) * {SCALE}) div ({total} + {SMOOTH} * v) as bigint)")


def probabilities(kept: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings: lang, source, term, p, q (of the language). Groups: lang,
    source, zero (the probability of a term they lack; null where no term is
    kept), slices (of the language's index), blocks (of its groups' rows)."""
    langs = kept.groupBy("lang").agg(F.sum("first").alias("v"), F.sum("n").alias("lang_total"),
                                     F.count("*").alias("postings"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("peers"))
    size = F.least(F.greatest(F.col("peers") * F.col("peers"), F.lit(SLICE[0])), F.lit(SLICE[1]))
    all_ = (groups.join(sums, ["lang", "source"], "left").join(sizes, "lang").join(langs, "lang", "left")
            .withColumns({"v": F.coalesce("v", F.lit(0)), "total": F.coalesce("total", F.lit(0)),
                          "slices": F.ceil(F.coalesce("postings", F.lit(1)) / size).cast("int"),
                          "blocks": F.ceil(F.col("peers") / ROWS).cast("int")}))
    all_ = written(all_.withColumn("zero", F.when(F.col("v") > 0, _p("0", "total")))
                   .select("lang", "source", "v", "total", "lang_total", "zero", "slices", "blocks"), "groups")
    postings = (kept.join(all_, ["lang", "source"])
                .select("lang", "source", "term", _p("n", "total").alias("p"), _p("lang_n", "lang_total").alias("q"),
                        "slices", "blocks"))
    return postings, all_.select("lang", "source", "zero", "slices", "blocks")


def distances(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the language), value. A task
    has one slice of a language's index and ``ROWS`` of its groups' rows."""
    importable(postings.sparkSession)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = (postings.withColumns({"slice": F.pmod(F.xxhash64("term"), "slices").cast("int"), "block": upto("blocks")})
             .select("lang", "slice", "block", "source", "term", "p"))
    peers = (groups.withColumn("slice", upto("slices")).withColumn("block", upto("blocks"))
             .select("lang", "slice", "block", "source", F.coalesce("zero", F.lit(0)).alias("zero")))

    def rows(index: pa.Table, peers: pa.Table) -> pa.Table:
        index, peers = index.combine_chunks(), peers.sort_by("source").combine_chunks()
        names, zero = peers["source"], peers["zero"].to_numpy()
        group = pc.index_in(index["source"], names).to_numpy().astype(np.int64)
        term = pc.dictionary_encode(index["term"].combine_chunks()).indices.to_numpy().astype(np.int64)
        first = peers["block"][0].as_py() * ROWS
        own, everyone = np.arange(first, min(first + ROWS, len(zero))), np.arange(len(zero))
        found = [(np.full(len(zero) - 1, g), np.delete(everyone, g), np.delete(row, g))
                 for g, row in zip(own, accumulate(group, term, index["p"].to_numpy(), zero, own))]
        a, b, value = (np.concatenate(x) for x in zip(*found))
        return pa.table([pa.array(peers["lang"][:1].to_pylist() * len(a), pa.string()), names.take(pa.array(a)),
                         names.take(pa.array(b)), pa.array(value)], names=["lang", "source", "item", "value"])

    keys = ("lang", "slice", "block")
    parts = (index.groupBy(*keys).cogroup(peers.groupBy(*keys))
             .applyInArrow(rows, "lang string, source string, item string, value long"))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def accumulate(group: np.ndarray, term: np.ndarray, p: np.ndarray, zero: np.ndarray,
               own: np.ndarray) -> Iterator[np.ndarray]:
    """For each of the groups ``own`` the distances to all groups, over the
    terms of one slice: postings (group, term, p), and each group's ``zero``."""
    by_term = np.lexsort((group, term))                      # term-major: the groups that have a term
    peer, peer_p = group[by_term], p[by_term]
    n_terms = int(term.max(initial=-1)) + 1
    first = np.searchsorted(term[by_term], np.arange(n_terms + 1))
    by_group = np.lexsort((p, group))                        # group-major, its probabilities ascending
    own_term, own_p = term[by_group], p[by_group]
    start = np.searchsorted(group[by_group], np.arange(len(zero) + 1))
    size, keys = np.diff(start), group[by_group] * _ROOM + own_p
    upto = np.concatenate([[0], np.cumsum(own_p)])
    groups = np.arange(len(zero))
    for g in own:
        lo, hi = start[g], start[g + 1]
        t, x = own_term[lo:hi], own_p[lo:hi]
        # baselines: own terms against each peer's zero, each peer's terms against the own zero, and terms of neither
        at = lo + np.searchsorted(x, zero)
        mine = zero * (at - lo) - (upto[at] - upto[lo]) + (upto[hi] - upto[at]) - zero * (hi - at)
        at = np.searchsorted(keys, groups * _ROOM + zero[g])
        theirs = (zero[g] * (at - start[:-1]) - (upto[at] - upto[start[:-1]])
                  + (upto[start[1:]] - upto[at]) - zero[g] * (start[1:] - at))
        row = mine + theirs + (n_terms - (hi - lo) - size) * np.abs(zero[g] - zero)
        # scatter: each own term to the peers that have it
        many = first[t + 1] - first[t]
        at = np.repeat(first[t] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        h, y, x = peer[at], peer_p[at], np.repeat(x, many)
        np.add.at(row, h, np.abs(x - y) - np.abs(x - zero[h]) - np.abs(zero[g] - y) + np.abs(zero[g] - zero[h]))
        yield row


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: the distance to
    each other source of the language; part ``term``: the ``top`` terms that
    the group uses more than its language, by how much."""
    postings, groups = probabilities(*kept_counts(docs, min_docs))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = distances(postings, groups).withColumn("rank", F.row_number().over(by_value))
    over = (postings.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top))
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                                         F.col("rank").cast("int").alias("rank"))
    return columns(pairs, "pair").unionByName(columns(over, "term"))


def oracle() -> str:
    """DuckDB SQL for the query: every group gives every kept term."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    p = f"1 + (CAST({SCALE} AS HUGEINT) * (n + {SMOOTH})) // (total + {SMOOTH} * v)"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
    w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
    langs AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
    dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v,
            sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
        FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN c USING (lang, source, term)),
    ps AS (SELECT lang, source, term, n, {p} AS p FROM dense),
    whole AS (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM dense GROUP BY lang, term),
    qs AS (SELECT lang, term, {p} AS q FROM (SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM whole)),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM ps a JOIN ps b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL SELECT ps.lang, ps.source, 'term', ps.term, CAST(p - q AS BIGINT)
            FROM ps JOIN qs USING (lang, term) WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found)
    SELECT lang, source, part, item, value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= {TOP}"""
