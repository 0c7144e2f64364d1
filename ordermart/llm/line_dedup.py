"""Boilerplate lines, by how many of a site's pages contain them.

Pages are grouped by host. For each line that has a word, the pages that
contain it (once or more) are divided by the host's page total; lines over
``ratio`` are dropped from every page of that host. A line must be on two
pages or more, and over the ratio by ``sure`` standard deviations of what a
line of just that ratio would show by chance: on a host of three pages two
are enough, among fifty a line of two near copies is no boilerplate, and on a
large host only the ratio counts. Pages of one host with the same text count as one page,
so a page that was copied often does not turn its own text into
boilerplate. Lines are compared exactly, as 64-bit hashes; lines without a
word are kept.

Counting is a partial aggregate, so a line that a third of a hot host's
pages contain is summed up before the shuffle. The lines to drop are one
array per host, of at most (lines per page / ratio) entries; it is joined to
the pages by host, and Spark's own size check decides whether it is
broadcast or both sides are shuffled (skewed hosts are then split).

Rows: a null text has no lines and stays null; a null host is a host of its
own; repeated rows are one page in the counts and each cleaned; an empty
table gives no rows; all columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, shielded, written

RATIO, SURE = 0.02, 3.0


def host_of(url: Column | str) -> Column:
    """The lower-case host of a URL, null where there is none."""
    found = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.nullif(found, F.lit("")))


def _lines(text: Column | str) -> Column:
    return F.split(text, "\n")


def boilerplate(docs: DataFrame, host: str, text: str = "text", ratio: float = RATIO, sure: float = SURE) -> DataFrame:
    """One row per host that has such lines: _host, _drop (hashes of lines)."""
    keys = F.array_distinct(F.transform(F.filter(_lines(text), lambda x: x.rlike(WORD)), lambda x: F.xxhash64(x)))
    pages = written(docs.select(F.col(host).alias("_host"), F.xxhash64(text).alias("_page"), keys.alias("_keys"))
                    .filter(F.col(text).isNotNull()).dropDuplicates(["_host", "_page"]).drop("_page"), "page-lines")
    totals = pages.groupBy("_host").agg(F.count("*").alias("pages"))
    counts = (pages.select("_host", F.explode("_keys").alias("_key")).groupBy("_host", "_key")
              .agg(F.count("*").alias("n")).filter("n > 1"))
    over = counts.join(totals.withColumnRenamed("_host", "_own"), F.col("_host").eqNullSafe(F.col("_own")))
    expected = F.lit(ratio) * F.col("pages")
    return (over.filter(F.col("n") > expected + F.lit(sure) * F.sqrt(expected)).groupBy("_host")
            .agg(F.sort_array(F.collect_list("_key")).alias("_drop")))


def drop_boilerplate(docs: DataFrame, host: str, text: str = "text", ratio: float = RATIO,
                     sure: float = SURE, measures: bool = False) -> DataFrame:
    """``docs`` with the lines dropped from ``text``; with ``measures`` also
    n_lines and n_dropped."""
    rows, names = shielded(docs, host, text)
    drop = written(boilerplate(rows, host, text, ratio, sure), "boilerplate-lines")
    rows = rows.join(drop, F.col(host).eqNullSafe(F.col("_host")), "left")
    none = F.array().cast("array<bigint>")
    hits = F.array_intersect(F.transform(_lines(text), lambda x: F.xxhash64(x)), F.coalesce("_drop", none))
    kept = F.filter(_lines(text), lambda x: ~(F.array_contains("_hits", F.xxhash64(x)) & x.rlike(WORD)))
    rows = (rows.withColumn("_hits", hits)
            .withColumn("_kept", F.when(F.size("_hits") > 0, kept))      # null where nothing is dropped
            .withColumn("_n_lines", F.coalesce(F.size(F.when(F.col(text).isNotNull(), _lines(text))).cast("long"), F.lit(0)))
            .withColumn("_n_dropped", F.coalesce(F.col("_n_lines") - F.size("_kept"), F.lit(0)).cast("long"))
            .withColumn(text, F.coalesce(F.array_join("_kept", "\n"), F.col(text))))
    if not measures:
        return rows.select(*names).toDF(*docs.columns)
    return rows.select(*names, "_n_lines", "_n_dropped").toDF(*docs.columns, "n_lines", "n_dropped")


def oracle(ratio: float = RATIO, sure: float = SURE) -> str:
    """DuckDB SQL for the query over ``documents`` with ``source`` as host."""
    word = r"[^\x20\x09-\x0D]"
    return f"""
    WITH pages AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
    totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
    lines AS (SELECT source, line, count(*) AS n FROM (
        SELECT source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM pages) GROUP BY source, line),
    boiler AS (SELECT l.source, list(l.line) AS lines FROM lines l JOIN totals t
        ON l.source IS NOT DISTINCT FROM t.source
        WHERE l.n > 1 AND l.n > CAST({ratio} AS DOUBLE) * t.pages + CAST({sure} AS DOUBLE) * sqrt(CAST({ratio} AS DOUBLE) * t.pages)
          AND regexp_matches(l.line, '{word}') GROUP BY l.source),
    cut AS (SELECT d.doc_id, d.text, CASE WHEN b.lines IS NULL THEN string_split(d.text, chr(10))
          ELSE list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(b.lines, x)) END AS kept
        FROM documents d LEFT JOIN boiler b ON d.source IS NOT DISTINCT FROM b.source)
    SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
           CAST(coalesce(len(string_split(text, chr(10))) - len(kept), 0) AS BIGINT) AS n_dropped,
           array_to_string(kept, chr(10)) AS text FROM cut"""
