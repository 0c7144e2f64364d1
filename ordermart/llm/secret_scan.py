"""Secrets in texts: fixed patterns, and random strings told by character
Markov models. DataFrame functions only.

The base patterns give spans in code points: a text is split at a pattern's
matches, and the lengths of what lies between and of the matches add up to
the positions. Further candidates are what base spans leave of the runs of
characters of base-64 alphabets. Two first-order Markov models over 66
characters, one of random strings and one of ordinary identifiers, are
trained from labelled samples; a candidate is a secret when the log
likelihood ratio of the models is at least ``MIN_TOTAL`` in all and
``MIN_MEAN`` a character pair. Random strings gain about 2.5 a pair, so fewer
than ``RUN`` characters do not tell; like the lengths of the base patterns it
is part of what counts as a secret. A candidate without a letter (a number)
never is one.

``labelled_samples`` takes them from the documents: ordinary are the runs of
the same alphabet in ``SAMPLE_DOCS`` documents (a bound, chosen by hash), also
in capitals, random are the distinct values that the base patterns found
(``SAMPLE_VALUES`` at most) and digests of those words. Everything else sees
every text whole.

One scan cuts out spans and candidates; only those are written and scored,
nothing is shuffled. Rows: a null text is empty; repeated rows are scanned
each for itself; an empty table gives no rows (the models are then uniform);
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sample, written

#: fixed values: the base patterns, in the order in which ties are listed
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
MIN_VALUE = 6

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
SAMPLE_DOCS, SAMPLE_VALUES = 300, 5000
MIN_TOTAL, MIN_MEAN = 20.0, 1.0
RUN = 9
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{RUN},}}"
SMOOTHING = 0.5
CHUNK = 256                 # spans that one growing array holds
_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def _running(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The spans that ``step`` (state, item -> state, array of spans) gives
    item by item. Arrays are copied when they grow, so they grow in chunks of
    CHUNK items, which are put together at the end."""
    none = F.array().cast(f"array<{_SPAN}>")

    def one(acc: Column, x: Column) -> Column:
        state, out = step(acc["state"], x)
        return F.struct(state.alias("state"), F.concat(acc["out"], out).alias("out"))

    def every(rows: Column) -> Column:
        def chunk(acc: Column, k: Column) -> Column:
            part = F.aggregate(F.slice(rows, k * CHUNK + 1, F.lit(CHUNK)),
                               F.struct(acc["state"].alias("state"), none.alias("out")), one)
            return _let(part, lambda p: F.struct(p["state"].alias("state"),
                                                 F.concat(acc["out"], F.array(p["out"])).alias("out")))

        empty = F.struct(zero.alias("state"), F.array().cast(f"array<array<{_SPAN}>>").alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.floor(F.size(rows) / CHUNK).cast("int")), empty, chunk,
                           lambda acc: F.flatten(acc["out"]))

    return _let(items, every)


def _found(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """array of (start, kind, end, value): the pattern's matches, leftmost
    and non-overlapping, with the group's text as value."""
    rx = F.lit(pattern)
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, rx, F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, rx, F.lit(group)).alias("value"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        return end, F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"),
                                     x["value"].alias("value")))

    spans = _running(F.filter(parts, lambda x: x["hit"].isNotNull()), F.lit(0), step)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _apart(runs: Column, base: Column) -> Column:
    """What base spans leave of the runs (which do not overlap each other):
    one sweep over both in order. A run is held until something starts behind
    its end, and loses what base spans cover; ``reach`` is how far these have
    come."""
    is_run = lambda x: x["kind"] == len(KINDS) - 1
    none, far = F.lit(None).cast(_SPAN), F.lit((1 << 31) - 1)
    last = F.struct(far.alias("start"), F.lit(0).alias("kind"), far.alias("end"), F.lit("").alias("value"))

    def part(run: Column, start: Column, end: Column) -> Column:
        """The run from one place to another, null if nothing is left of it."""
        value = run["value"].substr(start - run["start"] + 1, end - start)
        return F.when(end > start, F.struct(start.alias("start"), run["kind"].alias("kind"), end.alias("end"),
                                            value.alias("value"))).otherwise(none)

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        held, reach = state["held"], state["reach"]
        done = part(held, held["start"], F.least(held["end"], x["start"]))
        after = F.when(is_run(x), part(x, F.greatest(x["start"], reach), x["end"])).otherwise(
            part(held, F.greatest(held["start"], x["end"]), held["end"]))
        now = F.struct(F.when(is_run(x), reach).otherwise(F.greatest(reach, x["end"])).alias("reach"), after.alias("held"))
        return now, F.filter(F.array(done), lambda y: y.isNotNull())

    swept = _running(F.concat(F.sort_array(F.concat(base, runs)), F.array(last)),
                     F.struct(F.lit(0).alias("reach"), none.alias("held")), step)
    return F.when((F.size(runs) > 0) & (F.size(base) > 0), swept).otherwise(runs)


def cut_out(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans of the patterns, sorted) and candidates (what they
    leave of runs, if it is long enough and has a letter)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id", F.filter(_found(F.col("text"), ASSIGN, "assign", 2), lambda x: F.char_length(x["value"]) >= MIN_VALUE).alias("assign"),
        _found(F.col("text"), ACCESS, "access").alias("access"), _found(F.col("text"), HEX, "hex").alias("hex"),
        _found(F.col("text"), CANDIDATE, "random").alias("runs"))
    rows = rows.withColumn("base", F.sort_array(F.concat("assign", "access", "hex")))
    fit = lambda x: (F.char_length(x["value"]) >= RUN) & x["value"].rlike("[A-Za-z]")
    return rows.select("doc_id", "base", F.filter(_apart(F.col("runs"), F.col("base")), fit).alias("candidates"))


def labelled_samples(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """value and label (1 random, 0 ordinary) of bounded samples."""
    found = written(spans.select(F.explode("base").alias("b")).select(F.col("b.value").alias("value")).distinct(), "values")
    few = sample(docs.select("doc_id", "text"), F.col("doc_id"), SAMPLE_DOCS, spans.count())
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z0-9+/_-]{4,}"), F.lit(0))
    words = written(few.select(F.explode(words).alias("value")).join(found, "value", "left_anti"), "ordinary-words")
    ordinary = words.unionByName(words.select(F.upper("value").alias("value")))
    values = sample(found, F.col("value"), SAMPLE_VALUES, found.count())
    digests = words.distinct().orderBy(F.xxhash64("value"), "value").limit(SAMPLE_VALUES).select(F.explode(F.array(
        F.md5("value"), F.base64(F.unhex(F.sha2("value", 256))), F.upper(F.md5("value")))).alias("value"))
    return (ordinary.withColumn("label", F.lit(0)).unionByName(values.withColumn("label", F.lit(1)))
            .unionByName(digests.withColumn("label", F.lit(1))))


def ratio_table(samples: DataFrame) -> list[float]:
    """Log likelihood ratio (random to ordinary) of each transition between
    two characters of the alphabet: its square is the size, whatever the
    samples hold."""
    n = len(ALPHABET)
    value = F.regexp_replace("value", "[^A-Za-z0-9+/_-]", "")
    pairs = (samples.select("label", value.alias("v")).filter(F.char_length("v") > 1)
             .select("label", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("v") - 1),
                                                    lambda i: F.col("v").substr(i, F.lit(2)))).alias("pair")))
    counts = {(r["label"], r["pair"]): r["count"] for r in pairs.groupBy("label", "pair").count().collect()}
    table = []
    for a in ALPHABET:
        totals = [sum(counts.get((k, a + b), 0) for b in ALPHABET) + SMOOTHING * n for k in (0, 1)]
        table += [math.log((counts.get((1, a + b), 0) + SMOOTHING) / totals[1])
                  - math.log((counts.get((0, a + b), 0) + SMOOTHING) / totals[0]) for b in ALPHABET]
    return table


def random_spans(candidates: Column | str, table: list[float]) -> Column:
    """The candidates that the models call random."""
    ratios = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")

    def total(x: Column) -> Column:
        codes = F.transform(F.split(x["value"], ""), lambda c: F.instr(F.lit(ALPHABET), c))
        pairs = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                           lambda a, b: F.element_at(ratios, ((a - 1) * len(ALPHABET) + b).cast("int")))
        return F.aggregate(pairs, F.lit(0.0), lambda s, y: s + y)

    scored = F.transform(candidates, lambda x: F.struct(x.alias("span"), total(x).alias("score")))
    kept = F.filter(scored, lambda x: (x["score"] >= MIN_TOTAL)
                    & (x["score"] >= MIN_MEAN * (F.char_length(x["span"]["value"]) - 1)))
    return F.transform(kept, lambda x: x["span"])


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """doc_id, base and random (arrays of start, kind, end, value)."""
    spans = written(cut_out(docs), "secret-spans")
    table = ratio_table(samples if samples is not None else labelled_samples(docs, spans))
    return spans.select("doc_id", "base", random_spans("candidates", table).alias("random"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.sort_array(F.concat("base", "random"))).alias("spans"))
