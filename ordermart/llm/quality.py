"""Quality rules: counts per document, and language-model perplexity bands.

The reference text is every document that ``labels`` calls good (all of
them, no sample). Spark counts its character 4-grams per language, each
language's modified Kneser-Ney model is fitted from those counts (one task
a language, over its distinct n-grams; ``ngram_model``), and the log perplexities of the good documents give each language its band:
from the ``tail`` quantile to the ``1 - tail`` quantile, widened by the
factor ``margin`` on both sides. A document outside its language's band is
rejected, and so is one that fails the base rules.

A language in which no document is labelled good is judged by itself: all
its documents are the reference, and its band lies ``FENCE`` interquartile
ranges beyond their quartiles, widened alike, so only what is far from the
rest is rejected. Documents are scored once; the scores are written, and
bands and verdicts are read from them.

Rows: a null text counts as empty (and fails the base rules); a null
language is a language of its own; repeated rows are judged each for itself;
an empty table gives no rows. A document with any label row other than good
is not good.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import exact_quantiles
from ..plans.physical import broadcast_if_small
from .common import importable, shielded, written
from .ngram_model import Model, Scorer, grams, merge_counts

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
TAIL, MARGIN, FENCE = 0.0005, 1.3, 3.0
SCORE_CHARS = 2_000_000     # texts scored at a time
_MIX = np.uint64(0x9E3779B97F4A7C15)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text or "") - len(data) + sum(map(len, words)) if words else 0
    lines = [x for x in data.split(b"\n") if x.strip()]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    return (len(words), chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(ids, WINDOW))


def repeated_words(ids: np.ndarray, window: int) -> int:
    """Words inside a window that is found twice or more. Hashes name the
    candidates, the windows themselves decide."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    h = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(29)
    total = np.zeros(n, np.uint64)
    factor = 1
    for k in range(window):
        total += h[k:k + n] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % 2 ** 64
    ordered = np.sort(total)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(total, twice))
    rows = np.lib.stride_tricks.sliding_window_view(ids, window)[at]
    _, which, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[count[which.reshape(-1)] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def good_documents(labels: DataFrame) -> DataFrame:
    """Ids of documents whose label rows all say good (quality 1)."""
    return (labels.groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("low"))
            .filter((F.col("low") >= 1) & F.col("doc_id").isNotNull()).select("doc_id"))


def count_grams(texts: DataFrame) -> DataFrame:
    """lang, code, n over all rows of (lang, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for lang, part in _by_language(b.column(0).to_pylist(), b.column(1).to_pylist()):
                codes, n = np.unique(np.concatenate([grams(t) for _, t in part]), return_counts=True)
                if lang in held:
                    codes, n = merge_counts(np.append(held[lang][0], codes), np.append(held[lang][1], n))
                held[lang] = codes, n
        for lang, (codes, n) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)],
                names=["lang", "code", "n"])

    return (texts.select("lang", "text").mapInArrow(count, "lang string, code long, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))


def _by_language(langs: list, texts: list) -> Iterator[tuple[str | None, list[tuple[int, str]]]]:
    """Rows of one language at a time, in parts of about SCORE_CHARS."""
    rows: dict[str | None, list[tuple[int, str]]] = {}
    size: dict[str | None, int] = {}
    for i, (lang, text) in enumerate(zip(langs, texts)):
        rows.setdefault(lang, []).append((i, text or ""))
        size[lang] = size.get(lang, 0) + len(text or "")
        if size[lang] > SCORE_CHARS:
            yield lang, rows.pop(lang)
            size[lang] = 0
    yield from rows.items()


def fit_models(counts: DataFrame) -> DataFrame:
    """One row per language: the arrays of its model, from its distinct
    n-grams (their number grows with the corpus far slower than it)."""
    def fit(key, t):
        order = np.argsort(t["code"].to_numpy())
        model = Model.fit(t["code"].to_numpy()[order], t["n"].to_numpy()[order])
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()),
                         "arrays": pa.array([model.dump()], pa.list_(pa.binary()))})

    return counts.groupBy("lang").applyInArrow(fit, "lang string, arrays array<binary>")


class Judge:
    """The models by language, as they are sent to the tasks."""

    def __init__(self, models: dict[str | None, list[bytes]]):
        self.models = models
        self._scorers: dict[str | None, Scorer] = {}

    def __getstate__(self):
        return self.models

    def __setstate__(self, state):
        self.models, self._scorers = state, {}

    def log_perplexity(self, langs: list, texts: list) -> list[float | None]:
        """Null where the language has no model."""
        out: list[float | None] = [None] * len(texts)
        for lang, part in _by_language(langs, texts):
            if lang not in self.models:
                continue
            if lang not in self._scorers:
                self._scorers[lang] = Scorer(Model.load(self.models[lang]))
            means = self._scorers[lang].mean_log_prob([t for _, t in part])
            for (i, _), x in zip(part, means.tolist()):
                out[i] = -x
        return out


def _key() -> Column:
    """A language as a value that is never null."""
    return F.coalesce(F.concat(F.lit("l"), "lang"), F.lit("n"))


def reference(rows: DataFrame, good: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The (lang, text) that models are counted from, and the languages (as
    keys) that have no good document, one row each."""
    keyed = rows.select("doc_id", _key().alias("key"))
    lacking = written(keyed.select("key").distinct().join(keyed.join(good, "doc_id", "left_semi"), "key", "left_anti"),
                      "languages-without-good-documents")
    texts = rows.join(good, "doc_id", "left_semi").select("lang", "text")
    if lacking.isEmpty():
        return texts, lacking
    own = rows.withColumn("key", _key()).join(broadcast_if_small(lacking), "key", "left_semi")
    return texts.unionByName(own.select("lang", "text")), lacking


def scored(docs: DataFrame, judge: Judge, *names: str) -> DataFrame:
    """The columns ``names`` of ``docs`` and the five measures, base_failed,
    log_perplexity. Column names must not clash (``shielded``)."""
    cols = docs.columns
    text_at, lang_at, kept = cols.index("text"), cols.index("lang"), [cols.index(n) for n in names]
    added = [T.StructField(m, T.LongType()) for m in MEASURES] + [
        T.StructField("base_failed", T.BooleanType()), T.StructField("log_perplexity", T.DoubleType())]
    schema = T.StructType([*(docs.schema[n] for n in names), *added])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, langs = b.column(text_at).to_pylist(), b.column(lang_at).to_pylist()
            found = [measures(t) for t in texts]
            new = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [()] * 5)]
            new += [pa.array([base_failed(x[0], x[4]) for x in found], pa.bool_()),
                    pa.array(judge.log_perplexity(langs, texts), pa.float64())]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), *new], names=schema.fieldNames())

    return docs.mapInArrow(rate, schema)


def bands(scores: DataFrame, good: DataFrame, lacking: DataFrame, tail: float = TAIL, margin: float = MARGIN) -> DataFrame:
    """key, low, high: the band of each language, from (doc_id, lang,
    log_perplexity)."""
    rows = scores.select("doc_id", _key().alias("key"), F.col("log_perplexity").alias("v"))
    rows = (rows.join(good, "doc_id", "left_semi").select("key", "v")
            .unionByName(rows.join(broadcast_if_small(lacking), "key", "left_semi").select("key", "v")))
    q, wider = F.col("quantiles"), math.log(margin)
    ends = exact_quantiles(rows, ["key"], (tail, 1 - tail, 0.25, 0.75)).join(lacking.withColumn("alone", F.lit(True)), "key", "left")
    far = FENCE * (q[3] - q[2])
    return ends.select("key", (F.when(F.col("alone"), q[2] - far).otherwise(q[0]) - wider).alias("low"),
                       (F.when(F.col("alone"), q[3] + far).otherwise(q[1]) + wider).alias("high"))


def judged(docs: DataFrame, labels: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` of ``docs`` (doc_id, lang, text and others) and
    the five measures, base_failed, log_perplexity, kept. Models and bands
    have one row for each language."""
    importable(docs.sparkSession)
    good = written(good_documents(labels), "good-documents")
    texts, lacking = reference(docs, good)
    fitted = written(fit_models(count_grams(texts)), "language-models").collect()
    judge = Judge({r["lang"]: [bytes(x) for x in r["arrays"]] for r in fitted})
    own = [n for n in ("doc_id", "lang") if n not in names]
    scores = written(scored(docs, judge, *own, *names), "scored-documents")
    ends = written(bands(scores, good, lacking), "perplexity-bands")
    rows = scores.withColumn("_key", _key()).join(broadcast_if_small(ends), F.col("_key") == F.col("key"), "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return rows.select(*names, *MEASURES, "base_failed", "log_perplexity", (~F.col("base_failed") & inside).alias("kept"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five measures, base_failed, log_perplexity, kept."""
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return judged(rows, labels, "doc_id")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    rows, names = shielded(docs, "doc_id", "lang", "text")
    return judged(rows, labels, *names).filter("kept").select(*names).toDF(*docs.columns)
