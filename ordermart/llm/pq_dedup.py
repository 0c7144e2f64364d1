"""Embedding near-duplicates with product quantisation.

Vectors of one label are compared on the unit sphere, where a cosine of at
least ``threshold`` is a distance of at most r. Equal vectors of a label are
one class, so copies are never compared.

A coarse quantiser (k-means) puts every class into the inverted list of its
nearest centroid; what is left, the residual, is coded in subspaces of four
dimensions by one byte each, and the length of what the code misses is kept
beside it. Quantiser and codebooks are fitted on a sample of at most
16 * ``MAX_LISTS`` classes; every class is indexed.

A vector probes each list in whose cell a vector within r can lie: those
whose bisecting plane with its own cell is no farther than r. So the probes
are sufficient, whatever the sample. In a list the distance to every member
is looked up in a table (asymmetric: exact query, coded members); the code's
own error bounds how far the look-up can be off, and members that may be
within r are compared exactly, in double precision. Found links are all the
links there are.

Members and queries of a list are dealt out by blocks of at most about
``BLOCK``, so no task holds a whole large list. A task emits for each class
how many vectors it is linked with and one link to its group in the task,
never the pairs.

Rows: vectors that are null, all zero, or hold a null or non-finite
component, and rows without a label link with nothing: they have no links
and are their own component. Shorter vectors count as filled up with zeros.
Repeated rows are copies, linked like any other, also where ids repeat or
are null; a null id names a component only where all its ids are null, and
is kept then. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, sample, written
from .simhash import components, stars

THRESHOLD = 0.98
MAX_LISTS, PER_LIST = 1024, 16      # lists at most, sampled classes for each
SUB, CODES = 4, 256                 # dimensions of a subspace, codewords of one byte
ROUNDS = 8                          # of k-means
BLOCK = 2048                        # members, or queries, of a list that are compared in one task
TABLES = 128                        # queries whose look-up tables are held together
PAIRS = 1 << 15                     # candidate pairs that are gathered together
_SLACK = 1e-9                       # what rounding can do to a distance


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; neither huge nor tiny components overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of c."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T, 0.0)


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """At most k centroids, from evenly spaced rows and ``ROUNDS`` rounds."""
    c = np.unique(x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)], axis=0)
    for _ in range(ROUNDS):
        own = _squares(x, c).argmin(axis=1)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return np.unique(c, axis=0)


class Quantiser:
    """Coarse centroids and the codebooks of their residuals."""

    def __init__(self, dim: int, lists: int, rows: np.ndarray, radius: float):
        self.dim, self.radius = dim, radius
        x = unit_rows(rows)
        self.centroids = kmeans(x, lists)
        rest = x - self.centroids[_squares(x, self.centroids).argmin(axis=1)]
        self.subs = [slice(k, min(k + SUB, dim)) for k in range(0, dim, SUB)]
        self.books = [kmeans(rest[:, s], CODES) for s in self.subs]
        gaps = np.sqrt(_squares(self.centroids, self.centroids))
        self.gaps = np.where(gaps > 0, gaps, np.inf)

    def matrix(self, vectors: list) -> np.ndarray:
        out = np.zeros((len(vectors), self.dim))
        for row, v in zip(out, vectors):
            row[:len(v)] = v
        return unit_rows(out)

    def own(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's list, and for each row which lists of a higher number
        it must probe (those of a lower one probe it)."""
        d = _squares(x, self.centroids)
        own = d.argmin(axis=1)
        plane = (d - d.min(axis=1, keepdims=True)) / (2 * self.gaps[own])        # distance to the bisecting plane
        return own, (plane <= self.radius + _SLACK) & (np.arange(len(self.centroids)) > own[:, None])

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far the codes are off."""
        rest = x - self.centroids[own]
        codes = np.stack([_squares(rest[:, s], book).argmin(axis=1) for s, book in zip(self.subs, self.books)], axis=1)
        for k, (s, book) in enumerate(zip(self.subs, self.books)):
            rest[:, s] -= book[codes[:, k]]
        return codes.astype(np.uint8), np.sqrt((rest * rest).sum(axis=1))

    def near(self, list_: int, q: np.ndarray, codes: np.ndarray, error: np.ndarray) -> np.ndarray:
        """Which members of a list may be within the radius of which queries,
        by table look-ups."""
        rest, total = q - self.centroids[list_], np.zeros((len(q), len(codes)))
        for k, (s, book) in enumerate(zip(self.subs, self.books)):
            total += _squares(rest[:, s], book)[:, codes[:, k]]
        return np.sqrt(total) <= error + self.radius + _SLACK


def links(q: np.ndarray, x: np.ndarray, near: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the ``near`` pairs have a cosine of at least the threshold."""
    if near.mean() > 0.1:
        return near & (q @ x.T >= threshold)
    i, j = np.nonzero(near)
    out = np.zeros_like(near)
    for k in range(0, len(i), PAIRS):
        a, b = i[k:k + PAIRS], j[k:k + PAIRS]
        out[a, b] = np.einsum("ij,ij->i", q[a], x[b]) >= threshold
    return out


def classes_of(embeddings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows that can link (vec_id, label, v), those that can't (vec_id), and
    the distinct (label, v) as cls, label, v, n, first (the least vec_id)."""
    x = F.col("embedding")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), x)
    fit = F.coalesce(F.col("label").isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                     & F.exists(x, lambda c: c != 0), F.lit(False))
    v = F.transform(x, lambda c: c.cast("double") + F.lit(0.0)).alias("v")      # -0.0 is 0.0
    able = rows.filter(fit).select("vec_id", "label", v)
    classes = able.groupBy("label", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("cls"), "*"), "vector-classes")
    return able, rows.filter(~fit).select("vec_id"), classes


def fit(classes: DataFrame, threshold: float = THRESHOLD) -> Quantiser | None:
    """From a sample of at most PER_LIST * MAX_LISTS classes; lists grow with
    the square root of the classes."""
    n, dim = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return None
    lists = int(min(MAX_LISTS, max(16, n ** 0.5)))
    few = sample(classes.select("cls", "v"), F.col("cls"), PER_LIST * lists, n).collect()
    rows = np.zeros((len(few), dim))
    for row, r in zip(rows, few):
        row[:len(r["v"])] = r["v"]
    return Quantiser(dim, lists, rows, float(np.sqrt(max(0.0, 2 - 2 * threshold))))


def index(classes: DataFrame, quantiser: Quantiser) -> DataFrame:
    """cls, label, n, list, probes (other lists), code, error, x (the unit
    vector, as binary)."""
    out = "list int, probes array<int>, code binary, error double, x binary"
    label = classes.schema["label"].dataType.simpleString()

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = quantiser.matrix(b.column(3).to_pylist())
            own, probes = quantiser.own(x)
            code, error = quantiser.encode(x, own)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(own, pa.int32()),
                 pa.array([np.flatnonzero(p) for p in probes], pa.list_(pa.int32())),
                 pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error),
                 pa.array([r.tobytes() for r in x], pa.binary())],
                names=["cls", "label", "n", "list", "probes", "code", "error", "x"])

    rows = classes.select("cls", "label", "n", "v").mapInArrow(tag, f"cls long, label {label}, n long, {out}")
    return written(rows, "pq-index")


def found(indexed: DataFrame, quantiser: Quantiser, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """a, b, n: class a is linked with n vectors of other classes (b null),
    or to class b in one component."""
    members = indexed.select("label", "list", "cls", "n", "code", "error", "x")
    asks = indexed.select("label", F.explode(F.concat(F.array("list"), "probes")).alias("list"),
                          F.col("list").alias("home"), "cls", "n", "x")
    key, blocks = ["label", "list"], lambda c: F.ceil(F.col(c) / block)
    sizes = (members.groupBy(*key).agg(F.count("*").alias("m")).join(asks.groupBy(*key).agg(F.count("*").alias("q")), key)
             .select(*key, blocks("m").alias("m_blocks"), blocks("q").alias("q_blocks")))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in its hashed block, once for every block of the other side."""
        rows = (rows.join(sizes, key).withColumn(own, F.pmod(F.xxhash64("cls"), F.col(f"{own}_blocks")))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1)))
                .drop("m_blocks", "q_blocks"))
        return rows.toDF(*rows.columns)                                  # columns of its own on either side

    members, asks = dealt(members, "m", "q"), dealt(asks, "q", "m")

    def compare(m: pa.Table, a: pa.Table) -> pa.Table:
        if not len(m) or not len(a):
            return _found([], [], [])
        read = lambda t, c, kind: np.frombuffer(b"".join(t[c].to_pylist()), kind).reshape(len(t), -1)
        x, codes, error, size = read(m, "x", "<f8"), read(m, "code", "u1"), m["error"].to_numpy(), m["n"].to_numpy()
        q, many, list_ = read(a, "x", "<f8"), a["n"].to_numpy(), m["list"][0].as_py()
        q_cls, m_cls, guest = a["cls"].to_numpy(), m["cls"].to_numpy(), a["home"].to_numpy() != list_
        cls = np.unique(np.concatenate([q_cls, m_cls]))
        q_at, m_at = np.searchsorted(cls, q_cls), np.searchsorted(cls, m_cls)
        count, label = np.zeros(len(cls), np.int64), np.arange(len(cls))
        for k in range(0, len(q), TABLES):
            part = slice(k, k + TABLES)
            hit = links(q[part], x, quantiser.near(list_, q[part], codes, error), threshold)
            hit &= q_cls[part, None] != m_cls
            np.add.at(count, q_at[part], hit @ size)
            count[m_at] += many[part] @ (hit & guest[part, None])       # a member's own list does not probe back
            i, j = np.nonzero(hit)
            if len(i):                                                   # groups so far, and the new links
                i, j = label[q_at[part][i]], label[m_at[j]]
                label = stars(len(cls), i, j)[label]
        own = np.flatnonzero(label != np.arange(len(cls)))
        some = np.flatnonzero(count)
        return _found(np.concatenate([cls[own], cls[some]]), cls[label[own]], count[some])

    by = ["label", "list", "m", "q"]
    return written(members.groupBy(*by).cogroup(asks.groupBy(*by)).applyInArrow(compare, "a long, b long, n long"), "pq-links")


def _found(a, b, n) -> pa.Table:
    """Links (a, b), then counts (a, n), as one table."""
    return pa.table([pa.array(a, pa.int64()), pa.array([*b, *[None] * len(n)], pa.int64()),
                     pa.array([*[None] * len(b), *n], pa.int64())], names=["a", "b", "n"])


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id (the least vec_id that links reach),
    kept."""
    importable(embeddings.sparkSession)
    able, unable, classes = classes_of(embeddings)
    alone = unable.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    quantiser = fit(classes, threshold)
    rows = alone
    if quantiser is not None:
        pairs = found(index(classes, quantiser), quantiser, threshold, block)
        counts = pairs.filter("b is null").groupBy("a").agg(F.sum("n").alias("others"))
        roots = components(pairs.filter("b is not null").select("a", "b"))
        all_ = (classes.join(counts, F.col("cls") == counts["a"], "left").drop("a")
                .join(roots, F.col("cls") == roots["a"], "left")
                .select("cls", "label", "v", "first", F.coalesce("b", "cls").alias("root"),
                        (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links")))
        all_ = written(all_, "vector-groups")
        least = all_.groupBy("root").agg(F.min("first").alias("component_id"))
        rows = (able.join(all_.join(least, "root").select("label", "v", "n_links", "component_id"), ["label", "v"])
                .select("vec_id", "n_links", "component_id").unionByName(alone))
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def oracle() -> str:
    """DuckDB SQL for the query: every pair of a label, and what links reach."""
    return f"""
    WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
            coalesce(label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                     AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS able FROM embeddings),
    pairs AS (SELECT a.r, a.vec_id, b.r AS s, b.vec_id AS other FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r
        WHERE a.able AND b.able AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
    reach AS (SELECT r, s FROM pairs UNION SELECT reach.r, pairs.s FROM reach JOIN pairs ON reach.s = pairs.r),
    least AS (SELECT reach.r, min(v.vec_id) AS low FROM reach JOIN v ON v.r = reach.s GROUP BY reach.r),
    counts AS (SELECT r, count(*) AS n FROM pairs GROUP BY r)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, low) AS component_id,
        vec_id IS NOT DISTINCT FROM least(vec_id, low) AS kept
    FROM v LEFT JOIN counts USING (r) LEFT JOIN least USING (r)"""
