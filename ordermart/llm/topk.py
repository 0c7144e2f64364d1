"""Exact top-k inner products with a pivot-distance index.

Vectors are mapped to a sphere on which a larger inner product is a smaller
distance: x gets one more component so that its length is M, the largest
length there is, and a query is scaled to length M. ``PIVOTS`` pivots are
chosen from a bounded sample of ``SAMPLE`` vectors (farthest first); every
vector is keyed by its nearest pivot and the distance to it. The index is
sorted by (pivot, distance) and written in chunks of ``CHUNK`` vectors: each
is an annulus of one pivot, with its least and greatest distance. Vectors of
one distance, such as copies, fill many chunks.

Queries are packed into blocks in the same order. The triangle inequality
bounds the score that any vector of a chunk can reach for any query of a
block. The annuli at a block's own distance, of its ``NEAR`` nearest pivots,
are expanded first and give each query a lower bound for its k-th score. That
bound is a distance: of each pivot only annuli within it of the block's range
can hold better scores. They are neighbours in the sorted index, so a pair of
positions, found by merging the ends of the interval with the annuli, names
them; pairs beyond it are never made. Comparing is a matrix product; only
scores that reach the query's bound leave a task, and the k best of each
query are kept by a sort in bounded groups.

Rows: vectors that are null or hold a null or non-finite component take no
part, nor do rows without an id; shorter vectors count as filled up with
zeros; repeated rows of one id and vector count once, and a query's own id
is never its partner; zero vectors score 0 with everyone; an empty table
gives no rows; extra columns are ignored. Scores are exact integers (they
must fit 64 bits); ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import importable, sample, written

K, EVERY, SCALE = 20, 20, 64
PIVOTS, SAMPLE = 32, 2048
CHUNK, QUERY_BLOCK = 1024, 256
NEAR = 4                                # pivots whose annuli at a block's distance are expanded first
_SLACK = 1e-6                           # of M: what rounding can do to a distance


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and v: floor(SCALE * x) of each component, as doubles."""
    x = F.col("embedding")
    return (embeddings.filter(F.col("vec_id").isNotNull() & x.isNotNull())
            .filter(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("double")).alias("v"))
            .dropDuplicates(["vec_id", "v"]))


class Space:
    """The sphere: its radius, the dimension, and the pivots on it."""

    def __init__(self, dim: int, longest: float, sample: np.ndarray):
        self.dim, self.radius = dim, max(longest, 1e-9)
        points = self.lift(sample)
        chosen = [0]
        gap = np.linalg.norm(points - points[0], axis=1)
        while len(chosen) < min(PIVOTS, len(points)) and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, np.linalg.norm(points - points[chosen[-1]], axis=1))
        self.pivots = points[chosen]

    def matrix(self, vectors: list) -> np.ndarray:
        out = np.zeros((len(vectors), self.dim))
        for row, v in zip(out, vectors):
            row[:len(v)] = v
        return out

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.radius ** 2 - (x * x).sum(axis=1), 0.0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def aim(self, q: np.ndarray) -> np.ndarray:
        """Queries on the sphere; a zero query may stand anywhere."""
        size = np.linalg.norm(q, axis=1)
        out = np.hstack([q * (self.radius / np.where(size > 0, size, 1.0))[:, None], np.zeros((len(q), 1))])
        out[size == 0, -1] = self.radius
        return out

    def distances(self, points: np.ndarray) -> np.ndarray:
        """To every pivot."""
        square = (points ** 2).sum(axis=1)[:, None] + (self.pivots ** 2).sum(axis=1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(square, 0.0))


def _fit(vectors: DataFrame) -> Space | None:
    size = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    dim, longest, n = vectors.agg(F.max(F.size("v")), F.max(size), F.count("*")).first()
    if dim is None:
        return None
    few = [r["v"] for r in sample(vectors, F.col("vec_id"), SAMPLE, n).collect()]
    x = np.zeros((len(few), dim))
    for row, v in zip(x, few):
        row[:len(v)] = v
    return Space(dim, float(np.sqrt(longest)), x)


def _keyed(vectors: DataFrame, space: Space, queries: bool) -> DataFrame:
    """vec_id, v, and the key: pivot (the nearest) and distance to it."""
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = space.matrix(b.column(1).to_pylist())
            d = space.distances(space.aim(x) if queries else space.lift(x))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(d.argmin(axis=1), pa.int32()), pa.array(d.min(axis=1))],
                names=["vec_id", "v", "pivot", "distance"])

    return vectors.mapInArrow(key, "vec_id long, v array<double>, pivot int, distance double")


def _packed(keyed: DataFrame, space: Space, most: int, queries: bool, name: str) -> DataFrame:
    """Chunks of at most ``most`` neighbours in (pivot, distance) order: ids
    and matrix as binary. Chunks of vectors have their annulus; blocks of
    queries have, for every pivot, the range of their distances, and the
    length of their longest query."""
    ordered = keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, rest = TaskContext.get().partitionId() << 32, None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            pivots = t["pivot"].to_numpy()
            cuts = [0]
            for end in [*(np.flatnonzero(pivots[1:] != pivots[:-1]) + 1).tolist(), len(pivots)]:
                cuts += [*range(cuts[-1] + most, end, most), end]
            for lo, hi in zip(cuts[:-2], cuts[1:-1]):
                yield chunk(t.slice(lo, hi - lo), number)
                number += 1
            rest = t.slice(cuts[-2]) if cuts[-1] > cuts[-2] else None
        if rest is not None and len(rest):
            yield chunk(rest, number)

    def chunk(t: pa.Table, number: int) -> pa.RecordBatch:
        x = space.matrix(t["v"].to_pylist())
        d = space.distances(space.aim(x) if queries else space.lift(x))
        own = t["pivot"][0].as_py()
        ranges = [(k, lo, hi) for k, (lo, hi) in enumerate(zip(d.min(axis=0).tolist(), d.max(axis=0).tolist()))]
        if not queries:
            ranges = [ranges[own]]
        kind = pa.list_(pa.struct([("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))
        sizes = np.linalg.norm(x, axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([t["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
             pa.array([x.astype("<f8").tobytes()], pa.binary()),
             pa.array([[dict(zip(("pivot", "low", "high"), r)) for r in ranges]], kind), pa.array([float(sizes.max())])],
            names=["chunk", "ids", "x", "ranges", "longest"])

    return written(ordered.select("vec_id", "v", "pivot").mapInArrow(
        pack, "chunk long, ids binary, x binary, ranges array<struct<pivot:int,low:double,high:double>>, longest double"),
        name)


def _annuli(chunks: DataFrame) -> DataFrame:
    """chunk, pivot, low, high, seq: the annuli of each pivot numbered from 1
    in the order of the index."""
    order = Window.partitionBy("pivot").orderBy("chunk")
    return (chunks.select("chunk", F.col("ranges")[0].alias("c")).select("chunk", "c.pivot", "c.low", "c.high")
            .withColumn("seq", F.row_number().over(order)))


def _upto(asked: DataFrame, at: Column, annuli: DataFrame, end: str, name: str, ties: bool) -> DataFrame:
    """``asked`` (with pivot) and how many annuli of the pivot have their
    ``end`` below the distance ``at``, or at it with ``ties``: both are
    merged in one order, one sort per pivot over what describes them."""
    fields = asked.columns
    both = (asked.select(F.struct(*fields).alias("row"), "pivot", at.alias("_at"), F.lit(0 if ties else -2).alias("_kind"))
            .unionByName(annuli.select(F.lit(None).cast(f"struct<{_fields(asked)}>").alias("row"), "pivot",
                                       F.col(end).alias("_at"), F.lit(-1).alias("_kind"))))
    order = Window.partitionBy("pivot").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    counted = both.withColumn(name, F.count(F.when(F.col("row").isNull(), 1)).over(order).cast("int"))
    return counted.filter(F.col("row").isNotNull()).select("row.*", name)


def _fields(df: DataFrame) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)


def _compared(pairs: DataFrame, blocks: DataFrame, chunks: DataFrame, space: Space) -> DataFrame:
    """The k best of each pair of query block and chunk, of those that reach
    the query's bound: query_id, vec_id, score. ``pairs``: block, chunk."""
    rows = (pairs.join(chunks.select("chunk", F.col("ids").alias("c_ids"), F.col("x").alias("c_x")), "chunk")
            .join(blocks.select(F.col("chunk").alias("block"), F.col("ids").alias("q_ids"), F.col("x").alias("q_x"),
                                "bounds"), "block").select("q_ids", "q_x", "bounds", "c_ids", "c_x"))
    dim = space.dim

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                q_ids, c_ids = (np.frombuffer(b.column(c)[k].as_py(), "<i8") for c in (0, 3))
                q, x = (np.frombuffer(b.column(c)[k].as_py(), "<f8").reshape(-1, dim) for c in (1, 4))
                bound = np.frombuffer(b.column(2)[k].as_py(), "<i8") if b.column(2)[k].is_valid else None
                yield best(q_ids, q, c_ids, x, bound)

    def best(q_ids, q, c_ids, x, bound) -> pa.RecordBatch:
        if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * dim < 2.0 ** 53:
            score = (q @ x.T).astype(np.int64)
        else:                                            # too large for exact doubles
            exact = lambda m: np.array([[int(c) for c in row] for row in m], dtype=object)
            score = (exact(q) @ exact(x).T).astype(np.int64)
        fit = q_ids[:, None] != c_ids
        if bound is not None:
            fit &= score >= bound[:, None]
        rows, cols = np.nonzero(fit)
        order = np.lexsort((c_ids[cols], -score[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        rows, cols = rows[place < K], cols[place < K]
        return pa.RecordBatch.from_arrays([pa.array(q_ids[rows]), pa.array(c_ids[cols]), pa.array(score[rows, cols])],
                                          names=["query_id", "vec_id", "score"])

    return rows.mapInArrow(compare, "query_id long, vec_id long, score long")


def _top(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= K)


def search(embeddings: DataFrame, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible
    by ``every`` the K best others."""
    spark = importable(embeddings.sparkSession)
    out = "query_id long, rank int, vec_id long, score long"
    vectors = written(integer_vectors(embeddings), "integer-vectors")
    space = _fit(vectors)
    if space is None:
        return spark.createDataFrame([], out)
    chunks = _packed(_keyed(vectors, space, False), space, CHUNK, False, "annuli")
    asked = vectors.filter(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = _packed(_keyed(asked, space, True), space, QUERY_BLOCK, True, "query-blocks")
    annuli = written(_annuli(chunks), "annuli-by-pivot")
    # the annuli around a block's own distance to its nearest pivot, and at its distance to the next ones
    near = F.slice(F.array_sort(F.transform("ranges", lambda r: F.struct(r["high"], r["low"], r["pivot"]))), 1, NEAR)
    asked = (blocks.select(F.col("chunk").alias("block"), F.posexplode(near).alias("place", "r"))
             .select("block", "place", "r.pivot", "r.low"))
    around = F.when(F.col("place") == 0, F.array(*map(F.lit, (-1, 0, 1)))).otherwise(F.array(F.lit(0)))
    begun = (_upto(asked, F.col("low"), annuli, "low", "seq", True).withColumn("by", F.explode(around))
             .select("block", "pivot", (F.greatest("seq", F.lit(1)) + F.col("by")).alias("seq")))
    pairs = written(begun.join(annuli, ["pivot", "seq"]).select("block", "chunk"), "first-pairs")
    open_ = blocks.withColumn("bounds", F.lit(None).cast("binary"))
    first = written(_top(_compared(pairs, open_, chunks, space)).drop("rank"), "first-annuli")
    # the k-th score so far bounds a query; a query with fewer than k has no bound
    bound = (first.groupBy("query_id").agg(F.min("score").alias("score"), F.count("*").alias("n"))
             .select("query_id", F.when(F.col("n") >= K, F.col("score")).otherwise(-(2 ** 63)).alias("bound")))
    bounded = written(_with_bounds(blocks, bound), "bounded-blocks")
    rest = _within(bounded, blocks, annuli, space).join(pairs, ["block", "chunk"], "left_anti")
    second = _compared(rest, bounded, chunks, space)
    return _top(first.unionByName(second)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _within(bounded: DataFrame, blocks: DataFrame, annuli: DataFrame, space: Space) -> DataFrame:
    """block, chunk: the annuli that can hold a score as good as a bound. At
    distance d a vector reaches length * (M - d * d / 2M), so d is at most
    ``reach``; of each pivot these annuli follow one another."""
    radius, slack = space.radius, _SLACK * space.radius
    reach = F.sqrt(F.greatest(F.lit(2 * radius) * (F.lit(radius) - F.col("share") + F.lit(slack)), F.lit(0.0))) + F.lit(slack)
    asked = (blocks.select("chunk", F.explode("ranges").alias("q")).join(bounded.select("chunk", reach.alias("reach")), "chunk")
             .select(F.col("chunk").alias("block"), "q.pivot", (F.col("q.low") - F.col("reach")).alias("low"),
                     (F.col("q.high") + F.col("reach")).alias("high")))
    asked = _upto(asked, F.col("low"), annuli, "high", "before", False)
    asked = _upto(asked, F.col("high"), annuli, "low", "last", True)
    seq = F.explode(F.sequence(F.col("before") + 1, F.col("last"))).alias("seq")
    return asked.filter("last > before").select("block", "pivot", seq).join(annuli, ["pivot", "seq"]).select("block", "chunk")


def _with_bounds(blocks: DataFrame, bound: DataFrame) -> DataFrame:
    """Blocks with their queries' bounds in order, and the least of bound /
    length: a vector at distance d reaches length * (M - d * d / 2M)."""
    members = blocks.select("chunk", "ids", "x", "longest")

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                own = np.frombuffer(b.column(1)[k].as_py(), "<i8")
                x = np.frombuffer(b.column(2)[k].as_py(), "<f8").reshape(len(own), -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column(0)[k].as_py()] * len(own)), pa.array(range(len(own)), pa.int32()),
                     pa.array(own), pa.array(np.linalg.norm(x, axis=1))], names=["chunk", "at", "query_id", "size"])

    each = members.select("chunk", "ids", "x").mapInArrow(ids, "chunk long, at int, query_id long, size double")
    each = each.join(bound, "query_id", "left").select("chunk", "at", "size",
                                                       F.coalesce("bound", F.lit(-(2 ** 63))).alias("bound"))
    rows = each.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "size", "bound"))).alias("each"))
    joined = members.join(rows, "chunk")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.to_pylist()
            bounds = [np.array([e["bound"] for e in r["each"]], "<i8") for r in t]
            share = [min((e["bound"] / e["size"] if e["size"] > 0 else -1e300) for e in r["each"]) for r in t]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([x.tobytes() for x in bounds], pa.binary()),
                 pa.array(share, pa.float64())], names=["chunk", "ids", "x", "bounds", "share"])

    return joined.select("chunk", "ids", "x", "each").mapInArrow(
        pack, "chunk long, ids binary, x binary, bounds binary, share double")


def oracle() -> str:
    """DuckDB SQL for the query: every pair is scored."""
    return f"""
    WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= {K}"""
