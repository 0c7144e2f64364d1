"""SimHash near-duplicates, compared bit-sliced.

Fingerprints come from whole texts: a bit is set when it is set in over half
of the XXH64 hashes of the word shingles. Documents with one fingerprint are
one class, so copies are never compared. Two fingerprints that differ in at
most ``radius`` bits agree in at least two of ``radius + 2`` bit bands; every
fingerprint is sent to the groups of all pairs of bands, and groups are
compared inside tasks: bit planes are stored vertically (64 fingerprints to
a word), carry-save counters add up the differing bits of 64 pairs at a
time, and blocks of lanes are given up as soon as all of them exceed the
radius. Groups over ``BLOCK`` fingerprints are dealt out as pairs of hashed
blocks, so no task holds a whole large group. A task emits one link per
linked fingerprint, not the pairs; components follow by alternating large
and small stars, each round written to the shared folder.

Rows: null, empty and blank texts have fingerprint zero and are linked like
any other; fewer words than a shingle are one shingle; repeated rows are in
one class; null ids never name a component that has another id; an empty
table gives no rows. Extra columns are ignored by ``near_duplicates`` and
kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, shielded, written

SHINGLE, RADIUS, SEED = 3, 2, 42
BLOCK = 2048                # fingerprints of a group that one side of a comparison holds
LANES = 512                 # small groups are compared together, so many fingerprints at a time
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    starts, ends = (end - size)[:len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        part = h[k:k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """All columns of ``docs`` and: _fp (the fingerprint as a signed long)
    and _row (a number of its own for each row)."""
    importable(docs.sparkSession)
    at, names = docs.columns.index("text"), [*docs.columns, "_fp", "_row"]
    schema = T.StructType([*docs.schema.fields, T.StructField("_fp", T.LongType()), T.StructField("_row", T.LongType())])

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 40
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(at).to_pylist()], np.uint64).view(np.int64)
            row = np.arange(first, first + b.num_rows)
            first += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp), pa.array(row)], names=names)

    return docs.mapInArrow(tag, schema)


def close_pairs(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of fingerprints that differ in at most ``radius``
    bits, found with bit planes and carry-save counters."""
    n, words = len(fps), -(-len(fps) // 64)
    lanes = np.zeros(words * 64, np.uint64)
    lanes[:n] = fps
    bits = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")     # 64 x words
    flip = np.where(bits[:n].T == 1, _ONES, np.uint64(0))                                         # 64 x n
    i = np.repeat(np.arange(n), words)                       # a block: one fingerprint against one word of lanes
    w = np.tile(np.arange(words), n)
    lane = np.arange(words * 64)
    after = np.packbits((lane[None, :] > np.arange(n)[:, None]) & (lane < n), axis=1, bitorder="little").view("<u8")
    gone = ~after.reshape(-1)                                # lanes that no longer count; first those not after i
    counters = [np.zeros(len(i), np.uint64) for _ in range((radius + 1).bit_length())]
    for b in range(64):
        if b % 8 == 0:                                       # give up blocks whose lanes all exceed the radius
            live = np.flatnonzero(gone != _ONES)
            if len(live) < len(i):
                i, w, gone, counters = i[live], w[live], gone[live], [c[live] for c in counters]
        carry = planes[b][w] ^ flip[b][i]
        for k, c in enumerate(counters):
            counters[k], carry = c ^ carry, c & carry
        gone = gone | carry | _exceeds(counters, radius)
    keep = np.flatnonzero(gone != _ONES)
    inside = np.unpackbits((~gone[keep]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    block, bit = np.nonzero(inside)
    return i[keep][block], w[keep][block] * 64 + bit


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over the radius (a bitwise comparison)."""
    over, equal = np.zeros_like(counters[0]), np.full_like(counters[0], _ONES)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            over |= equal & counters[k]
            equal = equal & ~counters[k]
    return over


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n items the smallest item that links reach."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(classes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of column _fp: their
    components are those of all pairs within the radius."""
    importable(classes.sparkSession)
    bands = radius + 2
    edge = [64 * k // bands for k in range(bands + 1)]
    part = [F.shiftrightunsigned("_fp", edge[k]).bitwiseAND((1 << (edge[k + 1] - edge[k])) - 1) for k in range(bands)]
    groups = F.array(*[F.struct(F.lit(n).alias("pair"), part[x].alias("x"), part[y].alias("y"))
                       for n, (x, y) in enumerate(combinations(range(bands), 2))])
    rows = classes.select("_fp", F.explode(groups).alias("g")).select("_fp", F.xxhash64("g.pair", "g.x", "g.y").alias("g"))
    # groups of one key need no comparison; large ones are dealt out by blocks
    sizes = rows.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = (rows.join(sizes, "g").withColumn("own", F.pmod(F.xxhash64("_fp", F.lit(1)), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("_fp", "g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    dealt = dealt.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rest = np.empty((0, 4), np.int64)
        for b in batches:
            t = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], axis=1)
            t = np.concatenate([rest, t])
            cuts = np.flatnonzero((t[1:, 1:] != t[:-1, 1:]).any(axis=1)) + 1
            if not len(cuts):
                rest = t
                continue
            runs, rest = np.split(t[:cuts[-1], 0], cuts[:-1]), t[cuts[-1]:]
            for run in runs:
                held.append(run)
                if sum(map(len, held)) >= LANES:
                    yield _links_of(held, radius)
                    held = []
        held.append(rest[:, 0])
        yield _links_of(held, radius)

    return dealt.select("_fp", "g", "i", "j").mapInArrow(compare, "a long, b long").distinct()


def _links_of(runs: list[np.ndarray], radius: int) -> pa.RecordBatch:
    """One link per linked fingerprint of some groups. Fingerprints of
    different groups may be linked too: the bits decide, not the group."""
    fps = np.unique(np.concatenate(runs))
    label = stars(len(fps), *close_pairs(fps.view(np.uint64), radius)) if len(fps) > 1 else np.arange(len(fps))
    own = np.flatnonzero(label != np.arange(len(fps)))
    return pa.RecordBatch.from_arrays([pa.array(fps[own]), pa.array(fps[label[own]])], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each vertex of the edges that is not its component's smallest,
    and that smallest. Alternates large and small stars until nothing
    changes; a vertex of many edges is aggregated before it is shuffled."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = written(small, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now


def _classes(tagged: DataFrame, radius: int) -> DataFrame:
    """_fp and first: the smallest (id, row) of the component."""
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("_row").alias("row"))
    own = written(tagged.groupBy("_fp").agg(F.min(first).alias("own")), "fingerprint-classes")
    roots = components(links(own, radius))
    all_ = own.join(roots.select(F.col("a").alias("_fp"), F.col("b").alias("root")), "_fp", "left")
    all_ = all_.select("_fp", F.coalesce("root", "_fp").alias("root"), "own")
    least = all_.groupBy("root").agg(F.min("own").alias("first"))
    return written(all_.join(least, "root").select("_fp", "first"), "fingerprint-components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest id
    that links of at most ``radius`` bits reach)."""
    tagged = written(fingerprints(docs.select("doc_id", F.col("text").cast("string").alias("text")), shingle)
                     .select("doc_id", "_fp", "_row"), "fingerprints")
    found = tagged.join(_classes(tagged, radius), "_fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
                        F.col("first.doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that are first in their component, one of each."""
    rows, names = shielded(docs, "doc_id", "text")
    tagged = written(fingerprints(rows, shingle), "tagged-documents")
    kept = _classes(tagged.select("doc_id", "_fp", "_row"), radius).select(F.col("first.row").alias("_row")).distinct()
    return tagged.join(kept, "_row", "left_semi").select(*names).toDF(*docs.columns)
