"""Mixing sources to target weights, with a hypergeometric splitting tree.

Each source's documents are laid end to end in a hashed order and divided
into blocks of ``block_words`` words. A source's target says how many of its
words the mix takes; the first whole pass over the source comes first, what
is above it is a second pass. A pass visits the blocks in a keyed
permutation, so the blocks drawn are a random, disjoint choice, and the last
one may be cut, so targets are met to the word. Blocks are twice as long, or
four times and so on, where the mix would otherwise have ``MOST_BLOCKS``
(beyond about 8 * 10**12 words).

The drawn blocks go to output shards: a tree halves the shards again and
again, and at each node a multivariate hypergeometric draw splits the exact
quota of every source between the halves. The draw of a node depends only on
the seed and the node, so a task finds the shard of a block by walking the
tree, without a table of all shards. Within a shard, blocks are ordered by a
hash (the local shuffle). ``mix`` deals its rows to one task for each range
of shards and sorts them there by shard, position and word of the source, so
its partitions, in order, are the shards in order.

Sizes and offsets come from sums over hashed buckets of a source, so a
source with a third of all rows is spread over many tasks; only one row per
source (its size) is gathered on the driver. Reruns agree: every choice
hangs on the seed and the rows alone.

Rows: a null text has size 0 and is never taken; a null source is a source
of its own, the last in order; rows that agree in id, source and text are
interchangeable, each is counted; an empty table gives no rows; ``mix`` keeps
extra columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, importable, shielded, written
from .fill_middle import BlockTree

WEIGHTS, SHARE, MAX_REPEAT = (5, 2, 1), 1.5, 2.0
BLOCK_WORDS, SHARD_BLOCKS, SEED = 8192, 128, 17
BUCKET_ROWS = 512
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TREE_BYTES = 32 << 20       # of tree nodes a task remembers
TASK_SHARDS = 16            # most shards one task sorts, where there are more than shuffle partitions
MOST_BLOCKS = 10 ** 9       # numpy's hypergeometric draws are exact below this


def targets(sizes: list[int], weights: tuple = WEIGHTS, share: float = SHARE, most: float = MAX_REPEAT) -> list[float]:
    """Words to take from each source, in order: ``share`` of all words by
    weight; a target above ``most`` times its source stops there and what is
    over is shared among the others by weight, until none is above."""
    out = [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    left = share * sum(sizes)
    while open_:
        total = sum(weights[i % len(weights)] for i in open_)
        full = [i for i in open_ if left * weights[i % len(weights)] / total > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i % len(weights)] / total
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        open_.difference_update(full)
    return out


def _key(*parts) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little")


class Permutation:
    """A keyed one-to-one map of [0, n): a Feistel network over the next even
    number of bits, applied again while the result is not below n."""

    def __init__(self, n: int, *key):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = [_key("feistel", r, *key) for r in range(6)]

    def __call__(self, x: int) -> int:
        mask = (1 << self.half) - 1
        while True:
            a, b = x >> self.half, x & mask
            for k in self.keys:
                v = (b + k) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
                v = (v ^ v >> 29) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
                a, b = b, a ^ (v >> 32 & mask)
            x = a << self.half | b
            if x < self.n:
                return x


class Plan:
    """What the tasks need: sizes and targets by source, the block quotas,
    and the tree. One entry per source; nothing grows with the documents."""

    def __init__(self, sizes: dict[str | None, int], *, weights: tuple = WEIGHTS, share: float = SHARE,
                 most: float = MAX_REPEAT, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS,
                 seed: int = SEED):
        order = sorted(sizes, key=lambda s: (s is None, s or ""))        # code points, null last
        self.index = {s: i for i, s in enumerate(order)}
        self.sizes = [sizes[s] for s in order]
        self.targets = targets(self.sizes, weights, share, most)
        self.words = [min(round(t), math.floor(most * n)) for t, n in zip(self.targets, self.sizes)]
        self.block, self.seed = block_words, seed
        while sum(words // self.block for words in self.words) + 3 * len(order) >= MOST_BLOCKS:
            self.block *= 2
        self.per_pass = [-(-n // self.block) for n in self.sizes]
        self.quota = [self._blocks(i) for i in range(len(order))]
        self.total = sum(self.quota)
        self.shards = max(1, -(-self.total // shard_blocks))
        self._tree: dict[tuple[int, int], np.ndarray] = {}
        self._permutations: dict[tuple[int, int], Permutation] = {}

    def _blocks(self, i: int) -> int:
        """Drawn blocks of a source; the last block of a pass may be short."""
        n, words = self.sizes[i], self.words[i]
        passes, rest = divmod(words, n) if n else (0, 0)
        return passes * self.per_pass[i] + -(-rest // self.block)

    def _rank(self, i: int, epoch: int, block: int) -> int:
        """When a pass visits a block; the short one at the end comes last."""
        full = self.sizes[i] // self.block
        if block >= full:
            return block
        if (i, epoch) not in self._permutations:
            self._permutations[i, epoch] = Permutation(full, self.seed, i, epoch)
        return self._permutations[i, epoch](block)

    def shard(self, i: int, draw: int) -> int:
        """Walk the tree from the root to the shard of a source's draw."""
        lo, hi, quota = 0, self.shards, np.array(self.quota, np.int64)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            left = self._tree.get((lo, hi))
            if left is None:
                if len(self._tree) * (8 * len(self.quota) + 300) >= TREE_BYTES:
                    self._tree.clear()
                room = self.total * mid // self.shards - self.total * lo // self.shards
                rng = np.random.Generator(np.random.PCG64(_key("node", self.seed, lo, hi)))
                left = self._tree[lo, hi] = rng.multivariate_hypergeometric(quota, room, method="marginals")
            if draw < left[i]:
                hi, quota = mid, left
            else:
                draw, lo, quota = draw - int(left[i]), mid, quota - left
        return lo

    def spans(self, source: str | None, offset: int, size: int) -> list[tuple[int, int, int, int]]:
        """(shard, position, first word, words) of each part of a document
        that the mix takes. ``offset``: words of its source before it."""
        i = self.index[source]
        n, out = self.sizes[i], []
        if not size:
            return out
        for block in range(offset // self.block, (offset + size - 1) // self.block + 1):
            lo, hi = max(offset, block * self.block), min(offset + size, (block + 1) * self.block)
            for epoch in range(-(-self.words[i] // n)):
                rank = self._rank(i, epoch, block)
                end = min(hi, block * self.block + self.words[i] - epoch * n - rank * self.block)
                if end > lo:
                    draw = epoch * self.per_pass[i] + rank
                    out.append((self.shard(i, draw), _key("place", self.seed, i, draw) >> 1, lo - offset, end - lo))
        return out


def _placed(docs: DataFrame, text: str, source: str, id_col: str, seed: int) -> tuple[DataFrame, dict[str | None, int]]:
    """``docs`` with _mix_size, _mix_source and _mix_offset (words of the
    source before the row, in the order of hashed buckets and hashes), and
    each source's size."""
    rows = docs.withColumns({
        "_mix_size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "_mix_source": F.col(source).cast("string"),
        "_mix_key": F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")),
        "_mix_hash": F.xxhash64(F.lit(seed), id_col, source, text)})
    sums = written(rows.groupBy("_mix_source", "_mix_key", F.pmod("_mix_hash", F.lit(1 << 16)).alias("fine"))
                   .agg(F.sum("_mix_size").alias("words"), F.count("*").alias("n")), "mix-sizes")
    by_source = sums.groupBy("_mix_source").agg(F.sum("words").alias("words"), F.sum("n").alias("n")).collect()
    buckets = min(1 << 16, -(-max([1, *(r["n"] for r in by_source)]) // BUCKET_ROWS))
    bucket = lambda h: F.floor(h * buckets / (1 << 16)).cast("int")
    own = sums.groupBy("_mix_key", bucket(F.col("fine")).alias("_mix_bucket")).agg(F.sum("words").alias("words"))
    before = F.sum("words").over(Window.partitionBy("_mix_key").orderBy("_mix_bucket")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    starts = own.select("_mix_key", "_mix_bucket", F.coalesce(before, F.lit(0)).alias("_mix_start"))
    rows = rows.withColumn("_mix_bucket", bucket(F.pmod("_mix_hash", F.lit(1 << 16))))
    inside = F.sum("_mix_size").over(Window.partitionBy("_mix_key", "_mix_bucket").orderBy("_mix_hash", id_col, "_mix_size")
                                     .rowsBetween(Window.unboundedPreceding, -1))
    rows = (rows.join(starts, ["_mix_key", "_mix_bucket"])
            .withColumn("_mix_offset", F.col("_mix_start") + F.coalesce(inside, F.lit(0))))
    return rows, {r["_mix_source"]: r["words"] for r in by_source}


def taken(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its
    source's), taken (words the mix takes, repeats counted), and of each span
    taken, in shard and position order, its place in the mix: shards,
    positions."""
    importable(docs.sparkSession)
    rows, sizes = _placed(docs.select(id_col, text, source), text, source, id_col, options.get("seed", SEED))
    plan = Plan(sizes, **options)
    rows = rows.select(F.col(id_col).alias("doc_id"), "_mix_source", "_mix_size", "_mix_offset")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = list(zip(*(b.column(k).to_pylist() for k in (1, 2, 3))))
            index = [plan.index[s] for s, _, _ in own]
            spans = [sorted(plan.spans(s, at, n)) for s, n, at in own]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([plan.sizes[i] for i in index], pa.int64()),
                 pa.array([plan.targets[i] for i in index], pa.float64()),
                 pa.array([sum(x[3] for x in found) for found in spans], pa.int64()),
                 *(pa.array([[x[k] for x in found] for found in spans], pa.list_(pa.int64())) for k in (0, 1))],
                names=["doc_id", "size", "source_size", "target", "taken", "shards", "positions"])

    return rows.mapInArrow(count, T.StructType([
        rows.schema["doc_id"], T.StructField("size", T.LongType()), T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()), T.StructField("taken", T.LongType()),
        T.StructField("shards", T.ArrayType(T.LongType())), T.StructField("positions", T.ArrayType(T.LongType()))]))


class Words:
    """Cuts a text from one word to another, with what stands between them.
    A tree over blocks of the text is built once, so a cut costs what it
    gives, however long the text and however many its cuts."""

    def __init__(self, text: str, size: int):
        self.text, self.size = text, size
        self.data, self.tree = b"", None

    def cut(self, first: int, words: int) -> str:
        if words == self.size:
            return self.text
        if self.tree is None:
            self.data = self.text.encode("utf-8", "surrogatepass")
            self.tree = BlockTree(self.data)
        start = _WORD.search(self.data, self.tree.cut(first)[0]).start()
        return self.data[start:self.tree.cut(first + words)[0]].decode("utf-8", "surrogatepass")


def mix(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", places: bool = False,
        **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row for each span taken,
    with its text cut to the span; with ``places`` also mix_shard and
    mix_position. Rows stand in the order of shards and of positions within
    a shard; a shard lies in one partition."""
    importable(docs.sparkSession)
    shield, names = shielded(docs, text, source, id_col)
    placed, sizes = _placed(shield, text, source, id_col, options.get("seed", SEED))
    plan = Plan(sizes, **options)
    rows = placed.select(*names, "_mix_source", "_mix_size", "_mix_offset")
    at, width = names.index(text), len(names)
    schema = T.StructType([*rows.schema.fields[:width], T.StructField("_mix_shard", T.LongType()),
                           T.StructField("_mix_position", T.LongType()), T.StructField("_mix_word", T.LongType())])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, which, cut, shard, place, word = b.column(at).to_pylist(), [], [], [], [], []
            own = zip(*(b.column(width + k).to_pylist() for k in range(3)))
            for k, (s, n, offset) in enumerate(own):
                part = Words(texts[k], n)
                for to, position, first, words in plan.spans(s, offset, n):
                    which.append(k)
                    cut.append(part.cut(first, words))
                    shard.append(to)
                    place.append(position)
                    word.append(offset + first)
            index = pa.array(which, pa.int64())
            columns = [b.column(k).take(index) for k in range(width)]
            columns[at] = pa.array(cut, b.column(at).type)
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int64()) for x in (shard, place, word))],
                                             names=schema.fieldNames())

    tasks = min(plan.shards, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                 -(-plan.shards // TASK_SHARDS)))
    task = F.floor(F.col("_mix_shard") * tasks / plan.shards).cast("int")    # exact: no product reaches 2**53
    mixed = (rows.mapInArrow(draw, schema).repartitionById(tasks, task)
             .sortWithinPartitions("_mix_shard", "_mix_position", "_mix_word"))
    if places:
        return mixed.drop("_mix_word").toDF(*docs.columns, "mix_shard", "mix_position")
    return mixed.select(*names).toDF(*docs.columns)
