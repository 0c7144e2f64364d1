"""Token ids in binary shards, each a wavelet matrix in one compressed file.

The documents are range-partitioned by id and sorted, each task tokenizes
its range and writes shards of about ``shard_tokens`` ids (a document is
never split). A file holds the document table and, for every bit of the
vocabulary from the highest down, one bit plane with a rank directory; each
section is compressed on its own. From one file ``WaveletMatrix`` answers
``access(i)``, ``rank(c, i)``, ``count(c)``, ``positions(c)`` (select) and
``decode()`` without other data.

Files are written under names of their own for each task attempt into the
shared folder; the manifest that the job returns names those of the attempts
that counted, so retried or lost tasks leave nothing that is read. Reading
goes through Spark's ``binaryFile`` source, one shard at a time per task.

Rows: null or empty texts have the end id only; repeated ids stay apart, in
the order of (id, hash of the text); null ids come first; an empty table has
no shards; extra columns are ignored. Ids must be integers.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import importable, shared_folder, written

MAGIC = b"WVMX0001"
RANK_BITS = 512             # one directory entry for so many bits
SHARD_TOKENS = 2_000_000


class WaveletMatrix:
    """The sequence of one shard. Levels go from the highest bit down; level
    k's plane is in the order that the stable partitions above it left."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray, bits: int | None = None) -> "WaveletMatrix":
        bits = bits or max(1, int(ids.max(initial=0)).bit_length())
        cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for b in range(bits - 1, -1, -1):
            mask = (cur & cur.dtype.type(1 << b)) != 0
            plane = np.packbits(mask, bitorder="little")
            low = np.compress(~mask, cur)
            cur = np.concatenate([low, np.compress(mask, cur)])
            planes.append(plane)
            zeros.append(len(low))
            ranks.append(_directory(plane))
        return cls(len(ids), planes, zeros, ranks)

    def decode(self) -> np.ndarray:
        """All ids in order, from the lowest level up."""
        bits = len(self.planes)
        cur = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits - 1, -1, -1):
            mask = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            z, above = self.zeros[level], np.empty_like(cur)
            above[np.flatnonzero(mask)] = cur[z:] | cur.dtype.type(1 << (bits - 1 - level))
            above[np.flatnonzero(~mask)] = cur[:z]
            cur = above
        return cur

    def _rank1(self, level: int, i: int) -> int:
        """Set bits before position i of a plane."""
        block = i // RANK_BITS
        part = self.planes[level][block * RANK_BITS // 8:(i + 7) // 8]
        return int(self.ranks[level][block]) + int(
            np.unpackbits(part, bitorder="little")[:i - block * RANK_BITS].sum())

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, c: int, end: int) -> tuple[int, int]:
        """Where the occurrences of c before position ``end`` lie below the last plane."""
        lo, hi, bits = 0, end, len(self.planes)
        if c < 0 or c >> bits:
            return 0, 0
        for level in range(bits):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if c >> (bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, c: int, i: int) -> int:
        """Occurrences of c before position i."""
        lo, hi = self._range(c, i)
        return hi - lo

    def count(self, c: int) -> int:
        return self.rank(c, self.n)

    def positions(self, c: int) -> np.ndarray:
        """All positions of c, ascending (select, from the last plane up)."""
        lo, hi = self._range(c, self.n)
        at, bits = np.arange(lo, hi), len(self.planes)
        for level in range(bits - 1, -1, -1):
            one = c >> (bits - 1 - level) & 1
            at = self._select(level, one, at - self.zeros[level] if one else at)
        return at

    def _select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) bits of a kind: the directory names
        the block, the bits inside it the position."""
        first = np.arange(len(self.ranks[level])) * RANK_BITS
        before = self.ranks[level].astype(np.int64) if bit else np.minimum(first, self.n) - self.ranks[level]
        block = np.searchsorted(before, k, side="right") - 1
        out = np.empty(len(k), np.int64)
        for b in np.unique(block):
            part = self.planes[level][b * RANK_BITS // 8:(b + 1) * RANK_BITS // 8]
            inside = np.flatnonzero(np.unpackbits(part, bitorder="little") == bit)
            own = block == b
            out[own] = b * RANK_BITS + inside[k[own] - before[b]]
        return out

    def dump(self, docs: np.ndarray, missing: np.ndarray, lengths: np.ndarray) -> bytes:
        """The whole file: magic, header length, header, compressed sections."""
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = [pack(np.ascontiguousarray(x).tobytes()) for x in (
            docs.astype("<i8"), missing.astype("u1"), lengths.astype("<i8"), *self.planes,
            *(r.astype("<u4") for r in self.ranks))]
        header = json.dumps({"n": self.n, "docs": len(docs), "zeros": self.zeros, "bits": len(self.planes),
                             "sizes": [len(p) for p in parts]}).encode()
        return b"".join([MAGIC, struct.pack("<I", len(header)), header, *parts])

    @classmethod
    def load(cls, data: bytes) -> tuple["WaveletMatrix", np.ndarray, np.ndarray, np.ndarray]:
        """The matrix, the document ids, which of them are null, their lengths."""
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        size = struct.unpack("<I", data[8:12])[0]
        head, at, parts = json.loads(data[12:12 + size]), 12 + size, []
        unpack = zstandard.ZstdDecompressor().decompress
        for n in head["sizes"]:
            parts.append(unpack(data[at:at + n]))
            at += n
        bits = head["bits"]
        planes = [np.frombuffer(p, "u1") for p in parts[3:3 + bits]]
        ranks = [np.frombuffer(p, "<u4") for p in parts[3 + bits:]]
        return (cls(head["n"], planes, head["zeros"], ranks), np.frombuffer(parts[0], "<i8"),
                np.frombuffer(parts[1], "u1").astype(bool), np.frombuffer(parts[2], "<i8"))


def _directory(plane: np.ndarray) -> np.ndarray:
    """Set bits before each block of RANK_BITS bits; one more entry than blocks."""
    padded = np.zeros(-(-max(len(plane), 1) * 8 // RANK_BITS) * RANK_BITS // 8, "u1")
    padded[:len(plane)] = plane
    ones = np.bitwise_count(padded.view("<u8")).reshape(-1, RANK_BITS // 64).sum(axis=1, dtype=np.int64)
    return np.append(0, np.cumsum(ones)).astype(np.uint32)


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", *,
                 path: str | None = None, end_id: int = 2, shard_tokens: int = SHARD_TOKENS,
                 controls_as_text: bool = False) -> DataFrame:
    """Write the shards below ``folder`` and return the manifest: part, seq
    (ascending with the ids), file, n_docs, n_tokens. Control strings inside
    texts are the vocabulary's control tokens, or with ``controls_as_text``
    ordinary text."""
    importable(docs.sparkSession)
    path = path or tokens.default_path()
    rows = (docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
            .withColumn("h", F.xxhash64("text")))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext
        encoder, part, seq = tokens.tokenizer(path, controls_as_text), TaskContext.get().partitionId(), 0
        store, root = fs.FileSystem.from_uri(folder)
        end, ids, names, held = np.array([end_id], "<u4"), [], [], 0

        def flush() -> tuple:
            lengths = np.array([len(x) for x in ids], np.int64)
            matrix = WaveletMatrix.build(np.concatenate(ids))
            null = np.array([x is None for x in names])
            data = matrix.dump(np.array([x or 0 for x in names], np.int64), null, lengths)
            file = f"shard-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.wvm"
            with store.open_output_stream(f"{root}/{file}") as f:
                f.write(data)
            return part, seq, file, len(ids), int(lengths.sum())

        for b in batches:
            done = []
            for doc, x in zip(b.column(0).to_pylist(), encoder.encode(t.as_py() for t in b.column(1).cast(pa.binary()))):
                names.append(doc)
                ids.append(np.concatenate([x, end]).astype(np.uint32))
                held += len(ids[-1])
                if held >= shard_tokens:
                    done.append(flush())
                    ids, names, held, seq = [], [], 0, seq + 1
            if done:
                yield _manifest(done)
        if ids:
            yield _manifest([flush()])

    _make(docs.sparkSession, folder)
    return written(ordered.drop("h").mapInArrow(build, "part long, seq long, file string, n_docs long, n_tokens long"),
                   "shard-manifest")


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["part", "seq", "file", "n_docs", "n_tokens"])


def _make(spark: SparkSession, folder: str) -> None:
    """Create the folder through Hadoop's file system, as Spark's writers do."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers)."""
    spark = manifest.sparkSession
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("own"))     # one row per task that wrote
    before = F.sum("own").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")
                                    .rowsBetween(Window.unboundedPreceding, -1))
    starts = (manifest.select("part", "file", F.coalesce(within, F.lit(0)).alias("in_part")).join(parts, "part")
              .select("file", (F.col("part_start") + F.col("in_part")).alias("base")))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                matrix, docs, missing, lengths = WaveletMatrix.load(b.column(1)[k].as_py())
                ids, ends = matrix.decode().astype("<u4"), np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n:e].data) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64(), mask=missing), pa.array(b.column(0)[k].as_py() + ends - lengths),
                     pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (files.join(starts, "file").select("base", "content")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to shards in the shared folder and read them back."""
    folder = shared_folder(docs.sparkSession, "shards")
    return read_shards(write_shards(docs, folder, **options), folder)
