"""Fill-in-middle: documents cut at word boundaries and reordered.

A text is a row of units, each a word with the white space before it (white
space at the very end is a unit of its own). Two keyed draws name the units
after which the prefix and the middle end. The text is looked at in fixed
blocks of ``BLOCK`` UTF-8 bytes; a Fenwick tree over the blocks holds how
many units end in each and how many code points start there. Binary lifting
descends the tree to the block in which the wanted unit ends, and only that
block is searched for the byte; the code points before it come along.
Counting walks a text in bounded segments, so what is held beside the text
does not grow with it.

Output: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (form psm), ``<S>``
suffix ``<P>`` prefix ``<M>`` middle (spm), or the text as it is (plain).
The draws depend on the id alone, so reruns agree. ``restored`` rebuilds the
text from output and form alone.

Rows: null and empty texts are plain with no units, as are texts that hold a
marker; blank texts are one unit; a null id draws as an empty one; repeated
rows give equal rows; an empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import importable

BLOCK = 4096                # bytes of a block
SEGMENT = 256 * BLOCK       # bytes that are looked at together while counting
BATCH_BYTES = 8 << 20       # output texts that a task holds before it passes them on
SEED, RATE, SPM = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


class BlockTree:
    """Fenwick tree over the blocks of one text: units that end in a block
    and code points that start in it."""

    def __init__(self, data: bytes, block: int = BLOCK):
        self.bytes, self.block = np.frombuffer(data, np.uint8), block
        units, chars = self._counts()
        self.n_units, self.blocks = int(units.sum()), len(units)
        self.units, self.chars = _fenwick(units), _fenwick(chars)

    def _ends(self, lo: int, hi: int) -> np.ndarray:
        """Whether a unit ends with each byte of lo..hi: the last byte of a
        word, and the last byte of the text."""
        white = _WHITE[self.bytes[lo:hi + 1]]
        if hi < len(self.bytes):
            return ~white[:-1] & white[1:]
        ends = np.append(~white[:-1] & white[1:], True)
        return ends

    def _starts(self, lo: int, hi: int) -> np.ndarray:
        """Whether a code point starts with each byte."""
        return (self.bytes[lo:hi] & 0xC0) != 0x80

    def _counts(self) -> tuple[np.ndarray, np.ndarray]:
        units, chars, n = [], [], len(self.bytes)
        step = max(1, SEGMENT // self.block) * self.block
        for lo in range(0, n, step):
            hi = min(lo + step, n)
            at = np.arange(0, hi - lo, self.block)
            units.append(np.add.reduceat(self._ends(lo, hi), at, dtype=np.int64))
            chars.append(np.add.reduceat(self._starts(lo, hi), at, dtype=np.int64))
        empty = np.zeros(0, np.int64)
        return np.concatenate(units or [empty]), np.concatenate(chars or [empty])

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points before the end of the k-th unit."""
        if k <= 0:
            return 0, 0
        at, chars, step = 0, 0, 1 << self.blocks.bit_length()
        while step := step >> 1:                             # the last block before which fewer than k units end
            if at + step <= self.blocks and self.units[at + step] < k:
                at += step
                k -= int(self.units[at])
                chars += int(self.chars[at])
        lo = at * self.block
        hi = min(lo + self.block, len(self.bytes))
        inside = int(np.flatnonzero(self._ends(lo, hi))[k - 1]) + 1
        return lo + inside, chars + int(self._starts(lo, lo + inside).sum())


def _fenwick(values: np.ndarray) -> np.ndarray:
    """tree[i]: the sum of the lowbit(i) values before position i."""
    total = np.concatenate([[0], np.cumsum(values)])
    i = np.arange(len(total))
    return total - total[i - (i & -i)]


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers that depend on the id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def reorder(doc_id: int | None, data: bytes, *, seed: int = SEED, rate: int = RATE, spm: int = SPM,
            block: int = BLOCK) -> tuple[int, str, int | None, int | None, bytes]:
    """n, form, prefix_chars, middle_chars, output of one text in UTF-8."""
    tree, (h1, h2, h3, h4) = BlockTree(data, block), draws(doc_id, seed)
    n = tree.n_units
    if not data or h3 % 100 >= rate or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, data
    (a, a_chars), (b, b_chars) = map(tree.cut, sorted((h1 % (n + 1), h2 % (n + 1))))
    if h4 % 100 < spm:
        form, parts = "spm", (SUFFIX, data[b:], PREFIX, data[:a], MIDDLE, data[a:b])
    else:
        form, parts = "psm", (PREFIX, data[:a], SUFFIX, data[b:], MIDDLE, data[a:b])
    return n, form, a_chars, b_chars - a_chars, b"".join(parts)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: int = SEED, rate: int = RATE,
              spm: int = SPM, block: int = BLOCK) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain),
    output. ``rate`` percent of the texts are cut, ``spm`` percent of those
    put the suffix first."""
    importable(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def batch(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                          names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held = [], 0
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            for doc, text in zip(b.column(0).to_pylist(), texts):
                done.append((doc, *reorder(doc, text.as_py() or b"", seed=seed, rate=rate, spm=spm, block=block)))
                held += len(done[-1][-1])
                if held >= BATCH_BYTES:
                    yield batch(done)
                    done, held = [], 0
        if done:
            yield batch(done)

    out = rows.mapInArrow(apply, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from. A text of form psm
    or spm holds no marker, so the output splits at its own three."""
    part = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def digest(cut: DataFrame) -> DataFrame:
    """What ``transform`` returns, with digests in place of the outputs."""
    back = restored(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(back, 256).alias("restored_sha256"))


def oracle() -> str:
    """DuckDB SQL for the query."""
    def draw(k: int) -> str:
        return f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"

    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
            regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
        FROM documents),
    k AS (SELECT *, CAST(len(u) AS BIGINT) AS n, {draw(0)} % (len(u) + 1) AS k1, {draw(1)} % (len(u) + 1) AS k2,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {draw(2)} % 100 >= {RATE}
                 THEN 'plain' WHEN {draw(3)} % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (SELECT *, coalesce(array_to_string(u[1:least(k1, k2)], ''), '') AS a,
            coalesce(array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], ''), '') AS m,
            coalesce(array_to_string(u[greatest(k1, k2) + 1:], ''), '') AS z FROM k),
    o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
                              ELSE '<S>' || z || '<P>' || a || '<M>' || m END AS output FROM p),
    s AS (SELECT *, string_split_regex(output, '<[PSM]>') AS x FROM o)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256,
        sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN x[2] || x[4] || x[3] ELSE x[3] || x[4] || x[2] END)
            AS restored_sha256
    FROM s"""
