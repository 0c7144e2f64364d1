"""Packing documents into fixed token windows with a bounded set of open ones.

Each task tokenizes the documents of its input partition and keeps at most
``open_windows`` open windows. Whole windows of a long document leave at
once; what remains goes to the open window it fits best (least room left),
or opens a new one. When none fits and none may be opened, the fullest
window is topped up with the head of the piece and emitted, and the rest is
placed again. At the end of the partition its open windows are merged, so
at most one is left; these leftovers (one per partition) are merged in
rounds of ``GROUP`` partitions each until one group holds them all.

Nothing is shuffled but the leftovers. Memory per task: one Arrow batch and
the open windows. Rows: null or empty texts are one end token; repeated rows
are packed each for itself; a null id is carried; extra columns are ignored;
an empty table gives no rows. The plan of partitions is that of the scan, so
reruns over the same files agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import importable, written

GROUP = 256                 # leftover windows merged by one task
_PART_SHIFT, _LEVEL_SHIFT = 34, 58
FLUSH_ROWS = 4000


class Windows:
    """Open windows of one task; ``emit`` gets each finished one as a list of
    pieces (doc, start, ids, doc_tokens)."""

    def __init__(self, window: int, keep: int, emit: Callable[[list, bool], None]):
        self.window, self.keep, self.emit = window, keep, emit
        self.open: list[list] = []          # [tokens used, pieces]

    def add(self, doc, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        size = self.window
        whole = len(ids) - len(ids) % size
        for at in range(0, whole, size):
            self.emit([(doc, start + at, ids[at:at + size], doc_tokens)], False)
        start, ids = start + whole, ids[whole:].copy()
        while len(ids):
            fits = [w for w in self.open if w[0] + len(ids) <= size]
            if fits:
                best = max(fits, key=lambda w: w[0])
            elif len(self.open) < self.keep:
                best = [0, []]
                self.open.append(best)
            else:
                best = max(self.open, key=lambda w: w[0])
            n = min(size - best[0], len(ids))
            best[0] += n
            best[1].append((doc, start, ids[:n], doc_tokens))
            start, ids = start + n, ids[n:]
            if best[0] == size:
                self.open = [w for w in self.open if w is not best]
                self.emit(best[1], False)

    def finish(self) -> None:
        """Merge the open windows, fullest first, cutting at window ends; at
        most one unfilled window is emitted, marked as left over."""
        rest = sorted(self.open, key=lambda w: -w[0])
        self.open, room = [], [0, []]
        for _, pieces in rest:
            for doc, start, ids, doc_tokens in pieces:
                while len(ids):
                    n = min(self.window - room[0], len(ids))
                    room[0] += n
                    room[1].append((doc, start, ids[:n], doc_tokens))
                    start, ids = start + n, ids[n:]
                    if room[0] == self.window:
                        self.emit(room[1], False)
                        room = [0, []]
        if room[1]:
            self.emit(room[1], True)


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
        T.StructField("left_over", T.BooleanType())])


class _Rows:
    """Finished windows as Arrow rows; sequence ids count up from ``first``."""

    def __init__(self, arrow_id: pa.DataType, first: int):
        self.arrow_id, self.next, self.rows = arrow_id, first, []

    def emit(self, pieces: list, left_over: bool) -> None:
        offset = 0
        for doc, start, ids, doc_tokens in pieces:
            self.rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), doc_tokens, self.next, offset,
                              left_over))
            offset += len(ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 8
        self.rows = []
        kinds = [self.arrow_id, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "left_over"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str | None = None,
         window: int = 1024, open_windows: int = 32, end_id: int = 0, controls_as_text: bool = False) -> DataFrame:
    """Pieces of packed sequences: doc_id, start (the document's ids before
    the piece), length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset. A document is its ids and ``end_id``; each id lies
    in exactly one piece. All sequences but the last are full. Control strings
    inside texts are the vocabulary's control tokens, or with
    ``controls_as_text`` ordinary text."""
    importable(docs.sparkSession)
    path = path or tokens.default_path()
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    schema = _schema(rows.schema["doc_id"].dataType)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder, out, windows = tokens.tokenizer(path, controls_as_text), None, None
        end = np.array([end_id], dtype="<u4")
        for b in batches:
            if out is None:
                out = _Rows(b.column(0).type, TaskContext.get().partitionId() << _PART_SHIFT)
                windows = Windows(window, open_windows, out.emit)
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode(x.as_py() for x in b.column(1).cast(pa.binary()))):
                ids = np.concatenate([ids, end])
                windows.add(doc, 0, ids, len(ids))
                if len(out.rows) >= FLUSH_ROWS:
                    yield out.batch()
        if out is not None:
            windows.finish()
            yield out.batch()

    stage = written(rows.mapInArrow(first_pass, schema), "packed")
    closed, left, level = stage.filter(~F.col("left_over")), stage.filter("left_over"), 0
    while left.select("sequence_id").distinct().count() > 1:
        level += 1
        stage = written(_merged(left, schema, level, window), f"packed-{level}")
        closed = closed.unionByName(stage.filter(~F.col("left_over")))
        left = stage.filter("left_over")
    return closed.unionByName(left).drop("left_over")


def _merged(left: DataFrame, schema: T.StructType, level: int, window: int) -> DataFrame:
    """Leftover windows of GROUP partitions each, merged; a group holds at
    most GROUP windows."""
    part = F.shiftright(F.col("sequence_id").bitwiseAND((1 << _LEVEL_SHIFT) - 1), _PART_SHIFT)

    def merge(key, rows: pa.Table) -> pa.Table:
        group = int(key[0].as_py())
        out = _Rows(rows.schema.field("doc_id").type, level << _LEVEL_SHIFT | group << _PART_SHIFT)
        windows = Windows(window, GROUP, out.emit)
        pieces = sorted(rows.to_pylist(), key=lambda r: (r["sequence_id"], r["offset"]))
        for r in pieces:
            windows.add(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
        windows.finish()
        return pa.Table.from_batches([out.batch()])

    return (left.withColumn("_group", F.floor(part / GROUP).cast("long")).groupBy("_group")
            .applyInArrow(lambda key, rows: merge(key, rows.drop_columns(["_group"])), schema))
