"""Bounded-space online packing of token sequences.

Each task tokenises its documents and packs them as they come: whole windows of
a long document are sequences at once; its rest goes best-fit into one of ``OPEN`` open
windows. Where it fits in none, a new window opens; with all ``OPEN`` open, the
fullest is emitted first. The windows still open at the end of a task are merged, best-fit
decreasing, in groups of ``GROUP`` tasks, so that no task gathers all of them.

A null or empty text is one end token. Repeated rows are packed one by one. An
empty table gives no pieces. Only id and text are read.
"""
from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytelevel import ByteEncoder
from .common import materialize, small, worker_state

WINDOW = 2048
OPEN = 64
GROUP = 64


class Packer:
    """Best-fit packing with a fixed number of open windows. ``emit`` gets (window number, pieces, open)."""

    def __init__(self, window: int, most: int, emit: Callable[[int, list[tuple], bool], None]):
        self.window, self.most, self.emit = window, most, emit
        self.room: list[tuple[int, int]] = []  # (room left, number) of open windows, ascending
        self.pieces: dict[int, list[tuple]] = {}
        self.numbers = 0

    def _new(self) -> int:
        self.numbers += 1
        return self.numbers - 1

    def whole(self, piece: tuple) -> None:
        self.emit(self._new(), [piece], False)

    def place(self, piece: tuple, length: int) -> None:
        at = bisect.bisect_left(self.room, (length, -1))
        if at < len(self.room):
            left, number = self.room.pop(at)
        else:
            if len(self.room) == self.most:
                _, full = self.room.pop(0)
                self.emit(full, self.pieces.pop(full), False)
            left, number = self.window, self._new()
            self.pieces[number] = []
        self.pieces[number].append((*piece, self.window - left))
        left -= length
        if left:
            bisect.insort(self.room, (left, number))
        else:
            self.emit(number, self.pieces.pop(number), False)

    def close(self) -> None:
        for _, number in self.room:
            self.emit(number, self.pieces.pop(number), True)


def _merge(key: tuple, open_windows: pd.DataFrame) -> pd.DataFrame:
    """New places of the open windows of a group of tasks: (task, win, sequence_id, base)."""
    rows = open_windows.sort_values(["used", "task", "win"], ascending=[False, True, True])
    room: list[tuple[int, int]] = []
    out = []
    first = ((1 << 30) + int(key[0])) << 32
    n = 0
    for task, win, used in rows[["task", "win", "used"]].itertuples(index=False):
        at = bisect.bisect_left(room, (used, -1))
        if at < len(room):
            left, number = room.pop(at)
        else:
            left, number = WINDOW, n
            n += 1
        out.append((task, win, first + number, WINDOW - left))
        bisect.insort(room, (left - used, number))
    return pd.DataFrame(out, columns=["task", "win", "sequence_id", "base"])


PIECES = ("start long, length long, ids_crc32 long, doc_tokens long, "
          "task long, win long, open boolean, at long")


def pack(docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
         most_open: int = OPEN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``tokenizer`` is the file, ``pattern``
    what its pre-tokenizer splits by."""
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encoder, ready = worker_state(f"encoder {tokenizer} {pattern}", lambda: ByteEncoder(tokenizer, pattern)), []

        def emit(number: int, pieces: list[tuple], still_open: bool) -> None:
            ready.extend((*p[:5], task, number, still_open, p[5]) for p in pieces)

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*ready)) if ready else [[]] * 9
            ready.clear()
            types = [kind, *[pa.int64()] * 6, pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "win", "open", "at"])
        packer = Packer(WINDOW, most_open, emit)
        id_kind = None
        for batch in small(batches):
            id_kind = batch.schema.field(0).type
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, WINDOW):
                    own = ids[4 * start:4 * (start + WINDOW)]
                    n = len(own) // 4
                    piece = (doc_id, start, n, zlib.crc32(own), total)
                    if n == WINDOW:
                        packer.whole((*piece, 0))
                    else:
                        packer.place(piece, n)
            yield flush(id_kind)
        packer.close()
        if id_kind is not None:
            yield flush(id_kind)

    pieces = materialize(source.mapInArrow(run, f"doc_id {kind}, {PIECES}"), "packed")
    left = (pieces.where("open").groupBy("task", "win").agg(F.sum("length").alias("used"))
            .withColumn("grp", F.expr(f"task div {GROUP}")))
    merged = left.groupBy("grp").applyInPandas(_merge, "task long, win long, sequence_id long, base long")
    closed = pieces.where("not open").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.shiftleft("task", 32) + F.col("win")).alias("sequence_id"), F.col("at").alias("offset"))
    moved = pieces.where("open").join(merged, ["task", "win"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", (F.col("base") + F.col("at")).alias("offset"))
    return closed.unionByName(moved)
