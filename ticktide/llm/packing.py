"""Packing: bounded-space online best-fit with a fixed number of open windows.

Each task reads its documents once, in order. A document longer than a window
fills whole windows by itself; the rest goes to the fullest open window that
takes it. When none does, the fullest one is emitted: as it is when it lacks at
most ``max_padding`` tokens, else topped up with the head of the document, whose
tail goes on into the window that this frees. Windows still open at the end of a
task, at most ``open_windows``, leave it with their ids; the leftovers of
``fan_in`` tasks are merged in one group, packed in the same way and finally
chained, so that a group ends with at most one window that is not full. Tasks
hold the open windows and one document, groups hold at most
``fan_in * open_windows`` windows, whatever the size of the table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ticktide.llm.bytepair import encoder
from ticktide.llm.tables import checkpointed, id_and_text, text_slices

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
MERGED_FROM = 1 << 62  # sequence ids of merged windows start here
PER_TASK = 1 << 40


class Packer:
    """Open windows of one task. A piece is (doc_id, start, doc_tokens, ids)."""

    def __init__(self, size: int, open_windows: int, max_padding: int, emit: Callable[[list], None]):
        self.size, self.room, self.max_padding, self.emit = size, open_windows, max_padding, emit
        self.open: list[tuple[int, int]] = []  # (fill, number), sorted
        self.content: dict[int, list] = {}
        self.made = 0

    def document(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.size
        for start in range(0, whole, self.size):
            self.emit([(doc_id, start, len(ids), ids[start:start + self.size])])
        if whole < len(ids):
            self.piece((doc_id, whole, len(ids), ids[whole:]))

    def piece(self, piece: tuple) -> None:
        doc_id, start, doc_tokens, ids = piece
        at = bisect_right(self.open, (self.size - len(ids), 1 << 62)) - 1
        if at < 0 and len(self.open) >= self.room:
            fill, number = self.open.pop()
            lacking, window = self.size - fill, self.content.pop(number)
            if lacking > self.max_padding:
                window.append((doc_id, start, doc_tokens, ids[:lacking]))
                start, ids = start + lacking, ids[lacking:]
            self.emit(window)
            return self.piece((doc_id, start, doc_tokens, ids))
        if at < 0:
            fill, number, self.made = 0, self.made, self.made + 1
        else:
            fill, number = self.open.pop(at)
        # A copy: an open window must not keep whole documents alive.
        self.content.setdefault(number, []).append((doc_id, start, doc_tokens, ids.copy()))
        if fill + len(ids) == self.size:
            self.emit(self.content.pop(number))
        else:
            insort(self.open, (fill + len(ids), number))
        return None

    def left(self) -> list[list]:
        """The open windows, the fullest first."""
        return [self.content[number] for _, number in reversed(self.open)]


def _rows(window: list, sequence: int) -> list[tuple]:
    rows, offset = [], 0
    for doc_id, start, doc_tokens, ids in window:
        crc = zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
        rows.append((doc_id, start, len(ids), crc, doc_tokens, sequence, offset))
        offset += len(ids)
    return rows


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1024,
         end_id: int = 0, open_windows: int = 64, max_padding: int = 8, fan_in: int = 64,
         folder: str | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text followed by ``end_id``, so a null or
    empty text still has one. Repeated rows are packed each. An empty table
    gives no rows; null ids stay null; other columns are not looked at.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids_of, out, made = TaskContext.get().partitionId(), encoder(folder), [], 0
        end = np.array([end_id], dtype=np.uint32)

        def emit(window: list) -> None:
            nonlocal made
            out.extend((*row, None, None) for row in _rows(window, task * PER_TASK + made))
            made += 1

        packer = Packer(size, open_windows, max_padding, emit)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "task", "ids"]
        types = [pa.int64()] * 8 + [pa.binary()]

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for rows in text_slices(batches):
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                packer.document(doc_id, np.concatenate([ids_of(text), end]))
            yield batch()
        for window in packer.left():
            out.extend((d, s, len(i), None, n, None, None, task, i.tobytes()) for d, s, n, i in window)
        yield batch()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        group, out, made = int(pdf["task"].iloc[0]) // fan_in, [], 0

        def emit(window: list) -> None:
            nonlocal made
            out.extend(_rows(window, MERGED_FROM + group * PER_TASK + made))
            made += 1

        packer = Packer(size, open_windows, max_padding, emit)
        pieces = [(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), int(r.doc_tokens),
                   np.frombuffer(r.ids, dtype=np.uint32)) for r in pdf.itertuples(index=False)]
        for piece in sorted(pieces, key=lambda p: (-len(p[3]), p[0] is None, p[0] or 0, p[1])):
            packer.piece(piece)
        chain, fill = [], 0
        for doc_id, start, doc_tokens, ids in (p for window in packer.left() for p in window):
            while len(ids):
                head = ids[:size - fill]
                chain.append((doc_id, start, doc_tokens, head))
                start, ids, fill = start + len(head), ids[len(head):], fill + len(head)
                if fill == size:
                    emit(chain)
                    chain, fill = [], 0
        if chain:
            emit(chain)
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pd.DataFrame(out, columns=columns).astype({c: "Int64" for c in columns})

    passed = checkpointed(id_and_text(docs, id_col, text_col).mapInArrow(
        first, f"{PIECE}, task long, ids binary"))
    emitted = passed.filter(F.col("task").isNull()).drop("task", "ids")
    merged = (passed.filter(F.col("task").isNotNull())
              .groupBy((F.col("task") / fan_in).cast("long")).applyInPandas(merge, PIECE))
    return emitted.unionByName(merged)
