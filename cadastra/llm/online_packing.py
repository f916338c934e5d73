"""Bounded-space online packing of token ids into sequences of one length.

Every task keeps a fixed number of open windows.  Whole windows of a long
document leave at once; the rest of it goes into the open window it fits best.
When none has room and all windows are in use, the fullest is topped up with
the front of the piece, if that front is worth a cut, and emitted.  What is
open at the end of a partition is a leftover; leftovers of a fixed number of
partitions at a time are poured together, so that one padded sequence remains
of each such group.

A task holds ``open_windows`` windows and one batch of texts; a merging task
holds ``merge * open_windows`` windows.  Neither grows with the table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .tokens import encode

LENGTH = 2048
OPEN_WINDOWS = 32
MIN_CUT = 16
MERGE = 16
END_ID = 1
#: Characters of text taken from a batch at a time, so that a task's ids stay small.
FLUSH_ROWS = 8192

PIECES = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, leftover boolean"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
        ("offset", pa.int64()), ("leftover", pa.bool_()),
    ]
)

#: A piece: document, ids before it in its document, its ids, ids of the document.
Piece = tuple[int, int, np.ndarray, int]


class Packer:
    """The open windows of one task.  ``emit`` receives the pieces of each finished window."""

    def __init__(self, emit: Callable[[list[Piece]], None], length: int, open_windows: int, min_cut: int):
        self.emit, self.length, self.limit, self.min_cut = emit, length, open_windows, min_cut
        self.room: list[tuple[int, int]] = []  # (room left, window), smallest room first
        self.windows: dict[int, list[Piece]] = {}
        self.made = 0

    def add(self, doc: int, ids: np.ndarray) -> None:
        """All ids of one document."""
        total, whole = len(ids), len(ids) // self.length * self.length
        for start in range(0, whole, self.length):
            self.emit([(doc, start, ids[start : start + self.length], total)])
        if whole < total:
            self.place((doc, whole, ids[whole:], total))

    def place(self, piece: Piece) -> None:
        doc, start, ids, total = piece
        while len(ids):
            at = bisect_left(self.room, (len(ids), -1))
            if at < len(self.room):
                room, window = self.room.pop(at)
                self._put(window, room, (doc, start, ids, total))
                return
            if len(self.room) < self.limit:
                self.made += 1
                self.windows[self.made] = []
                insort(self.room, (self.length, self.made))
                continue
            room, window = self.room.pop(0)
            if room >= self.min_cut:
                self.windows[window].append((doc, start, ids[:room], total))
                start, ids = start + room, ids[room:]
            self.emit(self.windows.pop(window))

    def _put(self, window: int, room: int, piece: Piece) -> None:
        self.windows[window].append(piece)
        if room == len(piece[2]):
            self.emit(self.windows.pop(window))
        else:
            insort(self.room, (room - len(piece[2]), window))

    def leftovers(self) -> list[list[Piece]]:
        """The open windows, fullest first; none stays open."""
        out = [self.windows[w] for _, w in self.room]
        self.room, self.windows = [], {}
        return out


class _Rows:
    """Collects output rows of a task and hands them out as Arrow batches."""

    def __init__(self, first_sequence: int, keep_ids: bool):
        self.sequence, self.keep_ids, self.rows = first_sequence, keep_ids, []

    def add(self, window: list[Piece], leftover: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in window:
            raw = ids.tobytes()
            kept = raw if self.keep_ids or leftover else None
            self.rows.append((doc, start, len(ids), kept, zlib.crc32(raw), total, self.sequence, offset, leftover))
            offset += len(ids)
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def pack_online(
    docs: DataFrame,
    length: int = LENGTH,
    open_windows: int = OPEN_WINDOWS,
    min_cut: int = MIN_CUT,
    merge: int = MERGE,
    keep_ids: bool = True,
    ranks: str | None = None,
) -> DataFrame:
    """Pack ``doc_id, text`` into sequences of ``length`` ids, one row per piece.

    A document's ids are those of its text, then ``END_ID``; each lies in
    exactly one piece.  Columns: ``doc_id``, ``start`` (ids of the document
    before the piece), ``length``, ``ids`` (little-endian unsigned 32-bit; null
    unless ``keep_ids``), ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and
    ``offset`` (place in the sequence, gapless from 0).

    A null or empty text gives the end id alone.  Rows of equal ``doc_id``
    are packed as separate documents, a null id stays null, other columns are
    ignored, and an empty table gives no rows.
    """
    spark = docs.sparkSession

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(TaskContext.get().partitionId() << 40, keep_ids)
        packer = Packer(out.add, length, open_windows, min_cut)
        end = np.array([END_ID], dtype="<u4")
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc.as_py(), np.concatenate([encode(text.as_py(), ranks), end]))
                if len(out.rows) >= FLUSH_ROWS:
                    yield out.batch()
        for window in packer.leftovers():
            out.add(window, leftover=True)
        yield out.batch()

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        """Pour the leftovers of a group together, fullest window first."""
        out = _Rows(key[0].as_py() << 40 | 1 << 39, keep_ids)
        rows = table.to_pylist()
        rows.sort(key=lambda r: (r["sequence_id"], r["offset"]))
        fill, window = 0, []
        for r in rows:
            ids, start = np.frombuffer(r["ids"], dtype="<u4"), r["start"]
            while len(ids):
                part = ids[: length - fill]
                window.append((r["doc_id"], start, part, r["doc_tokens"]))
                fill, start, ids = fill + len(part), start + len(part), ids[len(part) :]
                if fill == length:
                    out.add(window)
                    fill, window = 0, []
        if window:
            out.add(window)
        return pa.Table.from_batches([out.batch()], schema=_ARROW)

    first = cut_lineage(docs.select("doc_id", "text").mapInArrow(windows, PIECES), "online-packing")
    group = F.shiftright(F.shiftright("sequence_id", 40), (merge - 1).bit_length())
    rest = first.where("leftover").withColumn("part", group).groupBy("part").applyInArrow(
        lambda key, t: merged(key, t.drop(["part"])), PIECES
    )
    return first.where("NOT leftover").unionByName(rest).drop("leftover")
