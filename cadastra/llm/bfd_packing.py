"""Best-fit-decreasing packing into fixed id matrices.

Pieces longer than a row are split without loss.  Every task packs shards of a
bounded number of ids: pieces are taken longest first, and each goes into the
row with the least room that still holds it.  A segment tree over the possible
capacities finds that row in ``log2(length)`` steps, however many rows are open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .tokens import encode

LENGTH = 2048
SHARD_IDS = 4_000_000
END_ID = 50256

MATRIX = (
    "sequence_id long, n_tokens int, ids binary, segment_ends array<int>, position_resets array<int>, "
    "doc_ids array<long>, starts array<long>"
)
_ARROW = pa.schema(
    [
        ("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()),
        ("segment_ends", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
    ]
)


class CapacityTree:
    """Which capacities from 0 to ``length`` have open rows; the smallest one at or above a need."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)

    def change(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def least(self, need: int) -> int | None:
        node = self.leaves + need
        if self.count[node]:
            return need
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers; no row exceeds ``length``."""
    tree, rows = CapacityTree(length), []
    at: list[list[int]] = [[] for _ in range(length + 1)]  # rows by capacity left
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.least(lengths[piece])
        if room is None:
            room, row = length, len(rows)
            rows.append([])
        else:
            row = at[room].pop()
            tree.change(room, -1)
        rows[row].append(piece)
        room -= lengths[piece]
        if room:
            at[room].append(row)
            tree.change(room, 1)
    return rows


def pack_matrix(
    docs: DataFrame,
    length: int = LENGTH,
    shard_ids: int = SHARD_IDS,
    end_id: int = END_ID,
    pad_id: int = END_ID,
    dtype: str = "<u2",
    ranks: str | None = None,
) -> DataFrame:
    """Pack ``doc_id, text`` into matrix rows of ``length`` ids.

    One row per sequence: ``ids`` holds ``length`` ids of ``dtype``, padded with
    ``pad_id`` after ``n_tokens``; ``segment_ends`` are the cumulative segment
    lengths (from 0 to ``n_tokens``), ``position_resets`` the places where
    positions start at 0 again; ``doc_ids`` and ``starts`` name each segment's
    document and the ids of it that lie before.  Text ids are followed by ``end_id``.

    A null or empty text gives the end id alone; a text longer than a row is
    split into whole rows and a rest, losing nothing; ids that ``dtype`` can't
    hold fail the job; rows of equal ``doc_id``
    stay separate documents; a null id stays null; other columns are ignored;
    an empty table gives no rows.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        rest: list[tuple[int, int, np.ndarray]] = []
        rows: list[tuple] = []
        held = 0

        def row(segments: list[tuple[int, int, np.ndarray]]) -> None:
            nonlocal sequence
            ends = np.cumsum([0, *(len(x[2]) for x in segments)])
            ids = np.full(length, pad_id, dtype=dtype)
            ids[: ends[-1]] = np.concatenate([x[2] for x in segments])
            docs, starts = [x[0] for x in segments], [x[1] for x in segments]
            rows.append((sequence, int(ends[-1]), ids.tobytes(), ends, ends[:-1], docs, starts))
            sequence += 1

        def batch() -> pa.RecordBatch:
            nonlocal rows
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_ARROW)
            rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(columns, _ARROW, strict=True)], schema=_ARROW
            )

        def settle() -> None:
            nonlocal rest, held
            for group in best_fit_decreasing([len(x[2]) for x in rest], length):
                row([rest[i] for i in group])
            rest, held = [], 0

        for incoming in batches:
            for doc, text in zip(incoming.column(0), incoming.column(1), strict=True):
                ids = np.append(encode(text.as_py(), ranks), np.uint32(end_id))
                if int(ids.max()) > np.iinfo(dtype).max:
                    raise ValueError(f"id {int(ids.max())} does not fit {dtype}")
                ids = ids.astype(dtype)
                whole = len(ids) // length * length
                for start in range(0, whole, length):
                    row([(doc.as_py(), start, ids[start : start + length])])
                if whole < len(ids):
                    rest.append((doc.as_py(), whole, ids[whole:]))
                    held += len(ids) - whole
                if held >= shard_ids:
                    settle()
                if len(rows) >= 1024:
                    yield batch()
        settle()
        while rows:
            later = rows[1024:]
            rows = rows[:1024]
            yield batch()
            rows = later

    if np.dtype(dtype).itemsize < 4 and max(end_id, pad_id) > np.iinfo(dtype).max:
        raise ValueError(f"ids do not fit {dtype}")
    return docs.select("doc_id", "text").mapInArrow(packed, MATRIX)


def write_matrix(docs: DataFrame, path: str, **options) -> None:
    """Write the packed rows below ``path``; a failed task's rows are written again by its successor."""
    pack_matrix(docs, **options).write.mode("errorifexists").parquet(path)


def read_matrix(table: DataFrame, length: int = LENGTH, dtype: str = "<u2") -> np.ndarray:
    """The id matrix of a bounded set of sequences, for a trainer's loader."""
    return np.stack([np.frombuffer(r.ids, dtype=dtype, count=length) for r in table.select("ids").collect()])
