"""Exact top-k inner products by a three-phase uniform threshold.

A vector is cut into parts; a node holds one part of a chunk of vectors.  Queries
meet chunks in blocks.  A score is the sum of its parts' scores, so of all parts
of a vector that reaches a total, one reaches the total over the number of parts.

1. Every node lists its best partial scores of each query.  The vectors on the
   best lists are scored exactly; the k-th of these is a total no answer is below.
2. That total over the number of parts is the cutoff, and goes out with the
   queries.  Every node lists all entries from the cutoff on.
3. The listed vectors, which include all answers, are scored exactly, chunk by
   chunk, and the best are kept.

Vectors travel as integer matrices, a bounded number to a row.  Lists are
entries of one chunk and one query block; nothing is gathered by query but the
best of each chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

TOP = 5
PARTS = 2
CHUNK, QUERY_BLOCK = 2048, 512
#: Chunks that one copy of the query blocks meets.
GROUP = 8

_ROWS = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])
_QUERIES = pa.schema([*_ROWS, ("least", pa.binary())])
_ENTRIES = pa.schema([("query_id", pa.int64()), ("part", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
_LISTS = pa.schema([("chunk", pa.int64()), ("block", pa.int64()), ("pairs", pa.binary())])
ENTRY = "query_id long, part int, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def scaled(vector: Column, by: int = 256) -> Column:
    """Each component times ``by``, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * by))


def _matrix(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, dtype="<i8").reshape(rows, -1)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of all rows; through floating point only where that is exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def _packed(vectors: DataFrame, width: int, parts: int, rows: int, cutoffs: bool) -> DataFrame:
    """``vec_id, vector`` (and ``least``) as matrices of at most ``rows`` vectors: part -1 whole, others a slice."""
    bounds = np.linspace(0, width, parts + 1).astype(int)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, waiting = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                piece = batch.slice(begin, rows)
                if waiting + piece.num_rows > rows:
                    yield matrix(chunk, held)
                    chunk, held, waiting = chunk + 1, [], 0
                held.append(piece)
                waiting += piece.num_rows
        if held:
            yield matrix(chunk, held)

    def matrix(chunk: int, pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        piece = pa.Table.from_batches(pieces).combine_chunks()
        data = np.zeros((piece.num_rows, width), dtype="<i8")
        for i, v in enumerate(piece.column(1)):
            own = v.values.to_numpy(zero_copy_only=False)
            data[i, : len(own)] = own
        ids = piece.column(0).to_numpy().astype("<i8").tobytes()
        slices = [(-1, data), *((p, data[:, bounds[p] : bounds[p + 1]]) for p in range(parts))]
        columns = [
            pa.array([chunk] * len(slices), pa.int64()),
            pa.array([p for p, _ in slices], pa.int32()),
            pa.array([ids] * len(slices), pa.binary()),
            pa.array([np.ascontiguousarray(x).tobytes() for _, x in slices], pa.binary()),
        ]
        if cutoffs:
            least = piece.column(2).to_numpy().astype("<i8").tobytes()
            columns.append(pa.array([least] * len(slices), pa.binary()))
        return pa.RecordBatch.from_arrays(columns, schema=_QUERIES if cutoffs else _ROWS)

    schema = "chunk long, part int, ids binary, data binary" + (", least binary" if cutoffs else "")
    return vectors.mapInArrow(pack, schema)


def top_scores(vectors: DataFrame, queries: Column, k: int = TOP, parts: int = PARTS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row of ``vec_id, vector`` that ``queries`` selects.

    ``vector`` is an array of integers.  A query's candidates are all rows but
    its own, its score their inner product; ties go to the smaller ``vec_id``;
    with fewer than ``k`` candidates all are returned.

    Scores are exact longs: entries ``m`` in ``d`` dimensions with
    ``m * m * d`` of 2**62 or more are refused before any work.
    Vectors are filled up with zeros to the longest.  Null vectors and rows
    without ``vec_id`` take no part.  Rows repeated under one ``vec_id`` are
    reduced to one, the smallest vector.  Other columns are ignored; without
    queries or candidates there are no rows.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(
        vectors.where("vec_id IS NOT NULL AND vector IS NOT NULL").groupBy(F.col("vec_id").cast("long"))
        .agg(F.min("vector").alias("vector")).toDF("vec_id", "vector"),
        "vectors",
    )
    count, width, high, low = rows.agg(
        F.count("*"), F.max(F.size("vector")), F.max(F.array_max("vector")), F.min(F.array_min("vector"))
    ).first()
    width = max(1, width or 0)
    if max(abs(high or 0), abs(low or 0)) ** 2 * width >= 1 << 62:
        raise ValueError(f"products of entries up to {max(abs(high), abs(low))} in {width} dimensions don't fit a long")
    parts = min(parts, width)
    groups = max(1, -(-count // (CHUNK * GROUP)))
    group = F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("group")
    chunks = cut_lineage(_packed(rows, width, parts, CHUNK, False), "vector-chunks").withColumn("group", group)
    asked = rows.where(queries)

    def met(blocks: DataFrame, own: Column) -> DataFrame:
        """Every chunk beside every query block: the blocks are copied once a group of chunks."""
        blocks = blocks.where(own).select(
            F.col("chunk").alias("block"), F.col("part").alias("block_part"), F.col("ids").alias("query_ids"),
            F.col("data").alias("query_data"), *(["least"] if "least" in blocks.columns else []),
            F.explode(F.sequence(*(F.lit(g).cast("long") for g in (0, groups - 1)))).alias("block_group"),
        )
        right = (F.col("block_group") == F.col("group")) & (F.col("block_part") == F.col("part"))
        return chunks.where(own).join(blocks, right)

    def local_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, query_ids = (np.frombuffer(r[c], dtype="<i8") for c in ("ids", "query_ids"))
                scores = _dot(_matrix(r["query_data"], len(query_ids)), _matrix(r["data"], len(ids)))
                found = [[], [], []]
                for q, own in zip(query_ids.tolist(), scores, strict=True):
                    at = np.flatnonzero(ids != q)
                    at = at[_best(own[at], ids[at], k)]
                    found[0].append(np.full(len(at), q))
                    found[1].append(ids[at])
                    found[2].append(own[at])
                q, v, s = (np.concatenate(c) for c in found)
                part = pa.array(np.full(len(q), r["part"]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(q), part, pa.array(v), pa.array(s)], schema=_ENTRIES)

    # Phase 1: local lists, and a total that no answer is below.
    blocks = _packed(asked, width, parts, QUERY_BLOCK, False)
    best = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id")
    listed = (
        met(cut_lineage(blocks, "query-blocks"), F.col("part") >= 0)
        .select("part", "ids", "data", "query_ids", "query_data").mapInArrow(local_lists, ENTRY)
        .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
        .select("query_id", "vec_id").distinct()
    )
    left = rows.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))
    exact = listed.join(left, "query_id").join(rows, "vec_id")
    terms = F.zip_with("query", "vector", lambda a, b: F.coalesce(a * b, F.lit(0).cast("long")))
    score = F.aggregate(terms, F.lit(0).cast("long"), lambda a, b: a + b)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    least = (
        exact.select("query_id", score.alias("score")).withColumn("place", place).where(F.col("place") == k)
        .select("query_id", F.col("score").alias("least"))
    )
    nothing = F.lit(-(1 << 62)).cast("long")
    cut = asked.join(least.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select(
        "vec_id", "vector", F.coalesce("least", nothing).alias("least")
    )
    blocks = cut_lineage(_packed(cut_lineage(cut, "cutoffs"), width, parts, QUERY_BLOCK, True), "cutoff-blocks")

    # Phase 2: every entry from the cutoff on, as places in its chunk and block.
    def sufficient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, query_ids, total = (np.frombuffer(r[c], dtype="<i8") for c in ("ids", "query_ids", "least"))
                scores = _dot(_matrix(r["query_data"], len(query_ids)), _matrix(r["data"], len(ids)))
                cutoff = -(-total // parts)
                listed = np.flatnonzero((scores >= cutoff[:, None]) & (query_ids[:, None] != ids[None, :]))
                pairs = pa.array([listed.astype("<u4").tobytes()], pa.binary())
                place = (pa.array([r[c]], pa.int64()) for c in ("chunk", "block"))
                yield pa.RecordBatch.from_arrays([*place, pairs], schema=_LISTS)

    lists = (
        met(blocks, F.col("part") >= 0)
        .select("chunk", "block", "ids", "data", "query_ids", "query_data", "least")
        .mapInArrow(sufficient, "chunk long, block long, pairs binary").where(F.length("pairs") > 0)
        .groupBy("chunk", "block").agg(F.collect_list("pairs").alias("lists"))
    )

    # Phase 3: listed pairs scored whole, the best of each chunk, then the best of all.
    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, query_ids, total = (np.frombuffer(r[c], dtype="<i8") for c in ("ids", "query_ids", "least"))
                data, query_data = _matrix(r["data"], len(ids)), _matrix(r["query_data"], len(query_ids))
                pairs = np.unique(np.concatenate([np.frombuffer(x, dtype="<u4") for x in r["lists"]]))
                query, vector = pairs // len(ids), pairs % len(ids)
                bounds = np.searchsorted(query, np.arange(len(query_ids) + 1))
                found = [np.empty((3, 0), np.int64)]
                for q in np.flatnonzero(np.diff(bounds)):
                    at = vector[bounds[q] : bounds[q + 1]]
                    scores = _dot(query_data[q : q + 1], data[at])[0]
                    at, scores = at[scores >= total[q]], scores[scores >= total[q]]
                    keep = _best(scores, ids[at], k)
                    found.append(np.stack([np.full(len(keep), query_ids[q]), ids[at[keep]], scores[keep]]))
                q, v, s = np.concatenate(found, axis=1)
                part = pa.array(np.full(len(q), -1), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(q), part, pa.array(v), pa.array(s)], schema=_ENTRIES)

    whole = blocks.where("part = -1").select(
        F.col("chunk").alias("block"), F.col("ids").alias("query_ids"), F.col("data").alias("query_data"), "least"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        lists.join(chunks.where("part = -1").select("chunk", "ids", "data"), "chunk").join(whole, "block")
        .select("ids", "data", "query_ids", "query_data", "least", "lists").mapInArrow(resolved, ENTRY)
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
