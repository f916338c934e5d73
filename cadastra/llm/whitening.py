"""Whitening of embeddings by an exact covariance from bit planes.

Whole numbers of each dimension are shifted to start at zero within a block of
rows and cut into bit planes; a plane is packed across rows, 64 rows a word.
The sum of products of two dimensions is then the sum, over their planes ``b``
and ``c``, of ``2 ** (b + c)`` times the set bits of both planes in common: AND
and popcount, no multiplication of values and nothing rounded.  A dimension of
ones beside the others yields sums and count by the same step.

A task keeps one matrix of whole numbers whatever its rows; matrices are added
up on the cluster in limbs of forty bits, centred as whole numbers and only then
divided and decomposed.  The driver holds one matrix of dimensions by dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SCALE = 256
COMPONENTS = 4
#: Rows whose planes are held at a time.
BLOCK_ROWS = 4096
#: Entries are kept within this bound, where doubles still are exact.
BOUND = 1 << 53
LIMB, LIMBS = 40, 5
#: Share of the trace below which a component has no variance of its own.
FLAT = 1e-12

_SUMS = pa.schema([("i", pa.int32()), ("j", pa.int32()), *((f"l{k}", pa.int64()) for k in range(LIMBS))])
_ROWS = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
])


def usable(vector: Column) -> Column:
    """Neither null nor holding null or non-finite entries."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every entry, as a long; beyond +-2**53 the bound itself."""
    bound = lambda x: F.greatest(F.least(x, F.lit(float(BOUND))), F.lit(-float(BOUND)))
    return F.transform(vector, lambda x: F.floor(bound(x.cast("double") * scale)).cast("long"))


def bit_planes(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Of a block of rows by dimensions: each dimension's packed planes after shifting, and the shifts."""
    low = x.min(axis=0)
    shifted = (x - low).astype(np.uint64)
    width = -(-len(x) // 64) * 64
    planes = []
    for column in shifted.T:
        bits = np.zeros((int(column.max()).bit_length(), width), dtype=np.uint8)
        for b in range(len(bits)):
            bits[b, : len(x)] = (column >> np.uint64(b)) & np.uint64(1)
        planes.append(np.packbits(bits, axis=1).view(np.uint64))
    return planes, low


def cross_products(x: np.ndarray) -> np.ndarray:
    """``x.T @ x`` as exact whole numbers, by AND and popcount of bit planes."""
    planes, low = bit_planes(x)
    d, n = x.shape[1], len(x)
    words = np.concatenate(planes) if d else np.zeros((0, 1), np.uint64)
    owner = np.repeat(np.arange(d), [len(p) for p in planes])
    place = np.concatenate([np.arange(len(p)) for p in planes]) if d else np.zeros(0, np.int64)
    out = np.zeros((d, d), dtype=object)
    sums = np.zeros(d, dtype=object)
    # Below 62 bits a dimension's weighted counts fit a long; wider ones add up as Python numbers.
    wide = len(place) and 2 * int(place.max()) + 2 + n.bit_length() >= 62
    weights = np.array([1 << int(b) for b in place], dtype=object if wide else np.int64)
    for k in range(len(words)):
        common = np.bitwise_count(words & words[k]).sum(axis=1, dtype=np.int64)
        part = np.zeros(d, dtype=weights.dtype)
        np.add.at(part, owner, weights * common)
        out[owner[k]] += part.astype(object) * (1 << int(place[k]))
        sums[owner[k]] += int(common[k]) << int(place[k])
    shift = np.array([int(v) for v in low], dtype=object)
    return out + np.outer(shift, sums) + np.outer(sums, shift) + np.outer(shift, shift) * n


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors of a batch as rows; entries that a shorter vector lacks are zero."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), dtype=np.int64)
    out[np.arange(dims) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def scatter(vectors: DataFrame, dims: int) -> list[list[int]]:
    """Exact sums of products of all rows' ``x``, with a dimension of ones at the end."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1), dtype=object)
        held, rows = [], 0

        def add() -> None:
            nonlocal total, held, rows
            total = total + cross_products(np.concatenate(held))
            held, rows = [], 0

        for batch in batches:
            x = _matrix(batch.column(0), dims)
            held.append(np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1))
            rows += len(x)
            if rows >= BLOCK_ROWS:
                add()
        if held:
            add()
        i, j = np.triu_indices(dims + 1)
        values, limbs = total[i, j], []
        for _ in range(LIMBS - 1):
            limbs.append(values & ((1 << LIMB) - 1))
            values = values >> LIMB
        columns = [i, j, *limbs, values]
        yield pa.RecordBatch.from_arrays([pa.array(c.tolist(), t.type) for c, t in zip(columns, _SUMS, strict=True)], schema=_SUMS)

    ddl = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    added = vectors.select("x").mapInArrow(sums, ddl).groupBy("i", "j").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)))
    out = [[0] * (dims + 1) for _ in range(dims + 1)]
    for r in added.toArrow().to_pylist():
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS))
    return out


@dataclass
class Whitening:
    """What whitens a vector: count and sums of the fit list, directions over deviations, shares of variance."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float

    def apply(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """Exact squared deviations (``None`` beyond a long) and whitened components of rows of whole numbers."""
        sums = np.array([int(s) for s in self.sums], dtype=object)
        widest = self.n * max(1, int(np.abs(x).max(initial=0))) + max([abs(s) for s in sums], default=0)
        if widest < 1 << 62 and widest * widest * max(1, x.shape[1]) < 1 << 63:
            centred = x * self.n - sums.astype(np.int64)
            squares = (centred * centred).sum(axis=1).tolist()
        else:
            centred = x.astype(object) * self.n - sums
            squares = [v if v < 1 << 63 else None for v in (centred * centred).sum(axis=1)]
        return squares, (centred.astype(np.float64) / max(self.n, 1)) @ self.directions


def decompose(products: list[list[int]], components: int = COMPONENTS) -> Whitening:
    """Whole-number centring, then one division and the eigenvectors of largest variance."""
    d, n = len(products) - 1, products[-1][-1]
    sums = np.array(products[-1][:d], dtype=object)
    centred = [[n * products[i][j] - products[i][d] * products[j][d] for j in range(d)] for i in range(d)]
    # Python divides whole numbers of any size with one rounding.
    v = np.array([[c / (n * n) for c in row] for row in centred], dtype=np.float64).reshape(d, d)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(v))
    order = order[values[order] > FLAT * trace] if trace > 0 else order[:0]
    # One step of Rayleigh quotients settles the last digits of the variances.
    units = vectors[:, order] / np.linalg.norm(vectors[:, order], axis=0)
    spread = np.einsum("ik,ij,jk->k", units, v, units)
    directions = units / np.sqrt(spread)
    error = np.abs(directions.T @ v @ directions - np.eye(len(order))).max(initial=0.0)
    return Whitening(n, sums, directions, spread / trace if trace > 0 else spread, float(error))


def whiten(table: DataFrame, vector: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component.

    Entries become ``x = floor(scale * entry)``.  Mean and covariance are over
    each distinct ``x`` vector once, ``n`` of them; ``deviation`` is the exact
    sum over dimensions of ``(n * x - sum) ** 2``, null where a long can't hold
    it; ``whitened`` is ``x`` less the mean, projected on a unit eigenvector
    and divided by its standard deviation; ``explained`` its share of variance;
    ``identity_error`` the largest entry of the whitened covariance less one.

    Null vectors and those with null or non-finite entries give no rows; a
    null id stays null; repeated rows are each returned.  Entries a shorter
    vector lacks are zero; entries beyond +-2**53 count as that bound.
    Components without variance (fewer dimensions or vectors) are left out; of
    equal variances any directions are taken, the same for all rows.  Other
    columns are ignored; an empty table gives no rows.
    """
    rows = cut_lineage(
        table.where(usable(F.col(vector))).select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col(vector), scale).alias("x")),
        "whole-vectors",
    )
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    # A shorter vector equals the longer one that has zeros in its place.
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), dims - F.size("x")))
    distinct = rows.select(filled.alias("x")).distinct()
    model = decompose(scatter(distinct, dims), components)

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.directions.shape[1]
        for batch in batches:
            squares, scores = model.apply(_matrix(batch.column(1), dims))
            at = np.repeat(np.arange(len(batch)), k)
            columns = [
                batch.column(0).take(pa.array(at)), np.tile(np.arange(1, k + 1), len(batch)), np.full(len(at), model.n),
                pa.array(squares, pa.int64()).take(pa.array(at)), scores.ravel(), np.tile(model.explained, len(batch)),
                np.full(len(at), model.identity_error),
            ]
            arrays = [(c if isinstance(c, pa.Array) else pa.array(c)).cast(t.type) for c, t in zip(columns, _ROWS, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_ROWS)

    return rows.mapInArrow(
        whitened,
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
