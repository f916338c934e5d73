"""Exact covariance and whitening beside whole-number loops and the eigenvalue equation."""

from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import whitening as w
from cadastra.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def by_hand(rows):
    """n, sums, covariance as fractions, and the whole vectors of usable rows."""
    usable = [(i, v) for i, v in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    dims = max((len(v) for _, v in usable), default=0)
    xs = [(i, tuple(floor(max(-2**53, min(2**53, 256 * x))) for x in v) + (0,) * (dims - len(v))) for i, v in usable]
    fit = sorted({x for _, x in xs})
    n = len(fit)
    sums = [sum(x[k] for x in fit) for k in range(dims)]
    cov = [[Fraction(n * sum(x[a] * x[b] for x in fit) - sums[a] * sums[b], n * n) for b in range(dims)] for a in range(dims)]
    return n, sums, cov, xs


def check(got, rows):
    n, sums, cov, xs = by_hand(rows)
    v = np.array([[float(c) for c in row] for row in cov])
    assert {r.n for r in got} == {n}
    assert sorted({(r.vec_id, r.deviation) for r in got}, key=repr) == sorted(
        {(i, d if (d := sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))) < 2**63 else None) for i, x in xs}, key=repr
    )
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    for k in sorted({r.component for r in got}):
        own = [r for r in got if r.component == k]
        assert len(own) == len(xs)
        assert all(r.explained == pytest.approx(values[k - 1] / np.trace(v), rel=1e-6) for r in own)
        assert all(r.identity_error < 1e-6 for r in own)
        # Scores are linear in x: recover the direction, and check that it is a unit eigenvector.
        y = np.array([r.whitened for r in sorted(own, key=lambda r: r.vec_id)])
        x = np.array([[a - float(Fraction(s, n)) for a, s in zip(x, sums, strict=True)] for _, x in sorted(xs)])
        direction, *_ = np.linalg.lstsq(x, y * np.sqrt(values[k - 1]), rcond=None)
        assert np.linalg.norm(direction) == pytest.approx(1, rel=1e-6)
        assert np.allclose(v @ direction, values[k - 1] * direction, rtol=1e-6, atol=1e-6 * values[0])
        assert np.allclose(x @ direction / np.sqrt(values[k - 1]), y, atol=1e-6)


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 40, 1 << 53])
def test_cross_products_are_exact(top):
    rng = np.random.default_rng(top % 97)
    for n in (1, 63, 64, 65, 200):
        x = rng.integers(-top, top + 1, (n, 5))
        x[:, 2] = top  # a dimension without variance has no plane
        big = x.astype(object)
        assert (w.cross_products(x) == big.T.dot(big)).all()


def test_planes_hold_the_shifted_bits():
    x = np.array([[-3, 0], [4, 0], [-3, 0]])
    planes, low = w.bit_planes(x)
    assert low.tolist() == [-3, 0] and [len(p) for p in planes] == [3, 0]
    assert [int(np.bitwise_count(p).sum()) for p in planes[0]] == [1, 1, 1]


def test_rows_equal_fractions(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, (rng.normal(size=6) * [3, 2, 1, 0.5, 0.2, 0.1]).tolist()) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(80)]  # a third are copies of one vector
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("-inf")] * 6)]
    rows += [(304, [-0.0, 0.0]), (305, [])]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("other")).withColumn("n", F.lit(0))
    got = w.whiten(table.repartition(3)).collect()
    check(got, rows)
    assert {r.component for r in got} == {1, 2, 3, 4} and not {300, 301, 302, 303} & {r.vec_id for r in got}


def test_odd_tables(spark):
    read = lambda rows: w.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert read([]) == [] and read([(1, None)]) == [] and read([(1, [])]) == []
    assert read([(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == []  # one vector has no variance
    line = [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (None, [3.0, 1.0])]
    got = sorted((r.vec_id or 3, r.component, r.n, r.deviation) for r in read(line))
    assert got == [(1, 1, 3, 1024**2), (2, 1, 3, 256**2), (3, 1, 3, (5 * 256) ** 2)]
    huge = [(1, [1e300, 1e8]), (2, [-1e300, 2e8]), (3, [0.0, -3e8])]
    out = read(huge)
    check(out, huge)
    assert {r.deviation for r in out} == {None}


def test_query_equals_fractions(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(QUERIES["op11_whitening"](spark, FOLDER).collect(), rows)
