"""Ring repair beside an exact area by horizontal slabs."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.operators import rings as rg
from cadastra.operators import spatial as sp


def odd_area(rings):
    """Area inside an odd number of rings: between all heights where something happens, trapezoids of every second gap."""
    edges = []
    for ring in rings:
        at = [(Fraction(x), Fraction(y)) for x, y in ring]
        edges += [(p, q) for p, q in zip(at, at[1:] + at[:1], strict=True) if p[1] != q[1]]
    heights = {y for p, q in edges for _, y in (p, q)}
    for i, (p, q) in enumerate(edges):
        for r, s in edges[:i]:
            den = (q[0] - p[0]) * (s[1] - r[1]) - (q[1] - p[1]) * (s[0] - r[0])
            if den:
                t = ((r[0] - p[0]) * (s[1] - r[1]) - (r[1] - p[1]) * (s[0] - r[0])) / den
                if 0 <= t <= 1:
                    heights.add(p[1] + t * (q[1] - p[1]))
    heights = sorted(heights)
    total = Fraction(0)
    for low, high in zip(heights, heights[1:], strict=False):
        x_at = lambda e, y: e[0][0] + (y - e[0][1]) * (e[1][0] - e[0][0]) / (e[1][1] - e[0][1])
        here = [e for e in edges if min(e[0][1], e[1][1]) <= low and high <= max(e[0][1], e[1][1])]
        here.sort(key=lambda e: x_at(e, (low + high) / 2))
        for a, b in zip(here[::2], here[1::2], strict=True):
            total += (high - low) * (x_at(b, low) - x_at(a, low) + x_at(b, high) - x_at(a, high)) / 2
    return total


def crossing_pairs(rings):
    """Pairs of edges of all rings that share more than a corner."""
    edges = [(tuple(p), tuple(q)) for r in rings for p, q in zip(r, np.roll(r, -1, axis=0), strict=True)]
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return sum(
        turn(a, b, c) * turn(a, b, d) < -1e-9 and turn(c, d, a) * turn(c, d, b) < -1e-9
        for i, (a, b) in enumerate(edges) for c, d in edges[:i]
    )


@pytest.mark.parametrize("seed", range(6))
def test_area_of_random_rings(seed):
    """Few whole coordinates, so corners, borders and whole edges fall together often."""
    rng = random.Random(seed)
    for _ in range(60):
        rings = [[(rng.randrange(7), rng.randrange(7)) for _ in range(rng.randrange(3, 9))] for _ in range(rng.randrange(1, 4))]
        want = odd_area(rings)
        shift = np.array([rng.choice([0, 150.25, 1e6]), 33.5])
        given = [np.array(r, dtype=float) + shift for r in rings]
        try:
            got = rg.arrange(given)
        except ValueError:
            assert want == 0
            continue
        if got is None:  # rings that only meet in their own corners, possibly one inside another
            assert len(rings) > 1 or abs(rg.signed_area(given[0])) == pytest.approx(float(want))
            continue
        assert sum(map(rg.signed_area, got)) == pytest.approx(float(want), rel=1e-6)
        assert crossing_pairs(got) == 0
        for ring in got:
            assert len({tuple(np.round(p, 6)) for p in ring}) == len(ring)  # no corner twice


def test_rows_are_repaired_rejected_or_left(spark):
    def ring(*points):
        return [(float(x), float(y)) for x, y in [*points, points[0]]]

    square = ring((0, 0), (10, 0), (10, 10), (0, 10))
    at_corner = ring((10, 10), (8, 5), (5, 8))
    rows = [
        (1, [square, at_corner], 89.5), (2, [at_corner, square], 89.5), (3, [square, ring((2, 2), (4, 2), (4, 4), (2, 4))], 96.0),
        (4, [ring((0, 0), (8, 6), (8, 0), (0, 10))], 8 * (36 + 100) / 32), (5, [ring((0, 0), (5, 5), (9, 9))], None),
        (6, [ring((0, 0), (float("nan"), 1), (1, 1))], None), (7, [], None), (8, None, None),
        (9, [ring((0, 0), (2, 2), (0, 2), (2, 0))], 2.0), (10, [square, square], None), (11, [square, ring((20, 0), (21, 0), (20, 1))], 100.5),
        (12, [[(0.0, 0.0), (1.0, None), (1.0, 1.0), (0.0, 0.0)]], None),
    ]
    table = spark.createDataFrame([r[:2] for r in rows], f"i int, r {sp.GEOMETRY}")
    fixed = sp.with_repaired(table, "r", "g")
    got = {r.i: r for r in fixed.select("i", "g", sp.planar_area("g").alias("area")).collect()}
    assert {i: got[i].area and round(got[i].area, 9) for i, _, _ in rows} == {i: a for i, _, a in rows}
    assert sorted(r.i for r in sp.repair_rejects(fixed, "r", "g").collect()) == [5, 6, 7, 10, 12]
    assert [[tuple(p) for p in r] for r in got[3].g][0] == square  # untouched points
    hole = {i: sorted(round(sum(p.x * q.y - q.x * p.y for p, q in zip(r, r[1:], strict=False)) / 2, 6) for r in got[i].g) for i in (1, 2, 3, 4)}
    assert hole[1] == hole[2] == [-10.5, 100] and hole[3] == [-4, 100] and all(a > 0 for a in hole[4])


def test_a_border_of_many_edges():
    turn = np.linspace(0, 2 * np.pi, 20_001)[:-1]
    circle = np.stack([np.cos(turn), np.sin(turn)], axis=1)
    assert rg.arrange([circle]) is None
    eight = np.stack([np.sin(2 * turn + 0.1), np.sin(turn + 0.05)], axis=1)
    halves = rg.arrange([eight])
    assert len(halves) == 2 and sum(map(rg.signed_area, halves)) == pytest.approx(8 / 3, rel=1e-5)


def test_shapes_arranged_together():
    """Many shapes at a time give what each gives alone, whatever stands beside it and however they are cut up."""
    rng = random.Random(11)
    shapes = [[np.array([(rng.randrange(6), rng.randrange(6)) for _ in range(rng.randrange(3, 8))], dtype=float) for _ in range(rng.randrange(1, 4))] for _ in range(200)]
    shapes[7][0][0, 0] = np.nan
    rings = [r for s in shapes for r in s]
    given = np.concatenate(rings), np.array([len(r) for r in rings]), np.array([len(s) for s in shapes])
    for pairs in (rg.PAIRS, 500):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(rg, "PAIRS", pairs)
            points, sizes, owner, kind = rg.repaired_batch(*given)
        parts = np.split(points, np.cumsum(sizes)[:-1])
        assert set(kind) == {rg.AS_IS, rg.REPAIRED, rg.BROKEN}
        for i, shape in enumerate(shapes):
            got = [p for p, o in zip(parts, owner, strict=True) if o == i]
            try:
                want = rg.arrange(shape)
            except ValueError:
                assert kind[i] == rg.BROKEN and not got
                continue
            assert kind[i] == (rg.AS_IS if want is None else rg.REPAIRED)
            assert [p.tolist() for p in got] == [p.tolist() for p in want or []]


def test_repair_is_dealt_over_tasks(spark):
    """A table of shapes in one split is repaired in several tasks."""
    crossing = [(0.0, 0.0), (8.0, 6.0), (8.0, 0.0), (0.0, 10.0), (0.0, 0.0)]
    table = spark.createDataFrame([(i, [crossing]) for i in range(40)], f"i int, r {sp.GEOMETRY}").coalesce(1)
    tasks = sp.with_repaired(table, "r", "g").filter("g IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 40
