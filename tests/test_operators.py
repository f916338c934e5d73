"""Operators against brute force on small, skewed inputs."""

import contextlib
import hashlib
import itertools
import math
import random
import struct
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.operators import aggregates as ag
from cadastra.operators import history as hi
from cadastra.operators import linkage as li
from cadastra.operators import shards as sh
from cadastra.operators import sinks
from cadastra.operators import spatial as sp
from cadastra.operators.keys import keep_first, stable_id
from cadastra.operators.quality import ConstraintError


def skewed(n=400):
    """One key holds most rows."""
    rng = random.Random(7)
    return [(i, 0 if rng.random() < 0.7 else rng.randrange(1, 5), rng.randrange(0, 60), rng.randrange(0, 9)) for i in range(n)]


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame(skewed(), "id int, k int, t int, v int").repartition(4)
    kept = keep_first(df, ["k"], [F.col("t").desc(), F.col("id").asc()])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(k#", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below
    want = {}
    for i, k, t, _ in skewed():
        want[k] = min(want.get(k, (1, 0)), (-t, i))
    assert {r.k: (-r.t, r.id) for r in kept.collect()} == want


def test_ids_do_not_change(spark):
    df = spark.range(3).select(stable_id("id", F.lit("x")).alias("a"))
    assert df.collect() == df.collect() and len({r.a for r in df.collect()}) == 3


def test_as_of(spark):
    days = [date(2020, 1, 1) + timedelta(days=10 * i) for i in range(40)]
    rows = [(i, i % 3, days[(i * 7) % 40]) for i in range(60)]
    cuts = [date(2019, 1, 1), date(2020, 3, 1), date(2020, 9, 9), date(2022, 1, 1)]
    df = spark.createDataFrame(rows, "id int, k int, d date")
    got = {(r.cutoff, r.k): r.id for r in hi.as_of(df, ["k"], "d", cuts, ["id"]).collect()}
    want = {}
    for c in cuts:
        for k in range(3):
            fit = [(d, i) for i, kk, d in rows if kk == k and d <= c]
            if fit:
                want[c, k] = max(fit)[1]
    assert got == want


@pytest.mark.parametrize("seconds,depth", [(30, 5), (29, 5), (30, 2), (5, 1000)])
def test_trailing_rate(spark, seconds, depth):
    rng = random.Random(3)
    rows = [(i, i % 2 if i > 150 else 0, rng.randrange(0, 3000), float(rng.randrange(100))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k int, s int, v double").withColumn("ts", F.timestamp_seconds("s"))
    out = hi.trailing_rate(df, ["k"], "ts", "v", seconds, depth, "id", slice_factor=2)
    got = {r.id: (r.window_rows, round(r.rate, 9)) for r in out.collect()}
    for k in (0, 1):
        line = sorted((s, i, v) for i, kk, s, v in rows if kk == k)
        for n, (s, i, v) in enumerate(line):
            kept = [x for x in line[: n + 1] if s - x[0] <= seconds][-depth:]
            # Samples of the same second as the current one but later ids do not count.
            dt = s - kept[0][0]
            assert got[i] == (len(kept), round((v - kept[0][2]) / dt, 9) if dt else 0.0)


def test_percentile_rank_and_segments(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "id int, k int, t int, v int")
    got = {r.k: r.p for r in ag.group_percentile(df, ["k"], "t", 0.83, "p").collect()}
    for k in got:
        assert got[k] == pytest.approx(np.percentile([t for _, kk, t, _ in rows if kk == k], 83))
    ranks = {r.id: r["rank"] for r in ag.global_rank(df, "t").collect()}
    assert ranks == {i: 1 + sum(x < t for _, _, x, _ in rows) for i, _, t, _ in rows}
    dated = df.withColumn("d", F.date_add(F.lit(date(2020, 1, 1)), F.col("t")))
    days = sorted(t for _, _, t, _ in rows)
    for n in (3, 7, 401):
        segments = {r.segment: r for r in ag.equal_segments(dated, "d", n).collect()}
        parts = [p for p in np.array_split(days, n) if len(p)]
        assert len(segments) == len(parts)
        for i, p in enumerate(parts, 1):
            s = segments[i]
            first, last = date(2020, 1, 1) + timedelta(int(p[0])), date(2020, 1, 1) + timedelta(int(p[-1]))
            assert (s.start_date, s.end_date, s.count_in_segment) == (first, last, len(p))


def test_value_runs_and_null_groups(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, v string")
    runs = ag.value_runs(df, ["k"], "v", "x").withColumn("y", ag.expand_runs("x"))
    assert {r.k: r.y for r in runs.collect()} == {1: ["a", "b", "b"], None: ["c"]}
    assert spark.range(1).select(ag.expand_runs(F.lit(None).cast("array<struct<value:string,n:bigint>>"))).first()[0] == []


# ------------------------------------------------------------------ sinks


def test_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, 5, "c")], "k int, u int, v string")
    sinks.append_new(first, path, ["k", "u"])
    sinks.append_new(first, path, ["k", "u"])
    more = spark.createDataFrame([(2, 5, "x"), (2, None, "y")], first.schema)
    sinks.append_new(more, path, ["k", "u"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, None, "a"), (2, 5, "c"), (2, None, "y")}
    strict = str(tmp_path / "s")
    sinks.append_strict(more, strict, ["k", "u"])
    with pytest.raises(ConstraintError):
        sinks.append_strict(more, strict, ["k", "u"])
    by_kind = {"a": str(tmp_path / "ka"), "c": str(tmp_path / "kc")}
    sinks.append_by_kind(first, "v", by_kind, ["k", "u"])
    assert spark.read.parquet(by_kind["a"]).count() == 1


def test_bucketed_table_needs_no_shuffle(spark, tmp_path):
    df = spark.createDataFrame(skewed(), "id int, k int, t int, v int")
    saved = sinks.save_bucketed(df, "bucketed_rows", "id", str(tmp_path / "b"))
    plan = saved.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    sinks.drop_tables(spark, ["bucketed_rows"])


# ---------------------------------------------------------------- spatial


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


L_SHAPE = ring((0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4), (0, 0))
SQUARE = ring((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))
HOLED = [ring((0, 0), (6, 0), (6, 6), (0, 6), (0, 0)), ring((1, 1), (1, 5), (5, 5), (5, 1), (1, 1))]


@pytest.mark.parametrize(
    "a,b,area",
    [
        ([SQUARE], [SQUARE], 4.0),
        ([L_SHAPE], [SQUARE], 3.0),
        ([SQUARE], [ring((2, 0), (4, 0), (4, 2), (2, 2), (2, 0))], 0.0),
        (HOLED, [ring((0, 0), (3, 0), (3, 3), (0, 3), (0, 0))], 5.0),
        (HOLED, [ring((2, 2), (3, 2), (3, 3), (2, 3), (2, 2))], 0.0),
        ([L_SHAPE], [ring((-1, 0.5), (5, 0.5), (5, 0.75), (-1, 0.75), (-1, 0.5))], 1.0),
        ([L_SHAPE], HOLED, 7.0),
        ([ring((0, 0), (4, 0), (0, 4), (0, 0))], [SQUARE], 4.0),
    ],
)
def test_overlap(spark, a, b, area):
    df = spark.createDataFrame([(a, b)], f"a {sp.GEOMETRY}, b {sp.GEOMETRY}")
    row = df.select(sp.overlap_area("a", "b").alias("x"), sp.overlap_area("b", "a").alias("y")).first()
    assert row.x == pytest.approx(area, abs=1e-9) and row.y == pytest.approx(area, abs=1e-9)


def test_overlap_of_long_borders_in_pieces(monkeypatch):
    turn = np.linspace(0, 2 * np.pi, 400)
    points = np.c_[np.cos(turn), np.sin(turn)]
    points[-1] = points[0]
    circle = np.hstack([points[:-1], points[1:]])
    box = np.array([[0, -2, 2, -2], [2, -2, 2, 2], [2, 2, 0, 2], [0, 2, 0, -2]], dtype=float)
    whole = sp._shared_areas([circle, box], [box, circle])
    monkeypatch.setattr(sp, "EDGE_PAIRS", 300)
    assert sp._shared_areas([circle, box], [box, circle]) == pytest.approx(whole)
    assert whole == pytest.approx([np.pi / 2] * 2, abs=1e-3)


def test_measures(spark):
    df = spark.createDataFrame([([L_SHAPE], HOLED)], f"a {sp.GEOMETRY}, b {sp.GEOMETRY}")
    row = df.select(
        sp.planar_area("a").alias("area_a"), sp.planar_area("b").alias("area_b"), sp.centroid("b").alias("c"),
        sp.intersects("a", "b").alias("i"), sp.wkt_from_rings("b").alias("w"),
    ).first()
    assert (row.area_a, row.area_b, tuple(row.c), row.i) == (7.0, 20.0, (3.0, 3.0), True)
    assert row.w == "MULTIPOLYGON (((0.0 0.0, 6.0 0.0, 6.0 6.0, 0.0 6.0, 0.0 0.0), (1.0 1.0, 1.0 5.0, 5.0 5.0, 5.0 1.0, 1.0 1.0)))"
    back = df.select(sp.rings_from_wkt(F.lit(row.w)).alias("g"), F.col("b")).first()
    assert back.g == back.b


def test_wkb(spark):
    def polygon(rings):
        body = b"\x01" + struct.pack("<II", 3, len(rings))
        for r in rings:
            body += struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in r)
        return body

    multi = b"\x01" + struct.pack("<II", 6, 2) + polygon(HOLED) + polygon([SQUARE])
    df = spark.createDataFrame([(bytearray(multi),), (None,)], "w binary")
    rows = df.select(sp.rings_from_wkb("w").alias("g")).collect()
    assert [[p.asDict() for p in r] for r in rows[0].g] == [*HOLED, SQUARE] and rows[1].g is None


def test_repair(spark):
    open_ring = ring((0, 0), (0, 2), (0, 2), (2, 2), (2, 0))
    collapsed = ring((0, 0), (1, 1), (0, 0))
    df = spark.createDataFrame([(1, [open_ring, collapsed]), (2, [collapsed])], f"i int, r {sp.GEOMETRY}")
    rows = {r.i: r.g for r in sp.with_repaired(df, "r", "g").collect()}
    assert [tuple(p) for p in rows[1][0]] == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)] and len(rows[1]) == 1
    assert rows[2] is None


def test_joins_with_a_hot_cell(spark):
    rng = random.Random(5)

    def box(x, y, w):
        return [ring((x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y))]

    small = [(i, box(rng.random() * (3 if i % 3 else 60), rng.random() * (3 if i % 3 else 60), 1 + i % 3)) for i in range(90)]
    large = [(i, box(rng.random() * 50, rng.random() * 50, 8)) for i in range(12)]
    a = spark.createDataFrame(small, f"i int, g {sp.GEOMETRY}")
    b = spark.createDataFrame(large, f"j int, h {sp.GEOMETRY}")

    def touch(p, q):
        (p0, p1), (q0, q1) = (p[0][0], p[0][2]), (q[0][0], q[0][2])
        return all(p0[c] <= q1[c] and q0[c] <= p1[c] for c in "xy")

    want = sorted((i, j) for (i, p), (j, q) in itertools.product(small, large) if touch(p, q))
    for cell, target in ((5.0, 50_000), (5.0, 3), (100.0, 7)):
        pairs = sp.candidate_pairs(a, b, "g", "h", cell, target)
        assert sorted((r.i, r.j) for r in pairs.collect()) == want
    assert sorted((r.i, r.j) for r in sp.intersects_join(a, b, "g", "h", 5.0).collect()) == want


def test_area_over_many_cells(spark):
    """One area over 100,000 cells beside shapes of every size, ties on cell borders, repeated rows and missing shapes."""
    rng = random.Random(9)

    def box(x, y, w, h):
        return [ring((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]

    sizes = [0.0, 0.5, 1, 2, 3, 8, 31, 64]
    small = [(i, box(rng.randrange(330), rng.randrange(330), w := rng.choice(sizes), w / 2)) for i in range(150)]
    small += [small[0], (900, None), (901, [])]
    large = [(1, box(0, 0, 320, 320)), (2, box(-5, 7, 700, 0.25)), *[(10 + i, box(i * 20, i * 9, sizes[i % 8], 40)) for i in range(16)]]
    a = spark.createDataFrame(small, f"i int, g {sp.GEOMETRY}")
    b = spark.createDataFrame(large, f"j int, h {sp.GEOMETRY}")

    def touch(p, q):
        (p0, p1), (q0, q1) = (p[0][0], p[0][2]), (q[0][0], q[0][2])
        return all(p0[c] <= q1[c] and q0[c] <= p1[c] for c in "xy")

    want = sorted((i, j) for (i, p), (j, q) in itertools.product(small, large) if p and touch(p, q))
    for target in (50_000, 3):
        pairs = sp.candidate_pairs(a, b, "g", "h", 1.0, target)
        assert sorted((r.i, r.j) for r in pairs.collect()) == want
    assert sp.candidate_pairs(a.limit(0), b, "g", "h", 1.0).count() == 0

    boxes = b.filter("j = 1").select("j", sp.bbox("h").alias("_box")).withColumn("_level", sp._level(F.col("_box"), 1.0))
    entries = sp.cell_entries(boxes, "_box", 1.0, range(10), 1, 2)
    assert entries.count() <= 9 and set(entries.columns) == {"j", "_box", "_level", "_at", "_meets", "_cell"}


def test_crowded_pairs_are_neither_written_nor_moved(spark, monkeypatch):
    """Where pairs outnumber the rows, rows are entered whole; repeated rows, names shared by both sides and missing shapes as ever."""
    rng = random.Random(8)

    def corner(x, y, w):
        return [ring((x, y), (x + w, y), (x, y + w), (x, y))]

    at = lambda: rng.randrange(20) / 2
    left = [(i, corner(at(), at(), 1 + i % 9)) for i in range(60)]
    left += [left[0], (900, None), (901, []), (None, corner(3, 3, 4))]
    right = [(i, corner(at(), at(), 2 + i % 5)) for i in range(50)] + [(7, corner(0, 0, 40))]
    a = spark.createDataFrame(left, f"i int, g {sp.GEOMETRY}")
    b = spark.createDataFrame(right, f"i int, h {sp.GEOMETRY}")
    written, write = [], sp.cut_lineage
    monkeypatch.setattr(sp, "cut_lineage", lambda df, name: written.append(name) or write(df, name))

    def rows(target):
        written.clear()
        pairs = sp.candidate_pairs(a, b, "g", "h", 4.0, target)
        assert pairs.columns == ["i", "g", "_lbox", "i", "h", "_rbox"]
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        named = pairs.toDF("i", "g", "lbox", "j", "h", "rbox").withColumn("shared", F.round(sp.overlap_area("g", "h"), 9))
        return sorted((str(tuple(r)) for r in named.collect())), plan

    want, _ = (monkeypatch.setattr(sp, "CROWDED", 10**9), rows(50_000))[1]
    assert "pairs" in written and len(want) > 500
    monkeypatch.setattr(sp, "CROWDED", 4)
    for target in (50_000, 3):
        got, plan = rows(target)
        assert got == want and "pairs" not in written
        assert "SortMergeJoin" in plan


def test_overlap_far_from_the_origin(spark):
    """The measure does not depend on where shapes lie: no border is cut within a tolerance."""
    rng = random.Random(3)

    def star(x, y, r, n):
        turns = [(k + rng.random() * 0.5) * 2 * np.pi / n for k in range(n)]
        points = [(x + round(r * (0.5 + rng.random()) * np.cos(t) * 1024) / 1024, y + round(r * np.sin(t) * 1024) / 1024) for t in turns]
        return ring(*points, points[0])

    def moved(shape, by):
        return [{"x": p["x"] + by, "y": p["y"] + by} for p in shape]

    pairs = [(star(0, 0, 5, rng.randint(5, 40)), star(rng.randrange(4), 2, rng.choice([1, 5, 50]), rng.randint(5, 40))) for _ in range(300)]
    rows = [(i, [moved(a, by)], [moved(b, by)]) for i, (a, b) in enumerate(pairs) for by in (0.0, float(1 << 23))]
    rows += [(998, None, [pairs[0][0]]), (999, [pairs[0][0]], []), (999, [[]], [pairs[0][0]]), (998, [pairs[0][0], None], [pairs[0][1]])]
    table = spark.createDataFrame(rows, f"i int, a {sp.GEOMETRY}, b {sp.GEOMETRY}")
    shared = [(r.i, r.x) for r in table.select("i", sp.overlap_area("a", "b").alias("x")).collect()]
    assert [x for i, x in shared if i >= 998] == [None] * 4
    found = {}
    for i, x in shared:
        found.setdefault(i, []).append(x)
    assert all(x == pytest.approx(y, abs=1e-9) for i, (x, y, *_) in found.items() if i < 998)
    assert sum(x > 1 for x, *_ in list(found.values())[:300]) > 100


def test_boxes_and_other_shapes_in_one_join(spark, monkeypatch):
    """Pairs of plain boxes are settled without their geometry, in several tasks; all others by geometry; areas are measured once a shape."""
    rng = random.Random(4)

    def box(x, y, w):
        return [ring((x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y))]

    def corner(x, y, w):
        return [ring((x, y), (x + w, y), (x, y + w), (x, y))]

    at = lambda: rng.randrange(40)
    left = [(i, (box, corner)[i % 2](at(), at(), 1 + i % 4)) for i in range(80)] + [(900, None), (901, [])]
    right = [(i, (box, corner)[i % 3 == 0](at(), at(), 12)) for i in range(20)]
    a = spark.createDataFrame(left, f"i int, g {sp.GEOMETRY}").coalesce(1)
    b = spark.createDataFrame(right, f"j int, h {sp.GEOMETRY}").coalesce(1)
    every = a.crossJoin(b).filter("size(g) > 0").withColumn("touch", sp.intersects("g", "h")).withColumn("shared", sp.overlap_area("g", "h"))
    every = every.select("i", "j", "touch", (F.col("shared") / sp.planar_area("g")).alias("share")).collect()
    touching = sp.intersects_join(a, b, "g", "h", 5.0)
    assert sorted((r.i, r.j) for r in touching.collect()) == sorted((r.i, r.j) for r in every if r.touch)
    over = sp.overlap_join(a, b, "g", "h", 5.0, 0.3)
    assert over.columns == ["i", "g", "j", "h", "share"]
    got = {(r.i, r.j): r.share for r in over.collect()}
    assert got == pytest.approx({(r.i, r.j): r.share for r in every if r.share > 0.3})
    found = sp._numbered_pairs(a, b, "g", "h", 5.0, 50_000)[0]
    assert len(found.inputFiles()) > 1
    looked_at = found.filter("NOT _boxes").count()
    assert 0 < looked_at < found.count()


def test_shapes_of_several_parts(spark):
    square = lambda x, y, w: ring((x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y))
    two = [square(0, 0, 1), square(20, 20, 2)]
    holed = [square(100, 0, 1), square(0, 0, 10), square(3, 3, 2), square(3.5, 3.5, 0.5)]
    cases = [
        (two, [square(10, 10, 30)], True), (two, [square(5, 5, 2)], False), (two, [square(20.5, 20.5, 0.1)], True),
        (holed, [square(4.2, 4.2, 0.1)], False), (holed, [square(3.6, 3.6, 0.1)], True), (holed, [square(1, 1, 1)], True),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], f"i int, a {sp.GEOMETRY}, b {sp.GEOMETRY}")
    both = df.select("i", sp.intersects("a", "b").alias("x"), sp.intersects("b", "a").alias("y")).orderBy("i").collect()
    assert [(r.x, r.y) for r in both] == [(w, w) for *_, w in cases]
    area = sp.with_repaired(df.filter("i = 3"), "a", "fixed").select(sp.planar_area("fixed").alias("p")).first().p
    assert area == pytest.approx(1 + 100 - 4 + 0.25)


@pytest.mark.parametrize("share", [0.0, 0.5, 0.8333, 1.0])
def test_percentile_of_a_large_group(spark, share):
    """Large enough for the bracket to leave most values out; many ties, and a group of its own beside."""
    df = spark.range(120_000).selectExpr(
        "CASE WHEN id % 40 = 0 THEN NULL ELSE 'k' END AS k", "CAST(pmod(xxhash64(id), 50000) AS DOUBLE) * IF(id % 3 = 0, 0, 1) AS v"
    )
    want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", share).alias("p")).collect()}
    got = {r.k: r.p for r in ag.group_percentile(df, ["k"], "v", share, "p").collect()}
    assert got == pytest.approx(want)


def test_ranks_of_nulls_and_neighbours(spark):
    rows = [(1, 2**53), (2, 2**53 + 1), (3, None), (4, 2**53), (5, None), (6, -1)]
    ranked = ag.global_rank(spark.createDataFrame(rows, "id int, v long"), "v")
    assert {r.id: r["rank"] for r in ranked.collect()} == {6: 1, 1: 2, 4: 2, 2: 4, 3: 5, 5: 5}


@pytest.mark.parametrize("kind", ["double", "string", "date", "decimal(20,2)"])
def test_rank_of_a_value_that_fills_ranges(spark, kind):
    """Half of all rows share one value, so it lies in several ranges; NaN and both zeros included."""
    value = {
        "double": "CASE WHEN id % 2 = 0 THEN 0.0 WHEN id % 41 = 0 THEN double('NaN') WHEN id % 43 = 0 THEN -0.0 ELSE id % 997 - 300 END",
        "string": "IF(id % 2 = 0, 'k', CAST(id % 997 AS STRING))",
        "date": "date_add(DATE '2020-01-01', IF(id % 2 = 0, 400, CAST(id % 997 AS INT)))",
        "decimal(20,2)": "IF(id % 2 = 0, 400, id % 997) / 4",
    }[kind]
    df = spark.range(0, 30_000, 1, 5).selectExpr("id", f"CAST(IF(id % 50 = 1, NULL, {value}) AS {kind}) AS v")
    want = df.selectExpr("id", "rank() OVER (ORDER BY v NULLS LAST) AS r")
    got = ag.global_rank(df, "v")
    assert {(r.id, r["rank"]) for r in got.collect()} == {(r.id, r.r) for r in want.collect()}


def test_rank_without_rows_and_of_nulls_alone(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v double")
    assert {(r.id, r["rank"]) for r in ag.global_rank(df, "v").collect()} == {(1, 1), (2, 1)}
    assert ag.global_rank(df.limit(0), "v").collect() == []


# ---------------------------------------------------------------- linkage


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def cost(a, b):
    share = (1 - lev(a, b) / max(len(a), len(b))) * 100
    return 100 - int(share + 0.5)


NAMES = ["HIGH STREET", "HIGH STREE", "HIGHT STREET", "LOW ROAD", "LOWE ROAD", "PARK AVENUE", "PARKS AVENUE", "ZZ"]
CHOICES = ["HIGH STREET", "HIGH STREETS", "LOW ROAD", "LOW ROADS", "PARK AVENUE", "KING ST"]


def frames(spark):
    names = spark.createDataFrame([("B", n) for n in NAMES] + [("C", "X")], "b string, n string")
    choices = spark.createDataFrame([("B", c) for c in CHOICES] + [("D", "X")], "b string, c string")
    return names, choices


@pytest.mark.parametrize("bounds", [((1, 5), (2, 5)), ()])
def test_best_match(spark, bounds):
    names, choices = frames(spark)
    got = {r.n: (r.c, round(r.score, 9)) for r in li.best_match(names, choices, ["b"], "n", "c", bounds=bounds).collect()}
    for n in NAMES:
        best = min((-(1 - lev(n, c) / max(len(n), len(c))), c) for c in CHOICES)
        assert got[n] == (best[1], round(-best[0], 9))
    assert set(got) == set(NAMES)


def edited(rng, text, letters):
    text = list(text)
    for _ in range(rng.randrange(0, 5)):
        at = rng.randrange(len(text) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            text.insert(at, rng.choice(letters))
        elif text and at < len(text):
            text[at : at + 1] = [] if kind == 1 else [rng.choice(letters)]
    return "".join(text)


@pytest.mark.parametrize("letters", ["ab", "abcdefgh "])
def test_similarity_join_equals_all_pairs(spark, letters):
    """A third of all names in one block, few letters, lengths from nothing up."""
    rng = random.Random(len(letters))
    texts = {"".join(rng.choice(letters) for _ in range(rng.randrange(0, 24))) for _ in range(120)}
    sides = []
    for _ in range(2):
        rows = {(rng.choice(["hot", "hot", "a", "b", "c", "d"]), edited(rng, t, letters)) for t in texts for _ in range(2)}
        sides.append(sorted(rows) + [("hot", None), (None, "abc")])
    names, choices = spark.createDataFrame(sides[0], "b string, n string"), spark.createDataFrame(sides[1], "b string, c string")
    both = [(b, n, c) for b, n in sides[0] for d, c in sides[1] if b == d and None not in (b, n, c)]
    share = lambda n, c: 1 - lev(n, c) / max(len(n), len(c)) if n or c else 1.0
    for limit in (0, 5, 20, 33):
        pairs = li.near_pairs(names, choices, ["b"], "n", "c", limit)
        want = sorted((b, n, c, p) for b, n, c in both if (p := 100 - int(share(n, c) * 100 + 0.5)) <= limit)
        assert sorted(tuple(r) for r in pairs.collect()) == want and want
    best = {}
    for b, n, c in both:
        best[b, n] = min(best.get((b, n), (9, "")), (-share(n, c), c))
    got = {(r.b, r.n): (-r.score, r.c) for r in li.best_match(names, choices, ["b"], "n", "c").collect()}
    assert {k: (round(s, 9), c) for k, (s, c) in got.items()} == {k: (round(s, 9), c) for k, (s, c) in best.items()}
    with pytest.raises(ValueError):
        li.near_pairs(names, choices, ["b"], "n", "c", 40)


def cheapest(names, choices, limit=20):
    """Total of the best assignment by trying all."""
    options = [[c for c in choices if cost(n, c) <= limit] + [None] for n in names]
    best = None
    for pick in itertools.product(*options):
        used = [p for p in pick if p]
        if len(used) == len(set(used)):
            total = sum(cost(n, p) if p else 100 for n, p in zip(names, pick))
            best = total if best is None else min(best, total)
    return best


def assigned(spark, names, choices, **how):
    left_side = spark.createDataFrame([("B", n) for n in names] + [("C", "X"), ("B", None)], "b string, n string")
    right_side = spark.createDataFrame([("B", c) for c in choices] + [("D", "X"), (None, "X")], "b string, c string")
    pairs, left = li.assign_one_to_one(left_side, right_side, ["b"], "n", "c", **how)
    return sorted(pairs.collect()), {r.n for r in left.collect()}


@pytest.mark.parametrize("piece_edges", [100_000, 3])
@pytest.mark.parametrize("names,choices", [(NAMES, CHOICES), (["HIGH STREET", "HIGH STREE", "LOW ROAD"], ["HIGH STREET", "LOW ROADS"])])
def test_one_to_one(spark, names, choices, piece_edges):
    """Groups held by one piece, and groups cut into pieces that bid apart."""
    rows, rest = assigned(spark, names, choices, piece_edges=piece_edges)
    assert len({r.n for r in rows}) == len({r.c for r in rows}) == len(rows)
    assert all(r.cost == cost(r.n, r.c) <= 20 for r in rows)
    assert rest == set(names) - {r.n for r in rows} | {"X"}
    assert sum(r.cost for r in rows) + 100 * (len(names) - len(rows)) == cheapest(names, choices)


def test_equally_cheap_assignments(spark):
    """Every pair costs the same: the tie order alone decides, however the work is cut."""
    names, choices = ["STATION ROAD A", "STATION ROAD B", "STATION ROAD C"], [f"STATION ROAD {x}" for x in "VWXYZ"]
    tie = {(n, c): int(hashlib.md5(f"B|{n}|{c}".encode()).hexdigest()[:8], 16) for n in names for c in choices}
    best = min(itertools.permutations(choices, 3), key=lambda pick: sum(tie[n, c] for n, c in zip(names, pick)))
    for piece_edges in (100_000, 4):
        rows, rest = assigned(spark, names, choices, piece_edges=piece_edges)
        assert [(r.n, r.c) for r in rows] == list(zip(names, best)) and rest == {"X"}


def test_assignment_of_nothing(spark):
    rows, rest = assigned(spark, [], [])
    assert rows == [] and rest == {"X"}


def test_auction_reaches_the_optimum():
    """Random groups against all permutations, bid for by one piece."""
    rng = random.Random(1)
    for size in (2, 3, 5):
        worth = {(p, 100 + o): rng.randrange(50) * (size + 1) for p in range(size) for o in range(size)}
        choices = {p: [(100 + o, worth[p, 100 + o]) for o in range(size)] for p in range(size)}
        price, owner = {100 + o: 0 for o in range(size)}, {}
        for left in (2, 1, 0):
            owner.clear()
            li._settle(choices, price, owner, li.FINER**left)
        best = max(sum(worth[p, o] for p, o in enumerate(pick)) for pick in itertools.permutations(price))
        assert sum(worth[p, o] for o, p in owner.items()) == best and len(owner) == size


# ----------------------------------------------------------------- shards


def test_date_parts():
    cases = [
        # A year in months, days beyond the first, decades in five-year steps with a rest, centuries, one month in days.
        (date(1987, 9, 1), date(1988, 9, 1), [date(1987 + (8 + m) // 12, (8 + m) % 12 + 1, 1) for m in range(12)]),
        (date(1931, 1, 1), date(1948, 1, 1), [date(y, 1, 1) for y in (1931, 1936, 1941, 1946)]),
        (date(1403, 1, 1), date(1750, 1, 1), [date(y, 1, 1) for y in (1403, 1503, 1603, 1703)]),
        (date(2023, 2, 1), date(2023, 3, 1), [date(2023, 2, d) for d in range(1, 29)]),
        (date(2023, 6, 7), date(2023, 6, 9), [date(2023, 6, 7), date(2023, 6, 8)]),
    ]
    for start, end, cuts in cases:
        assert sh.date_parts(start, end) == list(zip(cuts, [*cuts[1:], end]))


@pytest.mark.parametrize("start,end", [(0, 9), (0.25, 0.75), (3, 5000), (40, 41), (700, 1e9), (0.001, 0.002)])
def test_log_cuts(start, end):
    cuts = sh.log_cuts(start, end)
    assert cuts[0] == start and cuts[-1] == end and len(cuts) == sh.LOG_PARTS + 1
    assert all(a < b for a, b in zip(cuts[:-1], cuts[1:]))
    # Beside the exact places, each is rounded down, by less than one.
    low = math.log10(start) if start > 0 else min(0.0, math.log10(end) - sh.LOG_PARTS)
    for i, c in enumerate(cuts[1:-1], 1):
        exact = 10 ** (low + i * (math.log10(end) - low) / sh.LOG_PARTS)
        assert exact - 1 < c <= exact


def test_shard_plan_with_a_hot_day(spark):
    rng = random.Random(2)
    odd = [None, -5.0, -1e12, 2e6, 1e300, float("inf"), float("-inf"), float("nan")]
    rows = [
        (i, date(2020, 5, 5) if i % 3 else date(2015 + i % 8, 1 + i % 12, 1 + i % 28),
         rng.choice(odd) if i % 4 == 0 else rng.choice([1.0, rng.random() * 900, -rng.random() * 50, 1e6 + rng.random()]))
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "id int, d date, v double")
    plan = sh.plan_shards(df, "d", "v", date(2000, 1, 1), date(2030, 1, 1), 1e6, 20)
    placed = sh.with_shard(df, plan, "d", "v")
    assert placed.count() == placed.select("id").distinct().count() == 900
    arrived = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    shards = plan.collect()
    assert {r.shard: r.expected for r in shards} == arrived and all(r.expected <= 20 or r.full for r in shards)
    for r in shards[::7]:
        assert df.filter(r.predicate).count() == r.expected
    assert sorted(r.shard for r in shards) == list(range(len(shards)))
    order = [(r.day_from, r.value_missing, -math.inf if r.value_from is None else r.value_from) for r in sorted(shards)]
    assert order == sorted(order)
    assert sh.plan_shards(df.limit(0), "d", "v", date(2000, 1, 1), date(2030, 1, 1), 1e6, 20).collect() == []
    # Of the hot day's shards, those of one value or of none cannot be split.
    assert plan.filter("full").count() >= 2
    assert sh.shard_pages(plan, 7).agg(F.sum("size")).first()[0] == 900


def test_scratch_is_deleted(spark, tmp_path, monkeypatch):
    import os

    from cadastra import session

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    with session.Scratch(spark) as outer:
        with session.Scratch(spark) as inner:
            session.cut_lineage(spark.range(3), "gone").count()
            kept = inner.keep(spark.range(5), "kept")
        assert kept.count() == 5 and [x.split("-")[0] for x in os.listdir(tmp_path)] == ["kept"]
        assert outer.paths
    assert os.listdir(tmp_path) == []
    names = spark.createDataFrame([("b", "alpha"), ("b", "alphas"), ("b", "beta")], "k string, n string")
    pairs, rest = li.assign_one_to_one(names, names.selectExpr("k", "n AS c"), ["k"], "n", "c")
    assert pairs.count() == 3 and rest.count() == 0
    assert [x.split("-")[0] for x in os.listdir(tmp_path)] == ["pairs"]


def test_local_session_without_setting_gets_a_folder(spark, monkeypatch):
    from cadastra import session

    class Bare:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"master": "local[2]", "applicationId": "bare"})

    assert session.shared_folder(Bare) == session.shared_folder(Bare)
    monkeypatch.setattr(Bare.sparkContext, "master", "spark://x:1")
    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Bare)


def test_append_looks_only_where_its_keys_can_be(spark, tmp_path):
    """The stored table is scanned within the batch's smallest and largest keys, without being told a period."""
    path = str(tmp_path / "t")
    rows = lambda keys: spark.createDataFrame([(k, None if k is None else f"f{k:05}") for k in keys], "k long, f string")
    sinks.append_new(rows(range(100)), path, ["k", "f"])
    sinks.append_new(rows([*range(90, 200), 99, None]), path, ["k", "f"])
    sinks.append_new(rows([None, 150]), path, ["k", "f"])
    assert sorted(r.k for r in spark.read.parquet(path).filter("k IS NOT NULL").collect()) == list(range(200))
    assert spark.read.parquet(path).filter("k IS NULL").count() == 1
    near = sinks.stored_near(rows(range(5000, 5010)), path, ["k", "f"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,5000), LessThanOrEqual(k,5009)" in plan and near.count() == 0
    assert sinks.stored_near(rows([]), path, ["k"]).count() == 0
    with pytest.raises(ConstraintError):
        sinks.append_strict(rows([7]), path, ["k"])
    sinks.append_strict(rows([700]), path, ["k"])


def test_load_with_rules(spark, tmp_path):
    """Rules are counted by the writing pass; a strict load that breaks one leaves the old table and no other."""
    path, rows = str(tmp_path / "t"), spark.range(10).withColumn("v", F.when(F.col("id") > 2, F.col("id")))
    rules = {"small": F.col("id") < 8, "v is id": F.col("v") == F.col("id"), "odd `name`": F.col("id") % 2 == 1}
    assert sinks.load_checked(rows, path, rules, strict=False) == {"rows": 10, "small": 2, "v is id": 0, "odd `name`": 5}
    with pytest.raises(ConstraintError, match="small.*1"):
        sinks.load_checked(rows.filter("id IN (1, 9)"), path, {"small": rules["small"]})
    assert spark.read.parquet(path).count() == 10 and [p.name for p in tmp_path.iterdir()] == ["t"]
    assert sinks.load_checked(rows.limit(0), path, rules) == {"rows": 0, "small": 0, "v is id": 0, "odd `name`": 0}
    assert spark.read.parquet(path).count() == 0


@contextlib.contextmanager
def with_setting(spark, name, value):
    old = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_group_is_not_sorted_for_its_percentile(spark):
    """The brackets are joined by their real size: rows of a group stay in the tasks that read them."""
    rows = spark.range(100_000).select((F.col("id") % 10 > 0).cast("int").alias("k"), (F.col("id") * 7 % 99_991).cast("double").alias("v"))
    rows = rows.withColumn("k", F.when(F.col("v") % 1000 != 0, F.col("k")))
    with with_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "64k"):
        out = ag.group_percentile(rows, ["k"], "v", 0.95, "p")
        assert "BroadcastHashJoin" in plan_of(out) and "SortMergeJoin" not in plan_of(out)
        got = {r.k: r.p for r in out.collect()}
    want = rows.groupBy("k").agg(F.percentile("v", 0.95).alias("p")).collect()
    assert got == pytest.approx({r.k: r.p for r in want})


def test_facts_lacking_a_key_of_a_dimension(spark):
    """They keep their row without names and do not meet in one task; others find theirs."""
    from cadastra.operators.joins import with_dimension

    facts = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("b"))
    names = spark.createDataFrame([(i, "x", f"n{i}") for i in range(5)], "a long, b string, name string")
    with with_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), with_setting(spark, "spark.sql.adaptive.enabled", "false"):
        out = with_dimension(facts, names, ["a", "b"], "id")
        assert out.columns == ["a", "b", "id", "name"]
        lacking = out.filter("a IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(lacking) > 1 and sum(r["count"] for r in lacking) == 3000
        assert sorted(map(tuple, out.collect()), key=lambda r: r[2]) == sorted(
            map(tuple, facts.join(names, ["a", "b"], "left").collect()), key=lambda r: r[2]
        )


def test_newest_known_is_what_latest_keeps_of_an_unpivot(spark):
    rng = random.Random(3)
    pick = lambda *values: rng.choice([None, *values])
    rows = [(pick(1, 2, 3), pick(5, 6), pick(0, 1), pick(1.5, float("nan"), -2.0), pick(4.0), None, i) for i in range(300)]
    wide = spark.createDataFrame(rows, "k int, d int, t int, v1 double, v2 double, v3 double, other int")
    groups = [{"m": f"m{i}", "v": f"v{i}"} for i in (1, 2, 3)]

    def kept(df):
        long = hi.unpivot(df.withColumns({f"m{i}": F.lit(f"c{i}") for i in (1, 2, 3)}), ["k", "d", "t"], groups)
        chosen = hi.latest(long.filter(F.col("v").isNotNull()), ["k", "m"], "d", ["t", "v"])
        return sorted(map(repr, chosen.select("k", "m", "d", "t", "v").collect()))

    few = hi.newest_known(wide, ["k"], ["v1", "v2", "v3"], "d", ["t"])
    assert few.count() == len(kept(wide)) == 8 and kept(few) == kept(wide)


def test_rows_with_two_results_are_read_once(spark):
    from cadastra.functions import readers as rd
    from cadastra.operators.quality import split_rejects

    raw = spark.createDataFrame([(1, "5", "x"), (2, "z", "y"), (3, "", "w")], "i int, a string, b string")
    readings = {"a": ("a", rd.read_int("a")), "b": ("b", rd.read_text("b"))}
    good, rejects = split_rejects(raw, readings, ["a"], once=True)
    plain = split_rejects(raw, readings, ["a"])
    assert [good.columns, rejects.columns] == [df.columns for df in plain]
    assert [sorted(df.collect()) for df in (good, rejects)] == [sorted(df.collect()) for df in plain]
    assert good.inputFiles() and sorted(good.inputFiles()) == sorted(rejects.inputFiles())
