"""Polygons as ring arrays.

A geometry is ``array<array<struct<x,y>>>``: closed rings, outer ring
counter-clockwise, holes clockwise, several outer rings for a multi-polygon.
Everything but the overlap area is a native column expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .hold import hold
from .rings import AS_IS, REPAIRED, from_coordinates, subdivided

GEOMETRY = "array<array<struct<x:double,y:double>>>"

# GRS80 ellipsoid, the one under GDA2020.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
ECC2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(ECC2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- building

def rings_from_coordinates(c: Column | str) -> Column:
    """``array<array<array<double>>>`` (x, y, ...) to rings."""
    return F.transform(
        _col(c),
        lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))),
    )


def rings_from_wkt(c: Column | str) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text, in text order."""
    bodies = F.regexp_extract_all(_col(c), F.lit(r"\(([^()]+)\)"), F.lit(1))

    def point(text: Column) -> Column:
        xy = F.split(F.trim(text), r"\s+")
        return F.struct(xy[0].cast("double").alias("x"), xy[1].cast("double").alias("y"))

    return F.transform(bodies, lambda body: F.transform(F.split(body, ","), point))


def rings_from_wkb(wkb: Column | str) -> Column:
    """Rings of WKB (multi)polygons; the byte layout needs a helper, run on Arrow batches."""

    @F.pandas_udf(GEOMETRY)
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else _decode_wkb(bytes(v)))

    return decode(_col(wkb))


def _decode_wkb(data: bytes) -> list:
    def polygons(at: int) -> tuple[list, int]:
        order = "<" if data[at] == 1 else ">"
        kind, count = np.frombuffer(data, order + "u4", 2, at + 1)
        at += 9
        rings: list = []
        if kind == 6:
            for _ in range(count):
                inner, at = polygons(at)
                rings += inner
            return rings, at
        if kind != 3:
            raise ValueError(f"not a polygon: WKB type {kind}")
        for _ in range(count):
            size = int(np.frombuffer(data, order + "u4", 1, at)[0])
            xy = np.frombuffer(data, order + "f8", size * 2, at + 4).reshape(-1, 2)
            at += 4 + 16 * size
            rings.append([{"x": float(x), "y": float(y)} for x, y in xy])
        return rings, at

    return polygons(0)[0]


def wkt_from_rings(rings: Column | str) -> Column:
    """MULTIPOLYGON text; each ring as its own polygon when outer, as a hole when clockwise."""

    def ring_text(ring: Column) -> Column:
        points = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
        return F.concat(F.lit("("), F.array_join(points, ", "), F.lit(")"))

    def add(text: Column, ring: Column) -> Column:
        hole = ring_area(ring) < 0
        glue = F.when(text == "", F.lit("(")).when(hole, F.lit(", ")).otherwise(F.lit("), ("))
        return F.concat(text, glue, ring_text(ring))

    body = F.aggregate(_col(rings), F.lit(""), add)
    return F.concat(F.lit("MULTIPOLYGON ("), body, F.lit("))"))


def drop_repeats(ring: Column) -> Column:
    """Take out points equal to their predecessor, then close the ring."""
    kept = F.filter(ring, lambda p, i: (i == 0) | (p != F.try_element_at(ring, i)))
    first = F.try_element_at(kept, F.lit(1))
    open_end = first != F.try_element_at(kept, F.lit(-1))
    return F.when(open_end, F.concat(kept, F.array(first))).otherwise(kept)


def _clean(rings: Column) -> Column:
    return F.filter(F.transform(rings, drop_repeats), lambda r: F.size(r) >= 4)


def _orient(cleaned: Column) -> Column:
    """Outer rings counter-clockwise, holes clockwise: a ring inside an odd number of others is a hole."""

    def oriented(ring: Column, index: Column) -> Column:
        around = F.filter(cleaned, lambda other, i: (i != index) & point_in_ring(ring[0], other))
        hole = F.size(around) % 2 == 1
        wrong = (ring_area(ring) > 0) == hole
        return F.when(wrong, F.reverse(ring)).otherwise(ring)

    return F.when(F.size(cleaned) > 0, F.transform(cleaned, oriented))


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over tasks: work per shape is large, and a file of shapes, or of keys that shapes derive from, may be one split."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def with_repaired(df: DataFrame, rings: str, out: str) -> DataFrame:
    """Add valid rings: the area is what lies inside an odd number of the given rings.

    Repeated points are dropped, rings closed, collapsed rings dropped and
    orientation set.  Rings that touch, overlap or cross, each other or
    themselves, are cut where they meet and put together anew (``rings``);
    all others keep their points, and one is a hole when its first point lies
    in an odd number of the rest.  NULL when no area is left, a coordinate is
    missing or not finite: such rows are rejects (``repair_rejects``).
    """
    df = dealt(df)
    known = F.forall(F.flatten(F.col(rings)), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    cleaned = df.withColumn("_cleaned", hold(F.when(known, _clean(F.col(rings)))))
    plain = F.coalesce((F.size("_cleaned") == 0) | is_box("_cleaned"), F.lit(True))
    parted = cleaned.withColumn("_parted", subdivided(F.col("_cleaned"), plain))
    kind = F.col("_parted.kind")
    anew = F.when(kind == REPAIRED, from_coordinates(F.col("_parted.xs"), F.col("_parted.ys")))
    return parted.withColumn(out, hold(F.when(kind == AS_IS, _orient(F.col("_cleaned"))).otherwise(anew))).drop("_cleaned", "_parted")


def repair_rejects(repaired: DataFrame, rings: str, out: str) -> DataFrame:
    """The rows of ``with_repaired`` that had rings and could not be repaired."""
    return repaired.filter(F.col(rings).isNotNull() & F.col(out).isNull())


# ---------------------------------------------------------------- measures

def _edges(ring: Column) -> Column:
    size = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.arrays_zip(F.slice(ring, 1, size).alias("a"), F.slice(ring, 2, size).alias("b"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def ring_area(ring: Column) -> Column:
    """Signed shoelace area, taken relative to the first point for precision."""
    origin = F.get(ring, F.lit(0))

    def cross(a: Column, b: Column) -> Column:
        return (a["x"] - origin["x"]) * (b["y"] - origin["y"]) - (b["x"] - origin["x"]) * (a["y"] - origin["y"])

    size = F.greatest(F.size(ring) - 1, F.lit(0))
    return _sum(F.zip_with(F.slice(ring, 1, size), F.slice(ring, 2, size), cross)) / 2


def planar_area(rings: Column | str) -> Column:
    return F.abs(_sum(F.transform(_col(rings), ring_area)))


def _authalic(point: Column) -> Column:
    """Equal-area cylindrical projection of a lon/lat point on the ellipsoid."""
    lon, lat = F.radians(point["x"]), F.radians(point["y"])
    s = F.sin(lat)
    es = s * ECC
    q = (s / (1 - es * es) + F.log((1 + es) / (1 - es)) / (2 * ECC)) * (1 - ECC2)
    return F.struct((lon * SEMI_MAJOR).alias("x"), (q * SEMI_MAJOR / 2).alias("y"))


def geodesic_area(rings: Column | str) -> Column:
    """Square metres on the ellipsoid of lon/lat rings."""
    flat = F.transform(_col(rings), lambda ring: F.transform(ring, _authalic))
    return planar_area(flat)


def centroid(rings: Column | str) -> Column:
    """Area centroid over all rings (holes count negative)."""

    def moments(ring: Column) -> Column:
        def step(acc: Column, e: Column) -> Column:
            cross = e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
            return F.struct(
                (acc["x"] + (e["a"]["x"] + e["b"]["x"]) * cross).alias("x"),
                (acc["y"] + (e["a"]["y"] + e["b"]["y"]) * cross).alias("y"),
                (acc["d"] + cross).alias("d"),
            )

        return F.aggregate(_edges(ring), _zero(), step)

    def _zero() -> Column:
        return F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("d"))

    total = F.aggregate(
        F.transform(_col(rings), moments),
        _zero(),
        lambda a, m: F.struct(
            (a["x"] + m["x"]).alias("x"), (a["y"] + m["y"]).alias("y"), (a["d"] + m["d"]).alias("d")
        ),
    )
    return F.struct(
        (total["x"] / (F.nullif(total["d"], F.lit(0.0)) * 3)).alias("x"),
        (total["y"] / (F.nullif(total["d"], F.lit(0.0)) * 3)).alias("y"),
    )


def bbox(rings: Column | str) -> Column:
    points = F.flatten(_col(rings))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def boxes_touch(a: Column, b: Column) -> Column:
    return (
        (a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"]) & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"])
    )


def in_box(rings: Column | str, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Bounding-box filter."""
    limits = F.struct(
        F.lit(xmin).alias("xmin"), F.lit(ymin).alias("ymin"), F.lit(xmax).alias("xmax"), F.lit(ymax).alias("ymax")
    )
    return boxes_touch(bbox(rings), limits)


# ---------------------------------------------------------------- predicates

def point_in_ring(p: Column, ring: Column) -> Column:
    """Even-odd rule."""

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        straddles = (a["y"] > p["y"]) != (b["y"] > p["y"])
        x_at = a["x"] + (p["y"] - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        return straddles & (p["x"] < x_at)

    return F.size(F.filter(_edges(ring), crosses)) % 2 == 1


def point_in_rings(p: Column, rings: Column) -> Column:
    inside = F.transform(rings, lambda r: point_in_ring(p, r).cast("int"))
    return F.aggregate(inside, F.lit(0), lambda n, v: n + v) % 2 == 1


def _turn(a: Column, b: Column, c: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))


def _between(a: Column, b: Column, c: Column) -> Column:
    """c lies in the box of the segment a-b (used when the three are in line)."""
    return (
        (c["x"] >= F.least(a["x"], b["x"]))
        & (c["x"] <= F.greatest(a["x"], b["x"]))
        & (c["y"] >= F.least(a["y"], b["y"]))
        & (c["y"] <= F.greatest(a["y"], b["y"]))
    )


def _segments_meet(e: Column, f: Column) -> Column:
    a, b, c, d = e["a"], e["b"], f["a"], f["b"]
    abc, abd, cda, cdb = _turn(a, b, c), _turn(a, b, d), _turn(c, d, a), _turn(c, d, b)
    proper = (abc != abd) & (cda != cdb)
    touching = (
        ((abc == 0) & _between(a, b, c))
        | ((abd == 0) & _between(a, b, d))
        | ((cda == 0) & _between(c, d, a))
        | ((cdb == 0) & _between(c, d, b))
    )
    return proper | touching


def intersects(a: Column | str, b: Column | str) -> Column:
    """True when the two areas share at least one point, borders included."""
    a, b = _col(a), _col(b)
    ea, eb = F.flatten(F.transform(a, _edges)), F.flatten(F.transform(b, _edges))
    meet = F.exists(ea, lambda e: F.exists(eb, lambda f: _segments_meet(e, f)))
    # Without a meeting of borders each part lies wholly inside or outside; any of its points tells.
    return meet | F.exists(a, lambda r: point_in_rings(r[0], b)) | F.exists(b, lambda r: point_in_rings(r[0], a))


# ---------------------------------------------------------------- overlap

# Edge pairs looked at in one go; bounds the memory of a batch.
EDGE_PAIRS = 1_000_000


def _shared_areas(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Area shared by each pair of ring sets, given as edges (x0, y0, x1, y1)."""

    def flat(sides: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        upright = [edges[edges[:, 0] != edges[:, 2]] for edges in sides]
        counts = np.array([len(edges) for edges in upright], dtype=np.int64)
        return np.concatenate(upright).T, np.cumsum(counts) - counts, counts

    return _measured(flat(left), flat(right), np.array([edges[0, :2] for edges in left]).T) if left else np.zeros(0)


def _measured(
    left: tuple[np.ndarray, np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray, np.ndarray], origin: np.ndarray
) -> np.ndarray:
    """Area shared by pairs of ring sets: edges that are not upright (as x0, y0, x1, y1 by edge), the first of each and how many, by pair.

    A closed border is the signed sum of the strips below its edges, so the
    shared area is the signed sum, over pairs of an edge of either side, of the
    lower of both over the width they share.  What does not depend on both
    edges cancels out; half the distance between them, with its sign turned,
    is left: no border is cut and no point is placed.

    Pairs of like size are measured together; shorter borders are filled up
    with edges of no width, which contribute nothing.  Pairs lie along the last
    axis, so that arrays run over many of them even if their borders are short.
    """
    (a, a_from, a_count), (b, b_from, b_count) = left, right
    out = np.zeros(len(a_count))
    some = np.flatnonzero((a_count > 0) & (b_count > 0))
    room = np.ceil(np.log2([a_count[some], b_count[some]])).astype(np.int64)
    kind = room[0] * 64 + room[1]
    for n, m in (divmod(int(k), 64) for k in np.flatnonzero(np.bincount(kind))):
        members = some[kind == n * 64 + m]
        width = min(1 << m, EDGE_PAIRS)
        height = max(1, min(1 << n, EDGE_PAIRS // width))
        step = max(1, EDGE_PAIRS // (height * width))
        for at in range(0, len(members), step):
            part = members[at : at + step]
            for i in range(0, 1 << n, height):
                over = _edges_at(a, a_from[part], a_count[part], i, min(height, (1 << n) - i), origin[:, part])
                for k in range(0, 1 << m, width):
                    under = _edges_at(b, b_from[part], b_count[part], k, min(width, (1 << m) - k), origin[:, part])
                    out[part] -= _distances(over, under)
    return out


def _edges_at(edges: np.ndarray, first: np.ndarray, count: np.ndarray, at: int, size: int, origin: np.ndarray) -> tuple[np.ndarray, ...]:
    """``size`` edges of each border from ``at`` on: start, slope, ends of the width and sign; those beyond the border have no width."""
    place = np.arange(at, at + size)[:, None]
    there = place < count
    x0, y0, x1, y1 = edges[:, first + np.where(there, place, 0)]
    x0, x1, y0, y1 = x0 - origin[0], x1 - origin[0], y0 - origin[1], y1 - origin[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = (y1 - y0) / (x1 - x0)
    return x0, y0, slope, np.where(there, np.minimum(x0, x1), np.inf), np.maximum(x0, x1), np.where(x1 > x0, 0.5, -0.5)


def _distances(over: tuple[np.ndarray, ...], under: tuple[np.ndarray, ...]) -> np.ndarray:
    """Half the integral of the distance of every two edges over the width they share, negative where they run apart, summed up by pair."""
    ax, ay, a_slope, a_low, a_high, a_sign = (v[:, None] for v in over)
    bx, by, b_slope, b_low, b_high, b_sign = (v[None] for v in under)
    with np.errstate(divide="ignore", invalid="ignore"):
        low = np.maximum(a_low, b_low)
        width = np.minimum(a_high, b_high) - low
        d0 = (low - ax) * a_slope + ay - ((low - bx) * b_slope + by)
        d1 = d0 + (a_slope - b_slope) * width
        # Twice the mean of the distance, also where the edges cross.
        twice = (d0 * d0 + d1 * d1 + 2 * np.maximum(d0 * d1, 0.0)) / (np.abs(d0) + np.abs(d1))
        value = np.where((width > 0) & (twice > 0), width * twice, 0.0) * (a_sign * b_sign)
    return value.sum(axis=(0, 1))


def _borders(shapes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Edges of Arrow ring arrays that are not upright, the first of each shape and how many, its first point, and which shapes have edges at all."""
    rings, of_shape = shapes.values, shapes.offsets.to_numpy().astype(np.int64)
    points, of_ring = rings.values, rings.offsets.to_numpy().astype(np.int64)
    fields = dict(zip((f.name for f in points.type), points.flatten()))
    x, y = (fields[c].to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for c in "xy")
    follows = np.ones(len(x), dtype=bool)  # a point with a next one in its ring
    follows[of_ring[1:][np.diff(of_ring) > 0] - 1] = False
    at = of_ring[of_shape]

    def before(marks: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(marks)])

    every = before(follows)
    known = np.diff(every[at]) > 0
    if shapes.null_count:
        known &= shapes.is_valid().to_numpy(zero_copy_only=False)
    if rings.null_count:
        known &= np.diff(before(rings.is_null().to_numpy(zero_copy_only=False))[of_shape]) == 0
    slanted = np.zeros_like(follows)
    slanted[:-1] = follows[:-1] & (x[1:] != x[:-1])
    i = np.flatnonzero(slanted)
    edges = np.stack([x[i], y[i], x[i + 1], y[i + 1]])
    first = before(slanted)[at]
    start = np.minimum(at[:-1], max(len(x) - 1, 0))
    return edges, first[:-1], np.diff(first), np.stack([x[start], y[start]]) if len(x) else np.zeros((2, len(start))), known


def overlap_area(a: Column | str, b: Column | str) -> Column:
    """Shared area of two simple polygons with holes; numpy over Arrow batches."""

    def shared(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            a, a_from, a_count, origin, a_known = _borders(left)
            b, b_from, b_count, _, b_known = _borders(right)
            known = a_known & b_known
            out = _measured((a, a_from, np.where(known, a_count, 0)), (b, b_from, b_count), origin)
            yield pa.array(out, pa.float64(), mask=~known)

    # Not to be run a second time for a filter on the result.
    once = F.arrow_udf(shared, "double").asNondeterministic()
    return once(_col(a), _col(b))


def box_overlap_area(a: Column, b: Column) -> Column:
    """Shared area of two boxes, natively."""
    zero = F.lit(0.0)
    width = F.greatest(F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"]), zero)
    height = F.greatest(F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"]), zero)
    return width * height


def is_box(rings: Column | str) -> Column:
    """One ring covering exactly its bounding box."""
    rings = _col(rings)
    box = bbox(rings)
    full = (box["xmax"] - box["xmin"]) * (box["ymax"] - box["ymin"])
    corners = F.forall(
        F.flatten(rings),
        lambda p: ((p["x"] == box["xmin"]) | (p["x"] == box["xmax"])) & ((p["y"] == box["ymin"]) | (p["y"] == box["ymax"])),
    )
    first = F.get(rings, F.lit(0))
    return (F.size(rings) == 1) & (F.size(first) == 5) & corners & (full > 0) & (F.abs(ring_area(first)) > full / 2)


# ---------------------------------------------------------------- joins

def _level(box: Column, cell: float) -> Column:
    """How often the cell size has to be doubled to be as long as the longer side of a box."""
    longer = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    return F.greatest(F.lit(0), F.ceil(F.log2(longer / cell)).cast("int"))


def _cells(box: Column, size: Column) -> Column:
    def cell(value: Column) -> Column:
        return F.floor(value / size)

    xs = F.sequence(cell(box["xmin"]), cell(box["xmax"]))
    ys = F.sequence(cell(box["ymin"]), cell(box["ymax"]))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(x.alias("x"), y.alias("y")))))


def cell_entries(boxes: DataFrame, box: str, cell: float, others: Sequence[int], up: int, down: int) -> DataFrame:
    """Boxes with ``_level`` once for every ``_cell`` of every ``_at`` in which they can meet a box of the levels ``others``.

    At its own level a box lies in four cells at most (in nine where rounding
    of its size falls badly).  Two boxes meet at the higher of their levels:
    ``_meets`` is 0 for boxes of one level, ``up`` for the lower of two, ``down`` for the higher.
    """
    have = F.array(*[F.lit(x) for x in others]).cast("array<int>")
    level = F.col("_level")

    def entry(at: Column, meets: int) -> Column:
        return F.struct(at.alias("_at"), F.lit(meets).alias("_meets"))

    own = F.array(
        F.when(F.array_contains(have, level), entry(level, 0)), F.when(F.exists(have, lambda x: x < level), entry(level, down))
    )
    higher = F.transform(F.filter(have, lambda x: x > level), lambda x: entry(x, up))
    entered = boxes.select("*", F.inline(F.concat(F.array_compact(own), higher)))
    return entered.withColumn("_cell", F.explode(_cells(F.col(box), cell * F.pow(F.lit(2.0), F.col("_at")))))


#: Where each side's rows meet: a cell of a level, and which of both sides is the higher.
_PLACE = ["_at", "_meets", "_cell"]


def _numbered_side(side: DataFrame, geom: str, mark: str, cell: float) -> DataFrame:
    """Rows with a box, written with their number, box, whether they are a plain box, and level."""
    rows = dealt(side).withColumn(f"_{mark}id", F.monotonically_increasing_id()).withColumn(f"_{mark}box", hold(bbox(geom)))
    known = rows.filter(F.col(f"_{mark}box")["xmin"].isNotNull()).withColumn(f"_{mark}plain", hold(F.coalesce(is_box(geom), F.lit(False))))
    return cut_lineage(known.withColumn("_level", _level(F.col(f"_{mark}box"), cell)), "shapes")


def _entered(lrows: DataFrame, rrows: DataFrame, cell: float) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in every cell in which they can meet one of the other side."""

    def levels(rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select("_level").distinct().collect())

    llevels, rlevels = levels(lrows), levels(rrows)
    lhs = cell_entries(lrows, "_lbox", cell, rlevels, 1, 2).drop("_level")
    return lhs, cell_entries(rrows, "_rbox", cell, llevels, 2, 1).drop("_level")


def _spread(side: DataFrame, salts: Sequence[DataFrame], own: str, other: str) -> DataFrame:
    """Rows in one salt of their own side and all salts of the other."""
    many = side
    for counted in salts:
        many = many.join(counted, _PLACE, "left")
    at = F.pmod(F.xxhash64(f"_{own}id"), F.coalesce(f"_{own}salts", F.lit(1))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce(f"_{other}salts", F.lit(1)) - 1))
    return many.withColumn(f"_{own}salt", at).withColumn(f"_{other}salt", every).drop("_lsalts", "_rsalts")


def _touching(cell: float) -> Column:
    """Whether two boxes touch, and this is the cell of their common corner."""
    size = cell * F.pow(F.lit(2.0), F.col("_at"))
    corner = F.struct(
        F.floor(F.greatest(F.col("_lbox.xmin"), F.col("_rbox.xmin")) / size).alias("x"),
        F.floor(F.greatest(F.col("_lbox.ymin"), F.col("_rbox.ymin")) / size).alias("y"),
    )
    return boxes_touch(F.col("_lbox"), F.col("_rbox")) & (F.col("_cell") == corner)


def _found_pairs(lrows: DataFrame, rrows: DataFrame, cell: float, target: int) -> DataFrame:
    """``_lid, _rid, _boxes`` of the pairs of rows whose boxes touch, written."""
    lhs, rhs = _entered(lrows.select("_lid", "_lbox", "_lplain", "_level"), rrows.select("_rid", "_rbox", "_rplain", "_level"), cell)

    def salts(side: DataFrame, name: str) -> DataFrame:
        counted = side.groupBy(*_PLACE).agg(F.ceil(F.count(F.lit(1)) / target).cast("int").alias(name))
        return counted.filter(F.col(name) > 1)

    of_both = salts(lhs, "_lsalts"), salts(rhs, "_rsalts")
    pairs = _spread(lhs, of_both, "l", "r").join(_spread(rhs, of_both, "r", "l"), [*_PLACE, "_lsalt", "_rsalt"])
    found = pairs.filter(_touching(cell)).select("_lid", "_rid", (F.col("_lplain") & F.col("_rplain")).alias("_boxes"))
    return cut_lineage(found, "pairs")


def _numbered_pairs(
    left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, cell: float, target: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Row numbers ``_lid, _rid`` of the pairs of ``candidate_pairs``, with ``_boxes`` for two plain boxes, and both sides with their numbers.

    All three are written: the sides so that a row keeps its number whatever is
    computed again, the pairs so that they can be parted by ``_boxes`` without
    being found twice.
    """
    lrows, rrows = _numbered_side(left, left_geom, "l", cell), _numbered_side(right, right_geom, "r", cell)
    return _found_pairs(lrows, rrows, cell, target), lrows.drop("_level", "_lplain"), rrows.drop("_level", "_rplain")


def _attached(found: DataFrame, lrows: DataFrame, rrows: DataFrame) -> DataFrame:
    return found.join(lrows, "_lid").join(rrows, "_rid").drop("_lid", "_rid", "_boxes")


# Rows that could meet for each row entered in a cell, from which on rows move with their geometry.
CROWDED = 4


def candidate_pairs(
    left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, cell: float, target: int = 50_000
) -> DataFrame:
    """Pairs whose boxes touch, each pair once, with both boxes as ``_lbox`` and ``_rbox``.

    Cells double in size from level to level and a shape is entered at the level
    of its own size, so an area over any number of cells has few entries.  Pairs
    are found by an equi-join on the cell.  Where they are few, that is over row
    numbers and boxes alone, and geometries are attached to the pairs whose boxes
    touch.  Where they may outnumber the entries (``CROWDED``), rows are entered
    whole, once, and a pair neither moves nor is written.  A pair
    is emitted only in the cell holding the lower-left corner of the boxes'
    common part, so no duplicate removal (and no shuffle for it) is needed.
    A cell with more than ``target`` rows of a side is split into as many salts
    of that side as it needs, the rows of the other side being repeated per salt;
    a cell crowded on both sides becomes a grid of salts.
    Shapes that are null or empty touch nothing; repeated rows are rows of their own.
    """
    lrows, rrows = _numbered_side(left, left_geom, "l", cell), _numbered_side(right, right_geom, "r", cell)

    def counted(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*_PLACE).agg(F.count(F.lit(1)).alias(name))

    lhs, rhs = _entered(lrows.select("_lbox", "_level"), rrows.select("_rbox", "_level"), cell)
    cells = cut_lineage(counted(lhs, "_ln").join(counted(rhs, "_rn").hint("merge"), _PLACE), "cells")
    meet, entries = cells.agg(F.sum(F.col("_ln").cast("double") * F.col("_rn")), F.sum(F.col("_ln") + F.col("_rn"))).first()
    if not meet or meet <= CROWDED * entries:
        return _attached(_found_pairs(lrows, rrows, cell, target), lrows.drop("_level", "_lplain"), rrows.drop("_level", "_rplain"))
    # Written, so of known size: a join on them moves no rows as a rule.
    salts = [F.ceil(F.col(n) / target).cast("int").alias(s) for n, s in (("_ln", "_lsalts"), ("_rn", "_rsalts"))]
    of_both = [cut_lineage(cells.filter(F.greatest("_ln", "_rn") > target).select(*_PLACE, *salts), "salts")]
    lhs, rhs = _entered(lrows.drop("_lplain"), rrows.drop("_rplain"), cell)
    # Entries are merged and never broadcast: they are planned at the size of the rows before these are multiplied.
    lhs, rhs = _spread(lhs, of_both, "l", "r"), _spread(rhs, of_both, "r", "l").hint("merge")
    pairs = lhs.join(rhs, [*_PLACE, "_lsalt", "_rsalt"]).filter(_touching(cell))
    return pairs.select(*[lrows[c] for c in (*left.columns, "_lbox")], *[rrows[c] for c in (*right.columns, "_rbox")])


def intersects_join(
    left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, cell: float, target: int = 50_000
) -> DataFrame:
    """All pairs whose geometries share a point; plain boxes do when they touch, so their geometry is not looked at."""
    found, lrows, rrows = _numbered_pairs(left, right, left_geom, right_geom, cell, target)
    boxes = _attached(found.filter("_boxes"), lrows, rrows)
    shapes = _attached(found.filter("NOT _boxes"), lrows, rrows).filter(intersects(left_geom, right_geom))
    return boxes.union(shapes).drop("_lbox", "_rbox")


def overlap_join(
    left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, cell: float, min_share: float = 0.5, target: int = 50_000
) -> DataFrame:
    """Pairs of which more than ``min_share`` of the left area lies in the right one.

    Box pairs are measured natively, from the boxes alone; only the others go
    through numpy.  The area of a left shape is measured once, not per pair.
    """
    measured = left.withColumn("_larea", hold(planar_area(left_geom)))
    found, lrows, rrows = _numbered_pairs(measured, right, left_geom, right_geom, cell, target)
    boxes = _attached(found.filter("_boxes"), lrows, rrows)
    boxes = boxes.withColumn("overlap", box_overlap_area(F.col("_lbox"), F.col("_rbox")))
    shapes = _attached(found.filter("NOT _boxes"), lrows, rrows)
    shapes = shapes.withColumn("overlap", overlap_area(left_geom, right_geom))
    both = boxes.union(shapes).withColumn("share", F.col("overlap") / F.col("_larea"))
    return both.filter(F.col("share") > min_share).drop("overlap", "_lbox", "_rbox", "_larea")
