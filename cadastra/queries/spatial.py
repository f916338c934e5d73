"""Areas, overlaps and spatial joins on polygons derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import spatial as sp
from ..plans import analytics
from ..session import cut_lineage
from .base import Tables, query


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    def point(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    corners = [point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0)]
    return F.array(F.array(*corners))


# Customers as small lots, suppliers as larger areas; the field they lie in
# grows with the number of customers, so the pairs grow with the table.
_LOT = {
    "x0": "(c_custkey * 37) % 9973 / 10.0", "y0": "c_custkey * 91 % 9967 / 10.0",
    "w": "1 + c_custkey % 5", "h": "1 + c_custkey % 7",
}
_AREA = {
    "x0": "(s_suppkey * 53) % 997 * 1.0", "y0": "(s_suppkey * 71) % 991 * 1.0",
    "w": "10 + s_suppkey % 30", "h": "10 + s_suppkey % 40",
}
_BOXES = f"""
    lots AS (SELECT c_custkey, c_mktsegment, {_LOT['x0']} AS ax, {_LOT['y0']} AS ay,
      {_LOT['x0']} + {_LOT['w']} AS bx, {_LOT['y0']} + {_LOT['h']} AS "by" FROM customer),
    areas AS (SELECT s_suppkey, {_AREA['x0']} AS cx, {_AREA['y0']} AS cy,
      {_AREA['x0']} + {_AREA['w']} AS dx, {_AREA['y0']} + {_AREA['h']} AS dy FROM supplier)
"""


def _box(x0: str, y0: str, w: str, h: str) -> Column:
    return rectangle(F.expr(x0), F.expr(y0), F.expr(f"{x0} + {w}"), F.expr(f"{y0} + {h}"))


def lots(t: Tables):
    return t.customer.select("c_custkey", "c_mktsegment", _box(**_LOT).alias("geometry"))


def areas(t: Tables):
    return t.supplier.select("s_suppkey", _box(**_AREA).alias("area_geometry"))


@query(
    "bbox_join",
    f"""
    WITH {_BOXES}
    SELECT c_custkey, s_suppkey FROM lots, areas
    WHERE ax <= dx AND cx <= bx AND ay <= dy AND cy <= "by"
    """,
)
def bbox_join(t: Tables):
    pairs = sp.intersects_join(lots(t), areas(t), "geometry", "area_geometry", 25.0)
    return pairs.select("c_custkey", "s_suppkey")


@query(
    "bbox_filter",
    f"""
    WITH {_BOXES}
    SELECT c_custkey, round(ax, 3) AS xmin, round("by", 3) AS ymax FROM lots
    WHERE ax <= 600 AND bx >= 200 AND ay <= 500 AND "by" >= 100
    """,
)
def bbox_filter(t: Tables):
    rows = lots(t).filter(sp.in_box("geometry", 200.0, 100.0, 600.0, 500.0))
    box = sp.bbox("geometry")
    return rows.select("c_custkey", F.round(box["xmin"], 3).alias("xmin"), F.round(box["ymax"], 3).alias("ymax"))


@query(
    "overlap_share",
    f"""
    WITH {_BOXES}, p AS (
      SELECT c_custkey, s_suppkey,
        greatest(least(bx, dx) - greatest(ax, cx), 0) * greatest(least("by", dy) - greatest(ay, cy), 0)
          / ((bx - ax) * ("by" - ay)) AS share
      FROM lots, areas WHERE ax <= dx AND cx <= bx AND ay <= dy AND cy <= "by")
    SELECT c_custkey, s_suppkey, round(share, 6) AS share FROM p WHERE share > 0.505
    """,
)
def overlap_share(t: Tables):
    pairs = sp.overlap_join(lots(t), areas(t), "geometry", "area_geometry", 25.0, 0.505)
    return pairs.select("c_custkey", "s_suppkey", F.round("share", 6).alias("share"))


# Right triangles (clockwise, so orientation is put right) against the areas.
_TRIANGLE_SQL = """
    tri AS (SELECT c_custkey, ax AS tx, ay AS ty, bx - ax AS a FROM lots)
"""


@query(
    "overlap_triangles",
    f"""
    WITH {_BOXES}, {_TRIANGLE_SQL},
    clipped AS (
      SELECT c_custkey, s_suppkey, a,
        least(greatest(cx - tx, 0), a) AS u0, least(greatest(dx - tx, 0), a) AS u1,
        greatest(cy - ty, 0) AS v0, dy - ty AS v1
      FROM tri, areas WHERE tx <= dx AND cx <= tx + a AND ty <= dy AND cy <= ty + a),
    -- Area under the edge u + v = a cut at v, between u0 and u1.
    parts AS (
      SELECT c_custkey, s_suppkey, a,
        greatest(0, least(u1, greatest(u0, a - v1)) - u0) AS flat,
        greatest(u0, least(u1, greatest(u0, a - v1))) AS m0, least(u1, a - v0) AS m1, u0, v0, v1
      FROM clipped WHERE v1 > v0)
    SELECT c_custkey, s_suppkey,
      round(flat * (v1 - v0) + CASE WHEN m1 > m0 THEN (m1 - m0) * (a - v0 - (m0 + m1) / 2) ELSE 0 END, 5) AS overlap
    FROM parts
    WHERE flat * (v1 - v0) + CASE WHEN m1 > m0 THEN (m1 - m0) * (a - v0 - (m0 + m1) / 2) ELSE 0 END > 0.0001
    """,
)
def overlap_triangles(t: Tables):
    """Overlap of shapes that are no boxes, through the general polygon measure."""
    x, y, a = F.expr(_LOT["x0"]), F.expr(_LOT["y0"]), F.expr(_LOT["w"])

    def point(px: Column, py: Column) -> Column:
        return F.struct(px.cast("double").alias("x"), py.cast("double").alias("y"))

    ring = F.array(point(x, y), point(x, y + a), point(x + a, y), point(x, y))
    shapes = sp.with_repaired(t.customer.select("c_custkey", F.array(ring).alias("_r")), "_r", "geometry").drop("_r")
    pairs = sp.candidate_pairs(shapes, areas(t), "geometry", "area_geometry", 25.0)
    measured = pairs.withColumn("overlap", sp.overlap_area("geometry", "area_geometry"))
    return measured.filter("overlap > 0.0001").select("c_custkey", "s_suppkey", F.round("overlap", 5).alias("overlap"))


@query(
    "ring_area_centroid",
    """
    SELECT p_partkey, round(CAST(w * h AS DOUBLE) - 1, 6) AS area,
      round(((x + w / 2.0) * w * h - (x + 0.5)) / (w * h - 1), 6) AS cx,
      round(((y + h / 2.0) * w * h - (y + h - 0.5)) / (w * h - 1), 6) AS cy
    FROM (SELECT p_partkey, p_partkey % 100 AS x, p_size AS y, 2 + p_size % 9 AS w, 2 + p_partkey % 4 AS h FROM part)
    """,
)
def ring_area_centroid(t: Tables):
    """L-shaped lots: a rectangle without its upper left unit corner."""
    x, y = F.col("p_partkey") % 100, F.col("p_size")
    w, h = 2 + F.col("p_size") % 9, 2 + F.col("p_partkey") % 4

    def point(px: Column, py: Column) -> Column:
        return F.struct(px.cast("double").alias("x"), py.cast("double").alias("y"))

    ring = F.array(
        point(x, y), point(x + w, y), point(x + w, y + h), point(x + 1, y + h),
        point(x + 1, y + h - 1), point(x, y + h - 1), point(x, y),
    )
    rows = t.part.select("p_partkey", F.array(ring).alias("g"))
    middle = sp.centroid("g")
    return rows.select(
        "p_partkey", F.round(sp.planar_area("g"), 6).alias("area"),
        F.round(middle["x"], 6).alias("cx"), F.round(middle["y"], 6).alias("cy"),
    )


_E2 = "(2.0 / 298.257222101 - 1.0 / (298.257222101 * 298.257222101))"


def _q(lat: str) -> str:
    s = f"sin(radians({lat}))"
    e = f"sqrt({_E2})"
    return f"((1 - {_E2}) * ({s} / (1 - {_E2} * {s} * {s}) + ln((1 + {e} * {s}) / (1 - {e} * {s})) / (2 * {e})))"


@query(
    "geodesic_area",
    f"""
    WITH g AS (SELECT c_custkey, 141 + c_custkey % 12 AS lon, -37 + c_custkey % 8 AS lat, 0.001 * (1 + c_custkey % 9) AS d FROM customer)
    SELECT c_custkey,
      round(6378137.0 * 6378137.0 / 2 * radians(d) * ({_q('lat + d')} - {_q('lat')}), 1) AS sqm
    FROM g
    """,
)
def geodesic_area(t: Tables):
    """Square metres of lon/lat rectangles, closed form on the ellipsoid."""
    lon, lat = F.lit(141) + F.col("c_custkey") % 12, F.lit(-37) + F.col("c_custkey") % 8
    d = F.lit(0.001) * (1 + F.col("c_custkey") % 9)
    rows = t.customer.select("c_custkey", rectangle(lon, lat, lon + d, lat + d).alias("g"))
    return rows.select("c_custkey", F.round(sp.geodesic_area("g"), 1).alias("sqm"))


@query(
    "wkt_roundtrip",
    f"WITH {_BOXES} SELECT c_custkey, round((bx - ax) * (\"by\" - ay), 6) AS area, 1 AS rings FROM lots",
)
def wkt_roundtrip(t: Tables):
    text = lots(t).select("c_custkey", sp.wkt_from_rings("geometry").alias("wkt"))
    rings = text.select("c_custkey", sp.rings_from_wkt("wkt").alias("g"))
    return rings.select("c_custkey", F.round(sp.planar_area("g"), 6).alias("area"), F.size("g").alias("rings"))


def _valuations(t: Tables):
    return t.orders.select(
        F.col("o_custkey").alias("property_id"), F.col("o_orderdate").alias("effective_date"),
        F.col("o_totalprice").alias("land_value"), F.col("o_orderkey").alias("source_id"),
    )


_LATEST = """
    v AS (SELECT o_custkey AS property_id, o_totalprice AS land_value FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
"""


def _wide_area(t: Tables):
    """One region box over part of the field, named like a nation."""
    region = t.nation.select(
        "n_name",
        rectangle(
            F.col("n_nationkey") * 40, F.col("n_nationkey") * 38, F.col("n_nationkey") * 40 + 200,
            F.col("n_nationkey") * 38 + 300,
        ).alias("area_geometry"),
    )
    return analytics.named_area(region, "n_name", ["nation_7"])


_WIDE = "n AS (SELECT 7 * 40 AS cx, 7 * 38 AS cy, 7 * 40 + 200 AS dx, 7 * 38 + 300 AS dy)"


@query(
    "values_inside_area",
    f"""
    WITH {_BOXES}, {_LATEST}, {_WIDE}
    SELECT property_id, land_value FROM lots JOIN v ON property_id = c_custkey, n
    WHERE ax <= n.dx AND n.cx <= bx AND ay <= n.dy AND n.cy <= "by"
    """,
)
def values_inside_area(t: Tables):
    lands = lots(t).select(F.col("c_custkey").alias("property_id"), "geometry")
    return analytics.values_inside(lands, _wide_area(t), _valuations(t), 50.0).select("property_id", "land_value")


@query(
    "ranked_values_inside",
    f"""
    WITH {_BOXES}, {_LATEST}, {_WIDE}, s AS (
      SELECT c_custkey AS property_id,
        greatest(least(bx, n.dx) - greatest(ax, n.cx), 0) * greatest(least("by", n.dy) - greatest(ay, n.cy), 0)
          / ((bx - ax) * ("by" - ay)) AS share
      FROM lots, n)
    SELECT property_id, land_value, rank() OVER (ORDER BY land_value) AS rank FROM s JOIN v USING (property_id) WHERE share > 0.5
    """,
)
def ranked_values_inside(t: Tables):
    """Latest values of lots lying mostly in an area, ranked."""
    from ..operators.aggregates import global_rank

    lands = lots(t).select(F.col("c_custkey").alias("property_id"), "geometry")
    inside = sp.overlap_join(lands, _wide_area(t), "geometry", "area_geometry", 50.0).select("property_id")
    values = analytics._latest_values(_valuations(t))
    return global_rank(inside.join(values, "property_id"), "land_value")


@query(
    "sub_areas_in_region",
    f"""
    WITH {_BOXES}, {_WIDE}
    SELECT DISTINCT s_suppkey % 50 AS block FROM areas a, n
    WHERE a.cx <= n.dx AND n.cx <= a.dx AND a.cy <= n.dy AND n.cy <= a.dy
    """,
)
def sub_areas_in_region(t: Tables):
    blocks = areas(t).select((F.col("s_suppkey") % 50).alias("block"), F.col("area_geometry").alias("geometry"))
    return analytics.sub_areas(blocks, _wide_area(t), 50.0, ["block"])


@query(
    "ring_repair",
    """
    WITH p AS (SELECT p_partkey, p_partkey % 6 AS kind, 10 + p_size % 7 AS a, 1 + p_partkey % 5 AS h, 2 + p_size % 3 AS k FROM part)
    SELECT p_partkey, kind = 3 AS rejected, CASE kind
        WHEN 0 THEN round(a * a - 10.5::DOUBLE, 6)
        WHEN 1 THEN round(a * (h * h + k * k) / (2.0::DOUBLE * (h + k)), 6)
        WHEN 2 THEN round(2.0::DOUBLE * a * a - 2 * (a - h) * (a - h), 6)
        WHEN 4 THEN round(a * a - 6.0::DOUBLE, 6)
        WHEN 5 THEN round(a * a - 1.0::DOUBLE, 6) END AS area,
      CASE kind WHEN 3 THEN NULL WHEN 4 THEN 1 ELSE 2 END AS n_rings,
      CASE kind WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN 1 END AS n_holes
    FROM p
    """,
)
def ring_repair(t: Tables):
    """Holes touching a corner (0) or a border (4), ring crossing itself (1), overlapping parts (2), a line (3), a plain hole (5)."""
    a, h, k = 10 + F.col("p_size") % 7, 1 + F.col("p_partkey") % 5, 2 + F.col("p_size") % 3
    x, y = (F.col("p_partkey") % 1000) / 7, F.col("p_size") / 3

    def ring(*points) -> Column:
        at = [F.struct((x + px).cast("double").alias("x"), (y + py).cast("double").alias("y")) for px, py in points]
        return F.array(*at, at[0])

    zero = F.lit(0)
    square = ring((zero, zero), (a, zero), (a, a), (zero, a))
    shapes = [
        F.array(square, ring((a, a), (a - 2, a - 5), (a - 5, a - 2))),
        F.array(ring((zero, zero), (a, h), (a, zero), (zero, k))),
        F.array(ring((h, h), (h, a + h), (a + h, a + h), (a + h, h)), square),
        F.array(ring((zero, zero), (a, h), (2 * a, 2 * h))),
        F.array(square, ring((zero, zero + 2), (zero + 3, zero + 2), (zero + 3, zero + 4), (zero, zero + 4))),
        F.array(ring((zero + 2, zero + 2), (zero + 3, zero + 2), (zero + 3, zero + 3), (zero + 2, zero + 3)), square),
    ]
    kind = F.col("p_partkey") % 6
    given = F.coalesce(*(F.when(kind == i, g) for i, g in enumerate(shapes)))
    # Read twice, for the shapes and for those rejected.
    fixed = cut_lineage(sp.with_repaired(t.part.select("p_partkey", given.alias("given")), "given", "fixed"), "repaired")
    rejects = sp.repair_rejects(fixed, "given", "fixed").select("p_partkey", F.lit(True).alias("rejected"))
    whole = fixed.join(rejects, "p_partkey", "left")
    return whole.select(
        "p_partkey", F.coalesce("rejected", F.lit(False)).alias("rejected"),
        F.when(F.col("fixed").isNotNull(), F.round(sp.planar_area("fixed"), 6)).alias("area"),
        F.when(F.col("fixed").isNotNull(), F.size("fixed")).alias("n_rings"),
        F.when(F.col("fixed").isNotNull(), F.size(F.filter("fixed", lambda r: sp.ring_area(r) < 0))).alias("n_holes"),
    )


# Lots of lon/lat rectangles, two areas that cut through them.
_LANDS = """
    lands AS (SELECT c_custkey AS property_id, 150 + c_custkey % 83 * 0.004::DOUBLE AS x, -34 + c_custkey % 61 * 0.003::DOUBLE AS y,
      0.001::DOUBLE * (1 + c_custkey % 9) AS d FROM customer)
"""


@query(
    "value_per_square_metre",
    f"""
    WITH {_LANDS}, {_LATEST}, s AS (
      SELECT property_id, d, y, greatest(least(x + d, 150.2001::DOUBLE) - greatest(x, 150.0303::DOUBLE), 0)
        * greatest(least(y + d, -33.9003::DOUBLE) - greatest(y, -33.9907::DOUBLE), 0) / (d * d) AS share FROM lands),
    w AS (
      SELECT property_id, land_value / (6378137.0 * 6378137.0 / 2 * radians(d) * ({_q('y + d')} - {_q('y')})) AS per_sqm
      FROM s JOIN v USING (property_id) WHERE share > 0.5)
    SELECT property_id, round(per_sqm, 5) AS per_sqm, rank() OVER (ORDER BY per_sqm) AS rank FROM w
    """,
)
def value_per_square_metre(t: Tables):
    """Latest value per square metre, ranked, of the properties lying mostly in an area."""
    key = F.col("c_custkey")
    x, y = 150 + key % 83 * F.lit(0.004), -34 + key % 61 * F.lit(0.003)
    d = F.lit(0.001) * (1 + key % 9)
    lands = t.customer.select(key.alias("property_id"), rectangle(x, y, x + d, y + d).alias("geometry"))
    box = rectangle(F.lit(150.0303), F.lit(-33.9907), F.lit(150.2001), F.lit(-33.9003))
    area = t.region.filter("r_regionkey = 0").select(box.alias("area_geometry"))
    ranked = analytics.ranked_values(lands, area, _valuations(t), 0.05)
    return ranked.select("property_id", F.round("per_sqm", 5).alias("per_sqm"), "rank")
