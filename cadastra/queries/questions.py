"""The long analytic questions on stand-in tables.

Parts play properties, nations play areas, suppliers play blocks: a line item
links a part (property) to a supplier (block) through a parcel.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators.spatial import planar_area
from ..plans import analytics
from .base import Tables, day, query

HECTARES = [3, 77, 1234]

# Property: a part; its area is the part size, missing for every 13th.
_VALUED = """
    blocks AS (SELECT s_suppkey AS mb_code FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey IN (0, 1, 2)),
    p AS (SELECT p_partkey AS property_id, p_brand AS zone_code, p_name AS property_name,
            CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size AS DOUBLE) END AS area FROM part),
    parcels AS (SELECT DISTINCT l_partkey AS property_id, l_partkey || '/' || l_linenumber AS land_parcel_id FROM lineitem),
    pb AS (SELECT DISTINCT l_partkey || '/' || l_linenumber AS land_parcel_id, l_suppkey AS mb_code FROM lineitem),
    linked AS (
      SELECT * FROM p JOIN parcels USING (property_id) JOIN pb USING (land_parcel_id) JOIN blocks USING (mb_code)
      QUALIFY row_number() OVER (PARTITION BY property_id, land_parcel_id ORDER BY mb_code) = 1),
    v AS (SELECT l_partkey AS property_id, l_extendedprice AS land_value FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_extendedprice DESC) = 1),
    valued AS (
      SELECT linked.*, land_value,
        (CASE WHEN area IS NULL THEN 1 ELSE land_value END) /
        (CASE WHEN property_id IN (3, 77, 1234) THEN area * 10000 WHEN area IS NULL THEN 1 WHEN area < 10 THEN 10 {steps} ELSE area END) AS per_m2
      FROM linked LEFT JOIN v USING (property_id)),
    share AS (SELECT mb_code, quantile_cont(per_m2, 0.75) AS pc FROM valued GROUP BY 1)
"""
_PLAIN = _VALUED.format(steps="")
_STEPPED = _VALUED.format(steps="WHEN area < 50 THEN 50 WHEN area < 100 THEN 100")

_BEST = """
    SELECT mb_code, property_id, land_parcel_id, zone_code, land_value, round(per_m2, 8) AS per_m2,
      round(log10(land_value) * (1 - 0.4) + land_value * 0.4, 5) AS score
    FROM valued JOIN share USING (mb_code) WHERE per_m2 IS NOT NULL {where}
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order} NULLS LAST, property_id, land_parcel_id) = 1
"""


def _valued(t: Tables, steps=(10,)):
    blocks = (
        t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .filter(F.col("n_regionkey").isin(0, 1, 2))
        .select(F.col("s_suppkey").alias("mb_code"))
    )
    properties = t.part.select(
        F.col("p_partkey").alias("property_id"), F.col("p_brand").alias("zone_code"),
        F.col("p_name").alias("property_name"),
        F.when(F.col("p_partkey") % 13 != 0, F.col("p_size").cast("double")).alias("area"),
    )
    parcel = F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string"))
    links = t.lineitem.select(F.col("l_partkey").alias("property_id"), parcel.alias("land_parcel_id")).distinct()
    parcel_blocks = t.lineitem.select(parcel.alias("land_parcel_id"), F.col("l_suppkey").alias("mb_code")).distinct()
    valuations = t.lineitem.select(
        F.col("l_partkey").alias("property_id"), F.col("l_shipdate").alias("base_date"),
        F.col("l_extendedprice").alias("land_value"),
    )
    return analytics.parcel_values(blocks, properties, links, parcel_blocks, valuations, HECTARES, steps)


def _shape(df):
    return df.select(
        "mb_code", "property_id", "land_parcel_id", "zone_code", "land_value",
        F.round("per_m2", 8).alias("per_m2"), F.round("score", 5).alias("score"),
    )


@query("best_parcel_per_block", f"WITH {_PLAIN} {_BEST.format(where='', key='mb_code', order='per_m2')}")
def best_parcel_per_block(t: Tables):
    return _shape(analytics.best_parcels(_valued(t), 0.75, 0.4))


@query(
    "best_parcel_per_property",
    f"""WITH {_PLAIN} {_BEST.format(where="AND zone_code IN ('Brand#1', 'Brand#2', 'Brand#3')", key='property_id', order='per_m2')}""",
)
def best_parcel_per_property(t: Tables):
    zones = ["Brand#1", "Brand#2", "Brand#3"]
    return _shape(analytics.best_parcels(_valued(t), 0.75, 0.4, "property_id", zone_codes=zones))


@query("best_parcel_by_distance", f"WITH {_PLAIN} {_BEST.format(where='', key='mb_code', order='round(pc - per_m2, 6)')}")
def best_parcel_by_distance(t: Tables):
    return _shape(analytics.best_parcels(_valued(t), 0.75, 0.4, order="distance"))


@query(
    "top_value_per_block",
    f"""
    WITH {_STEPPED}
    SELECT mb_code, property_id, land_parcel_id, round(per_m2, 8) AS per_m2 FROM valued
    QUALIFY row_number() OVER (PARTITION BY mb_code ORDER BY per_m2 DESC NULLS FIRST, property_id, land_parcel_id) = 1
    """,
)
def top_value_per_block(t: Tables):
    out = analytics.top_value_per_block(_valued(t, (10, 50, 100)))
    return out.select("mb_code", "property_id", "land_parcel_id", F.round("per_m2", 8).alias("per_m2"))


# The whole question: nations are regions in a grid of 200 by 200, suppliers blocks of which many cross its lines.
_WHOLE = """
    WITH mb AS (SELECT s_suppkey AS mb_code, (s_suppkey * 53) % 997 AS cx, (s_suppkey * 71) % 991 AS cy, 10 + s_suppkey % 30 AS w, 10 + s_suppkey % 40 AS h FROM supplier),
    region_box AS (SELECT n_nationkey % 5 * 200 AS ax, n_nationkey // 5 * 200 AS ay FROM nation WHERE n_nationkey % 3 > 0),
    blocks AS (
      SELECT mb_code, w, h FROM mb, region_box
      WHERE greatest(least(cx + w, ax + 200) - greatest(cx, ax), 0) * greatest(least(cy + h, ay + 200) - greatest(cy, ay), 0) * 2 > w * h),
    p AS (SELECT p_partkey AS property_id, p_brand AS zone_code, p_name AS property_name,
            CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size AS DOUBLE) END AS area,
            CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey % 30 AS VARCHAR) END AS unit, CAST(p_size AS VARCHAR) AS house,
            CASE WHEN p_partkey % 7 > 0 THEN p_partkey % 30 END AS street_id, p_partkey % 6 AS suburb_id,
            CAST(2000 + p_size AS INTEGER) AS postcode FROM part),
    detail AS (SELECT l_orderkey || '-' || l_linenumber AS pid, l_partkey || '/' || l_linenumber AS land_parcel_id FROM lineitem),
    address_block AS (SELECT l_orderkey || '-' || l_linenumber AS pid, l_suppkey AS mb_code FROM lineitem),
    place AS (SELECT DISTINCT land_parcel_id, mb_code FROM detail JOIN address_block USING (pid)),
    link AS (SELECT DISTINCT l_partkey AS property_id, l_partkey || '/' || l_linenumber AS land_parcel_id FROM lineitem),
    linked AS (
      SELECT p.*, land_parcel_id, mb_code, w, h FROM p JOIN link USING (property_id) JOIN place USING (land_parcel_id) JOIN blocks USING (mb_code)
      QUALIFY row_number() OVER (PARTITION BY property_id, land_parcel_id ORDER BY mb_code) = 1),
    v AS (SELECT l_partkey AS property_id, l_extendedprice AS land_value FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_extendedprice DESC) = 1),
    valued AS (
      SELECT linked.*, land_value, (CASE WHEN area IS NULL THEN 1 ELSE land_value END) /
        (CASE WHEN property_id IN (3, 77, 1234) THEN area * 10000 WHEN area IS NULL THEN 1 WHEN area < 10 THEN 10 ELSE area END) AS per_m2
      FROM linked LEFT JOIN v USING (property_id)),
    best AS (
      SELECT * FROM valued WHERE per_m2 IS NOT NULL {where}
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY per_m2, property_id, land_parcel_id) = 1)
    SELECT mb_code, CASE WHEN property_id % 11 > 0 THEN p_type END AS property_description, land_parcel_id, property_name, property_id,
      zone_code, round(log10(land_value) * (1 - 0.4) + land_value * 0.4, 5) AS rank, round(per_m2, 8) AS per_m2, land_value, area,
      unit, house, n_name AS street, r_name AS suburb, postcode, CAST(w * h AS DOUBLE) AS block_area
    FROM best JOIN part ON p_partkey = property_id LEFT JOIN nation ON n_nationkey = street_id LEFT JOIN region ON r_regionkey = suburb_id
"""


def _whole(t: Tables, one_per: str = "mb_code", zone_codes=None):
    from .spatial import rectangle

    x, y = F.col("s_suppkey") * 53 % 997, F.col("s_suppkey") * 71 % 991
    west, south = F.col("n_nationkey") % 5 * 200, F.floor(F.col("n_nationkey") / 5) * 200
    parcel = F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string"))
    address = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    mesh_pid = F.concat(F.lit("MB"), F.col("s_suppkey").cast("string"))
    names = [r.n_name for r in t.nation.filter("n_nationkey % 3 > 0").select("n_name").collect()]
    tables = {
        "mesh_block": t.supplier.select(
            F.col("s_suppkey").alias("mb_code"),
            rectangle(x, y, x + 10 + F.col("s_suppkey") % 30, y + 10 + F.col("s_suppkey") % 40).alias("geometry"),
        ),
        "region": t.nation.select(
            F.col("n_name").alias("region_name"), rectangle(west, south, west + 200, south + 200).alias("area_geometry")
        ),
        "property": t.part.select(
            F.col("p_partkey").alias("property_id"), F.col("p_brand").alias("zone_code"), F.col("p_name").alias("property_name"),
            F.when(F.col("p_partkey") % 13 != 0, F.col("p_size").cast("double")).alias("area"),
            F.when(F.col("p_partkey") % 4 == 0, (F.col("p_partkey") % 30).cast("string")).alias("unit_number"),
            F.col("p_size").cast("string").alias("house_number"),
            F.when(F.col("p_partkey") % 7 > 0, F.col("p_partkey") % 30).alias("street_id"),
            (F.col("p_partkey") % 6).alias("suburb_id"), (2000 + F.col("p_size")).cast("int").alias("postcode"),
        ),
        "land_parcel_link": t.lineitem.select(F.col("l_partkey").alias("property_id"), parcel.alias("land_parcel_id")).distinct(),
        "address_detail": t.lineitem.select(address.alias("address_detail_pid"), parcel.alias("legal_parcel_id")),
        "address_mesh_block": t.lineitem.select(
            address.alias("address_detail_pid"), F.concat(F.lit("MB"), F.col("l_suppkey").cast("string")).alias("mb_pid")
        ),
        "mb": t.supplier.select(mesh_pid.alias("mb_pid"), F.col("s_suppkey").alias("mb_code")),
        "valuation": t.lineitem.select(
            F.col("l_partkey").alias("property_id"), F.col("l_shipdate").alias("base_date"), F.col("l_extendedprice").alias("land_value")
        ),
        "property_description": t.part.filter("p_partkey % 11 > 0").select(
            F.col("p_partkey").alias("property_id"), F.col("p_type").alias("property_description")
        ),
        "street": t.nation.select(F.col("n_nationkey").alias("street_id"), F.col("n_name").alias("street_name")),
        "suburb": t.region.select(F.col("r_regionkey").alias("suburb_id"), F.col("r_name").alias("suburb_name")),
    }
    best = analytics.best_parcels_in(tables, names, 0.75, 0.4, 100.0, HECTARES, one_per, zone_codes=zone_codes)
    return best.select(
        *[c for c in best.columns if c not in ("rank", "per_m2", "geometry")],
        F.round("rank", 5).alias("rank"), F.round("per_m2", 8).alias("per_m2"),
        F.round(planar_area("geometry"), 6).alias("block_area"),
    )


@query("best_parcel_in_regions", _WHOLE.format(where="", key="mb_code"))
def best_parcel_in_regions(t: Tables):
    """Blocks chosen by overlap, parcels by the chain of addresses, the best of each block with its texts."""
    return _whole(t)


@query(
    "best_property_in_regions",
    _WHOLE.format(where="AND zone_code IN ('Brand#1', 'Brand#2', 'Brand#3')", key="property_id"),
)
def best_property_in_regions(t: Tables):
    """The same, one row per property of some zones."""
    return _whole(t, "property_id", ["Brand#1", "Brand#2", "Brand#3"])


@query(
    "zoning_as_of",
    """
    WITH z AS (SELECT user_id AS property_id, event_type AS zone_code, CAST(ts AS DATE) AS d, event_id FROM events),
    f AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY property_id, zone_code ORDER BY d, event_id) = 1),
    c AS (SELECT unnest([DATE '2024-01-05', DATE '2024-01-20']) AS cutoff)
    SELECT CAST(cutoff AS VARCHAR) AS cutoff, property_id, zone_code, CAST(d AS VARCHAR) AS zone_day
    FROM c JOIN f ON d <= cutoff
    QUALIFY row_number() OVER (PARTITION BY cutoff, property_id ORDER BY d DESC, zone_code DESC) = 1
    """,
)
def zoning_as_of(t: Tables):
    zones = t.events.select(
        F.col("user_id").alias("property_id"), F.col("event_type").alias("zone_code"),
        F.col("ts").cast("date").alias("effective_date"), F.col("event_id").alias("source_id"),
    )
    out = analytics.zoning_as_of(zones, [date(2024, 1, 5), date(2024, 1, 20)])
    return out.select(
        F.col("cutoff").cast("string").alias("cutoff"), "property_id", "zone_code",
        day("effective_date").alias("zone_day"),
    )


_YEARS = range(1996, 2002)


@query(
    "values_as_of_years",
    """
    WITH v AS (SELECT o_custkey AS property_id, CAST(o_orderdate AS DATE) AS d, o_totalprice AS land_value,
                 o_orderpriority = '6A(1)' OR o_orderpriority = '1-URGENT' AS heritage, o_orderkey AS source_id FROM orders),
    a AS (SELECT l_orderkey AS source_id, min(l_quantity) AS sqm_area FROM lineitem GROUP BY 1),
    s AS (SELECT property_id, d, round(land_value / sqm_area, 8) AS land_value, heritage, source_id FROM v JOIN a USING (source_id)),
    c AS (SELECT make_date(CAST(y AS BIGINT), 1, 1) AS cutoff FROM range(1996, 2002) r(y))
    SELECT CAST(year(cutoff) AS INTEGER) AS year, property_id, CAST(d AS VARCHAR) AS base_day, land_value, heritage
    FROM c JOIN s ON d <= cutoff
    QUALIFY row_number() OVER (PARTITION BY cutoff, property_id ORDER BY d DESC, source_id DESC) = 1
    """,
)
def values_as_of_years(t: Tables):
    valuations = t.orders.select(
        F.col("o_custkey").alias("property_id"), F.col("o_orderdate").cast("date").alias("valuation_base_date"),
        F.col("o_totalprice").alias("land_value"), F.col("o_orderkey").alias("source_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "6A(1)").otherwise(F.col("o_orderpriority")).alias("valuation_basis"),
    )
    owner = t.orders.select(F.col("o_custkey").alias("property_id"), F.col("o_orderkey").alias("source_id"))
    sizes = t.lineitem.select(F.col("l_orderkey").alias("source_id"), F.col("l_quantity").alias("sqm_area"))
    areas = owner.join(sizes, "source_id").withColumn("strata_lot_number", F.lit(None).cast("int"))
    out = analytics.values_as_of(valuations, areas, list(_YEARS))
    return out.select(
        "year", "property_id", day("valuation_base_date").alias("base_day"),
        F.round("land_value", 8).alias("land_value"), "heritage",
    )


# Orders play addresses, customers streets, nations localities, regions states.
def _wide(t: Tables):
    detail = t.orders.select(
        F.col("o_orderkey").alias("address_detail_pid"),
        F.col("o_custkey").alias("street_locality_pid"),
        (F.col("o_orderkey") % 200).alias("number_first"),
        F.concat_ws("/", (F.col("o_orderkey") % 50).cast("string"), F.col("o_custkey").cast("string")).alias("legal_parcel_id"),
        "o_orderstatus",
        "o_orderpriority",
    )
    street = t.customer.select(
        F.col("c_custkey").alias("street_locality_pid"), F.col("c_mktsegment").alias("street_name"),
        F.col("c_nationkey").alias("locality_pid"),
    )
    locality = t.nation.select(
        F.col("n_nationkey").alias("locality_pid"), F.col("n_name").alias("locality_name"),
        F.col("n_regionkey").alias("state_pid"),
    )
    state = t.region.select(F.col("r_regionkey").alias("state_pid"), F.col("r_name").alias("state_name"))
    return analytics.addresses_wide(detail, street, locality, state)


_WIDE = """
    w AS (SELECT o_orderkey AS address_detail_pid, c_mktsegment AS street_name, n_name AS locality_name, r_name AS state_name,
            o_orderkey % 200 AS number_first, (o_orderkey % 50) || '/' || o_custkey AS legal_parcel_id, o_orderstatus, o_orderpriority
          FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
"""


@query(
    "star_filter",
    f"""
    WITH {_WIDE}, b AS (SELECT DISTINCT l_orderkey AS address_detail_pid, l_suppkey AS mb_code FROM lineitem)
    SELECT 'locality' AS filters, mb_code FROM w JOIN b USING (address_detail_pid) WHERE locality_name IN ('NATION_3', 'NATION_8') GROUP BY 2
    UNION ALL SELECT 'street', mb_code FROM w JOIN b USING (address_detail_pid)
      WHERE locality_name IN ('NATION_3', 'NATION_8') AND street_name IN ('MACHINERY') GROUP BY 2
    UNION ALL SELECT 'number', mb_code FROM w JOIN b USING (address_detail_pid)
      WHERE locality_name IN ('NATION_3', 'NATION_8') AND street_name IN ('MACHINERY') AND number_first = 40 GROUP BY 2
    """,
)
def star_filter(t: Tables):
    wide = _wide(t)
    blocks = t.lineitem.select(F.col("l_orderkey").alias("address_detail_pid"), F.col("l_suppkey").alias("mb_code"))
    places = ["NATION_3", "NATION_8"]
    parts = {
        "locality": analytics.blocks_touched(wide, blocks, places),
        "street": analytics.blocks_touched(wide, blocks, places, ["MACHINERY"]),
        "number": analytics.blocks_touched(wide, blocks, places, ["MACHINERY"], 40),
    }
    out = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("filters"), "mb_code")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "composed_addresses",
    f"""
    WITH {_WIDE}
    SELECT address_detail_pid, legal_parcel_id,
      'L' || number_first || coalesce(CASE WHEN number_first % 3 = 0 THEN 'A' END, '') AS lot,
      coalesce(CASE WHEN number_first % 2 = 0 THEN o_orderstatus END, '') || number_first AS unit,
      coalesce(CASE WHEN number_first % 5 = 0 THEN 'LEVEL' END || ' ', '') || coalesce(CASE WHEN number_first % 7 = 0 THEN 'G' END || '-', '')
        || (number_first % 9) AS level,
      number_first || coalesce('-' || '' || (CASE WHEN number_first % 4 = 0 THEN number_first + 2 END) || 'B', '') AS house,
      street_name, locality_name, '2' || substr(o_orderpriority, 1, 1) || '00' AS postcode
    FROM w WHERE state_name IN (SELECT r_name FROM region WHERE r_regionkey <> 4)
    """,
)
def composed_addresses(t: Tables):
    n = F.col("number_first")
    none = F.lit(None).cast("string")
    detail = _wide(t).select(
        "address_detail_pid", "legal_parcel_id", "street_name", "locality_name", "state_pid",
        F.lit("L").alias("lot_number_prefix"), n.alias("lot_number"), F.when(n % 3 == 0, "A").alias("lot_number_suffix"),
        F.when(n % 2 == 0, F.col("o_orderstatus")).alias("flat_number_prefix"), n.alias("flat_number"),
        none.alias("flat_number_suffix"),
        F.when(n % 5 == 0, "LEVEL").alias("level_type_code"), F.when(n % 7 == 0, "G").alias("level_number_prefix"),
        (n % 9).alias("level_number"), none.alias("level_number_suffix"),
        none.alias("number_first_prefix"), n.alias("number_first"), none.alias("number_first_suffix"),
        F.lit("").alias("number_last_prefix"), F.when(n % 4 == 0, n + 2).alias("number_last"),
        F.lit("B").alias("number_last_suffix"),
        F.concat(F.lit("2"), F.substring("o_orderpriority", 1, 1), F.lit("00")).alias("postcode"),
    )
    return analytics.composed_addresses(detail, F.col("state_pid") != 4)


@query(
    "street_aliases",
    """
    WITH s AS (
      SELECT c_custkey AS pid, c_mktsegment || coalesce(' ' || n_name, '') || coalesce(' ' || r_name, '') AS street_label
      FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON n_nationkey = c_nationkey
      LEFT JOIN (SELECT * FROM region WHERE r_regionkey > 1) ON r_regionkey = c_custkey % 5),
    a AS (
      SELECT o_custkey AS pid, o_orderpriority || coalesce(' ' || n_name, '') AS alias_label
      FROM orders LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON n_nationkey = o_orderkey % 25)
    SELECT DISTINCT pid AS street_locality_pid, street_label, alias_label FROM s LEFT JOIN a USING (pid)
    """,
)
def street_aliases(t: Tables):
    types = t.nation.filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    suffixes = t.region.filter("r_regionkey > 1").select(
        F.col("r_regionkey").cast("bigint").alias("code"), F.col("r_name").alias("name")
    )
    streets = t.customer.select(
        F.col("c_custkey").alias("street_locality_pid"), F.col("c_mktsegment").alias("street_name"),
        F.col("c_nationkey").alias("street_type_code"), (F.col("c_custkey") % 5).alias("street_suffix_code"),
    )
    alias = t.orders.select(
        F.col("o_custkey").alias("street_locality_pid"), F.col("o_orderpriority").alias("street_name"),
        (F.col("o_orderkey") % 25).alias("street_type_code"), F.lit(None).cast("bigint").alias("street_suffix_code"),
    )
    return analytics.street_aliases(streets, alias, types, suffixes)


@query(
    "duplicate_lots",
    """
    WITH l AS (SELECT l_partkey || '/' || l_suppkey AS lot_id_string, l_quantity AS shape_area, l_orderkey, l_linenumber FROM lineitem),
    s AS (SELECT lot_id_string, max(shape_area) - min(shape_area) AS area_variance FROM l GROUP BY 1 HAVING max(shape_area) > min(shape_area))
    SELECT lot_id_string, l_orderkey AS object_id, shape_area, round(area_variance, 2) AS area_variance FROM l JOIN s USING (lot_id_string)
    """,
)
def duplicate_lots(t: Tables):
    layer = t.lineitem.select(
        F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("lot_id_string"),
        F.col("l_quantity").alias("shape_area"), F.col("l_shipdate").alias("last_update"),
        F.col("l_orderkey").alias("object_id"),
    )
    out = analytics.duplicate_lots(layer)
    return out.select("lot_id_string", "object_id", "shape_area", F.round("area_variance", 2).alias("area_variance"))
