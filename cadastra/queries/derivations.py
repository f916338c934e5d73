"""The derivation jobs on raw tables built from orders and line items.

Orders play sales (and, grouped by property and day, land-value rows), line
items play pieces of legal text and participants, the older orders archived
sales.  The SQL builds the same raw tables as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import zone_standard
from ..operators.joins import with_dimension
from ..operators.legal import derive_parcels, parse_descriptions, split_folio
from ..operators.steps import read_manifest
from ..plans import addresses, dims, land_values, layers, legacy, provenance, sales
from ..plans.build import rebuild_tables
from ..session import cut_lineage, scratch_path
from .base import Tables, day, query

# The same select list serves both engines: only division, day arithmetic and
# the text type differ.
_SALE = """
  o_orderkey AS position, 'file-' || (o_orderkey % 8) AS file_path, CAST(o_custkey % 25 AS INTEGER) AS district_code,
  CASE WHEN o_orderkey % 23 <> 0 THEN CAST({half} AS INTEGER) END AS property_id,
  CAST(o_orderkey AS INTEGER) AS sale_counter, {provided} AS date_provided,
  CASE WHEN o_orderkey % 6 = 0 THEN 'HOUSE ' || o_custkey END AS property_name,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderkey % 4 AS {text}) END AS unit_number,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey % 90 AS {text}) END AS house_number,
  CASE WHEN o_orderkey % 8 <> 0 THEN lower(o_orderpriority) || ' st' END AS street_name,
  CASE WHEN o_orderkey % 12 <> 0 THEN 'Town ' || (o_custkey % 40) END AS locality_name,
  CAST(2000 + o_custkey % 40 AS {text}) AS postcode,
  CASE WHEN o_orderkey % 13 <> 0 THEN CAST({area} AS DOUBLE) END AS area,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'H' WHEN '2-HIGH' THEN 'M' WHEN '5-LOW' THEN 'U' END AS area_type,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS contract_date,
  CASE WHEN o_orderkey % 7 <> 0 THEN {settled} END AS settlement_date,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS purchase_price,
  CASE o_orderkey % 4 WHEN 0 THEN 'R' || (o_custkey % 6) WHEN 1 THEN 'A' WHEN 2 THEN 'ZZ' END AS zone_code,
  CASE o_orderstatus WHEN 'F' THEN 'V' WHEN 'O' THEN 'R' ELSE '3' END AS nature_of_property,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS primary_purpose,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS strata_lot_number,
  CASE WHEN o_orderkey % 10 = 0 THEN 'PC' END AS comp_code, CASE WHEN o_orderkey % 14 = 0 THEN 'SV' END AS sale_code,
  CAST(o_orderkey % 100 AS INTEGER) AS interest_of_sale, 'D' || (o_custkey % 1000) AS dealing_number
"""
_SALE_DUCK = _SALE.format(
    half="o_custkey // 2", provided="o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER))", text="VARCHAR",
    area="round(o_totalprice) / 10", settled="CAST(o_orderdate AS DATE) + 42",
)
_SALE_SPARK = _SALE.format(
    half="o_custkey div 2", text="STRING",
    provided="CAST(o_orderdate AS TIMESTAMP) + make_dt_interval(CAST(o_orderkey % 30 AS INT))",
    area="round(o_totalprice) / 10", settled="date_add(CAST(o_orderdate AS DATE), 42)",
)

_LV = """
  SELECT CAST(district_code AS INTEGER) AS district_code,
    CASE WHEN property_id % 3 <> 0 THEN 'DISTRICT ' || district_code END AS district_name, property_id,
    CASE WHEN property_id % 4 = 0 THEN 'UNDERSP' WHEN n % 2 = 0 THEN 'NORMAL' END AS property_type,
    CAST(property_id % 60 AS {text}) AS house_number, 'Lane ' || (property_id % 70) AS street_name,
    'Town ' || (property_id % 45) AS suburb_name, CAST(2000 + property_id % 45 AS {text}) AS postcode,
    CASE WHEN n % 5 <> 4 THEN n || '/' || (700000 + property_id) END AS property_description,
    'R' || (property_id % 7) AS zone_code, CAST(top / 100 AS DOUBLE) AS area,
    CASE property_id % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'M' END AS area_type,
    CASE WHEN sold = 1 THEN d END AS base_date_1, CASE WHEN sold = 1 THEN top END AS land_value_1,
    {january} AS base_date_2, low AS land_value_2, {january_before} AS base_date_3, n * 1000 AS land_value_3,
    d AS base_date_4, CAST(NULL AS BIGINT) AS land_value_4, DATE '2000-01-01' AS base_date_5, total AS land_value_5,
    '6A(' || (property_id % 3) || ')' AS basis_1, 'lv-' || district_code AS source_file_name,
    line AS source_line_number, {tomorrow} AS source_date
  FROM days
"""
# One land-value row per property and day with sales.
_DAYS = """
  SELECT CAST({half} AS INTEGER) AS property_id, CAST(o_orderdate AS DATE) AS d, min(o_custkey % 25) AS district_code,
    count(*) AS n, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS sold,
    CAST(max(round(o_totalprice)) AS BIGINT) AS top, CAST(min(round(o_totalprice)) AS BIGINT) AS low,
    CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS total, CAST(min(o_orderkey) AS INTEGER) AS line
  FROM {orders} GROUP BY 1, 2
"""
_LV_DUCK = _LV.format(
    text="VARCHAR", january="make_date(year(d), 1, 1)", january_before="make_date(year(d) - 1, 1, 1)", tomorrow="d + 1"
)
_LV_SPARK = _LV.format(
    text="STRING", january="make_date(year(d), 1, 1)", january_before="make_date(year(d) - 1, 1, 1)",
    tomorrow="date_add(d, 1)",
)

_ZONE = """CASE WHEN zone_code IS NULL THEN NULL WHEN regexp_full_match(zone_code, '[ABCDEIMNOPRSTUVWXYZ]') THEN 'legacy_vg_2011'
  WHEN regexp_full_match(zone_code, '(IN|MU|RE|RU|SP|B|C|E|R|W)[0-9]') THEN 'ep&a_2006' ELSE 'unknown' END"""

RAW = f"""
  sale AS (SELECT *, {_ZONE} AS zone_standard, sha256(file_path || '|' || position) AS source_id FROM (SELECT {_SALE_DUCK} FROM orders)),
  days AS ({_DAYS.format(half="o_custkey // 2", orders="orders")}),
  lv AS (SELECT *, 'ep&a_2006' AS zone_standard, sha256(source_file_name || '|' || source_line_number) AS source_id,
           coalesce(base_date_1, source_date) AS effective_date FROM ({_LV_DUCK})),
  ranked AS (
    SELECT *, EXISTS (SELECT 1 FROM lv WHERE lv.property_id = s.property_id AND lv.effective_date = s.effective_date) AS seen
    FROM (
      SELECT *, coalesce(contract_date, settlement_date, CAST(date_provided AS DATE)) AS effective_date FROM sale
      WHERE property_id IS NOT NULL AND sale_counter IS NOT NULL AND length(dealing_number) > 1
      QUALIFY row_number() OVER (PARTITION BY dealing_number, property_id, strata_lot_number ORDER BY
        (contract_date IS NOT NULL)::INT + (settlement_date IS NOT NULL)::INT + (purchase_price IS NOT NULL)::INT
          + (area_type IS NOT NULL)::INT + (area IS NOT NULL)::INT DESC, date_provided DESC, source_id) = 1) s),
  frag AS (
    SELECT 'file-' || (l_orderkey % 8) AS file_path, l_orderkey * 10 + l_linenumber AS position,
      CAST(l_orderkey AS INTEGER) AS sale_counter,
      CASE WHEN l_linenumber <> 5 THEN l_linenumber || '/' || min(l_partkey) || ' ' END AS property_description
    FROM lineitem GROUP BY l_orderkey, l_linenumber),
  texts AS (
    SELECT file_path, sale_counter, string_agg(property_description, '' ORDER BY position) AS full_text,
      sha256(file_path || '|' || min(position)) AS text_source
    FROM frag WHERE property_description IS NOT NULL GROUP BY 1, 2),
  described AS (
    SELECT property_id, strata_lot_number, dealing_number, full_text, text_source, effective_date, seen, date_provided
    FROM ranked JOIN texts USING (file_path, sale_counter)
    QUALIFY row_number() OVER (PARTITION BY property_id, strata_lot_number, dealing_number
      ORDER BY date_provided DESC, text_source) = 1)
"""


def ps_row_b(t: Tables) -> DataFrame:
    rows = t.spark.sql(f"SELECT {_SALE_SPARK} FROM {{orders}}", orders=t.orders)
    return rows.withColumn("zone_standard", zone_standard("zone_code"))


def land_value_row(t: Tables) -> DataFrame:
    grouped = t.spark.sql(_DAYS.format(half="o_custkey div 2", orders="{orders}"), orders=t.orders)
    rows = t.spark.sql(_LV_SPARK.replace("FROM days", "FROM {days}"), days=grouped)
    none = F.lit(None).cast("string")
    more = {f"{name}_{i}": none for i in range(1, 6) for name in ("basis", "authority") if f"{name}_{i}" != "basis_1"}
    return (
        rows.withColumn("zone_standard", zone_standard("zone_code"))
        .withColumns({"property_name": none, "unit_number": none, **more})
    )


def ps_row_c(t: Tables) -> DataFrame:
    piece = F.concat(F.col("l_linenumber").cast("string"), F.lit("/"), F.col("part").cast("string"), F.lit(" "))
    rows = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    return rows.select(
        F.concat(F.lit("file-"), (F.col("l_orderkey") % 8).cast("string")).alias("file_path"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
        F.col("l_orderkey").cast("int").alias("sale_counter"),
        F.when(F.col("l_linenumber") != 5, piece).alias("property_description"),
    )


def ps_row_d(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("file-"), (F.col("l_orderkey") % 8).cast("string")).alias("file_path"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
        F.col("l_orderkey").cast("int").alias("sale_counter"),
        F.when(F.col("l_partkey") % 31 != 0, F.col("l_partkey")).alias("property_id"),
        F.when(F.col("l_returnflag") == "R", "P").otherwise("V").alias("participant"),
    )


def _ranked(t: Tables) -> DataFrame:
    return sales.ranked_sales(ps_row_b(t), land_value_row(t))


def _shared_ranked(t: Tables) -> DataFrame:
    """Ranked sales written once, for queries that read them several times."""
    return cut_lineage(_ranked(t), "ranked-sales")


def _dated(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[day(c).alias(c) if c in _DATES else F.col(c) for c in columns])


_DATES = {"effective_date", "contract_date", "settlement_date", "valuation_base_date", "date_published"}


def _iso(name: str) -> str:
    return f"CAST(CAST({name} AS DATE) AS VARCHAR) AS {name}"


@query(
    "derive_identifiers",
    f"""
    WITH {RAW}
    SELECT 'zone' AS kind, zone_code AS code, NULL::VARCHAR AS name FROM
      (SELECT zone_code FROM lv WHERE zone_standard = 'ep&a_2006' UNION SELECT zone_code FROM sale WHERE zone_standard = 'ep&a_2006')
    UNION ALL SELECT 'purpose', primary_purpose, NULL FROM (SELECT DISTINCT primary_purpose FROM sale WHERE primary_purpose IS NOT NULL)
    UNION ALL SELECT 'district', CAST(d AS VARCHAR), nm FROM
      (SELECT district_code AS d FROM lv UNION SELECT district_code FROM sale) LEFT JOIN
      (SELECT district_code AS d, min(district_name) AS nm FROM lv GROUP BY 1) USING (d)
    UNION ALL SELECT 'property', CAST(p AS VARCHAR), NULL FROM
      (SELECT property_id AS p FROM lv UNION SELECT property_id FROM sale WHERE property_id IS NOT NULL)
    """,
)
def derive_identifiers(t: Tables):
    lv, b = land_value_row(t), ps_row_b(t)
    none = F.lit(None).cast("string")
    # Every table holds rows of its own, so that none can be left out unseen.
    first, second, third = (b.filter(F.col("position") % 3 == i) for i in range(3))
    parts = [
        dims.zones(lv, b).select(F.lit("zone").alias("kind"), F.col("zone_code").alias("code"), none.alias("name")),
        dims.primary_purposes(b).select(F.lit("purpose"), "primary_purpose", none),
        dims.valuation_districts(lv, first, second, third).select(
            F.lit("district"), F.col("valuation_district_code").cast("string"), "valuation_district_name"
        ),
        dims.properties(lv, first.unionByName(second), third).select(F.lit("property"), F.col("property_id").cast("string"), none),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@query(
    "derive_provenance",
    f"""
    WITH {RAW}
    SELECT 'line' AS kind, source_id, sha256(source_file_name) AS file_source_id, source_file_name AS file_path,
      CAST(source_line_number AS BIGINT) AS place, CAST(p AS VARCHAR) AS date_published
    FROM lv JOIN (SELECT source_file_name, min(source_date) AS p FROM lv GROUP BY 1) USING (source_file_name)
    UNION ALL
    SELECT 'byte', source_id, sha256(file_path), file_path, position, CAST(p AS VARCHAR)
    FROM sale JOIN (SELECT file_path, CAST(min(date_provided) AS DATE) AS p FROM sale WHERE position % 6 < 2 GROUP BY 1) USING (file_path)
    """,
)
def derive_provenance(t: Tables):
    """Sales dealt over the six kinds of records; the two kinds of headers date their file."""
    by_line = provenance.land_value_provenance(land_value_row(t))
    names = ["ps_row_a", "ps_row_a_legacy", "ps_row_b", "ps_row_b_legacy", "ps_row_c", "ps_row_d"]
    sales = ps_row_b(t)
    by_byte = provenance.sale_provenance({name: sales.filter(F.col("position") % 6 == i) for i, name in enumerate(names)})
    lines = by_line["source_file_line"].select(
        F.lit("line").alias("kind"), "source_id", "file_source_id", F.col("source_file_line").cast("bigint").alias("place")
    ).join(by_line["file_source"], "file_source_id")
    places = by_byte["source_byte_position"].select(
        F.lit("byte").alias("kind"), "source_id", "file_source_id", F.col("source_byte_position").alias("place")
    ).join(by_byte["file_source"], "file_source_id")
    return _dated(
        lines.unionByName(places), "kind", "source_id", "file_source_id", "file_path", "place", "date_published"
    )


@query(
    "derive_addresses",
    f"""
    WITH {RAW}, a AS (
      SELECT source_id, source_date AS effective_date, property_id, NULL::INT AS strata_lot_number, NULL::VARCHAR AS unit_number,
        house_number AS street_number, upper(street_name) AS street_name, upper(suburb_name) AS locality_name, postcode FROM lv
      UNION ALL
      SELECT source_id, effective_date, property_id, strata_lot_number, unit_number, house_number, upper(street_name), upper(locality_name), postcode
      FROM (SELECT *, coalesce(contract_date, settlement_date) AS effective_date FROM sale WHERE property_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY property_id, strata_lot_number, effective_date ORDER BY date_provided DESC, source_id) = 1))
    SELECT source_id, {_iso('effective_date')}, property_id, strata_lot_number, unit_number, street_number,
      CASE WHEN locality_name IS NOT NULL THEN street_name END AS street_name, locality_name, postcode FROM a
    """,
)
def derive_addresses(t: Tables):
    lv, b = land_value_row(t), ps_row_b(t)
    rows = addresses.addresses(lv, b)
    on_street = with_dimension(rows, addresses.streets(lv, b), ["street_id", "locality_id"], "source_id")
    named = with_dimension(on_street, addresses.localities(lv, b), ["locality_id"], "source_id")
    return _dated(
        named, "source_id", "effective_date", "property_id", "strata_lot_number", "unit_number", "street_number",
        "street_name", "locality_name", "postcode",
    )


@query(
    "full_address",
    f"""
    WITH {RAW}, a AS (
      SELECT source_id, source_date AS effective_date, property_id, NULL::INT AS strata_lot_number,
        house_number AS street_number, upper(street_name) AS street_name, upper(suburb_name) AS locality_name, postcode FROM lv
      UNION ALL
      SELECT source_id, effective_date, property_id, strata_lot_number, house_number, upper(street_name), upper(locality_name), postcode
      FROM (SELECT *, coalesce(contract_date, settlement_date) AS effective_date FROM sale WHERE property_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY property_id, strata_lot_number, effective_date ORDER BY date_provided DESC, source_id) = 1)),
    f AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY property_id, coalesce(strata_lot_number, -1)
      ORDER BY effective_date DESC NULLS FIRST, source_id DESC) = 1),
    n AS (SELECT *, CASE WHEN locality_name IS NOT NULL THEN street_name END AS st FROM f)
    SELECT property_id, strata_lot_number, street_number, st AS street_name, locality_name, postcode,
      street_number || ' ' || st || ' ' || locality_name || ' ' || postcode AS address
    FROM n
    """,
)
def full_address(t: Tables):
    lv, b = land_value_row(t), ps_row_b(t)
    out = addresses.full_addresses(
        addresses.addresses(lv, b), addresses.streets(lv, b), addresses.localities(lv, b)
    )
    return out.select(
        "property_id", "strata_lot_number", "street_number", "street_name", "locality_name", "postcode", "address"
    )


@query(
    "ranked_sales",
    f"""
    WITH {RAW}
    SELECT source_id, dealing_number, property_id, strata_lot_number, {_iso('effective_date')}, purchase_price, seen AS seen_in_land_values
    FROM ranked
    """,
)
def ranked_sales(t: Tables):
    return _dated(
        _ranked(t), "source_id", "dealing_number", "property_id", "strata_lot_number", "effective_date",
        "purchase_price", "seen_in_land_values",
    )


@query(
    "sale_descriptions",
    f"""
    WITH {RAW}
    SELECT text_source AS source_id, property_id, strata_lot_number, dealing_number, full_text AS full_property_description,
      {_iso('effective_date')} FROM described
    """,
)
def sale_descriptions(t: Tables):
    return _dated(
        sales.sale_descriptions(ps_row_c(t), _ranked(t)), "source_id", "property_id", "strata_lot_number",
        "dealing_number", "full_property_description", "effective_date",
    )


@query(
    "notices_of_sale",
    f"""
    WITH {RAW}, d AS (
      SELECT 'file-' || (l_orderkey % 8) AS file_path, CAST(l_orderkey AS INTEGER) AS sale_counter,
        string_agg(CASE WHEN l_returnflag = 'R' THEN 'P' ELSE 'V' END, '' ORDER BY CASE WHEN l_returnflag = 'R' THEN 'P' ELSE 'V' END) AS people
      FROM lineitem WHERE l_partkey % 31 <> 0 GROUP BY 1, 2)
    SELECT source_id, {_iso('effective_date')}, property_id, strata_lot_number, dealing_number, purchase_price,
      {_iso('contract_date')}, {_iso('settlement_date')}, interest_of_sale, coalesce(people, '') AS sale_participants, comp_code, sale_code
    FROM ranked LEFT JOIN d USING (file_path, sale_counter)
    """,
)
def notices_of_sale(t: Tables):
    out = sales.notices_of_sale(_ranked(t), ps_row_d(t)).withColumn(
        "sale_participants", F.array_join("sale_participants", "")
    )
    return _dated(
        out, "source_id", "effective_date", "property_id", "strata_lot_number", "dealing_number", "purchase_price",
        "contract_date", "settlement_date", "interest_of_sale", "sale_participants", "comp_code", "sale_code",
    )


_KEPT = """QUALIFY row_number() OVER (PARTITION BY effective_date, property_id, strata_lot_number
      ORDER BY date_provided DESC, source_id) = 1"""


@query(
    "derive_sales",
    f"""
    WITH {RAW}, o AS (
      SELECT 'legal_description' AS job, source_id, effective_date, property_id, strata_lot_number, full_text || '|' ||
        CASE WHEN CAST(date_provided AS DATE) > DATE '2004-08-17' THEN '> 2004-08-17' ELSE 'initial' END AS detail
      FROM (SELECT *, text_source AS source_id FROM described WHERE NOT seen) QUALIFY row_number() OVER (
        PARTITION BY effective_date, property_id, strata_lot_number ORDER BY date_provided DESC, source_id, dealing_number) = 1
      UNION ALL SELECT * FROM (SELECT 'property_area', source_id, effective_date, property_id, strata_lot_number,
        CAST(CAST(round(CASE area_type WHEN 'H' THEN area * 10000 ELSE area END * 10) AS BIGINT) AS VARCHAR) FROM ranked
        WHERE area IS NOT NULL AND area_type IN ('H', 'M') AND NOT seen {_KEPT})
      UNION ALL SELECT * FROM (SELECT 'primary_purpose', source_id, effective_date, property_id, strata_lot_number, primary_purpose FROM ranked
        WHERE primary_purpose IS NOT NULL {_KEPT})
      UNION ALL SELECT * FROM (SELECT 'nature', source_id, effective_date, property_id, strata_lot_number,
        CASE nature_of_property WHEN 'V' THEN 'Vaccant' WHEN 'R' THEN 'Residence' ELSE 'Other' END FROM ranked {_KEPT})
      UNION ALL SELECT * FROM (SELECT 'zone', source_id, effective_date, property_id, NULL::INT, zone_code FROM ranked
        WHERE zone_standard = 'ep&a_2006' AND NOT seen AND strata_lot_number IS NULL
        QUALIFY row_number() OVER (PARTITION BY effective_date, property_id ORDER BY date_provided DESC, source_id) = 1))
    SELECT job, source_id, {_iso('effective_date')}, property_id, strata_lot_number, detail FROM o
    """,
)
def derive_sales(t: Tables):
    """Every observation drawn from the ranked sales, tagged by job."""
    ranked = _shared_ranked(t)
    purposes = dims.primary_purposes(ps_row_b(t))
    described = sales.legal_descriptions(sales.sale_descriptions(ps_row_c(t), ranked))
    purpose_rows = sales.primary_purposes(ranked, purposes).join(purposes, "primary_purpose_id")
    parts = {
        "legal_description": (described, F.concat_ws("|", "legal_description", "legal_description_kind")),
        "property_area": (sales.property_areas(ranked), F.round(F.col("sqm_area") * 10).cast("bigint").cast("string")),
        "primary_purpose": (purpose_rows, F.col("primary_purpose")),
        "nature": (sales.natures_of_property(ranked), F.col("nature_of_property")),
        "zone": (
            sales.zone_observations(ranked).withColumn("strata_lot_number", F.lit(None).cast("int")),
            F.col("zone_code"),
        ),
    }
    out = None
    for job, (df, detail) in parts.items():
        part = df.select(
            F.lit(job).alias("job"), "source_id", day("effective_date").alias("effective_date"), "property_id",
            "strata_lot_number", detail.alias("detail"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "derive_land_values",
    f"""
    WITH {RAW}, o AS (
      SELECT 'legal_description' AS job, source_id, effective_date, property_id, property_description || '|> 2004-08-17' AS detail FROM lv
      WHERE property_description IS NOT NULL
      UNION ALL SELECT 'property_area', source_id, effective_date, property_id,
        CAST(CAST(round(CASE area_type WHEN 'H' THEN area * 10000 ELSE area END * 100) AS BIGINT) AS VARCHAR) FROM lv WHERE area_type IN ('H', 'M')
      UNION ALL SELECT 'zone', source_id, effective_date, property_id, zone_code FROM lv
      UNION ALL SELECT * FROM (SELECT 'strata', source_id, effective_date, property_id, CAST(property_type = 'UNDERSP' AS VARCHAR) FROM lv
        WHERE property_type IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY effective_date, property_id ORDER BY source_date DESC, source_id) = 1))
    SELECT job, source_id, {_iso('effective_date')}, property_id, detail FROM o
    """,
)
def derive_land_values(t: Tables):
    lv = land_value_row(t)
    parts = {
        "legal_description": (
            land_values.legal_descriptions(lv), F.concat_ws("|", "legal_description", "legal_description_kind")
        ),
        "property_area": (land_values.property_areas(lv), F.round(F.col("sqm_area") * 100).cast("bigint").cast("string")),
        "zone": (land_values.zone_observations(lv), F.col("zone_code")),
        "strata": (land_values.under_strata_plan(lv), F.col("under_strata_plan").cast("string")),
    }
    out = None
    for job, (df, detail) in parts.items():
        part = df.select(
            F.lit(job).alias("job"), "source_id", day("effective_date").alias("effective_date"), "property_id",
            detail.alias("detail"),
        )
        out = part if out is None else out.unionByName(part)
    return out


_VALUATIONS = f"""
    WITH {RAW}, l AS (
      SELECT source_id, district_code, property_id, source_date, base_date_1 AS b, land_value_1 AS v, basis_1 AS basis FROM lv
      UNION ALL SELECT source_id, district_code, property_id, source_date, base_date_2, land_value_2, NULL FROM lv
      UNION ALL SELECT source_id, district_code, property_id, source_date, base_date_3, land_value_3, NULL FROM lv
      UNION ALL SELECT source_id, district_code, property_id, source_date, base_date_4, land_value_4, NULL FROM lv
      UNION ALL SELECT source_id, district_code, property_id, source_date, base_date_5, land_value_5, NULL FROM lv)
    SELECT source_id, district_code AS valuation_district_code, property_id, CAST(b AS VARCHAR) AS valuation_base_date,
      basis AS valuation_basis, CAST(v AS DOUBLE) AS land_value
    FROM l WHERE v IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY property_id, b ORDER BY source_date DESC, source_id, v DESC, basis NULLS LAST) = 1
    """


@query("land_valuation_history", _VALUATIONS)
def land_valuation_history(t: Tables):
    return _dated(
        land_values.land_valuations(land_value_row(t)), "source_id", "valuation_district_code", "property_id",
        "valuation_base_date", "valuation_basis", "land_value",
    )


@query("rebuilt_land_valuation", _VALUATIONS)
def rebuilt_land_valuation(t: Tables):
    """One table by the graph of steps, beside another one that is done already; a second run reads it back."""
    raw, folder = {"land_value_row": land_value_row(t), "ps_row_b": ps_row_b(t)}, scratch_path(t.spark, "steps")
    # The zones are done, the valuations are not.
    rebuild_tables(raw, folder, ["epa_2006_zone"], {"land_value_row": "1", "ps_row_b": "1"})
    versions = {"land_value_row": "1", "ps_row_b": "2"}
    for _ in range(2):
        made = rebuild_tables(raw, folder, ["land_valuation"], versions)
    steps = [r.step for r in read_manifest(t.spark, folder).orderBy("written").collect()]
    if steps != ["epa_2006_zone", "land_valuation"]:
        raise AssertionError(steps)
    return _dated(
        made["land_valuation"], "source_id", "valuation_district_code", "property_id", "valuation_base_date",
        "valuation_basis", "land_value",
    )


# All orders play the archive once more; a file is published on its first day.
def _archive(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.orders.select(
        F.col("o_orderkey").alias("position"),
        F.concat(F.lit("old-"), (F.col("o_orderkey") % 16).cast("string")).alias("file_path"),
        F.when(F.col("o_orderkey") % 20 != 0, F.expr("CAST(o_custkey div 2 AS INT)")).alias("property_id"),
        F.col("o_orderdate").cast("date").alias("contract_date"),
        F.col("o_totalprice").alias("purchase_price"),
        F.concat(F.lit("V"), F.col("o_custkey").cast("string")).alias("valuation_number"),
        F.when(F.col("o_orderkey") % 10 == 0, "PC").alias("comp_code"),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("LOT "), F.col("o_orderkey").cast("string"))).alias("land_description"),
        F.round("o_totalprice").alias("area"),
        F.when(F.col("o_orderkey") % 3 == 0, "H").when(F.col("o_orderkey") % 3 == 1, "M").alias("area_type"),
        F.when(F.col("o_orderkey") % 6 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit("X10"))).alias("dimensions"),
    )
    heads = rows.select("file_path").distinct().withColumn(
        "date_provided", F.expr("date_add(DATE '2000-01-01', CAST(substring(file_path, 5) AS INT) % 5)").cast("timestamp")
    )
    return rows, heads


@query(
    "derive_legacy",
    f"""
    WITH {RAW}, old AS (
      SELECT sha256('old-' || (o_orderkey % 16) || '|' || o_orderkey) AS source_id, DATE '2000-01-01' + CAST((o_orderkey % 16) % 5 AS INTEGER) AS published,
        CAST(o_custkey // 2 AS INTEGER) AS property_id, CAST(o_orderdate AS DATE) AS effective_date, o_totalprice, o_custkey, o_orderkey
      FROM orders WHERE o_orderkey % 20 <> 0),
    kept AS (SELECT *, EXISTS (SELECT 1 FROM ranked r WHERE r.strata_lot_number IS NULL AND r.property_id = old.property_id
          AND r.effective_date = old.effective_date) AS seen FROM old
      QUALIFY row_number() OVER (PARTITION BY property_id, effective_date ORDER BY published DESC, source_id) = 1),
    o AS (
      SELECT 'sale' AS job, source_id, effective_date, property_id, 'V' || o_custkey || '|' || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS detail FROM kept
      UNION ALL SELECT 'description', source_id, effective_date, property_id, 'LOT ' || o_orderkey FROM kept WHERE o_orderkey % 4 <> 0
      UNION ALL SELECT 'area', source_id, effective_date, property_id,
        CAST(CAST(CASE WHEN o_orderkey % 3 = 0 THEN round(o_totalprice) * 10000 ELSE round(o_totalprice) END AS BIGINT) AS VARCHAR)
        FROM kept WHERE o_orderkey % 3 < 2 AND NOT seen
      UNION ALL SELECT 'dimensions', source_id, effective_date, property_id, o_custkey || 'X10' FROM kept WHERE o_orderkey % 6 = 0)
    SELECT job, source_id, {_iso('effective_date')}, property_id, detail FROM o
    """,
)
def derive_legacy(t: Tables):
    rows, heads = _archive(t)
    old = cut_lineage(legacy.legacy_sales(rows, heads, _ranked(t)), "legacy-sales")
    cents = F.round(F.col("purchase_price") * 100).cast("bigint").cast("string")
    parts = {
        "sale": (legacy.archived_sales(old), F.concat_ws("|", F.col("valuation_number"), cents)),
        "description": (legacy.archived_descriptions(old), F.col("legal_description")),
        "area": (legacy.property_areas(old), F.col("sqm_area").cast("bigint").cast("string")),
        "dimensions": (legacy.described_dimensions(old), F.col("dimension_description")),
    }
    out = None
    for job, (df, detail) in parts.items():
        part = df.select(
            F.lit(job).alias("job"), "source_id", day("effective_date").alias("effective_date"), "property_id",
            detail.alias("detail"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "derive_parcels_layers",
    """
    WITH l AS (
      SELECT l_orderkey AS object_id, l_shipdate AS last_update, l_quantity AS q,
        CASE l_partkey % 3 WHEN 0 THEN l_linenumber || '//SP' || l_partkey WHEN 1 THEN l_linenumber || '//DP' || l_partkey
          ELSE l_linenumber || '/' || l_suppkey || '/' || l_partkey END AS base,
        l_partkey % 3 AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem),
    b AS (SELECT *, CASE k WHEN 0 THEN 'SP' || p WHEN 1 THEN n || '/' || p ELSE n || '/' || s || '/' || p END AS base_parcel_id FROM l),
    o AS (
      SELECT 'parcel' AS kind, base_parcel_id AS id, CASE k WHEN 0 THEN 'strata_plan' ELSE 'deposit_lot' END AS detail FROM b
        WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size >= 40 AND 'SP' || p_partkey = base_parcel_id) GROUP BY 2, 3
      UNION ALL SELECT * FROM (SELECT 'geometry', base_parcel_id, CAST(CAST(q AS BIGINT) AS VARCHAR) FROM b
        QUALIFY row_number() OVER (PARTITION BY base_parcel_id ORDER BY last_update DESC, object_id DESC, q DESC) = 1)
      UNION ALL SELECT * FROM (SELECT 'property', CAST(o_custkey AS VARCHAR), CAST(CAST(o_totalprice * 100 AS BIGINT) AS VARCHAR) FROM orders
        WHERE o_orderstatus = 'O' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
      UNION ALL SELECT DISTINCT 'new property', CAST(o_custkey AS VARCHAR), NULL FROM orders
        WHERE o_orderstatus = 'O' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 8))
    SELECT * FROM o
    """,
)
def derive_parcels_layers(t: Tables):
    text = lambda c: F.col(c).cast("string")
    lot_id = (
        F.when(F.col("l_partkey") % 3 == 0, F.concat(text("l_linenumber"), F.lit("//SP"), text("l_partkey")))
        .when(F.col("l_partkey") % 3 == 1, F.concat(text("l_linenumber"), F.lit("//DP"), text("l_partkey")))
        .otherwise(F.concat_ws("/", text("l_linenumber"), text("l_suppkey"), text("l_partkey")))
    )
    # The quantity stands for the geometry and settles equal updates of one object.
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("object_id"), lot_id.alias("lot_id_string"), F.col("l_shipdate").alias("last_update"),
        F.col("l_quantity").alias("geometry"),
    )
    known = t.part.filter("p_size >= 40").select(F.concat(F.lit("SP"), text("p_partkey")).alias("base_parcel_id"))
    single = rows.groupBy("lot_id_string", "last_update", "object_id").agg(F.max("geometry").alias("geometry"))
    # Several lots of one strata plan may share update and object: the widest stands for them.
    plan = layers.base_parcel_id("lot_id_string")
    single = single.withColumn("_plan", plan).groupBy("_plan", "last_update", "object_id").agg(
        F.max_by("lot_id_string", F.struct("geometry", "lot_id_string")).alias("lot_id_string"),
        F.max("geometry").alias("geometry"),
    ).drop("_plan")
    lots = layers.base_parcels(single, known)
    lands = t.orders.select(
        F.col("o_custkey").alias("property_id"), F.col("o_orderkey").alias("rid"),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("principal_address_type"),
        F.col("o_orderkey").alias("address_string_oid"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("geometry"),
    )
    listed = t.customer.filter("c_nationkey < 8").select(F.col("c_custkey").alias("property_id"))
    principal = layers.principal_properties(lands, listed)
    return (
        lots["base_parcel"].select(F.lit("parcel").alias("kind"), F.col("base_parcel_id").alias("id"), F.col("base_parcel_kind").alias("detail"))
        .union(lots["base_parcel_geometry"].select(F.lit("geometry"), "base_parcel_id", F.col("geometry").cast("bigint").cast("string")))
        .union(principal["property_geometry"].select(F.lit("property"), F.col("property_id").cast("string"), F.col("geometry").cast("string")))
        .union(principal["property"].select(F.lit("new property"), F.col("property_id").cast("string"), F.lit(None).cast("string")))
    )


# Descriptions composed from part keys, so that every expected row is known.
_HEAD_SQL = """CASE p_partkey % 5 WHEN 0 THEN p_size || '/' || (700000 + p_partkey)
    WHEN 1 THEN 'PT ' || p_size || '/A/' || (700000 + p_partkey)
    WHEN 2 THEN '1, PT ' || (p_size + 1) || ', 3/' || (700000 + p_partkey)
    WHEN 3 THEN '1, 2, CP/SP ' || (20000 + p_partkey)
    ELSE p_size || '/' || (700000 + p_partkey) || ' 7//' || (800000 + p_partkey) END"""
_TAIL_SQL = """CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN ' Enclosure Permit ' || p_partkey
    WHEN 2 THEN ' and crown roads Licence ' || p_partkey || ' Licence ' || (p_partkey + 1)
    WHEN 3 THEN ' (near the creek)' WHEN 4 THEN ' Mining Lease ' || p_partkey || ' (Part)'
    WHEN 5 THEN ' Lease Number ' || p_partkey || ' TO ' || (p_partkey + 5) || ' SUBSURFACE ONLY'
    ELSE ' Western Land Lease ' || p_partkey || ' Western Land Lease ' || (p_partkey + 2) || ' DRAINAGE RESERVE' END"""
_LEGAL = f"d AS (SELECT p_partkey, p_size, {_HEAD_SQL} || {_TAIL_SQL} AS legal_description FROM part)"


def _descriptions(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("source_id"),
        F.lit("2010-01-01").cast("date").alias("effective_date"),
        F.col("p_partkey").cast("string").alias("legal_description_id"),
        F.col("p_partkey").cast("int").alias("property_id"),
        F.lit(None).cast("int").alias("strata_lot_number"),
        F.expr(f"{_HEAD_SQL} || {_TAIL_SQL}").alias("legal_description"),
        F.lit("> 2004-08-17").alias("legal_description_kind"),
    )


_FOLIOS = """
    f AS (
      SELECT p_partkey, unnest(CASE p_partkey % 5
        WHEN 0 THEN [p_size || '/' || (700000 + p_partkey)]
        WHEN 1 THEN ['P' || p_size || '/A/' || (700000 + p_partkey)]
        WHEN 2 THEN ['1/' || (700000 + p_partkey), 'P' || (p_size + 1) || '/' || (700000 + p_partkey), '3/' || (700000 + p_partkey)]
        WHEN 3 THEN ['1/SP' || (20000 + p_partkey), '2/SP' || (20000 + p_partkey), 'CP/SP' || (20000 + p_partkey)]
        ELSE [p_size || '/' || (700000 + p_partkey), '7/' || (800000 + p_partkey)] END) AS x FROM part),
    g AS (SELECT p_partkey, x LIKE 'P%' AS partial, regexp_replace(x, '^P', '') AS folio_id FROM f WHERE x NOT LIKE 'CP%'
      UNION ALL SELECT p_partkey, FALSE, x FROM f WHERE x LIKE 'CP%')
"""


@query(
    "legal_job_parcels",
    f"""
    WITH {_FOLIOS}
    SELECT p_partkey AS property_id, folio_id, partial,
      CASE WHEN folio_id LIKE '%/SP%' THEN regexp_replace(folio_id, '^.*/', '') ELSE folio_id END AS base_parcel_id FROM g
    """,
)
def legal_job_parcels(t: Tables):
    out = derive_parcels(_descriptions(t))["property_folio"]
    return out.select(F.col("property_id").cast("bigint").alias("property_id"), "folio_id", "partial", "base_parcel_id")


@query(
    "legal_job_folios",
    f"""
    WITH {_FOLIOS}
    SELECT DISTINCT folio_id, split_part(folio_id, '/', 1) AS folio_lot,
      CASE WHEN length(folio_id) - length(replace(folio_id, '/', '')) = 2 THEN split_part(folio_id, '/', 2) END AS folio_section,
      regexp_replace(folio_id, '^.*/', '') AS folio_plan FROM g
    """,
)
def legal_job_folios(t: Tables):
    return derive_parcels(_descriptions(t))["folio"].drop("base_parcel_id")


@query(
    "legal_job_items",
    """
    SELECT p_partkey, unnest(CASE p_partkey % 7
      WHEN 1 THEN ['enclosure_permit ' || p_partkey || '  false']
      WHEN 2 THEN ['crown_roads_licence ' || p_partkey || '  false', 'crown_land_licence ' || (p_partkey + 1) || '  false']
      WHEN 4 THEN ['mining_lease ' || p_partkey || '  true']
      WHEN 5 THEN ['lease_number ' || p_partkey || ' ' || (p_partkey + 5) || ' false']
      WHEN 6 THEN ['western_land_lease ' || p_partkey || '  false', 'western_land_lease ' || (p_partkey + 2) || '  false', 'drainage_reserve   false']
      ELSE []::VARCHAR[] END) AS item FROM part
    """,
)
def legal_job_items(t: Tables):
    parsed = parse_descriptions(_descriptions(t)).select("property_id", F.explode("items").alias("i"))
    others = parsed.filter(F.col("i.kind") != "folio")
    words = [F.col("i.kind"), F.coalesce("i.id", F.lit("")), F.coalesce("i.id_b", F.lit("")), F.col("i.part").cast("string")]
    return others.select(F.col("property_id").cast("bigint").alias("p_partkey"), F.concat_ws(" ", *words).alias("item"))


@query(
    "legal_job_remains",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS legal_description_id,
      CASE p_partkey % 7 WHEN 2 THEN 'and ' ELSE '(near the creek)' END AS legal_description_remains
    FROM part WHERE p_partkey % 7 IN (2, 3)
    """,
)
def legal_job_remains(t: Tables):
    return derive_parcels(_descriptions(t))["legal_description_remains"]


@query(
    "legal_job_permits",
    "SELECT p_partkey AS property_id, CAST(p_partkey AS VARCHAR) AS enclosure_permit FROM part WHERE p_partkey % 7 = 1",
)
def legal_job_permits(t: Tables):
    permits = derive_parcels(_descriptions(t))["enclosure_permit"]
    return permits.select(F.col("property_id").cast("bigint").alias("property_id"), "enclosure_permit")


@query(
    "folio_parts",
    """
    WITH f AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size || '/' || p_partkey WHEN 1 THEN p_size || '//SP' || p_partkey
      WHEN 2 THEN p_size || '/B/' || p_partkey WHEN 3 THEN (100000 + p_size) || '/' || p_partkey ELSE p_size || '/DP' || p_partkey END AS folio FROM part)
    SELECT p_partkey, folio,
      CASE WHEN p_partkey % 5 < 3 THEN regexp_replace(folio, '//', '/') END AS id,
      CASE WHEN p_partkey % 5 < 3 THEN split_part(folio, '/', 1) END AS lot,
      CASE WHEN p_partkey % 5 = 2 THEN 'B' END AS section,
      CASE WHEN p_partkey % 5 < 3 THEN regexp_replace(folio, '^.*/', '') END AS plan FROM f
    """,
)
def folio_parts(t: Tables):
    folio = F.expr(
        """CASE p_partkey % 5 WHEN 0 THEN p_size || '/' || p_partkey WHEN 1 THEN p_size || '//SP' || p_partkey
           WHEN 2 THEN p_size || '/B/' || p_partkey WHEN 3 THEN (100000 + p_size) || '/' || p_partkey
           ELSE p_size || '/DP' || p_partkey END"""
    )
    rows = t.part.select("p_partkey", folio.alias("folio")).withColumn("f", split_folio("folio"))
    return rows.select("p_partkey", "folio", "f.id", "f.lot", "f.section", "f.plan")


@query(
    "destination_zones",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN s_suppkey IS NOT NULL THEN l_suppkey END AS sa2_code,
      CASE WHEN s_suppkey IS NOT NULL THEN l_returnflag END AS state_code
    FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 15) ON s_suppkey = l_suppkey
    """,
)
def destination_zones(t: Tables):
    """Line items as destination zones; suppliers of some nations are no known parents."""
    zones = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("sa2_code"), F.col("l_returnflag").alias("state_code")
    )
    parents = t.supplier.filter("s_nationkey < 15").select(F.col("s_suppkey").alias("sa2_code"))
    return layers.clean_destination_zones(zones, parents)
