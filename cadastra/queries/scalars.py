"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes, readers, text, values
from ..operators import quality
from ..sources.lines import number_lines
from .base import Tables, query


@query(
    "scalar_labels",
    """
    SELECT o_orderkey,
      CASE o_orderstatus WHEN 'F' THEN 'Vaccant' WHEN 'O' THEN 'Residence' WHEN 'P' THEN 'Other' END AS nature,
      CASE WHEN CAST(o_orderdate AS DATE) > DATE '2000-08-17' THEN 'after' ELSE 'before' END AS half,
      CASE WHEN CAST(o_orderdate AS DATE) + 2000 > DATE '2004-08-17' THEN '> 2004-08-17' ELSE 'initial' END AS kind,
      o_orderpriority = '1-URGENT' AS urgent,
      upper('st ' || o_orderpriority) AS upper_name,
      round(o_totalprice, 0) AS rounded,
      CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
      coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'Level ' END, '')
        || coalesce((CASE WHEN o_orderkey % 5 = 0 THEN 'G' END) || '-', '')
        || o_orderkey || coalesce('-' || CASE WHEN o_orderkey % 7 = 0 THEN 'A' END, '') AS level_text,
      o_orderkey || coalesce('-' || (CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END)
        || (CASE WHEN o_orderkey % 4 = 0 THEN 'B' END), '') AS house_text,
      o_orderpriority || coalesce(' ' || CASE WHEN o_orderkey % 3 = 0 THEN 'ROAD' END, '')
        || coalesce(' ' || CASE WHEN o_orderkey % 5 = 0 THEN 'WEST' END, '') AS street_text
    FROM orders
    """,
)
def scalar_labels(t: Tables):
    key = F.col("o_orderkey")

    def some(n: int, c):
        return F.when(key % n == 0, c)

    coded = F.translate("o_orderstatus", "FOP", "VR3")
    day = F.col("o_orderdate").cast("date")
    none = F.lit(None).cast("string")
    return t.orders.select(
        "o_orderkey",
        codes.nature_label(coded).alias("nature"),
        F.when(day > F.lit("2000-08-17").cast("date"), "after").otherwise("before").alias("half"),
        codes.description_kind(F.date_add(day, 2000)).alias("kind"),
        codes.equals_flag("o_orderpriority", "1-URGENT").alias("urgent"),
        text.upper_name(F.concat(F.lit("st "), F.col("o_orderpriority"))).alias("upper_name"),
        F.round("o_totalprice", 0).alias("rounded"),
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        text.level_label(some(3, F.lit("Level")), some(5, F.lit("G")), key, some(7, F.lit("A"))).alias("level_text"),
        text.house_label(none, key, none, F.lit(""), some(2, F.col("o_custkey")), some(4, F.lit("B"))).alias("house_text"),
        text.street_label("o_orderpriority", some(3, F.lit("ROAD")), some(5, F.lit("WEST"))).alias("street_text"),
    )


@query(
    "zone_classify",
    """
    WITH z AS (
      SELECT p_partkey, CASE p_partkey % 6
        WHEN 0 THEN substr(p_type, 1, 1) WHEN 1 THEN substr(p_type, 1, 1) || (p_size % 10)
        WHEN 2 THEN 'RU' || (p_size % 10) WHEN 3 THEN substr(p_type, 1, 2)
        WHEN 4 THEN '' ELSE 'SP' || p_size END AS zone_code
      FROM part)
    SELECT p_partkey, zone_code, CASE
      WHEN zone_code = '' THEN NULL
      WHEN regexp_full_match(zone_code, '[ABCDEIMNOPRSTUVWXYZ]') THEN 'legacy_vg_2011'
      WHEN regexp_full_match(zone_code, '(IN|MU|RE|RU|SP|B|C|E|R|W)[0-9]') THEN 'ep&a_2006'
      ELSE 'unknown' END AS zone_standard
    FROM z
    """,
)
def zone_classify(t: Tables):
    code = F.expr(
        """CASE p_partkey % 6 WHEN 0 THEN substr(p_type, 1, 1) WHEN 1 THEN substr(p_type, 1, 1) || (p_size % 10)
           WHEN 2 THEN 'RU' || (p_size % 10) WHEN 3 THEN substr(p_type, 1, 2)
           WHEN 4 THEN '' ELSE 'SP' || p_size END"""
    )
    zoned = t.part.select("p_partkey", code.alias("zone_code"))
    return zoned.withColumn("zone_standard", codes.zone_standard("zone_code"))


@query(
    "area_units",
    """
    WITH a AS (
      SELECT p_partkey, p_retailprice * 100 AS v,
             CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size AS DOUBLE) END AS area,
             CASE p_partkey % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'M' WHEN 2 THEN 'U' END AS unit
      FROM part)
    SELECT p_partkey, CASE unit WHEN 'H' THEN area * 10000 WHEN 'M' THEN area END AS sqm,
      round((CASE WHEN area IS NULL THEN 1 ELSE v END) / (CASE WHEN p_partkey IN (5, 11, 500) THEN area * 10000
        WHEN area IS NULL THEN 1 WHEN area < 10 THEN 10 ELSE area END), 9) AS per_m2,
      round((CASE WHEN area IS NULL THEN 1 ELSE v END) / (CASE WHEN p_partkey IN (5, 11, 500) THEN area * 10000
        WHEN area IS NULL THEN 1 WHEN area < 10 THEN 10 WHEN area < 50 THEN 50 WHEN area < 100 THEN 100 ELSE area END), 9) AS per_m2_stepped,
      round(log10(v) * (1 - 0.25) + v * 0.25, 6) AS score
    FROM a
    """,
)
def area_units(t: Tables):
    rows = t.part.select(
        "p_partkey",
        (F.col("p_retailprice") * 100).alias("v"),
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_size").cast("double")).alias("area"),
        F.expr("CASE p_partkey % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'M' WHEN 2 THEN 'U' END").alias("unit"),
    )
    hectares = [5, 11, 500]
    return rows.select(
        "p_partkey",
        codes.area_sqm("area", "unit").alias("sqm"),
        F.round(values.value_per_sqm("v", "area", "p_partkey", hectares), 9).alias("per_m2"),
        F.round(values.value_per_sqm("v", "area", "p_partkey", hectares, (10, 50, 100)), 9).alias("per_m2_stepped"),
        F.round(values.blended_score("v", 0.25), 6).alias("score"),
    )


_FOLIO_SQL = """CASE p_partkey % 5 WHEN 0 THEN p_size || '//DP' || p_partkey WHEN 1 THEN p_size || '/SP' || p_partkey
   WHEN 2 THEN p_size || '/' || (p_partkey % 9) || '/' || p_partkey WHEN 3 THEN 'CP//SP' || p_partkey
   ELSE p_size || '///DP' || p_partkey || '//' || p_size END"""


@query(
    "parcel_base",
    f"""
    WITH f AS (SELECT p_partkey, {_FOLIO_SQL} AS folio FROM part),
    g AS (SELECT *, regexp_replace(folio, '/+', '/') AS one, regexp_extract(folio, '([^/]+)$', 1) AS plan FROM f)
    SELECT p_partkey, folio,
      CASE WHEN regexp_full_match(plan, 'SP[0-9]+') THEN plan
           ELSE regexp_replace(one, '[^/]+$', '') || regexp_replace(plan, '^DP', '') END AS base_parcel_id,
      CASE WHEN regexp_full_match(plan, 'SP[0-9]+') THEN 'strata_plan' ELSE 'deposit_lot' END AS kind,
      regexp_replace(regexp_replace(folio, '/{{2,}}', '/', 'g'), '/DP([0-9]+)', '/\\1', 'g') AS cleaned
    FROM g
    """,
)
def parcel_base(t: Tables):
    rows = t.part.select("p_partkey", F.expr(_FOLIO_SQL).alias("folio"))
    return rows.select(
        "p_partkey", "folio", codes.base_parcel_id("folio").alias("base_parcel_id"),
        codes.base_parcel_kind("folio").alias("kind"), codes.clean_parcel_id("folio").alias("cleaned"),
    )


# Orders as text records, every 17th with a bad number and every 19th with a bad date.
_TEXT_SQL = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 17 = 0 THEN 'x' || o_custkey WHEN o_orderkey % 29 = 0 THEN '' ELSE CAST(o_custkey AS {text}) END AS key_text,
  CASE WHEN o_orderkey % 19 = 0 THEN '19991399' WHEN o_orderkey % 31 = 0 THEN '' ELSE {compact} END AS day_text,
  {slashed} AS slashed_text,
  CASE WHEN o_orderkey % 37 = 0 THEN 'n/a' ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS {text}) END AS price_text,
  substr(CAST(o_custkey + 98 AS {text}), 1, 5) AS post_text,
  CASE o_orderkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'H' WHEN 2 THEN 'U' WHEN 3 THEN '' ELSE 'Q' END AS unit_text
FROM {table}"""
_TEXT_DUCK = _TEXT_SQL.format(
    text="VARCHAR", compact="strftime(o_orderdate, '%Y%m%d')", slashed="strftime(o_orderdate, '%-d/%-m/%Y')", table="orders"
)
_TEXT_SPARK = _TEXT_SQL.format(
    text="STRING", compact="date_format(o_orderdate, 'yyyyMMdd')", slashed="date_format(o_orderdate, 'd/M/yyyy')", table="{orders}"
)


def _text_orders(t: Tables):
    return t.spark.sql(_TEXT_SPARK, orders=t.orders)


_READINGS = {
    "custkey": ("key_text", readers.read_int),
    "order_day": ("day_text", readers.read_date),
    "price": ("price_text", readers.read_double),
    "unit": ("unit_text", readers.read_area_unit),
}


@query(
    "typed_readers",
    f"""
    WITH r AS ({_TEXT_DUCK})
    SELECT o_orderkey,
      CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 29 <> 0 THEN CAST(o_custkey AS INTEGER) END AS custkey,
      CASE WHEN o_orderkey % 19 <> 0 AND o_orderkey % 31 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_day,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS slashed_day,
      CASE WHEN o_orderkey % 37 <> 0 THEN CAST(price_text AS DOUBLE) END AS price,
      CASE WHEN length(post_text) = 4 THEN post_text END AS postcode,
      CASE WHEN unit_text IN ('M', 'H', 'U') THEN unit_text END AS unit
    FROM r JOIN orders USING (o_orderkey)
    """,
)
def typed_readers(t: Tables):
    return _text_orders(t).select(
        "o_orderkey",
        readers.read_int("key_text").alias("custkey"),
        readers.read_date("day_text").cast("string").alias("order_day"),
        readers.read_date("slashed_text", readers.DATE_SLASHED).cast("string").alias("slashed_day"),
        readers.read_double("price_text").alias("price"),
        readers.read_postcode("post_text").alias("postcode"),
        readers.read_area_unit("unit_text").alias("unit"),
    )


@query(
    "reject_rows",
    f"""
    WITH r AS ({_TEXT_DUCK}),
    b AS (
      SELECT 'custkey' AS field FROM r WHERE key_text = '' OR o_orderkey % 17 = 0
      UNION ALL SELECT 'order_day' FROM r WHERE o_orderkey % 19 = 0
      UNION ALL SELECT 'price' FROM r WHERE price_text = 'n/a'
      UNION ALL SELECT 'unit' FROM r WHERE unit_text = 'Q')
    SELECT field, count(*) AS n FROM b GROUP BY 1
    UNION ALL SELECT 'accepted', count(*) FROM r
    WHERE NOT (key_text = '' OR o_orderkey % 17 = 0) AND o_orderkey % 19 <> 0 AND price_text <> 'n/a' AND unit_text <> 'Q'
    """,
)
def reject_rows(t: Tables):
    readings = {name: (text_col, reader(text_col)) for name, (text_col, reader) in _READINGS.items()}
    good, rejects = quality.split_rejects(_text_orders(t), readings, ["custkey"])
    accepted = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("accepted").alias("field"), "n")
    return quality.reject_counts(rejects).unionByName(accepted)


@query(
    "csv_bytes_decode",
    r"""
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text
      ELSE regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g') END AS decoded FROM documents
    """,
)
def csv_bytes_decode(t: Tables):
    """Bytes in one of two encodings, told apart by UTF-8 validity."""
    latin = F.encode(F.regexp_replace("text", r"[^\x00-\xFF]", "?"), "ISO-8859-1")
    raw = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(latin)
    # Each document is a file of one line; the reader decides the encoding file by file.
    lines = t.documents.select(
        F.col("doc_id").cast("string").alias("file_path"), F.lit(0).alias("_block"), F.lit(0).alias("_seq"),
        raw.cast("string").alias("value"),
    )
    return number_lines(lines).select(F.col("file_path").cast("bigint").alias("doc_id"), F.col("value").alias("decoded"))
