"""Formats written from the tables and read back; the SQL side is the table itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import stable_id
from ..operators.spatial import planar_area
from ..schemas import LAND_VALUE_COLUMNS
from ..session import Scratch, cut_lineage, free_shuffles, scratch_path
from ..sources import features, land_values, layers, pages, psv, sale_files, sdmx
from ..sources.lines import number_lines, read_lines
from .base import Tables, day, query


@query(
    "provenance_positions",
    """
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_number FROM documents)
    SELECT doc_id, CAST(line_number AS INTEGER) AS line_number, CAST(strlen(line) AS INTEGER) AS line_bytes,
      CAST(coalesce(sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_position,
      sha256(doc_id || '|' || line_number) AS source_id
    FROM l
    """,
)
def provenance_positions(t: Tables):
    """Lines of every text with their byte position and id."""
    lines = t.documents.select(
        F.col("doc_id").cast("string").alias("file_path"), F.lit(0).alias("_block"),
        F.posexplode(F.split("text", "\n")).alias("_seq", "value"),
    )
    numbered = number_lines(lines)
    return numbered.select(
        F.col("file_path").cast("bigint").alias("doc_id"),
        F.col("line_number").cast("int").alias("line_number"),
        F.octet_length("value").alias("line_bytes"),
        "byte_position",
        stable_id("file_path", "line_number").alias("source_id"),
    )


def _sale_lines(t: Tables) -> DataFrame:
    """Orders as B records, line items as C records (text with a line break) and D records."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    stamp = F.date_format("o_orderdate", "yyyyMMdd HH:mm")
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    blank = F.lit("")
    b = F.concat_ws(
        ";", F.lit("B"), (F.col("o_custkey") % 900).cast("string"),
        F.when(F.col("o_orderkey") % 10 != 0, text("o_custkey")).otherwise(""), text("o_orderkey"), stamp,
        blank, blank, blank, F.col("o_orderpriority"), F.col("o_orderstatus"), F.lit("2000"),
        F.when(F.col("o_orderkey") % 3 == 0, text("o_totalprice")).otherwise(""), F.lit("M"), compact, compact,
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"), F.lit("R2"), F.lit("R"), blank, blank, blank, blank,
        F.lit("0"), F.concat(F.lit("D"), text("o_orderkey")), F.lit(""),
    )
    sales = t.orders.select("o_orderkey", F.lit(0).alias("n"), F.lit(0).alias("m"), b.alias("value"))
    lines = t.lineitem.join(
        t.orders.select(F.col("o_orderkey"), stamp.alias("stamp")), F.col("l_orderkey") == F.col("o_orderkey")
    )
    head = [(F.col("l_partkey") % 900).cast("string"), text("l_partkey"), text("l_orderkey"), F.col("stamp")]
    c = F.concat_ws(
        ";", F.lit("C"), *head,
        F.concat(text("l_linenumber"), F.lit("/"), text("l_partkey"), F.lit("\nand "), text("l_suppkey")), F.lit(""),
    )
    # Every third participant record lacks the property id.
    d_full = F.concat_ws(";", F.lit("D"), *head, F.col("l_returnflag"), *[blank] * 6)
    d_short = F.concat_ws(";", F.lit("D"), head[0], *head[2:], F.col("l_returnflag"), *[blank] * 6)
    d = F.when(F.col("l_partkey") % 3 == 0, d_short).otherwise(d_full)
    extra = F.xxhash64("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    pieces = lines.select("o_orderkey", "l_linenumber", extra.alias("m"), F.posexplode(F.array(c, d)).alias("k", "value"))
    return sales.unionByName(
        pieces.select("o_orderkey", (F.col("l_linenumber") * 2 + F.col("k")).alias("n"), "m", "value")
    )


@query(
    "record_file_roundtrip",
    """
    SELECT 'B' AS kind, o_orderkey AS sale_counter, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS property_id,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '|' || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) || '|ep&a_2006|D' || o_orderkey AS detail
    FROM orders
    UNION ALL SELECT 'C', l_orderkey, CAST(l_partkey AS VARCHAR), l_linenumber || '/' || l_partkey || chr(10) || 'and ' || l_suppkey FROM lineitem
    UNION ALL SELECT 'D', l_orderkey, CASE WHEN l_partkey % 3 <> 0 THEN CAST(l_partkey AS VARCHAR) END, l_returnflag FROM lineitem
    UNION ALL SELECT 'rejects', 0, NULL, '0'
    """,
)
def record_file_roundtrip(t: Tables):
    """Sale files written from the tables, read back through the record reader."""
    path = scratch_path(t.spark, "sale-files")
    with Scratch(t.spark) as scratch:
        scratch.paths.append(path)
        _sale_lines(t).repartition("o_orderkey").sortWithinPartitions("o_orderkey", "n", "m").select("value").write.text(path)
        free_shuffles(t.spark)
        found = read_lines(t.spark, path)
        manifest = found.select("file_path").distinct().select(
            "file_path", F.lit(2001).alias("published_year"), F.lit("2001-07").alias("layout")
        )
        # Read once for three kinds; the files have served then.
        records = scratch.keep(sale_files.read_records(found, manifest), "records")
    b, rejects_b = sale_files.typed_table(records, "ps_row_b")
    c, rejects_c = sale_files.typed_table(records, "ps_row_c")
    d, rejects_d = sale_files.typed_table(records, "ps_row_d")
    key = [F.col("sale_counter").cast("bigint").alias("sale_counter"), F.col("property_id").cast("string").alias("property_id")]
    sale = F.concat_ws(
        "|", day("contract_date"), F.col("purchase_price").cast("bigint").cast("string"), F.col("zone_standard"),
        F.col("dealing_number"),
    )
    bad = [r.select(F.lit(1).alias("x")) for r in (rejects_b, rejects_c, rejects_d)]
    rejected = bad[0].union(bad[1]).union(bad[2]).agg(F.count(F.lit(1)).cast("string").alias("detail"))
    return (
        b.select(F.lit("B").alias("kind"), *key, sale.alias("detail"))
        .union(c.select(F.lit("C"), *key, F.col("property_description")))
        .union(d.select(F.lit("D"), *key, F.col("participant")))
        .union(rejected.select(F.lit("rejects"), F.lit(0).cast("bigint"), F.lit(None).cast("string"), "detail"))
    )


@query(
    "land_value_roundtrip",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS property_id,
      'Straße é ' || (o_custkey % 50) || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE ', "rear"' END
        || CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || 'up, "stairs"' ELSE '' END
        || CASE WHEN o_orderkey % 7 = 0 THEN ' ' || chr(92) ELSE '' END AS street_name,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS base_date_1, CAST(round(o_totalprice) AS BIGINT) AS land_value_1,
      CASE WHEN o_orderkey % 4 = 0 THEN 'H' WHEN o_orderkey % 4 = 1 THEN 'M' END AS area_type, 'ep&a_2006' AS zone_standard,
      CAST(7 AS INTEGER) AS district_code, '777' AS district_name
    FROM orders
    UNION ALL SELECT NULL, 'rejects', NULL, 0, NULL, NULL, NULL, NULL
    """,
)
def land_value_roundtrip(t: Tables):
    """Land-value files in two encodings and two column orders, as publishers quote them, read back."""
    folder = scratch_path(t.spark, "land-values")
    key = F.col("o_orderkey")
    street = F.concat(
        F.lit("Straße é "), (F.col("o_custkey") % 50).cast("string"),
        F.when(key % 2 == 0, "").otherwise(', "rear"'),
        F.when(key % 5 == 0, '\nup, "stairs"').otherwise(""),
        F.when(key % 7 == 0, " \\").otherwise(""),
    )
    values = {
        "DISTRICT CODE": F.lit("7"), "DISTRICT NAME": F.lit("777"), "PROPERTY ID": key.cast("string"),
        "PROPERTY TYPE": F.lit("NORMAL"), "STREET NAME": street,
        "SUBURB NAME": F.lit("TOWN"), "POSTCODE": F.lit("2000"), "ZONE CODE": F.lit("R2"), "AREA": F.lit("12.5"),
        "AREA TYPE": F.when(key % 4 == 0, "H").when(key % 4 == 1, "M").otherwise(""),
        "BASE DATE 1": F.date_format("o_orderdate", "d/M/yyyy"),
        "LAND VALUE 1": F.round("o_totalprice").cast("bigint").cast("string"),
    }
    for name, order, part, encoding in (
        ("utf8", LAND_VALUE_COLUMNS, key % 3 == 0, "UTF-8"),
        ("latin1", LAND_VALUE_COLUMNS[::-1], key % 3 != 0, "ISO-8859-1"),
    ):
        rows = t.orders.filter(part).select(*[values.get(c, F.lit("")).alias(c) for c in order])
        rows.write.option("header", "true").option("escape", '"').option("emptyValue", "").option(
            "encoding", encoding
        ).csv(f"{folder}/{name}")
    good, rejects = land_values.read_land_values(t.spark, [f"{folder}/utf8", f"{folder}/latin1"])
    found = good.select(
        "property_id", "street_name", day("base_date_1").alias("base_date_1"), "land_value_1", "area_type", "zone_standard",
        "district_code", "district_name",
    )
    counted = rejects.agg(F.count(F.lit(1)).alias("land_value_1")).withColumn("street_name", F.lit("rejects"))
    return found.unionByName(counted, allowMissingColumns=True)


@query(
    "psv_roundtrip",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS p_brand,
      p_type, 'ADDRESS_DETAIL' AS table_name
    FROM part
    """,
)
def psv_roundtrip(t: Tables):
    """One table in two folders whose files order their columns differently."""
    folder = scratch_path(t.spark, "psv")
    padded = t.part.select(
        F.col("p_partkey").cast("string").alias("P_PARTKEY"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("P_NAME"),
        F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).otherwise("   ").alias("P_BRAND"),
        F.col("p_type").alias("P_TYPE"),
    )
    columns = padded.columns
    for name, order, part in (("a", columns, 0), ("b", columns[::-1], 1)):
        padded.filter(F.col("P_PARTKEY").cast("long") % 2 == part).select(order).write.option("sep", "|").option(
            "header", "true"
        ).option("quote", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(
            f"{folder}/{name}"
        )
    back = psv.read_psv(t.spark, [f"{folder}/a", f"{folder}/b"], columns)
    return back.withColumn("table_name", psv.table_name(F.lit("NSW_ADDRESS_DETAIL_psv.psv")))


@query(
    "layer_conform",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS area_code, s_name AS area_name, s_nationkey = 3 AS in_australia,
      CASE WHEN s_suppkey % 9 <> 0 THEN s_acctbal END AS area_sqkm, round(CAST(1 + s_suppkey % 5 AS DOUBLE) * 2, 6) AS planar
    FROM supplier
    """,
)
def layer_conform(t: Tables):
    x, w = F.col("s_suppkey"), 1 + F.col("s_suppkey") % 5
    corner = lambda dx, dy: F.concat_ws(" ", (x + dx).cast("string"), F.lit(dy).cast("string"))
    ring = F.concat_ws(", ", corner(0, 0), corner(w, 0), corner(w, 2), corner(0, 2), corner(0, 0))
    layer = t.supplier.select(
        F.col("s_suppkey").alias("AREA_CODE_2021"), F.col("s_name").alias("AREA_NAME_2021"),
        F.when(F.col("s_nationkey") == 3, "AUS").otherwise("ZZZ").alias("AUS_CODE_2021"),
        F.when(x % 9 != 0, F.col("s_acctbal")).otherwise(float("nan")).alias("AREA_ALBERS_SQKM"),
        F.concat(F.lit("MULTIPOLYGON ((("), ring, F.lit(")))")).alias("geometry"),
    )
    mapping = {
        "AREA_CODE_2021": ("area_code", "text"), "AREA_NAME_2021": ("area_name", "text"),
        "AUS_CODE_2021": ("in_australia", "home"), "AREA_ALBERS_SQKM": ("area_sqkm", "number"),
        "geometry": ("geometry", "geometry"),
    }
    out = layers.conform(layer, mapping)
    return out.withColumn("planar", F.round(planar_area("geometry"), 6)).drop("geometry")


_EVENT_FIELDS = [
    features.Field("id", "objectid", 1, "object_id", "number"),
    features.Field("data", "kind", 1),
    features.Field("data", "detail", 3),
    features.Field("meta", "lastupdate", 1, "last_update", "timestamp_ms"),
    features.Field("geo", "Shape__Area", 1, "shape_area", "number"),
]


@query(
    "feature_json",
    """
    SELECT event_id AS object_id, event_type AS kind,
      CASE WHEN event_id % 50 <> 0 THEN CAST(epoch_us(ts) // 1000000 AS BIGINT) END AS updated,
      round(value, 4) AS shape_area, CASE WHEN event_id % 70 <> 0 THEN CAST((1 + event_id % 7) * (1 + event_id % 3) AS DOUBLE) END AS planar,
      event_id % 70 = 0 AS broken
    FROM events
    """,
)
def feature_json(t: Tables):
    """Events as pages of at most 75 features; open rings, repeated points and collapsed shapes included."""
    key = F.col("event_id")
    w, h = 1 + key % 7, F.when(key % 70 == 0, 0).otherwise(1 + key % 3)
    point = lambda px, py: F.array(px.cast("double"), py.cast("double"))
    zero = F.lit(0)
    ring = F.array(point(zero, zero), point(zero, h), point(zero, h), point(w, h), point(w, zero))
    ms = F.when(key % 50 == 0, F.lit(99999999999999)).otherwise(F.unix_millis(F.col("ts").cast("timestamp")))
    attributes = F.create_map(
        F.lit("objectid"), key.cast("string"), F.lit("kind"), F.col("event_type"), F.lit("detail"), F.col("props"),
        F.lit("lastupdate"), ms.cast("string"), F.lit("Shape__Area"), F.col("value").cast("string"),
    )
    feature = F.struct(attributes.alias("attributes"), F.struct(F.array(ring).alias("rings")).alias("geometry"))
    bodies = t.events.groupBy(F.floor(key / 75).alias("page")).agg(F.collect_list(feature).alias("features"))
    served = bodies.select("page", F.to_json(F.struct("features")).alias("body"))
    chosen = features.choose_fields(_EVENT_FIELDS, ("id", ("data", 2), ("meta", 2), "geo"))
    flat = features.flatten_features(served, "body", chosen)
    return flat.select(
        F.col("object_id").cast("bigint").alias("object_id"), "kind",
        F.unix_seconds("last_update").alias("updated"), F.round("shape_area", 4).alias("shape_area"),
        planar_area("geometry").alias("planar"), "broken",
    )


@query(
    "sdmx_flatten",
    """
    SELECT CAST(year(l_shipdate) AS VARCHAR) AS time_period, l_returnflag AS flag, l_linestatus AS status, CAST(count(*) AS DOUBLE) AS value
    FROM lineitem GROUP BY 1, 2, 3
    """,
)
def sdmx_flatten(t: Tables):
    """Counts as a statistics message per year, flattened again."""
    flags, states = ["A", "N", "R"], ["F", "O"]

    def values(ids: list[str]):
        return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(i).alias("name"), F.lit(n).alias("order")) for n, i in enumerate(ids)])

    counts = t.lineitem.groupBy(F.year("l_shipdate").alias("y"), "l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    place = lambda c, ids: (F.array_position(F.array(*[F.lit(i) for i in ids]), F.col(c)) - 1).cast("string")
    key = F.concat_ws(":", place("l_returnflag", flags), place("l_linestatus", states), F.lit("0"))
    cells = counts.groupBy("y").agg(F.map_from_entries(F.collect_list(F.struct(key, F.array("n")))).alias("observations"))
    year = F.col("y").cast("string")
    time_values = F.array(F.struct(year.alias("id"), year.alias("name"), F.lit(0).alias("order")))

    def dimension(name: str, pos: int, vals):
        return F.struct(F.lit(name).alias("id"), F.lit(name).alias("name"), F.lit(pos).alias("keyPosition"), vals.alias("values"))

    dims = F.array(dimension("FLAG", 0, values(flags)), dimension("STATUS", 1, values(states)), dimension("TIME_PERIOD", 2, time_values))
    links = F.array(F.struct(F.lit("DataStructure").alias("rel"), F.lit("urn:counts").alias("urn")))
    data = F.struct(
        F.array(F.struct(F.lit(0).alias("structure"), links.alias("links"), F.col("observations"))).alias("dataSets"),
        F.array(
            F.struct(F.array(F.lit(0)).alias("dataSets"), F.struct(dims.alias("observation")).alias("dimensions"))
        ).alias("structures"),
    )
    messages = cells.select(F.to_json(F.struct(data.alias("data"))).alias("body"))
    flat = sdmx.dimension_ids(sdmx.observations(messages, "body"), ["FLAG", "STATUS", "TIME_PERIOD"])
    return flat.select("time_period", "flag", "status", "value")


@query(
    "page_links",
    r"""
    WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*\shref\s*=\s*"([^"]*)"[^>]*>', 1)) AS href FROM pages)
    SELECT page_id, href, CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href ELSE href END AS url FROM l
    """,
)
def page_links(t: Tables):
    return pages.page_links(t.pages, "url", "html", keep=["page_id"]).select("page_id", "href", "url")


# One folder per layout: download date and published year of its files, on the edges of each layout's time.
_PUBLISHED = [(None, 1999), ("2001-07-31", 2001), ("2012-03-12", 2012), ("2012-03-13", 2012), ("2021-08-23", 2021)]


@query(
    "sale_layouts",
    """
    WITH o AS (SELECT o_orderkey % 5 AS k, o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d,
        CAST(round(o_totalprice) AS BIGINT) AS price FROM orders),
    n AS (SELECT k, [1999, 2001, 2012, 2012, 2021][k + 1] AS y, ['1990', '2001-07', '2002', '2012', '2021-08-23'][k + 1] AS layout, * EXCLUDE (k) FROM o)
    SELECT layout, 'A' AS kind, CASE WHEN k = 0 THEN y || '|' || 'USER' || o_orderkey
      ELSE y || '|' || CASE WHEN k > 2 THEN 'RTSALEDATA' ELSE '' END || '|' || (o_custkey % 900) || '|USER' || o_orderkey END || '|' || d AS detail FROM n
    UNION ALL SELECT layout, 'B', o_orderkey || '|' || o_custkey || '|' || d || '|' || price || '|' ||
      CASE WHEN k = 0 THEN 'A' ELSE 'R2' END || '|' || CASE WHEN k = 0 THEN 'LOT ' || o_orderkey ELSE 'D' || o_orderkey END FROM n
    UNION ALL SELECT layout, 'C', o_orderkey || '|' || o_custkey || '|1/' || o_orderkey FROM n WHERE k > 0
    UNION ALL SELECT layout, 'D', o_orderkey || '|' || o_custkey || '|' || o_orderstatus FROM n WHERE k > 0
    UNION ALL SELECT layout, 'Z', count(*) * 2 || '|' || count(*) FROM n GROUP BY layout
    UNION ALL SELECT 'rejects', 'none', '0'
    """,
)
def sale_layouts(t: Tables):
    """All records of all five layouts; the layout follows from each file's download date and published year."""
    folder = scratch_path(t.spark, "layouts")
    text = lambda c: F.col(c).cast("string")
    k, blank = F.col("k"), F.lit("")
    stamp, compact = F.date_format("o_orderdate", "yyyyMMdd HH:mm"), F.date_format("o_orderdate", "yyyyMMdd")
    price, district = F.round("o_totalprice").cast("bigint").cast("string"), (F.col("o_custkey") % 900).cast("string")
    user = F.concat(F.lit("USER"), text("o_orderkey"))
    head = [district, text("o_custkey"), text("o_orderkey"), stamp]

    def record(kind: str, semicolons: int, *fields):
        """The fields, then as many empty ones as the layout wants."""
        return F.concat_ws(";", F.lit(kind), *fields, *[blank] * (semicolons - len(fields)))

    a = (
        F.when(k == 0, record("A", 5, blank, user, stamp)).when(k < 3, record("A", 4, district, stamp, user))
        .otherwise(record("A", 5, F.lit("RTSALEDATA"), district, stamp, user))
    )
    old = record(
        "B", 21, district, F.lit("ARCHIVE"), text("o_orderkey"), text("o_custkey"), blank, blank, F.lit("MAIN ST"), F.lit("TOWN"),
        F.lit("2000"), F.date_format("o_orderdate", "dd/MM/yyyy"), price, F.concat(F.lit("LOT "), text("o_orderkey")),
        blank, F.lit("M"), blank, blank, F.lit("A"),
    )
    new = record(
        "B", 24, *head, blank, blank, blank, F.lit("MAIN ST"), F.lit("TOWN"), F.lit("2000"), blank, F.lit("M"), compact, compact,
        price, F.lit("R2"), F.lit("R"), blank, blank, blank, blank, F.lit("0"), F.concat(F.lit("D"), text("o_orderkey")),
    )
    c = record("C", 6, *head, F.concat(F.lit("1/"), text("o_orderkey")))
    d = F.when(k == 4, record("D", 12, *head, text("o_orderstatus"))).otherwise(record("D", 11, *head, text("o_orderstatus")))
    orders = t.orders.withColumn("k", F.col("o_orderkey") % 5)
    lines = orders.select("k", F.explode(F.when(k == 0, F.array(a, old)).otherwise(F.array(a, new, c, d))).alias("value"))
    lines.write.partitionBy("k").text(f"{folder}/records")
    counts = orders.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    many, n = (F.col("n") * 2).cast("string"), text("n")
    trailer = F.when(k == 0, record("Z", 3, many, n)).otherwise(record("Z", 5, many, n, n, n))
    counts.select("k", trailer.alias("value")).write.partitionBy("k").text(f"{folder}/trailers")

    found = read_lines(t.spark, folder)
    of = F.element_at(F.array(*[F.struct(F.lit(day_).cast("date").alias("d"), F.lit(y).alias("y")) for day_, y in _PUBLISHED]),
                      F.regexp_extract("file_path", r"/k=(\d)/", 1).cast("int") + 1)
    manifest = found.select("file_path").distinct().select("file_path", of["d"].alias("download_date"), of["y"].alias("published_year"))
    records = cut_lineage(sale_files.read_records(found, sale_files.with_layout(manifest)), "records")
    read = {table: sale_files.typed_table(records, table) for table in sale_files.SALE_TABLES}
    layouts = cut_lineage(records.select("file_path", "layout").distinct(), "layouts")
    details = {
        "ps_row_a_legacy": ["year_of_sale", "submitting_user_id", day("date_provided")],
        "ps_row_a": ["year_of_sale", F.coalesce("file_type", blank), "district_code", "submitting_user_id", day("date_provided")],
        "ps_row_b_legacy": ["valuation_number", "property_id", day("contract_date"), F.col("purchase_price").cast("bigint"), "zone_code", "land_description"],
        "ps_row_b": ["sale_counter", "property_id", day("contract_date"), F.col("purchase_price").cast("bigint"), "zone_code", "dealing_number"],
        "ps_row_c": ["sale_counter", "property_id", "property_description"],
        "ps_row_d": ["sale_counter", "property_id", "participant"],
        "ps_row_z": ["total_records", "total_sale_property_details"],
    }
    out = t.spark.range(0).select(blank.alias("layout"), blank.alias("kind"), blank.alias("detail"))
    bad = t.spark.range(0).select("id")
    for table, fields in details.items():
        good, rejects = read[table]
        shown = good.join(layouts, "file_path").select("layout", F.lit(table[7].upper()).alias("kind"), F.concat_ws("|", *fields).alias("detail"))
        out = out.unionByName(shown)
        bad = bad.union(rejects.select(F.lit(1).alias("id")))
    rejected = bad.agg(F.count(F.lit(1)).cast("string").alias("detail"))
    return out.unionByName(rejected.select(F.lit("rejects").alias("layout"), F.lit("none").alias("kind"), "detail"))


@query(
    "sdmx_metadata",
    """
    WITH c AS (SELECT p_brand AS b, p_type AS code, count(*) AS n FROM part GROUP BY 1, 2), b AS (SELECT DISTINCT p_brand AS b FROM part),
    m AS (SELECT p_brand AS b, min(p_size) AS lo, max(p_size) AS hi FROM part GROUP BY 1)
    SELECT 'code' AS kind, 'CL ' || b AS owner, code AS id, 'Name of ' || code || '|' || n || '|' || CASE WHEN n % 2 = 0 THEN 'more on ' || code ELSE '' END AS detail FROM c
    UNION ALL SELECT 'dimension', 'DS ' || b, 'TYPE', 'Dimension|1|C.TYPE|CL ' || b || '|' FROM b
    UNION ALL SELECT 'dimension', 'DS ' || b, 'TIME_PERIOD', 'TimeDimension|2|C.TIME||ObservationalTimePeriod' FROM b
    UNION ALL SELECT 'measure', 'DS ' || b, 'OBS_VALUE', 'C.VALUE|Double|false' FROM b
    UNION ALL SELECT 'attribute', 'DS ' || b, 'UNIT', 'Mandatory|C.UNIT||TYPE,TIME_PERIOD' FROM b
    UNION ALL SELECT 'attribute', 'DS ' || b, 'STATUS', 'Conditional|C.STATUS|OBS_VALUE|' FROM b
    UNION ALL SELECT 'concept', 'CS ' || b, code, 'Name of ' || code FROM c
    UNION ALL SELECT 'dataflow', b, 'Flow of ' || b, 'About ' || b || '|' || lo || '|' || hi || '|TIME_PERIOD,TYPE|TYPE||'
      || 'urn:sdmx:org.sdmx.infomodel.datastructure.Dataflow=ABS:' || b || '(1.2)' FROM m
    UNION ALL SELECT 'constraint', 'CC ' || b, 'TYPE', string_agg(code, ',' ORDER BY code) || '||' FROM c GROUP BY b
    UNION ALL SELECT 'constraint', 'CC ' || b, 'TIME_PERIOD', '|' || (1960 + lo) || '-01-01 true|' || (1960 + hi) || '-12-31 false' FROM m
    """,
)
def sdmx_metadata(t: Tables):
    """One structure message per brand with its types as codes, flattened by every reader of metadata."""
    brand = F.col("b")
    codes = t.part.groupBy(F.col("p_brand").alias("b"), F.col("p_type").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.min("p_size").alias("lo"), F.max("p_size").alias("hi")
    )
    listed = F.array_sort(F.collect_list(F.struct("code", "n")))
    brands = codes.groupBy("b").agg(listed.alias("codes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def named(**fields):
        return F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(name) for name, v in fields.items()])

    def note(kind: str, **fields):
        none = F.lit(None).cast("string")
        return named(type=kind, title=fields.get("title", none), text=fields.get("text", none))

    def a_code(c):
        more = F.when(c["n"] % 2 == 0, F.concat(F.lit("more on "), c["code"]))
        notes = F.array(note("ORDER", text=c["n"].cast("string")), note("FURTHER_INFORMATION", text=more))
        return named(id=c["code"], name=F.concat(F.lit("Name of "), c["code"]), annotations=notes)

    def component(name: str, concept: str, kind: str = "", place: int = 0, listing=None, text: str | None = None):
        format_ = named(textType=F.lit(text), isMultiLingual=F.lit(False), isSequence=F.lit(False))
        local = named(enumeration=F.lit(None).cast("string") if listing is None else listing, textFormat=format_)
        return named(id=name, type=kind, position=F.lit(place), conceptIdentity=concept, localRepresentation=local)

    def attribute(name: str, status: str, concept: str, relation):
        return named(id=name, assignmentStatus=status, conceptIdentity=concept, attributeRelationship=relation)

    none, no_list = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    own = F.array(F.lit("TYPE"), F.lit("TIME_PERIOD"))
    parts = named(
        dimensionList=named(
            dimensions=F.array(component("TYPE", "C.TYPE", "Dimension", 1, F.concat(F.lit("CL "), brand))),
            timeDimensions=F.array(component("TIME_PERIOD", "C.TIME", "TimeDimension", 2, text="ObservationalTimePeriod")),
        ),
        measureList=named(primaryMeasure=component("OBS_VALUE", "C.VALUE", text="Double")),
        attributeList=named(
            attributes=F.array(
                attribute("UNIT", "Mandatory", "C.UNIT", named(primaryMeasure=none, dimensions=own)),
                attribute("STATUS", "Conditional", "C.STATUS", named(primaryMeasure=F.lit("OBS_VALUE"), dimensions=no_list)),
            )
        ),
    )
    default = F.concat(F.lit("FROM="), F.col("lo").cast("string"), F.lit(",TILL="), F.col("hi").cast("string"))
    flow_notes = F.array(
        note("DEFAULT", title="FROM=0,TILL=0"), note("DEFAULT", title=default), note("LAYOUT_COLUMN", title="TIME_PERIOD,TYPE"),
        note("LAYOUT_ROW", title="TYPE"), note("LAYOUT_ROW_SECTION", title=""),
    )

    def period(year, rest: str, inclusive: bool):
        return named(period=F.concat((1960 + year).cast("string"), F.lit(rest)), isInclusive=F.lit(inclusive))

    spans = named(startPeriod=period(F.col("lo"), "-01-01T00:00:00", True), endPeriod=period(F.col("hi"), "-12-31T00:00:00", False))
    keys = F.array(
        named(id="TYPE", values=F.transform("codes", lambda c: c["code"]), timeRange=F.when(F.lit(False), spans)),
        named(id="TIME_PERIOD", values=no_list, timeRange=F.when(F.lit(True), spans)),
    )
    version = {"version": "1.2"}
    data = named(
        dataStructures=F.array(named(id=F.concat(F.lit("DS "), brand), **version, dataStructureComponents=parts)),
        codelists=F.array(named(id=F.concat(F.lit("CL "), brand), **version, codes=F.transform("codes", a_code))),
        conceptSchemes=F.array(named(
            id=F.concat(F.lit("CS "), brand), **version,
            concepts=F.transform("codes", lambda c: named(id=c["code"], name=F.concat(F.lit("Name of "), c["code"]))),
        )),
        dataflows=F.array(named(
            id=brand, **version, name=F.concat(F.lit("Flow of "), brand), description=F.concat(F.lit("About "), brand), annotations=flow_notes,
        )),
        contentConstraints=F.array(named(
            id=F.concat(F.lit("CC "), brand), **version, constraintAttachment=named(dataflows=F.array(brand)),
            cubeRegions=F.array(named(keyValues=keys)),
        )),
    )
    messages = cut_lineage(brands.select(F.to_json(named(data=data)).alias("body")), "messages")

    def shown(rows: DataFrame, kind: str, owner: str, name: str, *fields):
        texts = [F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields]
        return rows.select(F.lit(kind).alias("kind"), F.col(owner).alias("owner"), F.col(name).alias("id"), F.concat_ws("|", *texts).alias("detail"))

    def edge(time: str, inclusive: str):
        return F.concat_ws(" ", day(time), F.when(F.col(time).isNotNull(), F.col(inclusive).cast("string")))

    joined = lambda c: F.array_join(c, ",")
    tables = [
        shown(sdmx.code_lists(messages, "body"), "code", "code_list", "code", "name", "code_order", "further_information"),
        shown(sdmx.dimensions(messages, "body"), "dimension", "data_structure", "dimension", "type", "position", "concept_identity",
              "enumeration", "text_type"),
        shown(sdmx.measures(messages, "body"), "measure", "data_structure", "measure", "concept_identity", "text_type", "is_sequence"),
        shown(sdmx.attributes(messages, "body"), "attribute", "data_structure", "attribute", "assignment_status", "concept_identity",
              "primary_measure", joined("dimensions")),
        shown(sdmx.concepts(messages, "body"), "concept", "concept_scheme", "concept", "name"),
        shown(sdmx.dataflows(messages, "body"), "dataflow", "dataflow", "name", "description", F.col("default_parameters")["FROM"],
              F.col("default_parameters")["TILL"], joined("layout_column"), joined("layout_row"), joined("layout_row_section"), "urn"),
        shown(sdmx.content_constraints(messages, "body"), "constraint", "constraint", "dimension", joined("allowed"),
              edge("time_from", "from_inclusive"), edge("time_to", "to_inclusive")),
    ]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
