"""Sale record files: ``;``-separated records of several kinds in one file.

``A`` header, ``B`` sale, ``C`` piece of legal text, ``D`` participant, ``Z``
trailer.  A record may run over several lines; the records behind the first
``Z`` of a file are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import readers as rd
from ..functions.codes import zone_standard
from ..operators.quality import split_rejects
from ..schemas import TABLES, table_schema
from ..session import cut_lineage
from .lines import line_groups, plain_path, read_lines

# Semicolons per record kind and layout, longest variant first.
LAYOUTS = {
    "1990": {"A": (5,), "B": (21,), "Z": (3,)},
    "2001-07": {"A": (4,), "B": (24,), "C": (6, 5), "D": (11, 10), "Z": (5,)},
    "2002": {"A": (4,), "B": (24,), "C": (6,), "D": (11,), "Z": (5,)},
    "2012": {"A": (5,), "B": (24,), "C": (6,), "D": (11,), "Z": (5,)},
    "2021-08-23": {"A": (5,), "B": (24,), "C": (6,), "D": (12,), "Z": (5,)},
}
MISSING_PROPERTY = "missing_property_id"

RECORD_KINDS = ("A", "B", "C", "D", "Z")

# Fields per table in file order: (name, reader, required).
_B = [
    ("district_code", "int", True), ("property_id", "int", False), ("sale_counter", "int", True),
    ("date_provided", "stamp", True), ("property_name", "text", False), ("unit_number", "text", False),
    ("house_number", "text", False), ("street_name", "text", False), ("locality_name", "text", False),
    ("postcode", "postcode", False), ("area", "double", False), ("area_type", "unit", False),
    ("contract_date", "date", False), ("settlement_date", "date", False), ("purchase_price", "double", False),
    ("zone_code", "zone", False), ("nature_of_property", "text", True), ("primary_purpose", "text", False),
    ("strata_lot_number", "int", False), ("comp_code", "text", False), ("sale_code", "text", False),
    ("interest_of_sale", "int", False), ("dealing_number", "text", True),
]
_B_1990 = [
    ("district_code", "int", True), ("source", "text", False), ("valuation_number", "text", False),
    ("property_id", "int", False), ("unit_number", "text", False), ("house_number", "text", False),
    ("street_name", "text", False), ("locality_name", "text", False), ("postcode", "postcode", False),
    ("contract_date", "slashed", True), ("purchase_price", "double", True), ("land_description", "text", False),
    ("area", "double", False), ("area_type", "unit", False), ("dimensions", "text", False),
    ("comp_code", "text", False), ("zone_code", "zone", False),
]
_HEAD = [
    ("district_code", "int", True), ("property_id", "int", False), ("sale_counter", "int", True),
    ("date_provided", "stamp", True),
]
FIELDS = {
    "ps_row_a_legacy": [(None, None, False), ("submitting_user_id", "text", False), ("date_provided", "stamp", True)],
    "ps_row_a": [
        ("file_type", "text", False), ("district_code", "int", True), ("date_provided", "stamp", True),
        ("submitting_user_id", "text", True),
    ],
    "ps_row_b_legacy": _B_1990,
    "ps_row_b": _B,
    "ps_row_c": [*_HEAD, ("property_description", "text", False)],
    "ps_row_d": [*_HEAD, ("participant", "text", True)],
    "ps_row_z": [
        ("total_records", "int", True), ("total_sale_property_details", "int", True),
        ("total_sale_property_legal_descriptions", "int", False), ("total_sale_participants", "int", False),
    ],
}


def layout_of(downloaded: Column, published_year: Column) -> Column:
    """Layout of a file by download date and published year; NULL when it cannot be told."""
    year, month = F.year(downloaded), F.month(downloaded)
    return (
        F.when(downloaded.isNull(), F.when(published_year <= 2001, "1990"))
        .when((published_year == 2001) & (year <= 2001) & (month < 8), "2001-07")
        .when(published_year < 2012, "2002")
        .when(
            (published_year == 2012) & ((month < 3) | ((month == 3) & (F.dayofmonth(downloaded) < 13))), "2002"
        )
        .when((published_year == 2021) & (month == 8) & (F.dayofmonth(downloaded) == 23), "2021-08-23")
        .otherwise("2012")
    )


def with_layout(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("layout", layout_of(F.col("download_date"), F.col("published_year")))


def read_records(lines: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records (file_path, position, published_year, layout, kind, variant, fields, semicolons).

    ``manifest`` is unique on file_path with published_year and layout.  A line
    that starts no record continues the one before it, also across blocks.
    """
    starts = F.substring(F.ltrim("value"), 1, 2).isin([f"{k};" for k in RECORD_KINDS])
    facts = manifest.select(plain_path("file_path").alias("file_path"), "published_year", "layout")
    groups = line_groups(lines, starts, facts).filter("group > 0").withColumnRenamed("group", "record")
    # Of records read whole in one block, only ends of files and records that lack semicolons are looked at.
    marks = groups.withColumn("missing", _missing()).withColumn("end", F.startswith(F.ltrim("text"), F.lit("Z;")))
    marks = marks.filter("NOT headed OR missing > 0 OR end").select(
        "file_path", "record", "position", "headed", "missing", "end", _semicolons().alias("found"), F.when(~F.col("headed"), F.col("text")).alias("text")
    )
    marks = cut_lineage(marks, "marks")
    pieces = F.array_sort(F.collect_list(F.struct("position", "text")))
    tails = marks.filter("NOT headed").groupBy("file_path", "record").agg(
        F.sum("found").alias("_more"), F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("_tail")
    )
    tails = cut_lineage(tails, "tails")
    whole = groups.filter("headed").join(tails.drop("_more"), ["file_path", "record"], "left").select(
        "file_path", "record", "published_year", "layout", "position", F.concat_ws("\n", "text", "_tail").alias("text")
    )
    short = marks.filter("headed").join(tails.drop("_tail"), ["file_path", "record"], "left")
    short = short.filter(F.col("missing") > F.coalesce("_more", F.lit(0)))
    if short.isEmpty():
        complete, ended = whole, marks.filter("headed AND end")
    else:
        complete = _complete(cut_lineage(whole, "records"))
        ended = complete.filter(F.startswith(F.ltrim(F.regexp_replace("text", r"\s+$", "")), F.lit("Z;")))
    ends = ended.groupBy("file_path").agg(F.min("record").alias("_end"))
    # One row a file: of known size, so that no file's records need to meet in one task.
    read = complete.withColumn("text", F.regexp_replace("text", r"\s+$", "")).join(cut_lineage(ends, "ends"), "file_path", "left")
    return _cut_fields(read.filter(F.col("_end").isNull() | (F.col("record") <= F.col("_end"))).drop("_end"))


def _by_kind(value: Callable[[tuple[int, ...]], Column]) -> Column:
    pairs = [
        x for name, kinds in LAYOUTS.items() for kind, counts in kinds.items() for x in (F.lit(f"{name}/{kind}"), value(counts))
    ]
    return F.create_map(*pairs)


def _semicolons() -> Column:
    return F.size(F.split("text", ";")) - 1


def _missing() -> Column:
    """How many semicolons a record has less than any variant of its kind."""
    least = _by_kind(lambda counts: F.lit(min(counts)))
    kind = F.trim(F.substring_index("text", ";", 1))
    needed = F.try_element_at(least, F.concat_ws("/", F.col("layout"), kind))
    return F.greatest(F.coalesce(needed - _semicolons(), F.lit(0)), F.lit(0))


def _complete(records: DataFrame) -> DataFrame:
    """Let a record go on until it has its semicolons.

    A line of free text may look like the start of a record.  A record with
    fewer semicolons than any variant of its kind therefore takes up the
    records behind it until it has enough; each brings one at least, so only
    as many as are missing can belong to it.  Files without such a record
    pass untouched; of the others only records that are joined move their texts.
    """
    marked = records.withColumn("_missing", _missing())
    counted = cut_lineage(marked.select("file_path", "record", _semicolons().alias("found"), F.col("_missing").alias("missing")), "semicolons")
    if counted.filter("missing > 0").isEmpty():
        return records
    touched = counted.filter("missing > 0").select("file_path").distinct()
    joined = joined_records(counted.join(touched, "file_path", "left_semi"))
    moved = joined.select("file_path", "record", F.col("head")).unionByName(
        joined.select("file_path", F.col("head").alias("record"), "head").distinct()
    )
    moved = cut_lineage(moved, "joined-records")
    texts = F.array_sort(F.collect_list(F.struct("record", "text")))
    mended = (
        marked.join(moved, ["file_path", "record"])
        .groupBy("file_path", "published_year", "layout", F.col("head").alias("record"))
        .agg(F.min("position").alias("position"), F.array_join(F.transform(texts, lambda t: t["text"]), "\n").alias("text"))
    )
    columns = ["file_path", "published_year", "layout", "record", "position", "text"]
    return marked.join(moved, ["file_path", "record"], "left_anti").select(columns).unionByName(mended.select(columns))


def joined_records(counted: DataFrame, width: int = 256) -> DataFrame:
    """``file_path, record, head`` of records that continue an earlier one, from ``file_path, record, found, missing``.

    Records are numbered without gaps.  What goes from one record to the next is
    only how many semicolons the open record still lacks.  A slice of ``width``
    records is a map from what it is handed to what it hands on; maps of
    ``width`` slices are composed to one, up to a single slice a file, and what
    each is handed comes down the same way.  No step holds more than ``width``
    rows, of numbers alone.
    """
    most = max(min(counts) for kinds in LAYOUTS.values() for counts in kinds.values())
    if width <= most:
        raise ValueError(f"slices of more than {most} records")
    last = counted.agg(F.max("record")).first()[0]
    if last is None:
        return counted.select("file_path", "record", F.lit(0).cast("long").alias("head")).limit(0)

    def step(open_: Column, r: Column) -> Column:
        return F.when(open_ > 0, F.greatest(open_ - r["found"], F.lit(0))).otherwise(r["missing"])

    def handed(rows: str, start: Column, onward: Callable[[Column, Column], Column]) -> Column:
        """What each row of a slice is handed, and at last what the slice hands on."""
        return F.aggregate(rows, F.array(start), lambda done, r: F.concat(done, F.array(onward(F.element_at(done, -1), r))))

    def as_map(rows: str, onward: Callable[[Column, Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(most)), lambda start: F.aggregate(rows, start, onward))

    def sliced(rows: DataFrame, *values: str) -> DataFrame:
        slice_ = F.floor(F.col("at") / width)
        return rows.groupBy("file_path", slice_.alias("slice")).agg(F.array_sort(F.collect_list(F.struct("at", *values))).alias("rows"))

    def through(open_: Column, r: Column) -> Column:
        return F.element_at(r["map"], open_ + 1)

    bottom = cut_lineage(sliced(counted.withColumn("at", F.col("record")), "found", "missing"), "slices")
    # A full slice without short records ends whatever it is handed.
    settled = (F.size("rows") > most) & ~F.exists("rows", lambda r: r["missing"] > 0)
    maps = bottom.select(
        "file_path", F.col("slice").alias("at"), F.when(settled, F.array_repeat(F.lit(0), most + 1)).otherwise(as_map("rows", step)).alias("map")
    )
    levels, slices = [], last // width + 1
    while slices > 1:
        levels.append(cut_lineage(sliced(maps, "map"), "slice-maps"))
        maps = levels[-1].select("file_path", F.col("slice").alias("at"), as_map("rows", through).alias("map"))
        slices = (slices - 1) // width + 1
    # The first record of a file is handed nothing.
    start = None
    for level in reversed(levels):
        given = level.withColumn("open", F.lit(0)) if start is None else level.join(start, ["file_path", "slice"])
        inner = F.transform("rows", lambda r, i: F.struct(r["at"].alias("slice"), F.get("_handed", i).alias("open")))
        start = given.withColumn("_handed", handed("rows", F.col("open"), through)).select("file_path", F.inline(inner))
    given = bottom.withColumn("open", F.lit(0)) if start is None else bottom.join(start, ["file_path", "slice"])
    def running(done: Column, r: Column) -> Column:
        return F.concat(done, F.array(F.when(F.get("_handed", F.size(done) - 1) > 0, F.element_at(done, -1)).otherwise(r["at"])))

    none = F.array(F.lit(None).cast("long"))
    marked = given.withColumn("_handed", handed("rows", F.col("open"), step)).withColumn("_heads", F.aggregate("rows", none, running))
    marked = cut_lineage(marked.select("file_path", "slice", "rows", "_handed", "_heads"), "heads")
    # A slice is longer than any joined record, so a head lies in the same slice or the one before.
    before = marked.select("file_path", (F.col("slice") + 1).alias("slice"), F.element_at("_heads", -1).alias("_before"))
    continued = F.filter(
        F.transform("rows", lambda r, i: F.struct(r["at"].alias("record"), F.get("_heads", i + 1).alias("head"), F.get("_handed", i).alias("_open"))),
        lambda r: r["_open"] > 0,
    )
    rows = marked.select("file_path", "slice", continued.alias("rows")).filter(F.size("rows") > 0)
    return rows.join(before, ["file_path", "slice"], "left").select("file_path", "_before", F.inline("rows")).select(
        "file_path", "record", F.coalesce("head", "_before").alias("head")
    )


def _cut_fields(records: DataFrame) -> DataFrame:
    parts = F.split("text", ";")
    cut = (
        records.withColumn("semicolons", F.size(parts) - 1)
        .withColumn("kind", F.trim(parts[0]))
        .withColumn("_parts", F.slice(parts, F.lit(2), F.size(parts)))
    )
    layout = _by_kind(lambda counts: F.array(*map(F.lit, counts)))
    counts = F.try_element_at(layout, F.concat_ws("/", F.col("layout"), F.col("kind")))
    short = F.coalesce(F.col("semicolons") == F.try_element_at(counts, F.lit(2)), F.lit(False))
    # A record without property id gets a blank one, so every variant reads alike.
    filled = F.concat(F.slice("_parts", 1, 1), F.array(F.lit("")), F.slice("_parts", F.lit(2), F.size("_parts")))
    # The header of 2001 to 2012 has no file type.
    untyped = (F.col("kind") == "A") & F.col("layout").isin("2001-07", "2002")
    typed = F.concat(F.array(F.lit("")), F.col("_parts"))
    # A trailer is read up to its last known field; whatever follows it is not read.
    fits = F.when(F.col("kind") == "Z", F.col("semicolons") >= F.try_element_at(counts, F.lit(1))).otherwise(
        F.array_contains(counts, F.col("semicolons"))
    )
    return cut.withColumn("well_formed", F.coalesce(fits, F.lit(False))).select(
        "file_path",
        "position",
        "published_year",
        "layout",
        "kind",
        F.when(short, MISSING_PROPERTY).alias("variant"),
        "semicolons",
        "well_formed",
        F.when(short, filled).when(untyped, typed).otherwise(F.col("_parts")).alias("fields"),
    )


_READERS = {
    "int": rd.read_int,
    "double": rd.read_double,
    "text": rd.read_text,
    "postcode": rd.read_postcode,
    "unit": rd.read_area_unit,
    "date": rd.read_date,
    "slashed": lambda c: rd.read_date(c, rd.DATE_SLASHED),
    "stamp": rd.read_timestamp,
    "zone": lambda c: rd.read_text(c, max_len=4),
}


def typed_table(records: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of one table and the records that could not be read."""
    kind = table.split("_")[2].upper()
    legacy = F.col("layout") == "1990"
    rows = records.filter(F.col("kind") == kind)
    if table in ("ps_row_a", "ps_row_b"):
        rows = rows.filter(~legacy)
    elif table.endswith("_legacy"):
        rows = rows.filter(legacy)
    fields = FIELDS[table]
    texts = rows.select(
        "file_path",
        "position",
        F.col("published_year").alias("year_of_sale"),
        "well_formed",
        *[
            F.coalesce(F.try_element_at("fields", F.lit(i + 1)), F.lit("")).alias(f"_{name}")
            for i, (name, _, _) in enumerate(fields)
            if name
        ],
    )
    readings = {}
    for name, reader, _ in fields:
        if not name:
            continue
        value = _READERS[reader](F.col(f"_{name}"))
        if reader == "postcode":
            # A postcode of another length is unknown, not an error.
            readings[name] = (f"_{name}", value)
            texts = texts.withColumn(f"_{name}", F.when(F.length(f"_{name}") == 4, F.col(f"_{name}")).otherwise(""))
        else:
            readings[name] = (f"_{name}", value)
    required = [name for name, _, needed in fields if needed]
    good, rejects = split_rejects(texts.filter("well_formed"), readings, required)
    malformed = texts.filter(~F.col("well_formed")).withColumn("bad_fields", F.array(F.lit("semicolons")))
    if "zone_code" in readings:
        good = good.withColumn("zone_standard", zone_standard("zone_code"))
    if table == "ps_row_z":
        totals = ("total_sale_property_legal_descriptions", "total_sale_participants")
        good = good.na.fill(0, list(totals))
    schema = table_schema(table)
    return good.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), rejects.unionByName(malformed)


SALE_TABLES = [t for t in TABLES if t.startswith("ps_row_")]


def read_sale_files(spark: SparkSession, paths: str | list[str], manifest: DataFrame, glob: str | None = None) -> DataFrame:
    """Records of sale files; split them by kind with ``typed_table``."""
    lines = read_lines(spark, paths, glob)
    return read_records(lines, manifest)


def no_layout(manifest: DataFrame) -> DataFrame:
    """Files whose layout cannot be told (published after 2001, no download date)."""
    return manifest.filter(F.col("layout").isNull())

