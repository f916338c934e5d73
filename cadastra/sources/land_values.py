"""Land-value CSV files: one row per property and snapshot, five valuations each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import readers as rd
from ..functions.codes import zone_standard
from ..operators.hold import hold
from ..operators.quality import split_rejects
from ..schemas import LAND_VALUE_COLUMNS, table_schema
from .lines import csv_fields, header_lines, number_lines, quote_states, read_lines, whole_records


def snapshot_date(path) -> F.Column:
    """Date in a name ending ``_yyyyMMdd.csv``."""
    digits = F.nullif(F.regexp_extract(path, r"_(\d{8})\.[Cc][Ss][Vv]$", 1), F.lit(""))
    return F.try_to_date(digits, "yyyyMMdd")


def header_places(header: Column) -> Column:
    """Where each published column stands in a header; NULL when one is missing."""
    names = F.transform(
        csv_fields(F.regexp_replace(header, r"[\r\x{FEFF}]", "")), lambda c: F.upper(F.trim(c))
    )
    places = F.transform(F.array(*map(F.lit, LAND_VALUE_COLUMNS)), lambda c: F.array_position(names, c).cast("int") - 1)
    return F.when(F.array_min(places) >= 0, places)


def header_width(header: Column) -> Column:
    """Fields of a header."""
    return F.size(csv_fields(F.regexp_replace(header, r"[\r\x{FEFF}]", "")))


def parse_land_values(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejects of numbered CSV records with the ``places`` and ``width`` of their file's header.

    The first line of a file is its header, and columns are taken by its names.
    A file whose header lacks a column is rejected whole, record by record;
    so is a record of more or fewer fields than its header (bad field ``field_count``).
    """
    text = F.regexp_replace("value", r"\r$", "")
    columns = [c.lower().replace(" ", "_") for c in LAND_VALUE_COLUMNS]
    body = numbered.filter((F.col("line_number") > 0) & (F.trim("value") != ""))
    fields = body.select(
        F.col("file_path").alias("source_file_name"),
        F.col("line_number").cast("int").alias("source_line_number"),
        snapshot_date(F.col("file_path")).alias("source_date"),
        "places",
        "width",
        hold(csv_fields(text)).alias("r"),
    ).select(
        "source_file_name",
        "source_line_number",
        "source_date",
        *[F.get("r", F.get("places", F.lit(i))).alias(f"_{c}") for i, c in enumerate(columns)],
        F.size("r").cast("string").alias("_field_count"),
        "width",
    )

    readers = {"district_code": rd.read_int, "property_id": rd.read_int, "area": rd.read_double}
    readings = {}
    for c in columns:
        name = f"_{c}"
        if c in readers:
            value = readers[c](name)
        elif c.startswith("land_value_"):
            value = rd.read_double(name).cast("bigint")
        elif c.startswith("base_date_"):
            value = rd.read_date(name, rd.DATE_SLASHED)
        elif c == "area_type":
            value = rd.read_area_unit(name)
        elif c == "zone_code":
            value = rd.read_text(name, max_len=4)
        else:
            value = rd.read_text(name)
        readings[c] = (name, value)
    right = F.col("_field_count") == F.col("width").cast("string")
    readings["field_count"] = ("_field_count", F.when(right, F.col("width")))
    fields = fields.withColumn("_postcode", F.when(F.length("_postcode") == 4, F.col("_postcode")))
    good, rejects = split_rejects(fields, readings, ["district_code", "property_id", "property_type", "suburb_name"], once=True)
    good = good.withColumn("zone_standard", zone_standard("zone_code"))
    schema = table_schema("land_value_row")
    return good.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), rejects


def header_errors(lines: DataFrame) -> DataFrame:
    """Files whose header lacks a published column."""
    return header_lines(lines).filter(header_places(F.col("header")).isNull()).select(
        "file_path", F.col("header").alias("value")
    )


def number_records(lines: DataFrame) -> DataFrame:
    """Numbered CSV records of raw lines with their file's column places."""
    facts = header_lines(lines).select(
        "file_path", header_places(F.col("header")).alias("places"), header_width(F.col("header")).alias("width")
    )
    return whole_records(number_lines(lines, file_facts=facts, states=quote_states()))


def read_land_values(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    return parse_land_values(number_records(read_lines(spark, paths, "*.[cC][sS][vV]")))
