"""Pipe-separated address files, one table spread over state files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.readers import blank_to_null
from .lines import header_lines, read_lines

# Address tables shipped per state.
STATE_TABLES = [
    "STATE", "ADDRESS_SITE", "MB_2016", "MB_2021", "LOCALITY", "LOCALITY_ALIAS", "LOCALITY_NEIGHBOUR",
    "LOCALITY_POINT", "STREET_LOCALITY", "STREET_LOCALITY_ALIAS", "STREET_LOCALITY_POINT", "ADDRESS_DETAIL",
    "ADDRESS_SITE_GEOCODE", "ADDRESS_ALIAS", "ADDRESS_DEFAULT_GEOCODE", "ADDRESS_FEATURE",
    "ADDRESS_MESH_BLOCK_2016", "ADDRESS_MESH_BLOCK_2021", "PRIMARY_SECONDARY",
]


def table_name(file_name: Column | str) -> Column:
    """Table a file belongs to: ``NSW_ADDRESS_DETAIL_psv.psv`` or ``Authority_Code_STREET_TYPE_AUT_psv.psv``."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    base = F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"\.[^.]*$", "")
    stem = F.regexp_replace(base, r"_[^_]*$", "")
    return F.when(base.startswith("Authority_Code"), F.substr(stem, F.lit(16))).otherwise(
        F.regexp_replace(stem, r"^[^_]*_", "")
    )


def read_psv(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Text columns named by each file's own header, trimmed, empty text as NULL.

    Files may order their columns differently.  Without ``columns`` the result
    has all columns of any header, in the order of the first file; with them,
    a file that lacks one fails.  Only headers are looked at beforehand: one
    line a file.
    """
    reader = spark.read.option("sep", "|").option("header", "true").option("quote", "")
    names = F.transform(F.split(F.regexp_replace("header", r"[\r\x{FEFF}]", ""), r"\|"), F.trim)
    place = F.url_decode(F.replace(F.col("file_path"), F.lit("+"), F.lit("%2B")))
    heads = header_lines(read_lines(spark, paths)).select(names.alias("names"), place.alias("file_path"))
    groups = heads.groupBy("names").agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    found = sorted(groups.collect(), key=lambda r: r.files[0])
    wanted = [c.lower() for c in columns or dict.fromkeys(n for r in found for n in r.names)]
    parts = []
    for group in found:
        own = [n.lower() for n in group.names]
        if columns and not set(wanted) <= set(own):
            raise ValueError(f"{group.files[0]}: header lacks {sorted(set(wanted) - set(own))}")
        rows = reader.schema(", ".join(f"`{c}` string" for c in own)).csv(group.files)
        parts.append(rows.select(*[blank_to_null(F.col(f"`{c}`")).alias(c) for c in own if c in wanted]))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in wanted) or "empty string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*wanted)


def read_table(spark: SparkSession, root: str, table: str, states: list[str], columns: list[str] | None = None) -> DataFrame:
    """One standard table over the given states."""
    return read_psv(spark, [f"{root}/Standard/{s}_{table}_psv.psv" for s in states], columns)


def read_authority(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_psv(spark, f"{root}/Authority Code/Authority_Code_{table}_psv.psv")
