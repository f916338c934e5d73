"""Feature-server JSON pages to feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import as_format
from ..operators.spatial import rings_from_coordinates, with_repaired

PAGE = (
    "struct<features:array<struct<attributes:map<string,string>,"
    "geometry:struct<rings:array<array<array<double>>>,paths:array<array<array<double>>>>>>>"
)


class Field(NamedTuple):
    category: str
    name: str
    priority: int
    rename: str | None = None
    format: str = "text"


# Fields of the property and lot layers.
PROPERTY_FIELDS = [
    Field("id", "RID", 1, "rid", "number"),
    Field("meta", "createdate", 1, "create_date", "timestamp_ms"),
    Field("assoc", "propid", 1, "property_id", "number"),
    Field("assoc", "gurasid", 3),
    Field("assoc", "principaladdresssiteoid", 2, "principal_address_site_oid", "number"),
    Field("data", "propertytype", 2, "property_type"),
    Field("data", "dissolveparcelcount", 2, "dissolve_parcel_count", "number"),
    Field("data", "superlot", 1, "super_lot"),
    Field("data", "housenumber", 3, "house_number"),
    Field("data", "address", 1),
    Field("meta", "startdate", 1, "start_date", "timestamp_ms"),
    Field("meta", "enddate", 1, "end_date", "timestamp_ms"),
    Field("meta", "lastupdate", 1, "last_update", "timestamp_ms"),
    Field("meta", "shapeuuid", 2, "shape_uuid"),
    Field("meta", "changetype", 3, "change_type"),
    Field("data", "principaladdresstype", 2, "principal_address_type", "number"),
    Field("assoc", "addressstringoid", 1, "address_string_oid", "number"),
    Field("geo", "Shape__Length", 1, "shape_length", "number"),
    Field("geo", "Shape__Area", 1, "shape_area", "number"),
]
LOT_FIELDS = [
    Field("id", "objectid", 1, "object_id", "number"),
    Field("assoc", "lotidstring", 1, "lot_id_string"),
    Field("assoc", "controllingauthorityoid", 1, "controlling_authority_oid", "number"),
    Field("assoc", "cadid", 2, "cad_id", "number"),
    Field("meta", "createdate", 1, "create_date", "timestamp_ms"),
    Field("meta", "modifieddate", 1, "modified_date", "timestamp_ms"),
    Field("meta", "startdate", 1, "start_date", "timestamp_ms"),
    Field("meta", "enddate", 1, "end_date", "timestamp_ms"),
    Field("meta", "lastupdate", 1, "last_update", "timestamp_ms"),
    Field("geo", "Shape__Length", 1, "shape_length", "number"),
    Field("geo", "Shape__Area", 1, "shape_area", "number"),
]
DEFAULT_NEEDS = ("id", ("assoc", 2), ("data", 2), ("meta", 2), "geo")


def choose_fields(fields: Sequence[Field], needs: Sequence[str | tuple[str, int]] | str = "*") -> list[Field]:
    """Fields by category and priority; a bare category means priority up to 3."""
    if isinstance(needs, str):
        if needs != "*":
            raise ValueError("needs is a list of categories or '*'")
        return list(fields)
    wanted = [(n, 3) if isinstance(n, str) else n for n in needs]
    return [f for category, top in wanted for f in fields if f.category == category and f.priority <= top]


def _typed(name: str, fmt: str) -> Column:
    text = F.try_element_at(F.col("_f.attributes"), F.lit(name))
    if fmt == "number":
        return as_format(text.try_cast("double"), fmt)
    if fmt == "timestamp_ms":
        return as_format(text.try_cast("double"), fmt)
    return as_format(text, fmt)


def flatten_features(pages: DataFrame, body: str, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """One row per feature: chosen attributes, polygon rings (or line paths) and a repair flag.

    ``geometry`` is NULL and ``broken`` true where no valid ring is left.
    """
    parsed = pages.select(*keep, F.from_json(body, PAGE).alias("_p"))
    rows = parsed.select(*keep, F.explode("_p.features").alias("_f"))
    rings = rings_from_coordinates("_f.geometry.rings")
    flat = rows.select(
        *keep,
        *[_typed(f.name, f.format).alias(f.rename or f.name) for f in fields],
        rings.alias("_rings"),
        rings_from_coordinates("_f.geometry.paths").alias("paths"),
    )
    return with_repaired(flat, "_rings", "geometry").withColumn(
        "broken", F.col("_rings").isNotNull() & F.col("geometry").isNull()
    ).drop("_rings")


def read_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Saved pages, one JSON document per file; page size is bounded by the server's result limit."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("body")
    )
