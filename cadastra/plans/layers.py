"""Parcels, properties and zones out of the spatial layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import base_parcel_id, base_parcel_kind
from ..operators.history import latest
from ..operators.joins import null_orphans, unseen
from ..operators.keys import keep_first, oldest


def lot_parcels(lot_layer: DataFrame) -> DataFrame:
    """The latest row per base parcel: several strata lots share one plan, so the derived id is the key."""
    rows = lot_layer.withColumn("base_parcel_id", base_parcel_id("lot_id_string")).withColumn(
        "base_parcel_kind", base_parcel_kind("lot_id_string")
    )
    return latest(rows, ["base_parcel_id"], "last_update", ["object_id"])


def base_parcels(lot_layer: DataFrame, known: DataFrame) -> dict[str, DataFrame]:
    """New base parcels (not in ``known``) and the geometry of all."""
    parcels = lot_parcels(lot_layer)
    return {
        "base_parcel": unseen(parcels.select("base_parcel_id", "base_parcel_kind"), known, ["base_parcel_id"]),
        "base_parcel_geometry": parcels.select("base_parcel_id", "geometry"),
    }


def principal_properties(property_layer: DataFrame, known: DataFrame) -> dict[str, DataFrame]:
    """New properties and, per property, the geometry of its lowest address string."""
    rows = property_layer.filter(F.col("principal_address_type") == 1)
    chosen = keep_first(rows, ["property_id"], [oldest("address_string_oid"), oldest("rid")])
    return {
        "property": unseen(chosen.select("property_id"), known, ["property_id"]),
        "property_geometry": chosen.select("property_id", "geometry"),
    }


def clean_destination_zones(dzn: DataFrame, sa2: DataFrame) -> DataFrame:
    return null_orphans(dzn, sa2, "sa2_code", "sa2_code", ["sa2_code", "state_code"])
