"""Observations derived from land-value rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import KIND_AFTER, UNDER_STRATA_TYPE, ZONE_CURRENT, area_sqm, equals_flag
from ..operators.history import unpivot
from ..operators.keys import keep_first, newest, oldest, stable_id
from .provenance import sourced_land_values

GROUPS = [
    {
        "base_date": f"base_date_{i}",
        "valuation_basis": f"basis_{i}",
        "valuation_authority": f"authority_{i}",
        "land_value": f"land_value_{i}",
    }
    for i in range(1, 6)
]


def legal_descriptions(land_value_row: DataFrame) -> DataFrame:
    rows = sourced_land_values(land_value_row).filter(F.col("property_description").isNotNull())
    return rows.select(
        "source_id",
        "effective_date",
        stable_id("source_id").alias("legal_description_id"),
        "property_id",
        F.lit(None).cast("int").alias("strata_lot_number"),
        F.col("property_description").alias("legal_description"),
        F.lit(KIND_AFTER).alias("legal_description_kind"),
    )


def property_areas(land_value_row: DataFrame) -> DataFrame:
    rows = sourced_land_values(land_value_row).withColumn("sqm_area", area_sqm("area", "area_type"))
    return rows.filter(F.col("sqm_area").isNotNull()).select(
        "source_id", "effective_date", "property_id", F.lit(None).cast("int").alias("strata_lot_number"), "sqm_area"
    )


def land_valuations(land_value_row: DataFrame) -> DataFrame:
    """Valuation history: the newest snapshot's value per property and base date."""
    rows = sourced_land_values(land_value_row)
    long = unpivot(rows, ["source_id", "district_code", "property_id", "source_date"], GROUPS)
    kept = keep_first(
        long.filter(F.col("land_value").isNotNull()),
        ["property_id", "base_date"],
        [
            newest("source_date"), oldest("source_id"), newest("land_value"),
            oldest("valuation_basis"), oldest("valuation_authority"),
        ],
    )
    return kept.select(
        "source_id",
        F.col("base_date").alias("effective_date"),
        F.col("district_code").alias("valuation_district_code"),
        "property_id",
        F.col("base_date").alias("valuation_base_date"),
        "valuation_basis",
        "valuation_authority",
        F.col("land_value").cast("double").alias("land_value"),
    )


def zone_observations(land_value_row: DataFrame) -> DataFrame:
    rows = sourced_land_values(land_value_row).filter(F.col("zone_standard") == ZONE_CURRENT)
    return rows.select("source_id", "effective_date", "property_id", "zone_code")


def under_strata_plan(land_value_row: DataFrame) -> DataFrame:
    rows = sourced_land_values(land_value_row).filter(F.col("property_type").isNotNull())
    kept = keep_first(rows, ["effective_date", "property_id"], [newest("source_date"), oldest("source_id")])
    return kept.select(
        "source_id", "effective_date", "property_id",
        equals_flag("property_type", UNDER_STRATA_TYPE).alias("under_strata_plan"),
    )
