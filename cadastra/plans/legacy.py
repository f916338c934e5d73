"""Observations derived from archived (pre-2001) sale records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import area_sqm
from ..operators.joins import with_seen_flag
from ..operators.keys import keep_first, newest, oldest
from .provenance import with_source


def legacy_sales(ps_row_b_legacy: DataFrame, ps_row_a_legacy: DataFrame, ranked: DataFrame) -> DataFrame:
    """The latest published row per (property, contract date); rows without property are of no use."""
    published = ps_row_a_legacy.groupBy("file_path").agg(F.min(F.col("date_provided").cast("date")).alias("date_published"))
    rows = (
        with_source(ps_row_b_legacy.filter(F.col("property_id").isNotNull()))
        .join(published, "file_path", "left")
        .withColumn("effective_date", F.col("contract_date"))
    )
    kept = keep_first(rows, ["property_id", "effective_date"], [newest("date_published"), oldest("source_id")])
    modern = ranked.filter(F.col("strata_lot_number").isNull())
    return with_seen_flag(kept, modern, ["property_id", "effective_date"], "seen_in_modern_psi")


def archived_sales(legacy: DataFrame) -> DataFrame:
    return legacy.select(
        "source_id", "effective_date", "property_id", "purchase_price", "contract_date", "valuation_number", "comp_code"
    )


def archived_descriptions(legacy: DataFrame) -> DataFrame:
    return legacy.filter(F.col("land_description").isNotNull()).select(
        "source_id", "effective_date", "property_id", F.col("land_description").alias("legal_description")
    )


def property_areas(legacy: DataFrame) -> DataFrame:
    rows = legacy.withColumn("sqm_area", area_sqm("area", "area_type"))
    return rows.filter(F.col("sqm_area").isNotNull() & ~F.col("seen_in_modern_psi")).select(
        "source_id", "effective_date", "property_id", F.lit(None).cast("int").alias("strata_lot_number"), "sqm_area"
    )


def described_dimensions(legacy: DataFrame) -> DataFrame:
    return legacy.filter(F.col("dimensions").isNotNull()).select(
        "source_id", "effective_date", "property_id", F.col("dimensions").alias("dimension_description")
    )
