"""Observations derived from current sale records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import ZONE_CURRENT, area_sqm, description_kind, nature_label
from ..functions.values import completeness, first_date
from ..operators.aggregates import concat_in_order, expand_runs, value_runs
from ..operators.history import best_row
from ..operators.joins import with_seen_flag
from ..operators.keys import keep_first, newest, oldest, stable_id
from .provenance import sourced_land_values, with_source

SALE = ["file_source_id", "sale_counter"]
OBSERVED = ["effective_date", "property_id", "strata_lot_number"]


def ranked_sales(ps_row_b: DataFrame, land_value_row: DataFrame) -> DataFrame:
    """The most complete, then newest, row per (dealing, property, strata lot)."""
    rows = (
        with_source(ps_row_b)
        .filter(
            F.col("property_id").isNotNull()
            & F.col("sale_counter").isNotNull()
            & (F.length("dealing_number") > 1)
        )
        .withColumn(
            "effective_date",
            first_date("contract_date", "settlement_date", F.col("date_provided").cast("date")),
        )
    )
    score = completeness("contract_date", "settlement_date", "purchase_price", "area_type", "area")
    best = best_row(
        rows, ["dealing_number", "property_id", "strata_lot_number"], score, "date_provided", ["source_id"]
    )
    valued = sourced_land_values(land_value_row)
    return with_seen_flag(best, valued, ["property_id", "effective_date"], "seen_in_land_values")


def sale_descriptions(ps_row_c: DataFrame, ranked: DataFrame) -> DataFrame:
    """Whole legal texts of the ranked sales, one per (property, strata lot, dealing)."""
    pieces = with_source(ps_row_c).filter(
        F.col("property_description").isNotNull() & F.col("sale_counter").isNotNull()
    )
    whole = concat_in_order(
        pieces, SALE, "property_description", "position", "full_property_description",
        F.min_by("source_id", "position").alias("source_id"),
    )
    sale = ranked.select(
        *SALE, "property_id", "strata_lot_number", "effective_date", "seen_in_land_values", "date_provided",
        "dealing_number",
    )
    joined = sale.join(whole, SALE)
    return keep_first(
        joined,
        ["property_id", "strata_lot_number", "dealing_number"],
        [newest("date_provided"), oldest("source_id")],
    )


def notices_of_sale(ranked: DataFrame, ps_row_d: DataFrame) -> DataFrame:
    members = with_source(ps_row_d).filter(
        F.col("property_id").isNotNull() & F.col("sale_counter").isNotNull()
    )
    participants = value_runs(members, SALE, "participant", "_people")
    joined = ranked.join(participants, SALE, "left").withColumn("sale_participants", expand_runs("_people"))
    return joined.select(
        "source_id", "effective_date", "property_id", "strata_lot_number", "dealing_number", "purchase_price",
        "contract_date", "settlement_date", "interest_of_sale", "sale_participants", "comp_code", "sale_code",
    )


def legal_descriptions(descriptions: DataFrame) -> DataFrame:
    rows = descriptions.filter(~F.col("seen_in_land_values"))
    kept = keep_first(rows, OBSERVED, [newest("date_provided"), oldest("source_id"), oldest("dealing_number")])
    return kept.select(
        "source_id", "effective_date", stable_id("source_id", "property_id", "strata_lot_number").alias("legal_description_id"),
        "property_id", "strata_lot_number", F.col("full_property_description").alias("legal_description"),
        description_kind(F.col("date_provided").cast("date")).alias("legal_description_kind"),
    )


def property_areas(ranked: DataFrame) -> DataFrame:
    rows = ranked.withColumn("sqm_area", area_sqm("area", "area_type")).filter(
        F.col("sqm_area").isNotNull() & ~F.col("seen_in_land_values")
    )
    kept = keep_first(rows, OBSERVED, [newest("date_provided"), oldest("source_id")])
    return kept.select("source_id", *OBSERVED, "sqm_area")


def primary_purposes(ranked: DataFrame, primary_purpose: DataFrame) -> DataFrame:
    rows = ranked.filter(F.col("primary_purpose").isNotNull())
    kept = keep_first(rows, OBSERVED, [newest("date_provided"), oldest("source_id")])
    return kept.join(primary_purpose, ["primary_purpose"], "left").select(
        "source_id", *OBSERVED, "primary_purpose_id"
    )


def natures_of_property(ranked: DataFrame) -> DataFrame:
    rows = ranked.filter(F.col("nature_of_property").isNotNull())
    kept = keep_first(rows, OBSERVED, [newest("date_provided"), oldest("source_id")])
    return kept.select("source_id", *OBSERVED, nature_label("nature_of_property").alias("nature_of_property"))


def zone_observations(ranked: DataFrame) -> DataFrame:
    rows = ranked.filter(
        (F.col("zone_standard") == ZONE_CURRENT)
        & ~F.col("seen_in_land_values")
        & F.col("strata_lot_number").isNull()
    )
    kept = keep_first(rows, ["effective_date", "property_id"], [newest("date_provided"), oldest("source_id")])
    return kept.select("source_id", "effective_date", "property_id", "zone_code")
