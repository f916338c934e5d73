"""Dimensions taken from the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import ZONE_CURRENT
from ..operators.joins import distinct_union
from ..operators.keys import small_id


def zones(land_value_row: DataFrame, ps_row_b: DataFrame) -> DataFrame:
    current = F.col("zone_standard") == ZONE_CURRENT
    return distinct_union(
        [(land_value_row.filter(current), "zone_code"), (ps_row_b.filter(current), "zone_code")], "zone_code"
    )


def primary_purposes(ps_row_b: DataFrame) -> DataFrame:
    return distinct_union([(ps_row_b, "primary_purpose")], "primary_purpose").select(
        small_id("primary_purpose").alias("primary_purpose_id"), "primary_purpose"
    )


def valuation_districts(
    land_value_row: DataFrame, ps_row_b_legacy: DataFrame, ps_row_a: DataFrame, ps_row_b: DataFrame
) -> DataFrame:
    """Every district code, named from any row that has a name (the first by text)."""
    codes = distinct_union(
        [(df, "district_code") for df in (land_value_row, ps_row_b_legacy, ps_row_a, ps_row_b)], "district_code"
    )
    names = land_value_row.groupBy("district_code").agg(F.min("district_name").alias("valuation_district_name"))
    return codes.join(names, "district_code", "left").withColumnRenamed("district_code", "valuation_district_code")


def properties(land_value_row: DataFrame, ps_row_b: DataFrame, ps_row_b_legacy: DataFrame) -> DataFrame:
    return distinct_union(
        [(df, "property_id") for df in (land_value_row, ps_row_b, ps_row_b_legacy)], "property_id"
    )
