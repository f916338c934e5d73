"""Localities, streets and property addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import normalised_id
from ..functions.text import address_line, upper_name
from ..functions.values import first_date
from ..operators.history import latest
from ..operators.joins import union_parents, with_dimension
from ..operators.keys import keep_first, newest, oldest, small_id
from .provenance import sourced_land_values, with_source


def _locality_id(name: Column) -> Column:
    return F.when(name.isNotNull(), small_id(name))


def _named(df: DataFrame, street: str, locality: str) -> DataFrame:
    """Upper-case names and their ids.

    The ids are functions of the names and the dimensions hold every name that
    occurs, so a fact needs no lookup; a street without locality has no id.
    """
    named = df.withColumn("street_name", upper_name(street)).withColumn("locality_name", upper_name(locality))
    with_locality = named.withColumn("locality_id", _locality_id(F.col("locality_name")))
    known = F.col("street_name").isNotNull() & F.col("locality_id").isNotNull()
    return with_locality.withColumn("street_id", F.when(known, small_id("street_name", "locality_id")))


def from_land_values(land_value_row: DataFrame) -> DataFrame:
    rows = _named(sourced_land_values(land_value_row), "street_name", "suburb_name")
    return rows.select(
        "source_id",
        F.col("source_date").alias("effective_date"),
        "property_id",
        F.lit(None).cast("int").alias("strata_lot_number"),
        "property_name",
        "unit_number",
        F.col("house_number").alias("street_number"),
        "street_id",
        "locality_id",
        "street_name",
        "locality_name",
        "postcode",
    )


def from_sales(ps_row_b: DataFrame) -> DataFrame:
    """Latest provided address per (property, strata lot, effective date)."""
    rows = _named(with_source(ps_row_b), "street_name", "locality_name").withColumn(
        "effective_date", first_date("contract_date", "settlement_date")
    )
    chosen = keep_first(
        rows.filter(F.col("property_id").isNotNull()),
        ["property_id", "strata_lot_number", "effective_date"],
        [newest("date_provided"), oldest("source_id")],
    )
    return chosen.select(
        "source_id",
        "effective_date",
        "property_id",
        "strata_lot_number",
        "property_name",
        "unit_number",
        F.col("house_number").alias("street_number"),
        "street_id",
        "locality_id",
        "street_name",
        "locality_name",
        "postcode",
    )


def localities(land_value_row: DataFrame, ps_row_b: DataFrame) -> DataFrame:
    names = union_parents(
        [
            land_value_row.select(upper_name("suburb_name").alias("locality_name")),
            ps_row_b.select(upper_name("locality_name").alias("locality_name")),
        ]
    )
    return (
        names.filter(F.col("locality_name").isNotNull())
        .distinct()
        .select(small_id("locality_name").alias("locality_id"), "locality_name")
    )


def streets(land_value_row: DataFrame, ps_row_b: DataFrame) -> DataFrame:
    names = union_parents(
        [
            land_value_row.select(upper_name("street_name").alias("s"), upper_name("suburb_name").alias("l")),
            ps_row_b.select(upper_name("street_name").alias("s"), upper_name("locality_name").alias("l")),
        ]
    ).filter(F.col("s").isNotNull()).distinct()
    located = names.withColumn("locality_id", _locality_id(F.col("l")))
    return located.select(
        small_id(F.col("s"), F.col("locality_id")).alias("street_id"), F.col("s").alias("street_name"), "locality_id"
    )


ADDRESS = [
    "source_id", "effective_date", "property_id", "strata_lot_number", "property_name", "unit_number",
    "street_number", "street_id", "locality_id", "postcode",
]


def addresses(land_value_row: DataFrame, ps_row_b: DataFrame) -> DataFrame:
    rows = union_parents([from_land_values(land_value_row), from_sales(ps_row_b)])
    return rows.select(*ADDRESS)


def full_addresses(address: DataFrame, street: DataFrame, locality: DataFrame) -> DataFrame:
    """The latest address per normalised property id with its names and one-line form."""
    keyed = address.withColumn("_lot", F.coalesce("strata_lot_number", F.lit(-1)))
    current = latest(keyed, ["property_id", "_lot"], "effective_date", ["source_id"]).drop("_lot")
    on_street = with_dimension(current, street, ["street_id", "locality_id"], "source_id")
    named = with_dimension(on_street, locality, ["locality_id"], "source_id")
    return named.select(
        "property_id",
        "strata_lot_number",
        normalised_id("property_id", "strata_lot_number").alias("normalised_property_id"),
        "property_name",
        "unit_number",
        "street_number",
        "street_name",
        "locality_name",
        "postcode",
        address_line("street_number", "street_name", "locality_name", "postcode").alias("address"),
    )
