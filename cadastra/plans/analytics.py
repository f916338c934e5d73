"""Analytic questions over the derived tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import HERITAGE_BASIS, equals_flag
from ..functions.text import house_label, joined, level_label, street_label
from ..functions.values import blended_score, value_per_sqm
from ..operators.aggregates import (
    calendar_counts,
    equal_segments,
    global_rank,
    group_percentile,
    varying_groups,
)
from ..operators.history import as_of, first_sighting, latest, page
from ..operators.joins import first_match, match_report, unseen
from ..operators.keys import keep_first, newest, oldest
from ..operators.spatial import geodesic_area, intersects_join, overlap_join
from ..session import cut_lineage


def named_area(areas: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Areas whose name equals one of the given, letter case aside."""
    return areas.filter(F.lower(column).isin([n.lower() for n in names]))


def _latest_values(valuations: DataFrame) -> DataFrame:
    rows = valuations.filter(F.col("land_value").isNotNull())
    return latest(rows, ["property_id"], "effective_date", ["source_id"]).select("property_id", "land_value")


def values_inside(property_geometry: DataFrame, area: DataFrame, valuations: DataFrame, cell: float) -> DataFrame:
    """Latest land value of every property touching an area (geometry column ``area_geometry``)."""
    inside = intersects_join(property_geometry, area, "geometry", "area_geometry", cell)
    return inside.select("property_id", "geometry").join(_latest_values(valuations), "property_id")


def ranked_values(
    property_geometry: DataFrame, area: DataFrame, valuations: DataFrame, cell: float, share: float = 0.5
) -> DataFrame:
    """Value per square metre with rank, for properties lying mostly in an area."""
    inside = overlap_join(property_geometry, area, "geometry", "area_geometry", cell, share)
    valued = inside.select("property_id", "geometry").join(_latest_values(valuations), "property_id")
    per_sqm = valued.withColumn("per_sqm", F.col("land_value") / geodesic_area("geometry")).drop("land_value")
    return global_rank(per_sqm, "per_sqm")


def zoning_as_of(zones: DataFrame, cutoffs: Sequence[date], properties: Sequence | None = None) -> DataFrame:
    """Zone of each property on each day, by first sighting of the zone."""
    rows = zones if properties is None else zones.filter(F.col("property_id").isin(list(properties)))
    sighted = first_sighting(rows, ["property_id", "zone_code"], "effective_date", ["source_id"])
    return as_of(sighted, ["property_id"], "effective_date", cutoffs, ["zone_code"])


def values_as_of(
    valuations: DataFrame,
    areas: DataFrame | None,
    years: Sequence[int],
    properties: Sequence | None = None,
) -> DataFrame:
    """Land value on 1 January of each year with heritage flag; per square metre when areas are given."""
    rows = valuations if properties is None else valuations.filter(F.col("property_id").isin(list(properties)))
    rows = rows.withColumn("heritage", equals_flag("valuation_basis", HERITAGE_BASIS))
    if areas is not None:
        whole = areas.filter(F.col("strata_lot_number").isNull()).select("property_id", "source_id", "sqm_area")
        sized = first_match(rows, whole, ["property_id", "source_id"], [oldest("sqm_area")])
        rows = sized.withColumn("land_value", F.col("land_value") / F.nullif("sqm_area", F.lit(0.0)))
    snaps = as_of(rows, ["property_id"], "valuation_base_date", [date(y, 1, 1) for y in years], ["source_id"])
    return snaps.select(F.year("cutoff").alias("year"), "property_id", "valuation_base_date", "land_value", "heritage")


def parcel_values(
    block_area: DataFrame,
    properties: DataFrame,
    parcel_links: DataFrame,
    parcel_blocks: DataFrame,
    valuations: DataFrame,
    in_hectares: Sequence = (),
    steps: Sequence[int] = (10,),
) -> DataFrame:
    """Value per square metre of every (property, parcel) inside the given blocks."""
    linked = properties.join(parcel_links, "property_id").join(parcel_blocks, "land_parcel_id").join(
        block_area.select("mb_code").distinct(), "mb_code"
    )
    single = keep_first(linked, ["property_id", "land_parcel_id"], [oldest("mb_code")])
    newest_value = latest(valuations, ["property_id"], "base_date", ["land_value"]).select("property_id", "land_value")
    per_m2 = value_per_sqm("land_value", "area", "property_id", in_hectares, steps)
    return single.join(newest_value, "property_id", "left").withColumn("per_m2", per_m2)


def best_parcels(
    valued: DataFrame,
    percentile: float,
    linear_share: float,
    one_per: str = "mb_code",
    order: str = "value",
    zone_codes: Sequence[str] | None = None,
) -> DataFrame:
    """One row per block (or property): the lowest value, or the one nearest below the block's percentile.

    ``order``: ``value`` (ascending per_m2) or ``distance`` (percentile - per_m2; distances equal to a millionth are ties).
    """
    # Read twice below: written once.
    valued = cut_lineage(valued, "parcel-values")
    share = group_percentile(valued, ["mb_code"], "per_m2", percentile, "per_m2_percentile")
    rows = valued.filter(F.col("per_m2").isNotNull())
    if zone_codes is not None:
        rows = rows.filter(F.col("zone_code").isin(list(zone_codes)))
    rows = rows.join(share, "mb_code").withColumn("score", blended_score("land_value", linear_share))
    by = F.col("per_m2") if order == "value" else F.round(F.col("per_m2_percentile") - F.col("per_m2"), 6)
    return keep_first(rows.withColumn("_by", by), [one_per], [oldest("_by"), oldest("property_id"), oldest("land_parcel_id")]).drop("_by")


def blocks_mostly_in(
    blocks: DataFrame, regions: DataFrame, column: str, names: Sequence[str], cell: float, share: float = 0.5
) -> DataFrame:
    """Blocks (``mb_code, geometry``) with more than ``share`` of their area in a named region (``area_geometry``), once each."""
    chosen = named_area(regions, column, names).select("area_geometry")
    inside = overlap_join(blocks.select("mb_code", "geometry"), chosen, "geometry", "area_geometry", cell, share)
    # Regions may overlap: a block counts once.
    return keep_first(inside.select("mb_code", "geometry", "share"), ["mb_code"], [newest("share")]).drop("share")


def parcel_blocks(address_detail: DataFrame, address_block: DataFrame, block: DataFrame) -> DataFrame:
    """The blocks a parcel has addresses in: parcel, address, block id, block code."""
    chain = (
        address_detail.select("address_detail_pid", F.col("legal_parcel_id").alias("land_parcel_id"))
        .filter(F.col("land_parcel_id").isNotNull())
        .join(address_block.select("address_detail_pid", "mb_pid"), "address_detail_pid")
        .join(block.select("mb_pid", "mb_code"), "mb_pid")
    )
    return chain.select("land_parcel_id", "mb_code").distinct()


def described_parcels(
    best: DataFrame, descriptions: DataFrame, streets: DataFrame, suburbs: DataFrame, blocks: DataFrame
) -> DataFrame:
    """The chosen parcels with description, street and suburb names, and the geometry of their block.

    What is not known is null; of several descriptions the first in order of text is shown.
    """
    one = keep_first(descriptions.select("property_id", "property_description"), ["property_id"], [oldest("property_description")])
    return (
        best.join(one, "property_id", "left")
        .join(streets.select("street_id", F.col("street_name").alias("street")), "street_id", "left")
        .join(suburbs.select("suburb_id", F.col("suburb_name").alias("suburb")), "suburb_id", "left")
        .join(blocks.select("mb_code", "geometry"), "mb_code")
        .select(
            "mb_code", "property_description", "land_parcel_id", "property_name", "property_id", "zone_code",
            F.col("score").alias("rank"), "per_m2", "land_value", "area", F.col("unit_number").alias("unit"),
            F.col("house_number").alias("house"), "street", "suburb", "postcode", "geometry",
        )
    )


def best_parcels_in(
    tables: dict[str, DataFrame],
    regions: Sequence[str],
    percentile: float,
    linear_share: float,
    cell: float,
    in_hectares: Sequence = (),
    one_per: str = "mb_code",
    order: str = "value",
    zone_codes: Sequence[str] | None = None,
) -> DataFrame:
    """The whole question: blocks lying mostly in named regions, parcels in them, the best parcel per block or property.

    Tables: ``mesh_block, region, property, land_parcel_link, address_detail,
    address_mesh_block, mb, valuation, property_description, street, suburb``.
    """
    t = tables
    # Read for the choice of parcels and again for their geometry.
    blocks = cut_lineage(blocks_mostly_in(t["mesh_block"], t["region"], "region_name", regions, cell), "chosen-blocks")
    places = parcel_blocks(t["address_detail"], t["address_mesh_block"], t["mb"])
    valued = parcel_values(blocks, t["property"], t["land_parcel_link"], places, t["valuation"], in_hectares)
    best = best_parcels(valued, percentile, linear_share, one_per, order, zone_codes)
    return described_parcels(best, t["property_description"], t["street"], t["suburb"], blocks)


def top_value_per_block(valued: DataFrame) -> DataFrame:
    """The dearest parcel of each block; an unknown value sorts first, as in the source query."""
    return keep_first(valued, ["mb_code"], [newest("per_m2"), oldest("property_id"), oldest("land_parcel_id")])


def addresses_wide(detail: DataFrame, street: DataFrame, locality: DataFrame, state: DataFrame) -> DataFrame:
    """Address details with street, locality and state columns."""
    return detail.join(street, "street_locality_pid").join(locality, "locality_pid").join(state, "state_pid")


def blocks_touched(
    wide: DataFrame, blocks: DataFrame, localities: Sequence[str], streets: Sequence[str] | None = None, number=None
) -> DataFrame:
    """Distinct blocks holding an address that meets the filters."""
    rows = wide.filter(F.col("locality_name").isin(list(localities)))
    if streets is not None:
        rows = rows.filter(F.col("street_name").isin(list(streets)))
    if number is not None:
        rows = rows.filter(F.col("number_first") == number)
    return rows.select("address_detail_pid").join(blocks, "address_detail_pid").drop("address_detail_pid").distinct()


def composed_addresses(wide: DataFrame, where: Column | None = None) -> DataFrame:
    """Lot, unit, level and house labels of the addresses meeting a filter."""
    rows = wide if where is None else wide.filter(where)
    return rows.select(
        "address_detail_pid",
        "legal_parcel_id",
        joined("lot_number_prefix", "lot_number", "lot_number_suffix").alias("lot"),
        joined("flat_number_prefix", "flat_number", "flat_number_suffix").alias("unit"),
        level_label("level_type_code", "level_number_prefix", "level_number", "level_number_suffix").alias("level"),
        house_label(
            "number_first_prefix", "number_first", "number_first_suffix",
            "number_last_prefix", "number_last", "number_last_suffix",
        ).alias("house"),
        "street_name",
        "locality_name",
        "postcode",
    )


def street_aliases(street: DataFrame, alias: DataFrame, types: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Full names of streets and of their aliases."""

    def full(df: DataFrame, out: str) -> DataFrame:
        named = df.join(types.select(F.col("code").alias("street_type_code"), F.col("name").alias("_t")), "street_type_code", "left")
        named = named.join(
            suffixes.select(F.col("code").alias("street_suffix_code"), F.col("name").alias("_s")), "street_suffix_code", "left"
        )
        return named.select("street_locality_pid", street_label("street_name", "_t", "_s").alias(out))

    return full(street, "street_label").join(full(alias, "alias_label"), "street_locality_pid", "left").distinct()


def duplicate_lots(lot_layer: DataFrame) -> DataFrame:
    """Lots published with differing areas, widest spread first."""
    return varying_groups(lot_layer, ["lot_id_string"], "shape_area", "area_variance").orderBy(
        F.col("area_variance").desc(), newest("last_update"), oldest("object_id")
    )


def observation_counts(df: DataFrame, day: str, first: date, end: date) -> DataFrame:
    rows = df.filter((F.col(day) > F.lit(first)) & (F.col(day) < F.lit(end)))
    return calendar_counts(rows, day)


def observation_segments(df: DataFrame, day: str, n: int = 8) -> DataFrame:
    return equal_segments(df, day, n)


def find_text(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def earliest(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    return page(df, order, 0, n)


def merge_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Counts of a left merge and the rows that found no partner."""
    return match_report(left, right, keys), unseen(left, right, keys)


def sub_areas(areas: DataFrame, region: DataFrame, cell: float, columns: Sequence[str]) -> DataFrame:
    """Distinct areas touching a region (geometry column ``area_geometry``)."""
    return intersects_join(areas, region, "geometry", "area_geometry", cell).select(*columns).distinct()
