"""Classifiers and decoders for the codes found in land records."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone codes.
ZONE_LEGACY = "legacy_vg_2011"
ZONE_CURRENT = "ep&a_2006"
ZONE_UNKNOWN = "unknown"
LEGACY_ZONE_LETTERS = "ABCDEIMNOPRSTUVWXYZ"
CURRENT_ZONE_PREFIXES = ("IN", "MU", "RE", "RU", "SP", "B", "C", "E", "R", "W")

# Nature of property (spelling as published).
NATURE_LABELS = {"V": "Vaccant", "R": "Residence", "3": "Other"}

# Legal descriptions changed form after this date.
DESCRIPTION_CHANGE = date(2004, 8, 17)
KIND_AFTER = "> 2004-08-17"
KIND_INITIAL = "initial"

UNDER_STRATA_TYPE = "UNDERSP"
HERITAGE_BASIS = "6A(1)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zone_standard(code: Column | str) -> Column:
    code = _col(code)
    return (
        F.when(code.isNull() | (code == ""), F.lit(None).cast("string"))
        .when(code.rlike(f"^[{LEGACY_ZONE_LETTERS}]$"), ZONE_LEGACY)
        .when(code.rlike(f"^(?:{'|'.join(CURRENT_ZONE_PREFIXES)})[0-9]$"), ZONE_CURRENT)
        .otherwise(ZONE_UNKNOWN)
    )


def area_sqm(area: Column | str, unit: Column | str) -> Column:
    """Square metres: hectares scaled, metres kept, any other unit NULL."""
    area, unit = _col(area), _col(unit)
    return F.when(unit == "H", area * 10000).when(unit == "M", area)


def nature_label(code: Column | str) -> Column:
    code = _col(code)
    out = F.lit(None).cast("string")
    for key, label in NATURE_LABELS.items():
        out = F.when(code == key, label).otherwise(out)
    return out


def description_kind(provided: Column | str) -> Column:
    return F.when(_col(provided) > F.lit(DESCRIPTION_CHANGE), KIND_AFTER).otherwise(KIND_INITIAL)


def base_parcel_id(folio: Column | str) -> Column:
    """Plan of a strata folio, else the folio with a leading ``DP`` taken off its plan.

    Only the first run of slashes is collapsed, as in the source rules.
    """
    folio = _col(folio)
    one = F.regexp_replace(folio, "^(.*?)//+", "$1/")
    plan = F.regexp_extract(one, "([^/]+)$", 1)
    return F.when(plan.rlike("^SP\\d+$"), plan).otherwise(F.regexp_replace(one, "(^|/)DP([^/]*)$", "$1$2"))


def base_parcel_kind(folio: Column | str) -> Column:
    return F.when(_col(folio).rlike("(^|/)SP\\d+$"), "strata_plan").otherwise("deposit_lot")


def clean_parcel_id(text: Column | str) -> Column:
    """Collapse every run of slashes and drop ``DP`` before plan digits."""
    return F.regexp_replace(F.regexp_replace(_col(text), "/{2,}", "/"), "/DP([0-9]+)", "/$1")


def normalised_id(property_id: Column | str, strata: Column | str) -> Column:
    """Property and strata lot as one comparable key; no lot is -1."""
    return F.struct(
        _col(property_id).alias("property_id"),
        F.coalesce(_col(strata), F.lit(-1)).alias("strata_lot_num"),
    )


def equals_flag(c: Column | str, value: str) -> Column:
    return _col(c) == F.lit(value)
