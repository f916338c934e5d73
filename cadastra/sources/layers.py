"""Boundary layers: select, rename and type the mapped columns of a layer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import as_format
from ..operators.spatial import rings_from_wkb, rings_from_wkt

# Fixed value: country code of rows inside Australia.
HOME_COUNTRY = "AUS"


def _area_codes(year: str, *levels: str) -> dict[str, tuple[str, str]]:
    """Code columns shared by the statistical areas of a release."""
    names = {"gccsa": ("GCCSA_CODE", "gcc_code"), "state": ("STATE_CODE", "state_code")}
    out = {}
    for level in levels:
        source, target = names.get(level, (f"{level.upper()}_CODE", f"{level}_code"))
        out[f"{source}_{year}"] = (target, "text")
    return out


def _main_layer(year: str, own: str, parents: tuple[str, ...], named: bool) -> dict[str, tuple[str, str]]:
    columns = _area_codes(year, own)
    if named:
        source = {"gccsa": "GCCSA_NAME", "state": "STATE_NAME"}.get(own, f"{own.upper()}_NAME")
        target = {"gccsa": "gcc_name", "state": "state_name"}.get(own, f"{own}_name")
        columns[f"{source}_{year}"] = (target, "text")
    columns.update(_area_codes(year, *parents))
    columns["AREA_ALBERS_SQKM"] = ("area_sqkm", "number")
    columns["geometry"] = ("geometry", "geometry")
    return columns


# Main structure: every level carries the codes of the levels above it.
_LEVELS = ("sa1", "sa2", "sa3", "sa4", "gccsa", "state")
MAIN_STRUCTURE = {
    level: _main_layer("2021", level, _LEVELS[i + 1 :], named=level != "sa1") for i, level in enumerate(_LEVELS)
}
MAIN_STRUCTURE["meshblock"] = {
    "MB_CODE_2021": ("mb_code", "text"),
    "MB_CATEGORY_2021": ("mb_cat", "text"),
    **_main_layer("2021", "sa1", _LEVELS[1:], named=False),
}

# Non-main structures: (code column, name column, target prefix).
_OTHER = {
    "lga_2024": ("LGA_CODE_2024", "LGA_NAME_2024", "lga"),
    "lga_2023": ("LGA_CODE_2023", "LGA_NAME_2023", "lga"),
    "lga_2022": ("LGA_CODE_2022", "LGA_NAME_2022", "lga"),
    "lga_2021": ("LGA_CODE_2021", "LGA_NAME_2021", "lga"),
    "sed_2024": ("SED_CODE_2024", "SED_NAME_2024", "electorate"),
    "sed_2022": ("SED_CODE_2022", "SED_NAME_2022", "electorate"),
    "sed_2021": ("SED_CODE_2021", "SED_NAME_2021", "electorate"),
    "ced_2024": ("CED_CODE_2024", "CED_NAME_2024", "electorate"),
    "ced_2021": ("CED_CODE_2021", "CED_NAME_2021", "electorate"),
    "post_code_2021": ("POA_CODE_2021", "POA_NAME_2021", "post"),
    "sal_2021": ("SAL_CODE_2021", "SAL_NAME_2021", "locality"),
    "iloc": ("ILOC_CODE_2021", "ILOC_NAME_2021", "iloc"),
    "iare": ("IARE_CODE_2021", "IARE_NAME_2021", "iare"),
    "ireg": ("IREG_CODE_2021", "IREG_NAME_2021", "ireg"),
}


def other_layer(table: str) -> dict[str, tuple[str, str]]:
    code, name, prefix = _OTHER[table]
    year = code[-4:]
    return {
        code: (f"{prefix}_code", "text"),
        name: (f"{prefix}_name", "text"),
        f"AUS_CODE_{year}": ("in_australia", "home"),
        "AREA_ALBERS_SQKM": ("area_sqkm", "number"),
        "geometry": ("geometry", "geometry"),
    }


DESTINATION_ZONE = {
    "DZN_CODE_2021": ("dzn_code", "text"),
    "SA2_CODE_2021": ("sa2_code", "text"),
    "STATE_CODE_2021": ("state_code", "text"),
    "AUS_CODE_2021": ("in_australia", "home"),
    "AREA_ALBERS_SQKM": ("area_sqkm", "number"),
    "geometry": ("geometry", "geometry"),
}


def _convert(df: DataFrame, column: str, fmt: str) -> Column:
    c = F.col(f"`{column}`")
    if fmt == "home":
        return F.coalesce(c == HOME_COUNTRY, F.lit(False))
    if fmt == "geometry":
        kind = df.schema[column].dataType.typeName()
        if kind == "string":
            return rings_from_wkt(c)
        if kind == "binary":
            return rings_from_wkb(c)
        return c
    return as_format(c, fmt)


def conform(df: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """``mapping``: source column to (target column, format: text, number, bool, home, timestamp_ms, geometry)."""
    return df.select(*[_convert(df, source, fmt).alias(target) for source, (target, fmt) in mapping.items()])
