"""Legal descriptions to parcels, titles, permits and residue.

The parcel list at the head of a description is a regular language, so one
anchored pattern measures it and one pattern cuts it into groups; a group is
either one parcel (``PT 1/123``), several lots sharing a plan
(``1, PT 2, 3/313``, ``1, CP/SP 23170``) or a part strata plan.  Everything
stays in native expressions; long descriptions are safe because every
repetition is possessive.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import legal_patterns as lp
from ..functions.codes import KIND_AFTER, base_parcel_id, base_parcel_kind
from ..session import cut_lineage
from .hold import hold
from .keys import keep_first

_LOT = r"[A-Za-z0-9]{1,5}"
_PART = r"(?:PT )?"
_STRATA = r"CP//?SP \d+"
_SHARED_PLAN = r"(?!CP//?SP(?: |$))[A-Za-z0-9]*/[A-Za-z0-9]*(?:/[A-Za-z0-9]*)?"
_GROUP = (
    rf"(?:{_PART}{_LOT}/(?:\w+/|/)?(?:SP)?\d+(?= |$)"
    rf"|(?:{_PART}{_LOT}, )++{_PART}(?:{_STRATA}|{_SHARED_PLAN})(?= |$)"
    rf"|PT {_STRATA}(?= |$))"
)
PARCEL_LIST = rf"^(?:{_GROUP}(?: |$))*+"
# Lots and a PT left without a plan behind the list are read but give nothing.
DANGLING = rf"^(?:{_PART}{_LOT},(?: |$))*+(?:PT(?: |$))?+"
PARCEL_GROUP = rf"(?<![^ ]){_GROUP}"

ITEM = "struct<kind:string,id:string,id_b:string,part:boolean>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _one_space(text: Column) -> Column:
    """Every run of white space as one blank; text already in that form is left alone."""
    return F.regexp_replace(text, r"(?U)\s{2,}|[\s&&[^ ]]", " ")


def mark(text: Column | str) -> Column:
    """Put the stop mark before wording the parcel reader must not enter."""
    out = _col(text)
    for words, pattern, replacement in lp.MARK_BEFORE:
        out = F.when(F.contains(out, F.lit(words)), F.regexp_replace(out, pattern, replacement)).otherwise(out)
    return _one_space(out)


def _folios_of(parcel_list: Column) -> Column:
    """All folio ids of a parcel list in order, with their part flag."""

    def folios(group: Column) -> Column:
        pieces = F.split(group, ", ")
        plan = F.regexp_replace(F.regexp_extract(F.element_at(pieces, -1), "(/.*)$", 1), " ", "")

        def lot(piece: Column) -> Column:
            return F.regexp_extract(piece, "^(?:PT )?([^/]*)", 1)

        named = F.filter(pieces, lambda piece: lot(piece) != "")
        return F.transform(
            named,
            lambda piece: F.struct(F.concat(lot(piece), plan).alias("id"), piece.startswith("PT ").alias("part")),
        )

    groups = F.regexp_extract_all(parcel_list, F.lit(PARCEL_GROUP), F.lit(0))
    return F.flatten(F.transform(groups, folios))


def expand_parcels(df: DataFrame, text: str, folios: str = "folios", remains: str = "remains") -> DataFrame:
    """Add the folios heading ``text`` and the text behind them."""
    listed = F.regexp_extract(F.col(text), PARCEL_LIST, 0)
    with_list = df.withColumn("_list", listed)
    rest = F.substr(F.col(text), F.length("_list") + 1)
    with_rest = with_list.withColumn("_rest", rest)
    return (
        with_rest.withColumn(folios, _folios_of(F.col("_list")))
        .withColumn(remains, F.regexp_replace("_rest", DANGLING, ""))
        .drop("_list", "_rest")
    )


def _quoted(text: str) -> str:
    return f'r"{text}"'


def _gate(pattern: str) -> str:
    """Cheap test that must hold before a pattern is worth trying: its leading literal words."""
    ignore_case = pattern.startswith("(?i)")
    words = re.match(r"[A-Za-z -]+", pattern.removeprefix("(?i)")).group(0).rstrip(" ")
    if ignore_case:
        return f"contains(lower(_text), '{words.lower()}')"
    return f"contains(_text, '{words}')"


def _take(source: str, keep: str, kind: str, pattern: str, id_: int | None, id_b: int | None, part) -> str:
    """SQL step: append every match as an item and cut it out of the text."""
    rx, gate = _quoted(pattern), _gate(pattern)

    def group(number: int | None) -> str:
        return "CAST(NULL AS STRING)" if number is None else f"nullif(regexp_extract(m, {rx}, {number}), '')"

    flag = "true" if part is True else "false" if part is None else f"{group(part)} IS NOT NULL"
    item = f"named_struct('kind', '{kind}', 'id', {group(id_)}, 'id_b', {group(id_b)}, 'part', {flag})"
    return f"""SELECT {keep},
      CASE WHEN {gate} THEN concat(items, transform(regexp_extract_all(_text, {rx}, 0), m -> {item})) ELSE items END AS items,
      CASE WHEN {gate} THEN regexp_replace(_text, {rx}, '') ELSE _text END AS _text
      FROM ({source})"""


def parse_descriptions(df: DataFrame, text: str = "legal_description") -> DataFrame:
    """Add ``items`` (parcels first, then labelled ids in pattern order) and ``remains``.

    The patterns form one chain of projections inside a single narrow stage;
    a pattern is only tried on texts holding its leading words.
    """
    out = df.withColumn("_marked", mark(text))
    out = expand_parcels(out, "_marked", "_folios", "_behind")
    parcels = F.transform(
        "_folios",
        lambda f: F.struct(
            F.lit("folio").alias("kind"), f["id"].alias("id"), F.lit(None).cast("string").alias("id_b"), f["part"].alias("part")
        ),
    )
    rest = F.replace(F.col("_behind"), F.lit(lp.MARK), F.lit(""))
    for pattern in lp.IGNORE_BEFORE:
        rest = F.regexp_replace(rest, pattern, "")
    start = out.select(*df.columns, parcels.cast(f"array<{ITEM}>").alias("items"), rest.alias("_text"))

    keep = ", ".join(f"`{c}`" for c in df.columns)
    chain = "SELECT * FROM {start}"
    for kind, pattern in lp.LABELLED_IDS:
        chain = _take(chain, keep, kind, pattern, 1, None, None)
    for kind, pattern, first, second, part in lp.NAMED_GROUPS:
        chain = _take(chain, keep, kind, pattern, first, second, part)
    for kind, pattern in lp.FLAGS:
        chain = _take(chain, keep, kind, pattern, None, None, None)
    taken = df.sparkSession.sql(chain, start=start)

    rest = F.col("_text")
    for pattern in lp.IGNORE_AFTER:
        rest = F.regexp_replace(rest, pattern, "")
    rest = F.when(F.trim("_text") == "", F.col("_text")).otherwise(rest)
    cleaned = taken.withColumn("_rest", _one_space(rest))
    # A filter on the results would be copied through the chain, doubling at every step.
    remains = F.when(F.col("_rest") == " ", "").otherwise(F.col("_rest"))
    return cleaned.select(*df.columns, hold(F.col("items")).alias("items"), hold(remains).alias("remains"))


def split_folio(folio: Column | str) -> Column:
    """Checked parts of a folio id: struct(id, lot, section, plan), NULL when invalid."""
    folio = _col(folio)
    slashes = F.length(folio) - F.length(F.replace(folio, F.lit("/"), F.lit("")))
    three = F.when(slashes == 1, F.replace(folio, F.lit("/"), F.lit("//"))).otherwise(folio)
    parts = F.split(three, "/")
    lot, section, plan = parts[0], parts[1], parts[2]
    valid = (
        slashes.between(1, 2)
        & plan.rlike(r"^(?:SP)?\d+$")
        & (F.length(plan) <= lp.MAX_PLAN)
        & lot.rlike(r"^\w+$")
        & (F.length(lot) <= lp.MAX_LOT)
        & ((section == "") | (section.rlike(r"^\w+$") & (F.length(section) <= lp.MAX_SECTION)))
    )
    return F.when(
        valid,
        F.struct(
            F.replace(folio, F.lit("//"), F.lit("/")).alias("id"),
            lot.alias("lot"),
            F.nullif(section, F.lit("")).alias("section"),
            plan.alias("plan"),
        ),
    )


def assemble(items: Column | str) -> Column:
    """struct(complete, partial, folios, enclosure_permits) of parsed items."""
    items = _col(items)
    folios = F.filter(items, lambda i: i["kind"] == "folio")

    def ids(part: bool) -> Column:
        return F.transform(F.filter(folios, lambda i: i["part"] == part), lambda i: split_folio(i["id"]))

    permits = F.transform(F.filter(items, lambda i: i["kind"] == "enclosure_permit"), lambda i: i["id"])
    return F.struct(
        ids(False).alias("complete"),
        ids(True).alias("partial"),
        F.array_distinct(F.concat(ids(False), ids(True))).alias("folios"),
        permits.alias("enclosure_permits"),
    )


def derive_parcels(
    descriptions: DataFrame, save: Callable[[DataFrame, str], DataFrame] = cut_lineage
) -> dict[str, DataFrame]:
    """base_parcel, folio, property_folio, remains and rejects of legal descriptions.

    Descriptions are parsed once, in one narrow stage, and written; each result
    is then a small reduction over the exploded folios.
    """
    scope = descriptions.filter(
        (F.col("legal_description_kind") == KIND_AFTER) & F.col("strata_lot_number").isNull()
    )
    parsed = save(
        parse_descriptions(scope).select(
            "source_id", "effective_date", "legal_description_id", "property_id", "items", "remains"
        ),
        "parsed-descriptions",
    )
    rows = (
        parsed.select("source_id", "effective_date", "property_id", F.explode("items").alias("item"))
        .filter(F.col("item.kind") == "folio")
        .withColumn("f", split_folio("item.id"))
    )
    folios = rows.filter(F.col("f").isNotNull()).select(
        "source_id",
        "effective_date",
        "property_id",
        F.col("f.id").alias("folio_id"),
        F.col("f.plan").alias("folio_plan"),
        F.col("f.section").alias("folio_section"),
        F.col("f.lot").alias("folio_lot"),
        base_parcel_id("f.id").alias("base_parcel_id"),
        base_parcel_kind("f.id").alias("base_parcel_kind"),
        F.col("item.part").alias("partial"),
    )
    folio = folios.select("folio_id", "folio_plan", "folio_section", "folio_lot", "base_parcel_id").distinct()
    links = folios.select("source_id", "effective_date", "property_id", "folio_id", "base_parcel_id", "partial")
    # A whole folio belongs to one property per day; a part may be shared.
    owner = F.when(F.col("partial"), F.col("property_id"))
    property_folio = keep_first(
        links.withColumn("_owner", owner),
        ["folio_id", "effective_date", "partial", "_owner"],
        ["source_id", "property_id"],
    ).drop("_owner")
    return {
        "base_parcel": folios.select("base_parcel_id", "base_parcel_kind").distinct(),
        "folio": folio,
        "property_folio": property_folio,
        "legal_description_remains": parsed.filter(F.col("remains") != "").select(
            "legal_description_id", F.col("remains").alias("legal_description_remains")
        ),
        "enclosure_permit": parsed.select(
            "source_id", "effective_date", "property_id",
            F.explode(assemble("items")["enclosure_permits"]).alias("enclosure_permit"),
        ),
        "folio_rejects": rows.filter(F.col("f").isNull()).select(
            "source_id", "property_id", F.col("item.id").alias("folio_id")
        ),
    }
