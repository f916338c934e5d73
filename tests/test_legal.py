import re

import pytest

from cadastra.functions.legal_patterns import FLAGS, IGNORE_AFTER, IGNORE_BEFORE, LABELLED_IDS, NAMED_GROUPS
from cadastra.operators.legal import derive_parcels, expand_parcels, parse_descriptions, split_folio


def whole(*ids):
    return [("folio", i, None, False) for i in ids]


def part(*ids):
    return [("folio", i, None, True) for i in ids]


def item(kind, id_=None, id_b=None, part_=False):
    return [(kind, id_, id_b, part_)]


PARCEL_LISTS = [
    ("88//4410", "", [("88//4410", False)]),
    ("88/4410", "", [("88/4410", False)]),
    ("PT 88/4410", "", [("88/4410", True)]),
    ("7/bc/650", "", [("7/bc/650", False)]),
    ("30, 31/650", "", [("30/650", False), ("31/650", False)]),
    ("30, PT 31, 32/650", "", [("30/650", False), ("31/650", True), ("32/650", False)]),
    ("30, PT 31/650 PT 9, 8/770", "", [("30/650", False), ("31/650", True), ("9/770", True), ("8/770", False)]),
    ("PT 5/61 PT 6/62 PT 7/63", "", [("5/61", True), ("6/62", True), ("7/63", True)]),
    # Lots and a PT without plan are read and lost.
    ("12/44 19, 20 beside", "20 beside", [("12/44", False)]),
    ("12/44 PT beside", "beside", [("12/44", False)]),
    ("40, 41,", "", []),
    ("999999/3 words", "999999/3 words", []),
    ("8, CP/SP six", "CP/SP six", []),
    ("PT CP//SP 77 5/6", "", [("CP//SP77", True), ("5/6", False)]),
    ("", "", []),
]

# Our own wording for each pattern: (phrase, items it holds).
WORDINGS = [
    ("Wind Farm WF77", item("wind_farm", "WF77")),
    ("Consolidated Mining Lease 81", item("consolidated_mining_lease", "81")),
    ("Public Reserve R1234", item("public_reserve", "R1234")),
    ("Perpetual Lease 1901/44", item("perpetual_lease", "1901/44")),
    ("Mining Permit 302", item("mining_lease", "302")),
    ("Telstra Site Number 5150", item("telstra_site", "5150")),
    ("Mineral Claim 6060", item("mineral_claim", "6060")),
    ("Western Land Lease 9911", item("western_land_lease", "9911")),
    ("Railway Land Lease 310.44", item("railway_land_lease", "310.44")),
    ("Railway Land Lease 12/345/67", item("railway_land_lease", "12/345/67")),
    ("Stock Watering Place 18", item("stock_watering_place", "18")),
    ("Special Lease 1966/7", item("special_lease", "1966/7")),
    ("Forest Permit F9", item("forest_permit", "F9")),
    ("Enclosure Permit 70/2", item("enclosure_permit", "70/2")),
    ("Non-Irrigable Purchase 21", item("non_irrigable_purchase", "21")),
    ("NSW Maritime 4000/8", item("nsw_maritime", "4000/8")),
    ("Housing PRN H/22", item("housing_prn", "H/22")),
    ("crown roads Licence 808080", item("crown_roads_licence", "808080")),
    ("Licence 909090", item("crown_land_licence", "909090")),
    ("BUS DEPOT LEASE B4", item("bus_depot_lease", "B4")),
    ("STATE heritage Listing No 515", item("state_heritage", "515")),
    ("State Heritage Register SHR NO. 616", item("state_heritage", "616")),
    ("state heritage registrar 717", item("state_heritage", "717")),
    ("SUBJECT TO SHRL No 818", item("state_heritage", "818")),
    ("Permissive Occupancy 1971/3", item("permissive_occupancy", "1971/3")),
    ("Railcorp. File: RC88", item("railcorp_file", "RC88")),
    ("Domestic Waterfront Occupancy D5", item("domestic_waterfront", "D5")),
    ("Occupation Permit PB 5/6", item("occupancy_permit", "5/6")),
    ("Occupation Permit 7/8", item("occupancy_permit", "7/8")),
    ("Occupancy Permit 9/10", item("occupancy_permit", "9/10")),
    ("Crown Reserve CR3", item("crown_reserve", "CR3")),
    ("Part Crown Plan 71-72", item("crown_plan", "71", "72", True)),
    ("Crown Plan 73-74", item("crown_plan", "73", "74")),
    ("Crown Plan 75-76 (Part)", item("crown_plan", "75", "76", True)),
    ("MINING PURPOSE LEASE 91", item("mining_lease", "91")),
    ("mining lease 92 (Part)", item("mining_lease", "92", None, True)),
    ("Consolidated Coal Lease 93", item("consolidated_coal_lease", "93")),
    ("coal lease 94 (part)", item("coal_lease", "94", None, True)),
    ("Mineral Lease 95", item("mineral_lease", "95")),
    ("Lease Number 61 TO 64", item("lease_number", "61", "64")),
    ("Lease Number 65 - 66", item("lease_number", "65", "66")),
    ("Lease Number 67/68", item("lease_number", "67/68")),
    ("Site S9 of Sydney Ports Corporation Plan Q7", item("sydney_ports_plan", "S9", "Q7")),
    ("DRAINAGE RESERVE", item("drainage_reserve")),
]
# Phrases that say nothing and go without a trace.
SILENT = [
    "Licence for grazing", "nsw maritime lease of 55 sqm", "Subsurface Area = 17.25 HA", "TOTAL SUSURFACE = 9HA",
    "UNDEFINED ROAD RESERVE", "& Road Reserve", "Crown Road", "the Wanganella Wildlife Refuge no 5",
    "Coonong wildlife refuge 8", "Partly limited in height but unlimited in depth", "unlimited in depth & limtied in height",
    "Limited in depth", "lease attached to property", "limited in stratum", "least ove property", "property over lease",
    "subsurface only", "Lot 12 DP 34 mineral only", "coal only plan - K8", "share use", "SHARED USE",
    "excluding surface land valued on occupation", "Unleased floor space area",
]

DESCRIPTIONS = (
    [(f"PT 14, 15/60606 {phrase}", "", part("14/60606") + whole("15/60606") + items) for phrase, items in WORDINGS]
    + [(f"15/60606 {phrase}", "", whole("15/60606")) for phrase in SILENT]
    + [
        (f"{phrase} in words; Enclosure Permit 3", f"{phrase} in words; ", item("enclosure_permit", "3"))
        for phrase in ("PART", "beside the weir")
    ]
    + [
        # Wording that only looks like a parcel is left standing.
        ("3/9009 HCP77/1", "HCP77/1", whole("3/9009")),
        ("3/9009 PM1999/04", "PM1999/04", whole("3/9009")),
        ("3/9009 PTARC/ARC7", "PTARC/ARC7", whole("3/9009")),
        ("3/9009 (near lot 4/9009)", "(near lot 4/9009)", whole("3/9009")),
        ("3/9009 44.12/QRS", "44.12/QRS", whole("3/9009")),
        ("/5050 by the creek", "/5050 by the creek", []),
        ("60, 61, /5050", "", whole("60/5050", "61/5050")),
        ("60, 61, CP/SP 5151 2/88", "", whole("60/SP5151", "61/SP5151", "CP/SP5151", "2/88")),
        # Two of a kind, and kinds in the order of their patterns rather than of the text.
        ("3/9009 Licence 11 Licence 12", "", whole("3/9009") + item("crown_land_licence", "11") + item("crown_land_licence", "12")),
        ("3/9009 Coal Lease 5 Wind Farm W1", "", whole("3/9009") + item("wind_farm", "W1") + item("coal_lease", "5")),
    ]
)


def test_parcel_lists(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(PARCEL_LISTS)], "i int, d string")
    rows = expand_parcels(df, "d").orderBy("i").collect()
    assert [(r.d, r.remains, [(f.id, f.part) for f in r.folios]) for r in rows] == PARCEL_LISTS


def test_descriptions(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(DESCRIPTIONS)], "i int, legal_description string")
    for r, (text, remains, items) in zip(parse_descriptions(df).orderBy("i").collect(), DESCRIPTIONS):
        assert (r.remains, [(x.kind, x.id, x.id_b, x.part) for x in r.items]) == (remains, items), text


def test_every_pattern_is_reached():
    known = {k for k, *_ in [*LABELLED_IDS, *NAMED_GROUPS, *FLAGS]}
    assert known == {items[0][0] for _, items in WORDINGS}
    assert all(any(re.search(p, phrase) for phrase in SILENT) for p in [*IGNORE_BEFORE, *IGNORE_AFTER])


def test_long_parcel_list(spark):
    """A list of many thousand lots neither overflows nor is cut short."""
    lots = ", ".join(str(i) for i in range(20_000))
    df = spark.createDataFrame([(f"{lots}/99 Enclosure Permit 1",)], "legal_description string")
    row = parse_descriptions(df).first()
    assert len(row.items) == 20_001 and row.items[19_999].id == "19999/99" and row.remains == ""


@pytest.mark.parametrize(
    "folio,parts",
    [
        ("1/2", ("1/2", "1", None, "2")),
        ("1//SP2", ("1/SP2", "1", None, "SP2")),
        ("1/A/2", ("1/A/2", "1", "A", "2")),
        ("123456/2", None),
        ("1/2/3/4", None),
        ("1/ABCDE/2", None),
        ("1/DP2", None),
        ("1/1234567890", None),
    ],
)
def test_split_folio(spark, folio, parts):
    row = spark.createDataFrame([(folio,)], "f string").select(split_folio("f").alias("p")).first().p
    assert (tuple(row) if row else None) == parts


def test_derived_tables(spark):
    rows = [
        ("a", "2020-01-01", 1, None, "1, PT 2/7 Enclosure Permit 5", "> 2004-08-17"),
        ("b", "2020-01-01", 2, None, "1/7 PT 2/7 odd", "> 2004-08-17"),
        ("c", "2020-01-01", 3, None, "1, CP/SP 9", "> 2004-08-17"),
        ("d", "2020-01-01", 4, 3, "9/9", "> 2004-08-17"),
        ("e", "2020-01-01", 5, None, "8/8", "initial"),
        ("f", "2020-01-01", 6, None, "1, 2/7x", "> 2004-08-17"),
    ]
    df = spark.createDataFrame(
        rows,
        "source_id string, effective_date string, property_id int, strata_lot_number int, legal_description string,"
        " legal_description_kind string",
    ).selectExpr("*", "source_id AS legal_description_id")
    out = derive_parcels(df)
    links = {(r.property_id, r.folio_id, r.partial) for r in out["property_folio"].collect()}
    # A whole folio belongs to the first source of a day; parts are shared.
    assert links == {(1, "1/7", False), (1, "2/7", True), (2, "2/7", True), (3, "1/SP9", False), (3, "CP/SP9", False)}
    parcels = {(r.base_parcel_id, r.base_parcel_kind) for r in out["base_parcel"].collect()}
    assert parcels == {("1/7", "deposit_lot"), ("2/7", "deposit_lot"), ("SP9", "strata_plan")}
    assert out["folio"].count() == 4
    remains = {(r.legal_description_id, r.legal_description_remains) for r in out["legal_description_remains"].collect()}
    assert remains == {("b", "odd")}
    assert [tuple(r)[2:] for r in out["enclosure_permit"].collect()] == [(1, "5")]
    assert {r.folio_id for r in out["folio_rejects"].collect()} == {"1/7x", "2/7x"}
