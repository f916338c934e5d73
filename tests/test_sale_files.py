"""Sale files of every layout, written by a small generator with invented places, ids and dealings."""

import os
import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cadastra.plans.build import build
from cadastra.queries import QUERIES
from cadastra.session import cut_lineage, shared_folder
from cadastra.sources import sale_files
from cadastra.sources.lines import line_groups, read_lines
from cadastra.sources.manifest import choose_snapshots, list_files, select_files
from cadastra.sources.sale_files import SALE_TABLES, joined_records, layout_of, no_layout, read_records, read_sale_files, typed_table, with_layout
from cadastra.streaming.incremental import ingest_sale_files, year_in_path

def record(kind, semicolons, *fields):
    """One record: its fields, then as many empty ones as its layout wants."""
    text = ";".join([kind, *map(str, fields)])
    return text + ";" * (semicolons - text.count(";")) + "\n"


def sale(district, property_id, counter, stamp, street, place, contract, price, dealing, **more):
    """A ``B`` record since 2001; places, ids and dealings are invented."""
    m = {"area": "", "unit": "", "settled": contract, "zone": "", "nature": "R", "purpose": "", "lot": "", "house": "", **more}
    return record(
        "B", 24, district, property_id, counter, stamp, "", "", m["house"], street, place, "2999", m["area"], m["unit"], contract,
        m["settled"], price, m["zone"], m["nature"], m["purpose"], m["lot"], "", "", "", dealing,
    )


OLD_STAMP, JULY_STAMP, FIVE_STAMP, NEW_STAMP, DAY_STAMP = (
    "20170304 08:05", "20010705 14:21", "20050311 07:30", "20190520 22:10", "20210823 03:33",
)
ARCHIVE = (
    record("A", 5, "", "ARCHLOAD", OLD_STAMP)
    + record("B", 21, "042", "ARCHLOAD", "0900100", 501188, "", "", "WATTLE RISE", "OLD MILLS", 2999, "14/3/1988", 41000,
             "LOT 3 SEC 4, LOT 5.", 910, "M", "", "", "C")
    + record("B", 21, "042", "PAPERS", "0900200", "", "", "", "FORGE LANE", "OLD MILLS", 2999, "3/12/1988", 67250,
             "LOT 88", "2.75", "H", "31X44", "", "C")
    + record("Z", 3, 2, 2)
)
JULY_2001 = (
    record("A", 4, "207", JULY_STAMP, "CLERK")
    + sale("207", 640021, 1, JULY_STAMP, "HARROW ST", "FERNHOLLOW", "20010302", 118500, "5500101", house="17", zone="A")
    + record("C", 6, "207", 640021, 1, JULY_STAMP, "31//80077 WITH WORDS THAT\nGO ON BELOW")
    + record("C", 6, "207", 640021, 1, JULY_STAMP, " AND IN A SECOND PIECE")
    + record("D", 11, "207", 640021, 1, JULY_STAMP, "P")
    + record("D", 11, "207", 640021, 1, JULY_STAMP, "V")
    + sale("207", "", 93, "20010705 14:22", "", "QUARRY BEND", "20010418", 204000, "5500102", lot=6)
    + record("C", 5, "207", 93, "20010705 14:22", "6//SP 70707")
    + record("D", 11, "207", "", 93, "20010705 14:22", "P")
    + record("D", 10, "207", 93, "20010705 14:22", "V", "P")
    + record("Z", 5, 10, 2, 3, 4)
    + sale("207", 5, 9, JULY_STAMP, "", "AFTER THE END", "20010418", 1, "5500103")
)
YEAR_2005 = (
    record("A", 4, "118", FIVE_STAMP, "CLERK")
    + sale("118", 770045, 1, FIVE_STAMP, "'THE PADDOCK'", "DRY CREEK", "20041109", 3100000, "CC100200", nature="3", purpose="FARM", lot=0)
    + record("C", 6, "118", 770045, 1, FIVE_STAMP, "4/600123")
    + record("Z", 5, 4, 1, 1, 0)
).replace("\n", "\r\n")
YEAR_2019 = (
    record("A", 5, "SALELIST", "310", NEW_STAMP, "LOADER")
    + sale("310", 880123, 1, NEW_STAMP, "MERINO RD", "STONY GULLY", "20190402", 1450000, "EE300400", house="61", area="412.5",
           unit="H", zone="RU1", nature="3", purpose="GRAZING")
    + record("C", 6, "310", 880123, 1, NEW_STAMP, "21, 22/701701 9/702702")
    + sale("310", 880123, 2, NEW_STAMP, "MERINO RD", "STONY GULLY", "20190402", 1450000, "EE300401", area="wide", unit="H", zone="RU1")
    + record("Z", 5, 5, 2, 1, 0)
)
DAY_2021 = (
    record("A", 5, "SALELIST", "066", DAY_STAMP, "LOADER")
    + sale("066", 990321, 1, DAY_STAMP, "SALTBUSH WAY", "LONE PINE FLAT", "20210611", 8200000, "FF500600", area="300.5", unit="H", zone="RU1")
    + record("C", 6, "066", 990321, 1, DAY_STAMP, "5/1303303")
    + record("D", 12, "066", 990321, 1, DAY_STAMP, "P", "", "", "", "", "", "N")
    + record("D", 12, "066", 990321, 1, DAY_STAMP, "V", "", "", "", "", "", "N")
    + record("Z", 5, 6, 1, 1, 2)
)
FILES = {
    "1988/ARCHIVE_1988.DAT": ARCHIVE,
    "2001/207_SALES_05072001.DAT": JULY_2001,
    "2005/118_SALES_11032005.DAT": YEAR_2005,
    "2019/310_SALES_20052019.DAT": YEAR_2019,
    "2019/310_SALES_20052019-checkpoint.DAT": YEAR_2019,
    "2021/066_SALES_23082021.DAT": DAY_2021,
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "ps" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    return str(tmp_path / "ps")


def manifest_of(spark, folder):
    files = list_files(spark, folder).withColumn("published_year", year_in_path())
    return with_layout(select_files(files))


def tables_of(spark, folder):
    records = read_sale_files(spark, folder, manifest_of(spark, folder), "*.DAT").filter("layout IS NOT NULL")
    records = cut_lineage(records)
    return {t: typed_table(records, t) for t in SALE_TABLES}


def test_manifest(spark, folder):
    rows = {r.file_path.rsplit("/", 1)[1]: r for r in manifest_of(spark, folder).collect()}
    assert {n: (r.published_year, r.download_date, r.layout) for n, r in rows.items()} == {
        "ARCHIVE_1988.DAT": (1988, None, "1990"),
        "207_SALES_05072001.DAT": (2001, date(2001, 7, 5), "2001-07"),
        "118_SALES_11032005.DAT": (2005, date(2005, 3, 11), "2002"),
        "310_SALES_20052019.DAT": (2019, date(2019, 5, 20), "2012"),
        "066_SALES_23082021.DAT": (2021, date(2021, 8, 23), "2021-08-23"),
    }
    files = list_files(spark, folder).withColumn("published_year", year_in_path())
    assert select_files(files, publish_min=2005, publish_max=2019).count() == 2
    assert select_files(files, download_min=date(2001, 1, 1)).count() == 4


def test_layouts(spark):
    cases = (
        [(d, y, "2012") for y in range(2013, 2025) for d in [date(2024, 1, 1)]]
        + [(date(2012, 3, 13), 2012, "2012"), (date(2012, 4, 1), 2012, "2012"), (date(2021, 8, 22), 2012, "2012")]
        + [(date(2021, 8, 23), 2021, "2021-08-23"), (date(2021, 8, 24), 2021, "2012")]
        + [(date(y, 1, 1), y, "2002") for y in range(2002, 2012)]
        + [(date(y, 1, 1), 2001, "2002") for y in range(2002, 2012)]
        + [(date(2012, 3, 1), 2012, "2002"), (date(2012, 3, 12), 2012, "2002"), (date(2012, 1, 25), 2012, "2002")]
        + [(None, y, "1990") for y in range(1980, 2002)]
        + [(date(2001, m, 1), 2001, "2001-07") for m in range(1, 8)]
        + [(date(2001, 8, 1), 2001, "2002"), (None, 2002, None)]
    )
    df = spark.createDataFrame(cases, "d date, y int, want string")
    wrong = df.withColumn("got", layout_of(F.col("d"), F.col("y"))).filter("NOT got <=> want").collect()
    assert wrong == []
    assert no_layout(df.select(F.lit(None).cast("string").alias("layout"))).count() == len(cases)


def test_records(spark, folder):
    tables = tables_of(spark, folder)
    counts = {t: (good.count(), bad.count()) for t, (good, bad) in tables.items()}
    assert counts == {
        "ps_row_a_legacy": (1, 0), "ps_row_b_legacy": (2, 0), "ps_row_a": (4, 0), "ps_row_b": (5, 1),
        "ps_row_c": (6, 0), "ps_row_d": (6, 0), "ps_row_z": (5, 0),
    }
    assert tables["ps_row_b"][1].first().bad_fields == ["area"]

    old = {r.source: r for r in tables["ps_row_b_legacy"][0].collect()}
    assert old["ARCHLOAD"].contract_date == date(1988, 3, 14) and old["ARCHLOAD"].property_id == 501188
    assert (old["PAPERS"].property_id, old["PAPERS"].area, old["PAPERS"].dimensions) == (None, 2.75, "31X44")
    assert old["ARCHLOAD"].zone_standard == "legacy_vg_2011"

    sales = {r.dealing_number: r for r in tables["ps_row_b"][0].collect()}
    assert set(sales) == {"5500101", "5500102", "CC100200", "EE300400", "FF500600"}
    assert sales["CC100200"].street_name == "'THE PADDOCK'" and sales["CC100200"].area is None
    assert sales["EE300400"].zone_standard == "ep&a_2006"
    assert sales["5500102"].date_provided == datetime(2001, 7, 5, 14, 22)
    assert sales["5500102"].strata_lot_number == 6

    texts = {(r.sale_counter, r.position): r for r in tables["ps_row_c"][0].collect()}
    broken = [r for r in texts.values() if "\n" in r.property_description]
    assert [r.property_description for r in broken] == ["31//80077 WITH WORDS THAT\nGO ON BELOW"]
    lacking = [r for r in texts.values() if r.property_id is None]
    assert [(r.sale_counter, r.property_description) for r in lacking] == [(93, "6//SP 70707")]

    people = sorted((r.property_id, r.participant) for r in tables["ps_row_d"][0].filter("sale_counter = 93").collect())
    assert people == [(None, "P"), (None, "V")]

    heads = {r.district_code: r for r in tables["ps_row_a"][0].collect()}
    assert heads[207].file_type is None and heads[66].file_type == "SALELIST"
    assert heads[207].submitting_user_id == "CLERK" and heads[207].year_of_sale == 2001


def test_positions_are_bytes(spark, folder):
    tables = tables_of(spark, folder)
    for name, text in (("207_SALES_05072001", JULY_2001), ("118_SALES_11032005", YEAR_2005)):
        data = text.encode()
        for table in ("ps_row_a", "ps_row_b", "ps_row_c", "ps_row_d"):
            for r in tables[table][0].filter(F.col("file_path").contains(name)).collect():
                assert data[r.position : r.position + 2].decode() == f"{table[-1].upper()};"


def test_block_size_changes_nothing(spark, folder, request):
    def rows():
        return {
            t: sorted(map(str, good.drop("file_path").collect())) for t, (good, _) in tables_of(spark, folder).items()
        }

    whole = rows()
    request.getfixturevalue("small_blocks")
    assert rows() == whole


def test_incremental_files(spark, folder, tmp_path):
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    ingest_sale_files(spark, folder, out, marks, year_in_path())
    first = {t: spark.read.parquet(f"{out}/{t}").count() for t in SALE_TABLES}
    assert first["ps_row_b"] >= 5
    late = tmp_path / "ps" / "2005" / "119_SALES_12032005.DAT"
    late.write_bytes(YEAR_2005.replace("118", "119").encode())
    ingest_sale_files(spark, folder, out, marks, year_in_path())
    ingest_sale_files(spark, folder, out, marks, year_in_path())
    second = {t: spark.read.parquet(f"{out}/{t}").count() for t in SALE_TABLES}
    assert second["ps_row_b"] == first["ps_row_b"] + 1
    assert second["ps_row_b_legacy"] == first["ps_row_b_legacy"]


MONTHS = [date(2024 - y, m, 1) for y in range(11) for m in range(1, 13)]


@pytest.mark.parametrize("days", [MONTHS, MONTHS[::-1]])
def test_snapshots(days):
    assert choose_snapshots(days) == sorted(days, reverse=True)
    assert choose_snapshots(days, latest=True) == [date(2024, 12, 1)]
    assert choose_snapshots(days, every=1) == [date(y, 12, 1) for y in range(2024, 2013, -1)]
    assert choose_snapshots(days, every=2) == [date(y, 12, 1) for y in range(2024, 2013, -2)]
    assert choose_snapshots(days, every=4, include_first=True) == [
        date(2024, 12, 1), date(2020, 12, 1), date(2016, 12, 1), date(2014, 1, 1),
    ]
    wanted = {2024, 2022, 2020, 2017}
    assert [d.year for d in choose_snapshots(days, years=wanted)] == [2024, 2022, 2020, 2017]
    assert choose_snapshots([]) == []


def test_build_from_files(spark, folder, tmp_path):
    """Files to derived tables, one job slice after the other."""
    from test_land_values import HEADER, line

    lands = tmp_path / "lv"
    lands.mkdir()
    rows = [
        line(**{"DISTRICT CODE": "310", "DISTRICT NAME": "RIVERSIDE", "PROPERTY ID": "880123", "PROPERTY DESCRIPTION": "21, 22/701701",
                "STREET NAME": "Merino Rd", "SUBURB NAME": "Stony Gully", "HOUSE NUMBER": "61", "BASE DATE 1": "2/4/2019",
                "LAND VALUE 1": "1000", "BASE DATE 2": "1/7/2018", "LAND VALUE 2": "900"}),
        line(**{"DISTRICT CODE": "118", "PROPERTY ID": "77", "PROPERTY TYPE": "UNDERSP", "SUBURB NAME": "X", "AREA": "2", "AREA TYPE": "H"}),
    ]
    (lands / "001_LAND_VALUE_DATA_20190601.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    from cadastra.sources.land_values import read_land_values

    raw = {t: good for t, (good, _) in tables_of(spark, folder).items()}
    raw["land_value_row"] = read_land_values(spark, str(lands))[0]
    out = build(raw, str(tmp_path / "built"))

    sales = {r.dealing_number: r for r in out["notice_of_sale"].collect()}
    # Sales without property id stay out.
    assert set(sales) == {"5500101", "CC100200", "EE300400", "FF500600"}
    assert sales["5500101"].sale_participants == ["P", "V"] and sales["CC100200"].sale_participants == []
    texts = {(r.property_id, r.legal_description) for r in out["legal_description"].collect()}
    # The sale of 2 April 2019 is seen in the land values, so only their text counts.
    assert (880123, "21, 22/701701") in texts and (880123, "21, 22/701701 9/702702") not in texts
    assert (640021, "31//80077 WITH WORDS THAT\nGO ON BELOW AND IN A SECOND PIECE") in texts
    values = {(r.property_id, r.valuation_base_date, r.land_value) for r in out["land_valuation"].collect()}
    assert values == {(880123, date(2019, 4, 2), 1000.0), (880123, date(2018, 7, 1), 900.0)}
    assert {(r.property_id, r.sqm_area) for r in out["property_area"].collect()} == {
        (77, 20000.0), (990321, 3005000.0), (501188, 910.0),
    }
    assert {r.property_id: r.under_strata_plan for r in out["property_under_strata_plan"].collect()}[77] is True
    addresses = {r.property_id: r.address for r in out["full_property_address"].collect()}
    # The land-value row of June is newer than the sale of May.
    assert addresses[880123] == "61 MERINO RD STONY GULLY 2000"
    folios = {(r.property_id, r.folio_id) for r in out["property_folio"].collect()}
    assert {(880123, "21/701701"), (880123, "22/701701"), (990321, "5/1303303")} <= folios
    places = out["source_byte_position"].count()
    assert places == sum(raw[t].count() for t in SALE_TABLES if t != "ps_row_z")
    assert out["file_source"].filter("date_published = '2001-07-05'").count() == 1
    districts = {r.valuation_district_code: r.valuation_district_name for r in out["valuation_district"].collect()}
    assert districts[310] == "RIVERSIDE" and districts[207] is None

    # A later slice alone, over the tables already there.
    again = build(out, run_from=5, run_till=5)
    assert again["full_property_address"].count() == out["full_property_address"].count()


def test_text_that_looks_like_records(spark, tmp_path):
    """A line of text may begin as a record does: a record ends with its last semicolon."""
    texts = ["LOT 7\nA", "LOT 8", "LOT 9\nZ", "LOT 10\n D"]
    body = record("A", 5, "SALELIST", "310", NEW_STAMP, "LOADER")
    wanted = {}
    for n, text in enumerate(texts * 20, 1):
        body += sale("310", 100 + n, n, NEW_STAMP, "MERINO RD", "STONY GULLY", "20190402", 5, f"EE{n}")
        body += record("C", 6, "310", 100 + n, n, NEW_STAMP, text)
        wanted[n] = text
    body += record("Z", 5, 1, 1, 1, 0)
    path = tmp_path / "2019" / "310_SALES_20052019.DAT"
    path.parent.mkdir()
    path.write_bytes(body.encode())
    manifest = manifest_of(spark, str(tmp_path))
    records = read_sale_files(spark, str(tmp_path), manifest, "*.DAT")
    good, bad = typed_table(records, "ps_row_c")
    assert {r.sale_counter for r in typed_table(records, "ps_row_b")[0].collect()} == set(wanted)
    assert {r.sale_counter: r.property_description for r in good.collect()} == wanted
    assert bad.count() == 0
    assert [typed_table(records, t)[0].count() for t in ("ps_row_a", "ps_row_z")] == [1, 1]


def joined_by_hand(rows):
    """The walk over one file's (record, found, missing)."""
    out, open_, head = [], 0, None
    for number, found, missing in rows:
        if open_ > 0:
            out.append((number, head))
            open_ = max(open_ - found, 0)
        else:
            head, open_ = number, missing
    return out


def test_short_records_of_large_files(spark):
    """Slices of 30 records: one file in four levels, all of it short, beside files with few or no short records."""
    rng = random.Random(5)
    files = {
        "all": [(i + 1, 1, 1) for i in range(28_000)],
        "most": [(i + 1, rng.randint(1, 6), rng.choice([0, 2, 5, 23])) for i in range(3_000)],
        "few": [(i + 1, rng.randint(3, 20), 4 if rng.random() < 0.01 else 0) for i in range(2_000)],
        "end": [(1, 20, 0), (2, 2, 22)],
        "none": [(i + 1, 24, 0) for i in range(500)],
    }
    rows = [(name, *row) for name, part in files.items() for row in part]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "file_path string, record long, found int, missing int")
    got = {name: [] for name in files}
    for row in joined_records(table, width=30).collect():
        got[row.file_path].append((row.record, row.head))
    assert {k: sorted(v) for k, v in got.items()} == {k: joined_by_hand(v) for k, v in files.items()}
    assert joined_records(table.limit(0)).count() == 0
    with pytest.raises(ValueError, match="slices"):
        joined_records(table, width=20)


def test_large_file_of_short_records(small_blocks, tmp_path):
    """Texts broken into lines that look like records, all through a file read in blocks; no window holds its records."""
    spark = small_blocks
    pieces = [";".join(["C", "001", str(i), str(i)]) + ";\nB;D;" + f"part {i};\n" for i in range(700)]
    (tmp_path / "x_20190520.DAT").write_text("".join(pieces))
    manifest = spark.createDataFrame([(str(tmp_path / "x_20190520.DAT"), 2019, "2012")], "file_path string, published_year int, layout string")
    records = read_sale_files(spark, str(tmp_path), manifest)
    rows = records.orderBy("position").collect()
    assert len(rows) == 700 and {(r.kind, r.semicolons) for r in rows} == {("C", 7)}
    assert [r.fields[1] for r in rows] == [str(i) for i in range(700)]
    assert "Window" not in records._jdf.queryExecution().optimizedPlan().toString()


def test_records_of_a_file_do_not_meet_to_find_its_end(spark, tmp_path):
    """The ends of files, one row each, are joined by their real size; what stands behind an end is not read."""
    sales = "".join(sale("118", i, i, FIVE_STAMP, "", "DRY CREEK", "20041109", 7 * i, f"D{i}") for i in range(4000))
    (tmp_path / "a.DAT").write_text(record("A", 4, "118", FIVE_STAMP, "CLERK") + sales + record("Z", 5, 4002, 1, 0, 0) + record("B", 24, "118", 9))
    (tmp_path / "b.DAT").write_text(sale("118", 1, 1, FIVE_STAMP, "", "DRY CREEK", "20041109", 7, "D"))
    found = read_lines(spark, str(tmp_path))
    manifest = found.select("file_path").distinct().select("file_path", F.lit(2002).alias("published_year"), F.lit("2002").alias("layout"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12k")
    try:
        records = read_records(found, manifest)
        plan = records._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, records.groupBy("kind").count().collect())) == [("A", 1), ("B", 4001), ("Z", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def records_by_hand(raw):
    """Position and text of the records of a file's bytes."""
    text = raw.decode("utf-8") if is_utf8(raw) else raw.decode("latin-1")
    out, at = [], 0
    for line, size in zip(text.rstrip("\n").split("\n"), map(len, raw.rstrip(b"\n").split(b"\n")), strict=True):
        if line.lstrip(" ")[:2] in ("A;", "B;", "C;", "D;", "Z;"):
            out.append([at, line])
        elif out:
            out[-1][1] += "\n" + line
        at += size + 1
    return [(a, re.sub(r"\s+$", "", t)) for a, t in out]


def is_utf8(raw):
    try:
        return raw.decode("utf-8") is not None
    except UnicodeDecodeError:
        return False


def test_records_are_joined_where_they_are_read(small_blocks, tmp_path, monkeypatch):
    """Texts over many blocks, empty lines, both encodings: no record is moved, and none is written to be looked at again."""
    spark, rng = small_blocks, random.Random(11)
    for name, encoding in (("a", "utf-8"), ("b", "latin-1"), ("c", "utf-8")):
        body = "lines before\nany record é\n"
        for n in range(150):
            lines = [rng.choice(["", "und ü", "more of it", "x" * 40]) for _ in range(rng.choice([0, 0, 0, 1, 3, 40]))]
            body += ";".join([rng.choice(["C", " C"]), "001", str(n), str(n), NEW_STAMP, "é\n".join([f"text {n}", *lines]), "\n"])
        (tmp_path / f"{name}_20190520.DAT").write_bytes((body if name != "c" else "no record at all\n" * 60).encode(encoding))
    found = read_lines(spark, str(tmp_path))
    manifest = found.select("file_path").distinct().select("file_path", F.lit(2019).alias("published_year"), F.lit("2012").alias("layout"))
    written, write = [], sale_files.cut_lineage
    monkeypatch.setattr(sale_files, "cut_lineage", lambda df, name: written.append(name) or write(df, name))
    records = read_records(found, manifest)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "records" not in written and "Exchange hashpartitioning" not in plan and "Window" not in plan
    got = {}
    for r in records.collect():
        got.setdefault(r.file_path[-14], []).append((r.position, ";".join([r.kind, *r.fields])))
    for name in "ab":
        want = records_by_hand((tmp_path / f"{name}_20190520.DAT").read_bytes())
        assert sorted(got.pop(name)) == [(at, text.lstrip()) for at, text in want] and len(want) == 150
    assert got == {}


def test_lines_out_of_place_are_refused(small_blocks, tmp_path):
    """Lines that a task does not read in order, and blocks that are cut elsewhere the second time, end the job."""
    spark = small_blocks
    (tmp_path / "x.DAT").write_text("".join(f"C;001;{i};{i};;text\n" for i in range(200)))
    facts = spark.createDataFrame([], "file_path string, layout string")
    found = read_lines(spark, str(tmp_path))
    starts = F.startswith("value", F.lit("C;"))
    assert line_groups(found, starts, facts).count() == 200
    with pytest.raises(Exception, match="in the order in which they were read"):
        line_groups(found.orderBy(F.desc("_seq")), starts, facts).collect()
    groups = line_groups(found, starts, facts).filter("group > 0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "170b")
    with pytest.raises(Exception, match="split anew"):
        groups.collect()


def test_files_of_the_round_trip_go_when_they_are_read(spark):
    """Sale files, marks and ends are gone once the records are written; what is left gives every row."""
    before = set(os.listdir(shared_folder(spark)))
    rows = QUERIES["record_file_roundtrip"](spark, "/root/testdata/sf0.001")
    assert [name.rsplit("-", 1)[0] for name in set(os.listdir(shared_folder(spark))) - before] == ["records"]
    tables = [spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").count() for name in ("orders", "lineitem")]
    assert rows.count() == tables[0] + 2 * tables[1] + 1
