from datetime import date

import pytest

from cadastra.schemas import LAND_VALUE_COLUMNS
from cadastra.sources.land_values import header_errors, read_land_values
from cadastra.sources.lines import read_lines
from cadastra.sources.psv import read_authority, read_table, table_name

HEADER = ",".join(LAND_VALUE_COLUMNS)
DEFAULTS = {"DISTRICT CODE": "1", "PROPERTY ID": "5", "PROPERTY TYPE": "NORMAL", "SUBURB NAME": "TOWN", "POSTCODE": "2000"}


def line(**values):
    row = {**DEFAULTS, **values}
    return ",".join(f'"{row[c]}"' if "," in row.get(c, "") else row.get(c, "") for c in LAND_VALUE_COLUMNS)


def write(folder, name, lines, encoding, end="\n"):
    (folder / name).write_bytes((end.join([HEADER, *lines]) + end).encode(encoding))


def test_encodings_and_line_numbers(spark, tmp_path):
    write(tmp_path, "001_LV_20240701.csv", [line(**{"STREET NAME": "CAFÉ ST", "PROPERTY ID": str(i)}) for i in range(40)], "utf-8")
    write(tmp_path, "002_LV_20230701.csv", [line(**{"STREET NAME": "CAFÉ, ST", "AREA": "12.5", "AREA TYPE": "M"})], "latin-1", "\r\n")
    write(
        tmp_path, "003_LV_20220701.csv",
        [line(**{"PROPERTY ID": "x"}), line(**{"ZONE CODE": "ABCDE"}), line(**{"AREA TYPE": "Q"}), line(**{"SUBURB NAME": ""}),
         line(**{"BASE DATE 1": "1/7/2021", "LAND VALUE 1": "100", "BASIS 1": "6A(1)", "POSTCODE": "200"})],
        "utf-8",
    )
    good, bad = read_land_values(spark, str(tmp_path))
    rows = good.collect()
    assert {r.street_name for r in rows if r.source_date == date(2024, 7, 1)} == {"CAFÉ ST"}
    assert sorted(r.source_line_number for r in rows if r.source_date == date(2024, 7, 1)) == list(range(1, 41))
    assert all(r.property_id == r.source_line_number - 1 for r in rows if r.source_date == date(2024, 7, 1))
    latin = next(r for r in rows if r.source_date == date(2023, 7, 1))
    assert (latin.street_name, latin.area, latin.area_type) == ("CAFÉ, ST", 12.5, "M")
    valued = next(r for r in rows if r.land_value_1)
    assert (valued.base_date_1, valued.land_value_1, valued.basis_1, valued.postcode) == (date(2021, 7, 1), 100, "6A(1)", None)
    assert sorted(r.bad_fields for r in bad.collect()) == [["area_type"], ["property_id"], ["suburb_name"], ["zone_code"]]


def test_small_blocks(small_blocks, tmp_path):
    write(tmp_path, "001_LV_20240701.csv", [line(**{"STREET NAME": "CAFÉ ST", "PROPERTY ID": str(i)}) for i in range(60)], "latin-1")
    good, bad = read_land_values(small_blocks, str(tmp_path))
    rows = good.collect()
    assert bad.count() == 0 and len(rows) == 60
    assert all(r.property_id == r.source_line_number - 1 and r.street_name == "CAFÉ ST" for r in rows)


def test_header_errors(spark, tmp_path):
    write(tmp_path, "a_20240701.csv", [], "utf-8")
    (tmp_path / "b_20240701.csv").write_text("ONE,TWO\n1,2\n")
    found = header_errors(read_lines(spark, str(tmp_path))).collect()
    assert [r.file_path.rsplit("/", 1)[1] for r in found] == ["b_20240701.csv"]


@pytest.mark.parametrize("blocks", ["spark", "small_blocks"])
def test_columns_by_name_and_quotes(request, tmp_path, blocks):
    session = request.getfixturevalue(blocks)
    order = [*reversed(LAND_VALUE_COLUMNS), "EXTRA, ONE"]
    streets = ['THE ""OLD"" ROAD', "ENDS IN \\", "TWO\nLINES, ""AND""\n MORE", "", 'PLAIN "12" ST']

    def text(i, street):
        row = {**DEFAULTS, "DISTRICT CODE": "7", "DISTRICT NAME": "777", "PROPERTY ID": str(i), "STREET NAME": f'"{street}"'}
        return ",".join(row.get(c, "x" if c.startswith("EXTRA") else "") for c in order)

    head = ",".join(f'"{c}"' for c in order)
    body = [text(i, streets[i % 4]) for i in range(40)]
    (tmp_path / "a_LV_20240701.csv").write_text("\ufeff" + "\r\n".join([head, *body]) + "\r\n", encoding="utf-8")
    write(tmp_path, "b_LV_20230701.csv", [line(**{"STREET NAME": streets[4], "PROPERTY ID": "900"})], "latin-1")
    (tmp_path / "c_LV_20220701.csv").write_text("DISTRICT CODE,PROPERTY ID\n1,2\n")
    good, bad = read_land_values(session, str(tmp_path))
    rows = {r.property_id: r for r in good.collect()}
    wanted = ['THE "OLD" ROAD', "ENDS IN \\", "TWO\nLINES, AND\n MORE", None]
    assert {i: r.street_name for i, r in rows.items()} == {i: wanted[i % 4] for i in range(40)} | {900: streets[4]}
    assert {(r.district_code, r.district_name) for i, r in rows.items() if i < 40} == {(7, "777")}
    assert [r.source_file_name.rsplit("/", 1)[1] for r in bad.collect()] == ["c_LV_20220701.csv"]


def test_psv_headers_of_their_own(spark, tmp_path):
    (tmp_path / "Standard").mkdir()
    (tmp_path / "Standard" / "NSW_LOCALITY_psv.psv").write_text("PID|NAME\nA|1\n")
    (tmp_path / "Standard" / "ACT_LOCALITY_psv.psv").write_text("NAME|MORE|PID\n2|m|B\n")
    rows = read_table(spark, str(tmp_path), "LOCALITY", ["NSW", "ACT"], ["PID", "NAME"]).collect()
    assert {tuple(r) for r in rows} == {("A", "1"), ("B", "2")}
    every = read_table(spark, str(tmp_path), "LOCALITY", ["NSW", "ACT"])
    assert sorted(every.columns) == ["more", "name", "pid"] and every.where("more IS NULL").first().pid == "A"
    with pytest.raises(ValueError, match="lacks"):
        read_table(spark, str(tmp_path), "LOCALITY", ["NSW"], ["PID", "NAME", "MORE"])


def test_psv(spark, tmp_path):
    (tmp_path / "Standard").mkdir()
    (tmp_path / "Authority Code").mkdir()
    (tmp_path / "Standard" / "NSW_LOCALITY_psv.psv").write_text('LOCALITY_PID|NAME|POSTCODE\nn1| "A" TOWN |\nn2|B|  2000\n')
    (tmp_path / "Standard" / "ACT_LOCALITY_psv.psv").write_text("LOCALITY_PID|NAME|POSTCODE\na1|C|2600\n")
    (tmp_path / "Authority Code" / "Authority_Code_STREET_TYPE_AUT_psv.psv").write_text("CODE|NAME\nST|STREET\n")
    rows = read_table(spark, str(tmp_path), "LOCALITY", ["NSW", "ACT"]).collect()
    assert {tuple(r) for r in rows} == {("n1", '"A" TOWN', None), ("n2", "B", "2000"), ("a1", "C", "2600")}
    assert read_authority(spark, str(tmp_path), "STREET_TYPE_AUT").first().name == "STREET"
    names = spark.createDataFrame(
        [("/x/NSW_ADDRESS_DETAIL_psv.psv",), ("Authority_Code_STREET_TYPE_AUT_psv.psv",)], "f string"
    ).select(table_name("f"))
    assert [r[0] for r in names.collect()] == ["ADDRESS_DETAIL", "STREET_TYPE_AUT"]


@pytest.mark.parametrize("blocks", ["spark", "small_blocks"])
def test_quotes_inside_fields_are_text(request, tmp_path, blocks):
    import csv

    session = request.getfixturevalue(blocks)
    streets = ['5" PIPE RD', '"TWO\n5"" LINES"', "PLAIN", 'A "B" C"', '"BACK, ""\nTO"" \nBACK" X', '""', '"\n,""\n"']

    def text(i):
        row = {**DEFAULTS, "PROPERTY ID": str(i), "STREET NAME": streets[i % len(streets)]}
        return ",".join(row.get(c, "") for c in LAND_VALUE_COLUMNS)

    body = [text(i) for i in range(60)]
    (tmp_path / "a_LV_20240701.csv").write_text("\n".join([HEADER, *body, body[0] + ",more", "1,2", ""]))
    good, bad = read_land_values(session, str(tmp_path))
    want = {int(r["PROPERTY ID"]): r["STREET NAME"].strip() or None for r in csv.DictReader([x + "\n" for x in "\n".join([HEADER, *body]).split("\n")])}
    found = {r.property_id: r.street_name for r in good.collect()}
    assert len(want) == 60 and {i: (s or "").strip() or None for i, s in found.items()} == want
    rejects = [r.bad_fields for r in bad.collect()]
    assert len(rejects) == 2 and all("field_count" in r for r in rejects)


@pytest.mark.parametrize("blocks", ["spark", "small_blocks"])
def test_quote_states_over_blocks(request, tmp_path, blocks):
    import csv
    import random

    from cadastra.sources.lines import number_lines, quote_states, whole_records

    session, rng = request.getfixturevalue(blocks), random.Random(4)
    for name in "abc":
        text = "".join(rng.choice(['"', '"', ",", ",", "x", "y", "\n"]) for _ in range(1500))
        (tmp_path / f"{name}.csv").write_text(text)
    records = whole_records(number_lines(read_lines(session, str(tmp_path)), states=quote_states()))
    found = {}
    for r in records.collect():
        found.setdefault(r.file_path[-5], set()).add(r.line_number)
    for name in "abc":
        reader, starts, at = csv.reader((tmp_path / f"{name}.csv").read_text().splitlines(keepends=True)), set(), 0
        for _ in reader:
            starts.add(at)
            at = reader.line_num
        assert found[name] == starts
