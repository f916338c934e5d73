"""Statistics metadata, HTML links and feature pages."""

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from cadastra.sources import features, layers, pages, sdmx

STRUCTURE = {
    "data": {
        "dataStructures": [
            {
                "id": "DS1", "version": "1.0", "name": "Dwellings",
                "dataStructureComponents": {
                    "dimensionList": {
                        "dimensions": [
                            {"id": "REGION", "position": 0, "type": "Dimension", "conceptIdentity": "c1",
                             "localRepresentation": {"enumeration": "urn:list"}},
                        ],
                        "timeDimensions": [
                            {"id": "TIME_PERIOD", "position": 1, "type": "TimeDimension", "conceptIdentity": "c2",
                             "localRepresentation": {"textFormat": {"textType": "ObservationalTimePeriod", "isMultiLingual": False, "isSequence": False}}},
                        ],
                    },
                    "measureList": {"primaryMeasure": {"id": "OBS_VALUE", "conceptIdentity": "c3"}},
                    "attributeList": {
                        "attributes": [
                            {"id": "UNIT", "assignmentStatus": "Mandatory", "conceptIdentity": "c4",
                             "attributeRelationship": {"dimensions": ["REGION"]}},
                        ]
                    },
                },
            }
        ],
        "codelists": [
            {"id": "CL", "name": "Codes", "version": "1",
             "codes": [{"id": "1", "name": "One", "annotations": [{"type": "ORDER", "text": "10"}, {"type": "X", "text": "no"}]}, {"id": "2", "name": "Two"}]},
        ],
        "conceptSchemes": [{"id": "CS", "version": "1", "name": "n", "concepts": [{"id": "a", "name": "A"}]}],
        "dataflows": [
            {"id": "DF", "version": "1", "name": "Flow", "annotations": [
                {"type": "DEFAULT", "title": "REGION=1,TIME=2"}, {"type": "LAYOUT_ROW", "title": "A,B"}]},
        ],
        "contentConstraints": [
            {"id": "CC", "version": "1", "name": "n", "constraintAttachment": {"dataflows": [sdmx.DATAFLOW_URN + "DF(1)"]},
             "cubeRegions": [{"keyValues": [
                 {"id": "REGION", "values": ["1", "2"]},
                 {"id": "TIME_PERIOD", "timeRange": {"startPeriod": {"period": "2001-01-01T00:00:00", "isInclusive": True},
                                                     "endPeriod": {"period": "2021-12-31T23:59:59", "isInclusive": False}}}]}]},
        ],
    }
}
MESSAGE = {
    "data": {
        "dataSets": [{"structure": 0, "links": [{"rel": "x", "urn": "no"}, {"rel": "DataStructure", "urn": "urn:1"}],
                      "observations": {"0:1": [5.0, 6.0], "1:0": [7.5]}}],
        "structures": [{"dataSets": [0], "dimensions": {"observation": [
            {"id": "R", "name": "Region", "keyPosition": 0, "values": [{"id": "a", "name": "A", "order": 0}, {"id": "b", "name": "B", "order": 1, "parent": "a"}]},
            {"id": "T", "name": "Time", "keyPosition": 1, "values": [{"id": "2016", "name": "2016", "start": "2016-01-01T00:00:00", "end": "2016-12-31T00:00:00"}, {"id": "2021", "name": "2021"}]},
        ]}}],
    }
}


def test_structures(spark):
    df = spark.createDataFrame([(json.dumps(STRUCTURE),)], "body string")
    found = [(r.dimension, r.type, r.position, r.enumeration, r.text_type) for r in sdmx.dimensions(df, "body").collect()]
    assert found == [("REGION", "Dimension", 0, "urn:list", None), ("TIME_PERIOD", "TimeDimension", 1, None, "ObservationalTimePeriod")]
    assert [(r.code, r["name"], r.code_order) for r in sdmx.code_lists(df, "body").collect()] == [("1", "One", "10"), ("2", "Two", None)]
    assert sdmx.measures(df, "body").first().measure == "OBS_VALUE"
    unit = sdmx.attributes(df, "body").first()
    assert (unit.attribute, unit.assignment_status, unit.dimensions) == ("UNIT", "Mandatory", ["REGION"])
    assert tuple(sdmx.concepts(df, "body").first()) == ("CS", "1", "a", "A")
    flow = sdmx.dataflows(df, "body").first()
    assert (flow.default_parameters, flow.layout_row, flow.layout_column) == ({"REGION": "1", "TIME": "2"}, ["A", "B"], [])
    limits = {r.dimension: r for r in sdmx.content_constraints(df, "body").collect()}
    assert limits["REGION"].allowed == ["1", "2"] and flow.urn in limits["REGION"].dataflows
    time = limits["TIME_PERIOD"]
    assert (time.time_from, time.from_inclusive, time.to_inclusive) == (datetime(2001, 1, 1), True, False)


def test_observations(spark):
    df = spark.createDataFrame([(json.dumps(MESSAGE),)], "body string")
    rows = sdmx.dimension_ids(sdmx.observations(df, "body"), ["R", "T"]).collect()
    assert sorted((r.urn, r.r, r.t, r.value) for r in rows) == [
        ("urn:1", "a", "2021", 5.0), ("urn:1", "a", "2021", 6.0), ("urn:1", "b", "2016", 7.5),
    ]


HTML = """<html><div class="box weekly"><a class="btn" href="/old.zip">01 Jan 2020</a></div>
<div class='weekly wide'><div>inner</div><p><a class="btn btn-sales-data" href="files/a.zip"> 06 Jan
 2025 </a><a href="x.zip" class="btn-sales-data"><b>13 Jan 2025</b></a><a class="btn-sales-data-x" href="no.zip">n</a></p></div>
<div class="annual"><a class="btn-sales-data" href="https://other.example/2024.zip?x=1">2024</a></div></html>"""


def test_publication_links(spark):
    df = spark.createDataFrame([("https://site.example/data/page.html?q=1", HTML)], "url string, html string")
    weekly = pages.page_links(df, "url", "html", [("div", "weekly"), ("a", "btn-sales-data")], "dd MMM yyyy").collect()
    assert [(r.url, r.published, r.file_name) for r in weekly] == [
        ("https://site.example/data/files/a.zip", date(2025, 1, 6), "a.zip"),
        ("https://site.example/data/x.zip", date(2025, 1, 13), "x.zip"),
    ]
    yearly = pages.page_links(df, "url", "html", [("div", "annual"), ("a", "btn-sales-data")], "yyyy").collect()
    assert [(r.url, r.published, r.file_name) for r in yearly] == [("https://other.example/2024.zip?x=1", date(2024, 1, 1), "2024.zip")]
    assert pages.page_links(df, "url", "html", [("div", "missing"), ("a", None)]).count() == 0
    every = pages.page_links(df, "url", "html")
    assert every.count() == 5 and pages.archive_link(every, "old").count() == 1


def test_relative_links(spark):
    cases = [
        ("../up.zip", "https://s.example/a/up.zip"), ("./here.zip", "https://s.example/a/b/here.zip"),
        ("//cdn.example/x", "https://cdn.example/x"), ("?p=2", "https://s.example/a/b/c.html?p=2"),
        ("#top", "https://s.example/a/b/c.html#top"), ("mailto:a@b", "mailto:a@b"), ("/r", "https://s.example/r"),
        ("../../x/../y", "https://s.example/y"), ("../" * 9 + "x.zip", "https://s.example/x.zip"),
        ("a/" * 12 + "../" * 11 + "z?q=../k", "https://s.example/a/b/a/z?q=../k"), ("..", "https://s.example/a/"),
    ]
    df = spark.createDataFrame([("https://s.example/a/b/c.html", link, want) for link, want in cases], "b string, l string, w string")
    rows = df.select("l", "w", pages.absolute_url(F.col("b"), F.col("l")).alias("g")).collect()
    assert [(r.l, r.g) for r in rows] == cases


def test_features(spark):
    body = {"features": [
        {"attributes": {"objectid": 1, "lotidstring": "1//DP5", "lastupdate": 1700000000123, "cadid": 9},
         "geometry": {"rings": [[[0, 0], [0, 2], [2, 2], [2, 0], [0, 0]]]}},
        {"attributes": {"objectid": 2, "lotidstring": None, "lastupdate": None}, "geometry": {"paths": [[[0, 0], [1, 1]]]}},
        {"attributes": {"objectid": 3}, "geometry": {"rings": [[[0, 0], [1, 1], [0, 0]]]}},
    ]}
    df = spark.createDataFrame([(json.dumps(body),)], "body string")
    fields = features.choose_fields(features.LOT_FIELDS, ["id", ("assoc", 1), "meta"])
    rows = {int(r.object_id): r for r in features.flatten_features(df, "body", fields).collect()}
    assert rows[1].lot_id_string == "1//DP5" and rows[1].last_update == datetime(2023, 11, 14, 22, 13, 20)
    assert [tuple(p) for p in rows[1].geometry[0]][1] == (2.0, 0.0) and not rows[1].broken
    assert rows[2].geometry is None and rows[2].paths is not None and not rows[2].broken
    assert rows[3].broken and "cad_id" not in rows[1].asDict()


def test_layer_maps(spark):
    df = spark.createDataFrame(
        [("101", "Sydney", "AUS", 2.5, "POLYGON ((0 0, 1 0, 1 1, 0 0))"), ("102", "Else", "ZZZ", float("nan"), None)],
        "LGA_CODE_2024 string, LGA_NAME_2024 string, AUS_CODE_2024 string, AREA_ALBERS_SQKM double, geometry string",
    )
    rows = layers.conform(df, layers.other_layer("lga_2024")).collect()
    assert [(r.lga_code, r.lga_name, r.in_australia, r.area_sqkm) for r in rows] == [("101", "Sydney", True, 2.5), ("102", "Else", False, None)]
    assert len(rows[0].geometry[0]) == 4
    assert layers.MAIN_STRUCTURE["sa2"]["SA2_NAME_2021"] == ("sa2_name", "text")
    assert layers.MAIN_STRUCTURE["meshblock"]["GCCSA_CODE_2021"] == ("gcc_code", "text")
