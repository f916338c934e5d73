from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cadastra.functions import codes, readers, text, values

LEGACY = list("ABCDEIMNOPRSTUVWXYZ")
CURRENT = (
    [f"B{i}" for i in range(1, 9)] + [f"C{i}" for i in range(1, 5)] + [f"E{i}" for i in range(1, 6)]
    + [f"IN{i}" for i in range(1, 5)] + ["MU1"] + [f"R{i}" for i in range(1, 6)] + ["RE1", "RE2"]
    + [f"RU{i}" for i in range(1, 7)] + [f"SP{i}" for i in range(1, 6)] + ["W1", "W2", "W3"]
)
UNKNOWN = ["AGB", "EM", "ENT", "ENZ", "MU", "REZ", "UD", "UR", "R22", "a", "SP"]


def column(spark, values_, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values_)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_zone_standard(spark):
    given = LEGACY + CURRENT + UNKNOWN + ["", None]
    want = ["legacy_vg_2011"] * len(LEGACY) + ["ep&a_2006"] * len(CURRENT) + ["unknown"] * len(UNKNOWN) + [None, None]
    assert column(spark, given, codes.zone_standard) == want


def test_numbers_and_dates(spark):
    assert column(spark, ["5", "23", "", "x", "1.5"], readers.read_int) == [5, 23, None, None, None]
    assert column(spark, ["670.2", "", "a"], readers.read_double) == [670.2, None, None]
    assert column(spark, ["20010410", "", "20011399"], readers.read_date) == [date(2001, 4, 10), None, None]
    slashed = column(spark, ["20/11/1990", "1/2/1990"], lambda c: readers.read_date(c, readers.DATE_SLASHED))
    assert slashed == [date(1990, 11, 20), date(1990, 2, 1)]
    assert column(spark, ["20150909 11:33"], readers.read_timestamp) == [datetime(2015, 9, 9, 11, 33)]
    assert column(spark, ["2000", "200", "20000", None], readers.read_postcode) == ["2000", None, None, None]
    assert column(spark, ["M", "H", "U", "Q", ""], readers.read_area_unit) == ["M", "H", "U", None, None]
    assert column(spark, ["abcd", "abcde", ""], lambda c: readers.read_text(c, max_len=4)) == ["abcd", None, None]


def test_strict_reading_fails_with_the_text(spark):
    with pytest.raises(PySparkException, match="cannot read area: x"):
        column(spark, ["x"], lambda c: readers.or_fail(c, readers.read_double(c), "area"))


def test_base_parcels(spark):
    given = ["1//DP123", "1/SP55", "CP//SP9", "2/A/77", "5///DP1//2", "1/DPX"]
    assert column(spark, given, codes.base_parcel_id) == ["1/123", "SP55", "SP9", "2/A/77", "5/DP1//2", "1/X"]
    kinds = ["deposit_lot", "strata_plan", "strata_plan", "deposit_lot", "deposit_lot", "deposit_lot"]
    assert column(spark, given, codes.base_parcel_kind) == kinds
    assert column(spark, [None], codes.base_parcel_kind) == ["deposit_lot"]
    assert column(spark, ["1///DP123//DP4"], codes.clean_parcel_id) == ["1/123/4"]


def test_labels_and_values(spark):
    row = spark.range(1).select(
        text.address_line(F.lit("1"), F.lit("A ST"), F.lit("X"), F.lit("2000")).alias("a"),
        text.address_line(F.lit("1"), F.lit(None), F.lit("X"), F.lit("2000")).alias("b"),
        text.street_label(F.lit("HIGH"), F.lit("STREET"), F.lit(None)).alias("c"),
        values.blended_score(F.lit(100.0), 0.5).alias("d"),
        values.epoch_ms(F.lit(1500.0)).cast("long").alias("e"),
        values.epoch_ms(F.lit(2147483647001.0)).alias("f"),
        values.epoch_ms(F.lit(float("nan"))).alias("g"),
        codes.area_sqm(F.lit(2.0), F.lit("H")).alias("h"),
        codes.area_sqm(F.lit(2.0), F.lit("U")).alias("i"),
        codes.nature_label(F.lit("3")).alias("j"),
        codes.description_kind(F.lit(date(2004, 8, 17))).alias("k"),
        codes.description_kind(F.lit(date(2004, 8, 18))).alias("l"),
    ).first()
    assert list(row) == [
        "1 A ST X 2000", None, "HIGH STREET", 51.0, 1, None, None, 20000.0, None, "Other", "initial", "> 2004-08-17",
    ]


def test_value_per_sqm(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 20.0), (2, 100.0, 5.0), (3, 100.0, None), (4, 100.0, 2.0), (5, 100.0, 30.0), (4, 100.0, None)],
        "id int, v double, a double",
    )
    plain = [r[0] for r in df.select(values.value_per_sqm("v", "a", "id", [4])).collect()]
    assert plain == [5.0, 10.0, 1.0, 100 / 20000, 100 / 30, None]
    stepped = [r[0] for r in df.select(values.value_per_sqm("v", "a", "id", [4], (10, 50, 100))).collect()]
    assert stepped == [2.0, 10.0, 1.0, 100 / 20000, 2.0, None]
