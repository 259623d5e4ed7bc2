import pytest
from pyspark.sql import functions as F

from tallymark.functions.numbers import count_of, count_or_zero, percent, rounded, whole
from tallymark.functions.reports import (
    ReportNaming, first_of_month, is_national, month_columns, report_type, split_cells, state_code)


def apply(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_report_cells_become_counts(spark):
    texts = ["", "1,234", "x", "-4", "NaN", "inf", " 12 ", "1e3", "7.0", None, "9007199254740993"]
    assert apply(spark, texts, count_or_zero) == [
        0, 0, 0, 0, 0, 0, 12, 1000, 7, 0, 9007199254740993]


def test_counts_and_whole_numbers(spark):
    assert apply(spark, ["3.7", "-2", "NaN", "12", "1e99"], count_of) == [4, -2, None, 12, None]
    assert apply(spark, ["2016.0", "2016.5", "x", " 7"], whole) == [2016, None, None, 7]


def test_rounding_is_decimal(spark):
    assert apply(spark, [1.005, 0.285, -1.005, None], rounded, "double") == [1.01, 0.29, -1.01, None]


def test_percent_has_no_zero_base(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2)], "a long, b long")
    assert [r[0] for r in df.select(percent("a", "b")).collect()] == [33.33, None, None]


@pytest.mark.parametrize("name, kind, national", [
    ("fuel/market_fuel_an_monthwise_2016_2018.csv", "Fuel", False),
    ("a/b/MARKET_VEHICLE_CATEGORY_tn_monthwise_2016_2018.csv", "Vehicle_Category", False),
    ("market_manufacturer_la_monthwise_2016_2016.csv", "Manufacturer", False),
    ("market_pollution_norm_la_monthwise_2016_2016.csv", "Pollution_Norm", False),
    ("market_vehicle_class_la_monthwise_2016_2016.csv", "Vehicle_Class", False),
    ("market_vehicle_type_la_monthwise_2016_2016.csv", "Vehicle_Type", False),
    ("market_state_monthwise_2016_2016.csv", "State", True),
    ("market_fuel_monthwise_2016_2018.csv", "Fuel", True),
    ("market_manufacturer_2016_2016.csv", "Manufacturer", True),
    ("market_manufacturer_2016_2016.csv.bak", "Manufacturer", False),
    ("market_fuel_test.csv", "Other", False),
    ("market_fuel_sample_an.csv", "Other", False),
    ("market_manufacturing_year_total_2016_2018.csv", "Other", False),
    ("notes.csv", "Other", False),
])
def test_file_names(spark, name, kind, national):
    assert apply(spark, [name], report_type) == [kind]
    assert apply(spark, [name], is_national) == [national]


def test_state_codes_and_prefix(spark):
    names = [
        "fuel/market_fuel_tn_monthwise_2016_2018.csv", "market_manufacturer_CG_monthwise.csv",
        "market_vehicle_category_ct_x.csv", "market_vehicle_class_ct_x.csv", "market_fuel_abc_x.csv",
        "market_vehicle_category_ab_market_fuel_cd_x.csv", None]
    assert apply(spark, names, state_code) == ["tn", "cg", "ct", None, None, "cd", None]
    naming = ReportNaming(prefix="other.word")
    assert apply(spark, ["other.word_fuel_tn_x.csv", "otherxword_fuel_tn_x.csv"],
                 lambda c: state_code(c, naming)) == ["tn", None]


def test_cells_keep_quoted_commas(spark):
    lines = ['a,b,,c', '"A, LTD   ","1","2"', '"say ""hi"", x",3', '', '﻿"T"']
    assert apply(spark, lines, split_cells) == [
        ["a", "b", "", "c"], ["A, LTD", "1", "2"], ["say hi, x", "3"], [""], ["T"]]


def test_a_header_of_any_width(spark):
    header = ["Fuel"] + [f"{2000 + i // 12}-{'Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec'.split()[i % 12]}"
                         for i in range(240)] + ["Total", "2000-Jan", "2016-Xyz", "2016-jan"]
    line = ",".join(header)
    months = apply(spark, [line], lambda c: month_columns(split_cells(c)))[0]
    assert len(months) == 242
    assert months[0].asDict() == {
        "position": 1, "label": "2000-Jan", "period": "2000-01-01", "year": 2000, "month": 1,
        "month_name": "January"}
    assert [m.period for m in months[-2:]] == [None, "2016-01-01"]


def test_first_of_month_never_raises(spark):
    df = spark.createDataFrame(
        [(2016, 2), (2016, 13), (0, 1), (None, 1), (1900, 12)], "y int, m int")
    got = [str(r[0]) for r in df.select(first_of_month("y", "m")).collect()]
    assert got == ["2016-02-01", "None", "None", "None", "1900-12-01"]
