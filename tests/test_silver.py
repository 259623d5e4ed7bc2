import datetime

import pytest
from pyspark.sql import functions as F

from tallymark.operators import checks, keys
from tallymark.plans import quality, silver
from tallymark.schemas import BUSINESS_KEY, INDIA_STATES, SILVER_COLUMNS, SILVER_SCHEMA
from tallymark.sources import tables

UNIFIED = ("Dataset_Type string, Dimension_Value string, Period string, Year string, Month string, "
           "Month_Name string, Vehicle_Count string, Source_File string")
FUEL_FILE = "fuel/market_fuel_{}_monthwise_2016_2018.csv"


def unified(spark, *rows):
    return spark.createDataFrame(
        [(k, v, f"{y}-{m}-01", y, m, "Month", n, f) for k, v, y, m, n, f in rows], UNIFIED)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="Missing columns: .*'Vehicle_Count'"):
        silver.standardise(spark.createDataFrame([(1,)], "Year int"))


def test_transform_accepts_and_rejects(spark, rows):
    df = unified(
        spark,
        ("Fuel ", "  DIESEL  ", "2016", "1", "5", FUEL_FILE.format("ct")),
        ("Fuel", "DIESEL", "2016", "1", "5", FUEL_FILE.format("cg")),
        ("Fuel", "DIESEL", "2016", "1", "5", FUEL_FILE.format("cg")),
        ("Fuel", "", "2027", "13", "x", FUEL_FILE.format("zz")),
        ("Vehicle_Class", "BUS", "2016", "2", "1", "market_vehicle_class_tn_monthwise_2016_2018.csv"),
        (None, "BUS", None, None, "-1", FUEL_FILE.format("tn")),
    )
    good, bad = silver.transform(df, silver.india_states(spark))
    assert good.columns == SILVER_COLUMNS
    assert rows(good, "state_code", "state", "dimension_value", "vehicle_count", "date") == [
        ("cg", "Chhattisgarh", "DIESEL", 5, datetime.date(2016, 1, 1)),
        ("ct", "Chhattisgarh", "DIESEL", 5, datetime.date(2016, 1, 1))]
    assert {r.error_reason for r in bad.collect()} == {
        "Invalid year; Invalid month; Invalid vehicle count; Missing dimension value; "
        "Missing or invalid state code; ",
        "Missing or invalid state code; ",
        "Invalid year; Invalid month; Invalid vehicle count; Missing dataset type; "}
    # Nothing is lost: three accepted rows (one a full repeat) and three rejects.
    assert good.count() + 1 + bad.count() == df.count()


def test_state_table():
    assert len(INDIA_STATES) == 40 and len(set(INDIA_STATES.values())) == 37


def test_dedup_keeps_the_smallest_source(market, rows):
    df = market([
        ("Fuel", "an", "A", "2016-01", 5, "b.csv"), ("Fuel", "an", "A", "2016-01", 5, "a.csv"),
        ("Fuel", None, "A", "2016-01", 5, "n2"), ("Fuel", None, "A", "2016-01", 5, "n1"),
        ("Fuel", "an", "B", "2016-01", 7, "c.csv")])
    silver.require_no_conflicts(df)
    once = silver.dedup(df)
    assert rows(once, "dimension_value", "source_file") == [("A", "a.csv"), ("A", "n1"), ("B", "c.csv")]
    assert rows(silver.dedup(once)) == rows(once)
    assert keys.dedup_summary(df).first().asDict() == {
        "input_rows": 5, "output_rows": 3, "removed_rows": 2,
        "duplicate_business_key_groups": 2, "conflicting_value_groups": 0}


def test_conflicting_counts_stop_the_run(market):
    df = market([("Fuel", "an", "A", "2016-01", 5, "a"), ("Fuel", "an", "A", "2016-01", 6, "b")])
    with pytest.raises(silver.GateError, match="disagree on the count"):
        silver.require_no_conflicts(df)
    assert keys.conflicts(df).count() == 1


def test_load_gate(market, rows):
    repeated = [("Fuel", None, "A", "2016-01", 5, "a"), ("Fuel", None, "A", "2016-01", 5, "b")]
    sums = [("Fuel", "an", "Total", "2016-01", 9, "a"), ("Fuel", "an", "grand total", "2016-01", 9, "a"),
            ("Fuel", "an", "Total", "2016-01", 9, "b")]
    with pytest.raises(silver.GateError, match="2 rows in 1 groups"):
        silver.load_gate(market(repeated))
    kept = silver.load_gate(market(sums + [("Fuel", "an", "B", "2016-01", 1), ("Fuel", "an", None, "2016-01", 1)]))
    assert rows(kept, "dimension_value") == [("B",), (None,)]
    with pytest.raises(ValueError, match="Missing columns"):
        silver.load_gate(market(sums).drop("state"))


def test_silver_table_round_trip(spark, market, rows, tmp_path):
    df = market([("Fuel", "an", "A, \"x\"", "2016-01", 5), ("Manufacturer", None, "B", "2017-02", None)])
    tables.write_silver(df, str(tmp_path / "t"))
    back = tables.read_silver(spark, str(tmp_path / "t"))
    assert back.schema == SILVER_SCHEMA and rows(back) == rows(df)
    plan = back.filter("dataset_type = 'Fuel'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset_type" in plan
    tables.write_csv(df, str(tmp_path / "c"))
    assert rows(tables.read_typed_csv(spark, str(tmp_path / "c"))) == rows(df)


def test_typed_load_aborts_on_a_bad_row_and_reads_nulls(spark, tmp_path):
    head = ",".join(SILVER_COLUMNS) + "\n"
    good = tmp_path / "good.csv"
    good.write_text(head + 'Fuel,"",NULL,2016,1,January,,"f",an,A,2016-01-01\n')
    got = tables.read_typed_csv(spark, str(good)).first()
    assert (got.dimension_value, got.period, got.vehicle_count) == (None, None, None)
    bad = tmp_path / "bad.csv"
    bad.write_text(head + "Fuel,A,p,2016,1,January,many,f,an,A,2016-01-01\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        tables.read_typed_csv(spark, str(bad)).collect()


def test_null_year_counts_by_choice(market):
    df = market([("Fuel", "an", "A", "2016-01", 5)]).withColumn("year", F.lit(None).cast("int"))
    assert quality.invalid_years(df).first()[0] == 0
    report = {r.check_name: r for r in quality.dq_silver(df).collect()}
    assert report["invalid_years"].bad_rows == 1 and report["invalid_years"].status == "FAIL"
    profile = {r.check_name: r.rows for r in quality.dq_profile(df).collect()}
    assert profile["invalid_years"] == 0 and profile["rows"] == 1


def test_duplicate_counts(market):
    df = market([("Fuel", "an", "A", "2016-01", 5, "a")] * 3 + [("Fuel", "an", "A", "2016-01", 5, "b")])
    assert checks.duplicate_counts(df).first().asDict() == {"duplicate_rows": 2, "duplicate_keys": 3}
    assert keys.duplicate_records(df).count() == 4


def test_overlap_sources(market):
    df = market([
        ("Fuel", "an", "A", "2016-01", 10, "b"), ("Fuel", "an", "A", "2016-01", 9, "a"),
        ("Fuel", "an", "A", "2016-01", 9, "a"), ("Fuel", "an", "B", "2016-01", 9, "a")])
    got = keys.overlap_sources(df).collect()
    assert [(r.duplicate_row_count, r.unique_source_files, r.source_files, r.vehicle_counts) for r in got] == [
        (3, 2, "a | b", "9 | 10")]


def test_dq_log_appends(spark, market, tmp_path):
    df = market([("Fuel", "an", "A", "2016-01", -5)])
    log = str(tmp_path / "log")
    entry = quality.stage_result(quality.dq_silver(df), "silver_validation", 1)
    assert entry["status"] == "FAIL" and entry["details"] == "negative_counts: 1"
    tables.append_log(spark, log, entry)
    tables.append_log(spark, log, entry)
    assert tables.read_log(spark, log).count() == 2


def test_non_numeric_columns(spark):
    df = spark.createDataFrame([("x", 1, 1.5)], "vehicle_count string, year int, month double")
    assert checks.non_numeric(df, ["vehicle_count", "year", "month", "absent"]) == ["vehicle_count"]


def test_keys_are_the_five_columns():
    assert BUSINESS_KEY == ["dataset_type", "state_code", "dimension_value", "period", "date"]


def test_schema_errors_reach_the_log(spark, market):
    df = market([("Fuel", "an", "A", "2016-01", 5)])
    broken = df.drop("month_name").withColumn("year", F.col("year").cast("string"))
    errors = quality.schema_errors(broken, SILVER_COLUMNS)
    assert errors == ["missing columns: ['month_name']", "non-numeric columns: ['year']"]
    entry = quality.stage_result(quality.dq_silver(df), "silver_validation", 1, errors)
    assert entry["status"] == "FAIL" and entry["critical_error_count"] == 2


def test_count_statistics(market):
    df = market([("Fuel", "an", f"V{i}", "2016-01", n) for i, n in enumerate([1, 2, 3, 4, None, 10])])
    assert tuple(quality.count_statistics(df).first()) == (5, 4.0, 3.54, 1, 2.0, 3.0, 4.0, 10)
    one = quality.count_statistics(market([("Fuel", "an", "A", "2016-01", 7)])).first()
    assert (one.mean, one.stddev, one.p50) == (7.0, None, 7.0)
