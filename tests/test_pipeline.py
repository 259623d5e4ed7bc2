import pytest

from tallymark.plans import bronze, silver
from tallymark.plans.pipeline import run_medallion
from tallymark.sources.report_files import scan_lines
from tallymark.sources.tables import current_run, read_log, read_silver


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def bronze_dir(tmp_path):
    root = tmp_path / "bronze"
    write(root, "fuel/market_fuel_an_monthwise_2016_2018.csv", '"T"\\n\\nFuel,2016-Jan,Total\nDIESEL,5,5\nTotal,5,5\n')
    write(root, "category/market_vehicle_category_an_monthwise_2016_2018.csv",
          '"T"\\n\\nVehicle Category,2016-Jan,Total\nBUS,7,7\nTotal,7,7\n')
    write(root, "manufacturer/market_manufacturer_an_monthwise_2016_2016.csv",
          '"T"\n\n"Maker","2016-Jan"\n"ACME  ","9"\n')
    write(root, "fuel/market_fuel_zz_monthwise_2016_2018.csv", "Fuel,2016-Jan\nDIESEL,1\n")
    return root


def run(spark, tmp_path, root):
    lines = scan_lines(spark, str(root), str(tmp_path / "lines"))
    return run_medallion(
        spark, lines, silver.india_states(spark), str(tmp_path / "run"), with_views=True)


def test_whole_run(spark, tmp_path, bronze_dir, rows):
    done = run(spark, tmp_path, bronze_dir)
    assert rows(done.summary, "metric_value", "status") == [
        ("0", "PASS"), ("21", "PASS"), ("3", "PASS"), ("Silver-Gold row counts match", "PASS")]
    assert [r.error_reason for r in done.rejects.collect()] == ["Missing or invalid state code; "]
    assert done.failures.count() == 0
    assert rows(read_log(spark, str(tmp_path / "run" / "dq_log")), "stage", "status") == [
        ("silver_validation", "PASS"), ("unified_validation", "PASS")]
    # Gold is read from its own tables: a row lost there shows in the reconciliation.
    files = done.gold.fact_fuel.inputFiles()
    assert files and all(f"{done.path}/gold/fact_fuel/" in f for f in files)
    assert current_run(spark, str(tmp_path / "run")) == done.path
    assert done.dedup_log.first().conflicting_value_groups == 0
    assert sorted(rows(done.structure, "status")) == [("INVALID",)] + [("VALID",)] * 3
    assert {r.reconciliation_status for r in done.reconciliation["by_dataset"].collect()} == {"PASS"}
    assert rows(done.gold.dim_state) == [("an", "Andaman and Nicobar Islands")]
    assert spark.sql("select total_vehicles from vw_manufacturer_totals").first()[0] == 9


def test_equal_overlap_is_removed_and_conflict_stops(spark, tmp_path, bronze_dir):
    extra = "fuel/market_fuel_an_monthwise_2019_2021.csv"
    write(bronze_dir, extra, "Fuel,2016-Jan\nDIESEL,5\n")
    assert run(spark, tmp_path, bronze_dir).silver.count() == 3
    write(bronze_dir, extra, "Fuel,2016-Jan\nDIESEL,6\n")
    before = current_run(spark, str(tmp_path / "run"))
    with pytest.raises(silver.GateError, match="Copies of 1 business keys disagree"):
        run(spark, tmp_path, bronze_dir)
    # What was published stays, and can be read.
    assert current_run(spark, str(tmp_path / "run")) == before
    assert read_silver(spark, f"{before}/silver").count() == 3


def test_empty_report_and_huge_count_are_told(spark, tmp_path, bronze_dir, rows):
    write(bronze_dir, "fuel/market_fuel_ap_monthwise_2016_2018.csv", "")
    lines = scan_lines(spark, str(bronze_dir), str(tmp_path / "lines"))
    found = bronze.failures(bronze.parse(lines))
    assert [r.file for r in found.collect()] == ["fuel/market_fuel_ap_monthwise_2016_2018.csv"]
    write(bronze_dir, "fuel/market_fuel_ap_monthwise_2016_2018.csv",
          "Fuel,2016-Jan,Total\nDIESEL,10000000000000000000,99999999999999999999\n")
    reports = bronze.parse(scan_lines(spark, str(bronze_dir), str(tmp_path / "lines2")))
    ap = "source_file like '%_ap_%'"
    assert [r.vehicle_count for r in bronze.unify(reports).filter(ap).collect()] == [None]
    assert {r.status for r in bronze.total_reconcile(reports).filter(ap).collect()} == {"CHECK"}


def test_sinks_can_be_called_twice(spark):
    from tallymark.registry.queries import all_queries

    for name in ("silver_load", "silver_sort_write", "dq_log", "run_medallion", "scan_reports"):
        query = all_queries()[name]
        first = query(spark, "/root/testdata/sf0.001")
        second = query(spark, "/root/testdata/sf0.001")
        assert first.count() == second.count() > 0


def test_years_out_of_scope_fail_validation(spark, tmp_path, bronze_dir):
    write(bronze_dir, "fuel/market_fuel_ap_monthwise_2016_2018.csv", "Fuel,2015-Jan\nDIESEL,5\n")
    with pytest.raises(silver.GateError, match="unified_validation failed: invalid_years: 1"):
        run(spark, tmp_path, bronze_dir)
    log = read_log(spark, str(tmp_path / "run" / "dq_log")).collect()
    assert [(r.status, r.critical_error_count) for r in log] == [("FAIL", 1)]
