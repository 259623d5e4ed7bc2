import hashlib


import pytest

from tallymark.plans import bronze
from tallymark.plans.silver import india_states
from tallymark.schemas import PLANNED_STATES
from tallymark.sources.report_files import scan_files, scan_lines

FILES = {
    # Title and header on one physical line, a Total row, Windows line ends.
    "fuel/market_fuel_an_monthwise_2025_2026.csv":
        '"Fuel Data for A (2025-2026)"\\n\\nFuel,2025-Jan,2026-Feb,Total\r\n'
        "DIESEL,1,2,3\r\nPETROL(E20),x,-4,9\r\n ,5,5,10\r\nTotal,1,2,3\r\n",
    # Mark, all cells quoted, padded names, a quoted comma, one row twice.
    "manufacturer/market_manufacturer_ld_monthwise_2016_2016.csv":
        '﻿"Maker Data for L (2016)"\n\n"Maker","2016-Jan","2016-Feb","Total"\n'
        '"ACME, LTD    ","1","2","3"\n"ACME, LTD    ","1","2","3"\n"B + C"," 12 ","1e3","1012"\n',
    # Name and title say 2025-2026, columns are 2022.
    "category/market_vehicle_category_dd_monthwise_2025_2026.csv":
        '"Data for D (2025-2026)"\\n\\nVehicle Category,2022-Jan,2022-Xyz,Total\nBUS,7,1,7\n',
    "category/market_vehicle_category_ap_monthwise_2016_2018.csv":
        '"T (2016-2018)"\nNo header,2016-Jan\nBUS,1\n',
    "category/market_vehicle_category_ar_monthwise_2016_2018.csv":
        '"T (2016-2018)"\nVehicle Category,January,Total\nBUS,1,1\n',
    "category/market_vehicle_category_as_monthwise_2016_2018.csv":
        '"T (2016-2018)"\nVehicle Category,2016-Jan,Total\nGrand Total,1,1\nAll-India,2,2\n,3,3\n',
    "market_fuel_monthwise_2016_2018.csv": "Fuel,2016-Jan\nDIESEL,1\n",
    "market_fuel_test_an.csv": "Fuel,2016-Jan\nDIESEL,1\n",
    "other.csv": "Fuel,2016-Jan\nDIESEL,1\n",
    "notes.txt": "Fuel,2016-Jan\nDIESEL,1\n",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("bronze dir+x")
    for name, text in FILES.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode("utf-8"))
    return str(base)


@pytest.fixture(scope="module")
def reports(spark, root, tmp_path_factory):
    table = str(tmp_path_factory.mktemp("table") / "lines")
    return bronze.parse(scan_lines(spark, root, table))


def test_scan_finds_csv_files_with_lineage(spark, root, rows):
    found = {r.source_file: r.bytes for r in scan_files(spark, root).collect()}
    assert found == {n: len(t.encode()) for n, t in FILES.items() if n.endswith(".csv")}


def test_unify(reports, rows):
    got = rows(bronze.unify(reports), "source_file", "dimension_value", "period", "month_name", "vehicle_count")
    fuel, maker, category = (n for n in list(FILES)[:3])
    assert got == sorted([
        (fuel, "DIESEL", "2025-01-01", "January", 1), (fuel, "DIESEL", "2026-02-01", "February", 2),
        (fuel, "PETROL(E20)", "2025-01-01", "January", 0), (fuel, "PETROL(E20)", "2026-02-01", "February", 0),
        (maker, "ACME, LTD", "2016-01-01", "January", 1), (maker, "ACME, LTD", "2016-02-01", "February", 2),
        (maker, "B + C", "2016-01-01", "January", 12), (maker, "B + C", "2016-02-01", "February", 1000),
        (category, "BUS", "2022-01-01", "January", 7),
    ], key=repr)


def test_failures_are_listed_and_others_go_on(reports):
    got = {r.file.split("_")[3]: r.error for r in bronze.failures(reports).collect()}
    assert got == {
        "ap": "Expected column 'Vehicle Category' not found",
        "ar": "No monthly columns found in category/market_vehicle_category_ar_monthwise_2016_2018.csv",
        "as": "No valid rows found after transformation",
    }


def test_structure(reports):
    got = {r.source_file.split("/")[1].split("_")[-4]: (r.row_count, r.month_columns, r.has_total, r.status)
           for r in bronze.structure_check(reports).collect()}
    assert got == {
        "an": (4, 2, True, "VALID"), "ld": (3, 2, True, "VALID"), "dd": (1, 1, True, "VALID"),
        "ap": (0, 0, False, "INVALID"), "ar": (1, 0, True, "INVALID"), "as": (3, 1, True, "VALID")}
    summary = {r.dataset_type: (r.files, r.valid_files, r.expected_files)
               for r in bronze.structure_summary(reports, {"Fuel": 144}).collect()}
    assert summary == {"Fuel": (1, 1, 144), "Manufacturer": (1, 1, None), "Vehicle_Category": (4, 2, None)}


def test_totals(reports):
    got = {(r.source_file.split("/")[0], r.direction, r.item): (r.month_sum, r.stated_total, r.status)
           for r in bronze.total_reconcile(reports).collect()}
    assert got["fuel", "ROW", "DIESEL"] == (3, 3, "PASS")
    assert got["fuel", "ROW", "PETROL(E20)"] == (0, 9, "CHECK")
    assert got["fuel", "COLUMN", "2025-Jan"] == (1, 1, "PASS")
    assert got["manufacturer", "ROW", "B + C"] == (1012, 1012, "PASS")
    assert ("manufacturer", "COLUMN", "2016-Jan") not in got


def test_title_against_content(reports):
    got = {r.source_file.split("/")[1].split("_")[-4]: (r.title_from, r.title_to, r.name_from, r.name_to,
                                                       r.found_from, r.found_to, r.status)
           for r in bronze.title_lineage(reports).collect()}
    assert got["an"] == (2025, 2026, 2025, 2026, 2025, 2026, "PASS")
    assert got["ld"] == (2016, 2016, 2016, 2016, 2016, 2016, "PASS")
    assert got["dd"] == (2025, 2026, 2025, 2026, 2022, 2022, "CHECK")


def test_coverage(spark, reports):
    plan = bronze.report_plan(bronze.planned_states(india_states(spark)))
    assert plan.count() == 684 and len(PLANNED_STATES) == 36
    got = bronze.report_coverage(plan, reports)
    seen = {(r.state_code, r.report): r.status for r in got.filter("status <> 'MISSING'").collect()}
    assert seen == {
        ("an", "fuel"): "DELIVERED", ("ld", "manufacturer"): "DELIVERED",
        ("dd", "vehicle_category"): "MISMATCH", ("as", "vehicle_category"): "DELIVERED",
        ("ap", "vehicle_category"): "MISMATCH", ("ar", "vehicle_category"): "MISMATCH"}
    assert got.count() == 684


def test_report_quality(reports):
    got = {r.source_file.split("/")[0]: (r.row_count, r.duplicate_values, r.empty_cells,
                                         r.non_numeric_cells, r.negative_cells)
           for r in bronze.report_quality(reports).collect() if "_dd_" not in r.source_file}
    assert got["fuel"] == (4, 0, 0, 1, 1)
    assert got["manufacturer"] == (3, 1, 0, 0, 0)


def test_order_of_lines_survives_split_files(spark, tmp_path, rows):
    """A file cut into many splits: rows before the header stay out, all others come in."""
    folder = tmp_path / "in"
    folder.mkdir()
    body = "".join(f"V{i},{i}\n" for i in range(5000))
    (folder / "market_fuel_an_monthwise_2020_2020.csv").write_text(
        '"Title (2020)"\nstray,1\nFuel,2020-Jan\n' + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = scan_lines(spark, str(folder), str(tmp_path / "lines"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert lines.select("line_order.block").distinct().count() > 5
    got = rows(bronze.unify(bronze.parse(lines)), "dimension_value", "vehicle_count")
    assert got == sorted(((f"V{i}", i) for i in range(5000)), key=repr)


def test_plan_has_no_python_and_no_cross_join(reports):
    plan = bronze.unify(reports)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_long_to_text_to_long(spark, market):
    """Property: a long frame written as report text and parsed again is the dense frame.

    Files with a fault as a whole are left out; damaged cells must come back as 0.
    """
    from tallymark.sources.rendered import report_lines

    def h(*parts):
        return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:7], 16)

    cells, want = [], {}
    for year in range(1990, 2010):
        name = f"fuel/market_fuel_ba_monthwise_{year}_{year}.csv"
        for v in range(8):
            for m in range(1, 13):
                count = v * 10 + m if m in (1, 5, 12) else 0
                if count:
                    cells.append(("Fuel", "ba", f"F{v}", f"{year}-{m:02d}", count, name))
                k = h(name, f"F{v}", m)
                lost = k % 101 == 0 or k % 103 == 0 or (k % 113 == 0 and k % 107 and k % 109)
                if all(h(name) % fault for fault in (29, 31, 37, 43)):
                    want[name, f"F{v}", f"{year}-{m:02d}-01"] = 0 if lost else count
    got = {
        (r.source_file, r.dimension_value, r.period): r.vehicle_count
        for r in bronze.unify(bronze.parse(report_lines(market(cells)))).collect()
    }
    assert len(want) > 1000
    assert {k: got[k] for k in want} == want


def test_stored_heads_spare_the_lines(spark, root, tmp_path, rows):
    lines = scan_lines(spark, root, str(tmp_path / "lines"))
    found = bronze.find_heads(lines)
    found.write.parquet(str(tmp_path / "heads"))
    heads = spark.read.schema(found.schema).parquet(str(tmp_path / "heads"))
    stored, fresh = bronze.parse(lines, heads=heads), bronze.parse(lines)
    for check in (bronze.title_lineage, bronze.header_lines, bronze.failures, bronze.structure_check):
        assert rows(check(stored)) == rows(check(fresh))
    read = bronze.title_lineage(stored).inputFiles() + bronze.header_lines(stored).inputFiles()
    assert read and all("/heads/" in f for f in read)
    # One row for every supported report, those without a header too.
    assert {r.source_file for r in heads.filter("header IS NULL").collect()} == {
        "category/market_vehicle_category_ap_monthwise_2016_2018.csv"}
    assert stored.files().count() == lines.filter("is_processed").select("source_file").distinct().count()
