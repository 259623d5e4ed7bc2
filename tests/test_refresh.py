"""Partial refresh of Silver: only partitions with a changed report are written anew."""

import os
import time

from tallymark.sources import tables
from tallymark.sources.report_files import changed_files, scan_files
from tallymark.sources.workspace import written


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                place = os.path.join(folder, name)
                found[os.path.relpath(place, path)] = os.stat(place).st_mtime_ns
    return found


def cells(fuel=5, extra=()):
    return [("Fuel", "an", "A", "2016-01", 1, "a"), ("Fuel", "an", "A", "2017-01", fuel, "b"),
            ("Manufacturer", "an", "M", "2017-02", 7, "c"), ("Manufacturer", None, "N", "2018-02", 7, "c"),
            *extra]


def test_one_changed_report_rewrites_one_partition(spark, market, rows, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(market(cells()), path)
    before = files(path)
    new = market(cells(fuel=6))
    changed = spark.createDataFrame([("b",)], "source_file string")
    touched = tables.refresh_silver(new, path, changed)
    assert rows(touched) == [("Fuel", 2017)]
    after = files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {os.path.dirname(f) for f in before if f not in same} == {"dataset_type=Fuel/year=2017"}
    assert rows(tables.read_silver(spark, path)) == rows(new)


def test_added_and_vanished_partitions(spark, market, rows, tmp_path):
    path = str(tmp_path / "silver")
    stale = ("Fuel", "ap", "Z", "2001-01", 3, "b")
    tables.write_silver(market(cells(extra=[stale])), path)
    new = market(cells(extra=[("Fuel", "ap", "Z", "2020-01", 3, "d")]))
    changed = spark.createDataFrame([("b",), ("d",), ("nobody",)], "source_file string")
    touched = tables.refresh_silver(new, path, changed)
    assert rows(touched) == [("Fuel", 2001), ("Fuel", 2017), ("Fuel", 2020)]
    assert rows(tables.read_silver(spark, path)) == rows(new)
    assert not os.path.exists(f"{path}/dataset_type=Fuel/year=2001")


def test_partition_without_a_year_and_nothing_changed(spark, market, rows, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "silver")
    odd = market(cells()).withColumn("year", F.when(F.col("year") != 2016, F.col("year")))
    tables.write_silver(market(cells()), path)
    tables.refresh_silver(odd, path, spark.createDataFrame([("a",)], "source_file string"))
    assert rows(tables.read_silver(spark, path).filter("source_file = 'a'")) == rows(
        odd.filter("source_file = 'a'"))
    before = files(path)
    tables.refresh_silver(odd, path, spark.createDataFrame([], "source_file string"))
    assert files(path) == before


def test_year_filters_prune(spark, market, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(market(cells()), path)
    read = tables.read_silver(spark, path).filter("year = 2017 AND dataset_type = 'Fuel'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "year" in filters and "dataset_type" in filters
    assert read.count() == 1


def test_changed_files(spark, tmp_path):
    root = tmp_path / "reports"
    (root / "fuel").mkdir(parents=True)
    for name in ("a", "b", "c"):
        (root / "fuel" / f"{name}.csv").write_text("x")
    before = written(scan_files(spark, str(root)), "listing")
    (root / "fuel" / "a.csv").unlink()
    (root / "fuel" / "b.csv").write_text("xyz")
    (root / "fuel" / "d.csv").write_text("x")
    later = time.time() + 5
    os.utime(root / "fuel" / "b.csv", (later, later))
    found = {r.source_file: r.change for r in changed_files(before, scan_files(spark, str(root))).collect()}
    assert found == {"fuel/a.csv": "REMOVED", "fuel/b.csv": "CHANGED", "fuel/d.csv": "ADDED"}
