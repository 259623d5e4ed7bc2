"""Positions, quantiles and long lists without a task that holds a whole group."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallymark.operators import keys
from tallymark.operators.ranking import in_ranges, positions, ranked
from tallymark.operators.selection import BUCKETS, at_places, quantiles


def test_a_fully_tied_state_is_spread_over_all_tasks(spark):
    df = spark.range(40_000).selectExpr(
        "if(id % 10 = 0, 'bb', 'aa') AS g", "format_string('n%08d', id * 7919 % 40009) AS n",
        "5L AS v")
    order = [F.asc_nulls_first("g"), F.desc_nulls_last("v"), F.asc_nulls_last("n")]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # 40,000 rows alone would be one task's worth
    try:
        sizes = in_ranges(df, order).filter("g = 'aa'").groupBy("_range").count().collect()
        out = ranked(df, "v", ["n"], ["g"], "rank").collect()
    finally:
        spark.conf.set(setting, before)
    assert len(sizes) >= 7 and max(r["count"] for r in sizes) < 36_000 / 4
    for g in ("aa", "bb"):
        names = sorted(r.n for r in out if r.g == g)
        assert {r.n: r["rank"] for r in out if r.g == g} == {n: i for i, n in enumerate(names, 1)}


def test_positions_without_a_partition_and_of_nothing(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (1,)], "v int")
    got = positions(df, [], [F.asc_nulls_last("v")], "at").collect()
    assert sorted((r["at"], r.v) for r in got) == [(1, 1), (2, 1), (3, 3), (4, None)]
    assert positions(df.limit(0), ["v"], [F.asc("v")], "at").collect() == []


def plain_quantile(values, point):
    values = sorted(values)
    at = Fraction(str(point)) * (len(values) - 1)
    low = values[int(at)]
    high = values[min(int(at) + 1, len(values) - 1)]
    return float(low + (at - int(at)) * (high - low))


@pytest.mark.parametrize("make", [
    lambda rng: [rng.choice([0, 7, 7, 7, 900]) for _ in range(999)],
    lambda rng: [rng.randrange(-(2 ** 40), 2 ** 40) for _ in range(500)],
    lambda rng: [-(2 ** 63), 2 ** 63 - 1, 0, 1, 1],
    lambda rng: [4] * 50,
    lambda rng: list(range(BUCKETS * 3)),
    lambda rng: [11],
])
def test_quantiles_equal_sorting(spark, make):
    values = make(random.Random(2))
    counted = spark.createDataFrame([(v,) for v in values], "v long").groupBy("v").agg(
        F.count("*").alias("n"))
    points = (0, 0.25, 0.5, 0.75, 0.999, 1)
    assert quantiles(counted, "v", "n", points) == [plain_quantile(values, q) for q in points]
    every = range(0, len(values), max(1, len(values) // 20))
    low, high = min(values), max(values)
    assert at_places(counted, "v", "n", every, low, high) == {p: sorted(values)[p] for p in every}


def test_quantiles_of_nothing(spark):
    counted = spark.createDataFrame([], "v long, n long")
    assert quantiles(counted, "v", "n", (0.5,)) == [None]


KEY = ["k"]
COLUMNS = "k string, source_file string, vehicle_count long"


def test_lists_are_cut_and_complete(spark):
    rows = [("a", f"s{i % 25:02d}", i % 7) for i in range(100)]
    rows += [("b", "one", 1), ("b", None, None), ("c", "only", 1), (None, "x", 1), (None, "y", 1),
             ("d", None, None), ("d", None, None)]
    out = keys.overlap_sources(spark.createDataFrame(rows, COLUMNS), KEY, chunk=10)
    got = {(r.k, r.chunk): (r.duplicate_row_count, r.unique_source_files, r.source_files,
                            r.vehicle_counts) for r in out.collect()}
    names = [f"s{i:02d}" for i in range(25)]
    assert got == {
        ("a", 1): (100, 25, " | ".join(names[:10]), "0 | 1 | 2 | 3 | 4 | 5 | 6"),
        ("a", 2): (100, 25, " | ".join(names[10:20]), ""),
        ("a", 3): (100, 25, " | ".join(names[20:]), ""),
        ("b", 1): (1, 1, "one", "1"),
        (None, 1): (2, 2, "x | y", "1"),
        ("d", 1): (0, 0, "", ""),
    }


def test_a_key_with_a_million_sources(spark):
    df = spark.range(1_000_000).selectExpr(
        "'hot' AS k", "format_string('s%07d', id) AS source_file", "id % 3 AS vehicle_count")
    out = keys.overlap_sources(df, KEY).select("chunk", "unique_source_files", "source_files")
    rows = out.orderBy("chunk").collect()
    assert [r.chunk for r in rows] == list(range(1, 1001))
    assert {r.unique_source_files for r in rows} == {1_000_000}
    assert rows[0].source_files.startswith("s0000000 | s0000001")
    named = [r.source_files.split(" | ") for r in rows]
    assert all(len(n) == 1000 for n in named)
    assert [n[0] for n in named] == [f"s{i * 1000:07d}" for i in range(1000)]
