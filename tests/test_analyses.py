import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators.ranking import ranked, top_k
from tallymark.operators.totals import share, totals
from tallymark.plans import analytics, gold, measures, reconciliation, views
from tallymark.schemas import CATEGORY, FUEL, MANUFACTURER, SILVER_SCHEMA


def fact(market, cells, grain=FUEL):
    rows = [(grain.dataset_type, *c) for c in cells]
    return gold.fact(market(rows), grain)


def test_ranking_in_buckets_equals_a_plain_ranking(spark):
    rng = random.Random(7)
    data = [("hot" if i % 3 else f"s{i % 5}", f"n{i:05d}", rng.choice([0, 1, 5, rng.randrange(10**12), -4]))
            for i in range(4000)] + [(None, "x", None), (None, "y", 3), ("hot", "zz", 2**62), ("hot", "zy", 63), ("hot", "zx", 64)]
    df = spark.createDataFrame(data, "g string, n string, v long")
    got = {(r.g, r.n): r.rank for r in ranked(df, "v", ["n"], ["g"], "rank").collect()}
    want = {}
    for g in {d[0] for d in data}:
        group = sorted((d for d in data if d[0] == g), key=lambda d: (d[2] is None, -(d[2] or 0), d[1]))
        want.update({(g, d[1]): i for i, d in enumerate(group, 1)})
    assert got == want


def test_top_k_cuts_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as g", "id as v")
    plan = top_k(df, "v", 2, ["g"], partition=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_shares(spark, market, rows):
    df = fact(market, [("an", "A", "2016-01", 1), ("an", "B", "2016-01", 2), ("ap", "A", "2016-01", 0)])
    assert rows(analytics.market_share(df, FUEL), "fuel_name", "market_share_percent") == [
        ("A", 33.33), ("B", 66.67)]
    assert analytics.market_share(df, FUEL, 1).first().market_share_percent == 66.67
    within = share(totals(df, ["state_code", "fuel_name"]), "total_vehicles", "p", within=["state_code"])
    assert rows(within, "state_code", "fuel_name", "p") == [
        ("an", "A", 33.33), ("an", "B", 66.67), ("ap", "A", None)]
    zero = fact(market, [("an", "A", "2016-01", 0)])
    assert analytics.market_share(zero, FUEL).first().market_share_percent is None


def test_no_global_window_on_shares(market):
    df = fact(market, [("an", "A", "2016-01", 1)])
    for frame in (analytics.market_share(df, FUEL),
                  analytics.grain_concentration(df, FUEL, 3, "t", "a")):
        assert "Window" not in frame._jdf.queryExecution().executedPlan().toString()


def test_monthly_growth_compares_with_the_previous_row(market, rows):
    df = fact(market, [("an", "A", "2016-01", 0), ("an", "A", "2016-04", 5), ("an", "A", "2016-05", 4)])
    got = rows(views.monthly_growth(df, FUEL), "month", "previous_month_vehicles", "monthly_change", "monthly_growth_percent")
    assert got == [(1, None, None, None), (4, 0, 5, None), (5, 5, -1, -20.0)]


def test_yoy_skips_absent_years(market, rows):
    df = fact(market, [("an", "A", "2016-01", 4), ("an", "A", "2019-01", 5)])
    assert rows(analytics.year_over_year(df, FUEL), "year", "previous_year_vehicles", "yoy_growth_percent") == [
        (2016, None, None), (2019, 4, 25.0)]


def test_peak_and_rank_ties(market, rows):
    silver = market([("Fuel", "an", "A", "2016-02", 5), ("Fuel", "an", "A", "2016-01", 5), ("Fuel", "an", "A", "2016-03", 1)])
    assert analytics.extreme_month(silver).first().month == 1
    assert analytics.extreme_month(silver, lowest=True).first().month == 3
    assert rows(analytics.month_rank(silver), "month", "month_rank") == [(1, 1), (2, 1), (3, 3)]


def test_state_summary_keeps_states_of_one_fact(market, rows):
    silver = market([
        ("Vehicle_Category", "an", "A", "2016-01", 1), ("Fuel", "ap", "A", "2016-01", 2),
        ("Manufacturer", "ap", "A", "2016-01", 3), ("Manufacturer", "ar", "A", "2016-01", 4)])
    got = rows(views.state_market_summary(gold.build_gold(silver)),
               "state_code", "category_vehicles", "fuel_vehicles", "manufacturer_vehicles")
    assert got == [("an", 1, 0, 0), ("ap", 0, 2, 3), ("ar", 0, 0, 4)]


def test_anomaly_edges(market, rows):
    one = market([("Fuel", "an", "A", "2016-01", 5)])
    flat = market([("Fuel", "an", "A", f"{y}-01", 5) for y in range(2016, 2020)])
    for df in (one, flat):
        assert {(r.z_score, r.anomaly_status) for r in analytics.state_anomalies(df).collect()} == {(None, "NORMAL")}
        assert analytics.priority_anomalies(df).count() == 0


def test_rounding_before_the_test_differs(market):
    # Seven equal years and one high: z is near 2.475; the threshold is set between the
    # exact and the rounded score.
    df = market([("Fuel", "an", "A", f"{2016 + i}-01", 10 if i else 100) for i in range(8)])
    exact = analytics.annual_state_scores(df).agg(F.max("z")).first()[0]
    assert exact < 2.48 and round(exact, 2) != exact
    near = round(exact, 2)
    if near > exact:
        assert analytics.state_anomalies(df, near).filter("anomaly_status = 'ANOMALY'").count() == 0
        assert analytics.priority_anomalies(df, near).count() == 1
    else:
        assert analytics.state_anomalies(df, exact).filter("anomaly_status = 'ANOMALY'").count() == 1
        assert analytics.priority_anomalies(df, exact).count() == 0


def test_correlation_guards(market):
    def corr(category, fuel):
        silver = market(
            [("Vehicle_Category", "an", "A", f"{y}-01", n) for y, n in category]
            + [("Fuel", "an", "A", f"{y}-01", n) for y, n in fuel])
        g = gold.build_gold(silver)
        return analytics.yearly_correlation(g.fact_category, CATEGORY, g.fact_fuel, FUEL).first()

    assert corr([(2016, 1)], [(2016, 5)]).category_fuel_correlation is None
    assert corr([(2016, 1), (2017, 1)], [(2016, 5), (2017, 6)]).category_fuel_correlation is None
    full = corr([(2016, 1), (2017, 2), (2018, 4)], [(2016, 2), (2017, 4), (2018, 8), (2019, 1)])
    assert full.category_fuel_correlation == pytest.approx(1.0) and full.year_count == 3
    assert (full.avg_category_vehicles, full.avg_fuel_vehicles) == (2.33, 4.67)


def test_reconciliation(spark, market, rows):
    silver = market([("Fuel", "an", "A", "2016-01", 1), ("Fuel", "an", "B", "2016-01", 2)])
    full = gold.build_gold(silver)
    got = rows(reconciliation.reconcile_by_dataset(silver, full), "dataset_type", "silver_rows", "gold_total", "reconciliation_status")
    assert got == [("CATEGORY", 0, 0, "PASS"), ("FUEL", 2, 3, "PASS"), ("MANUFACTURER", 0, 0, "PASS")]
    short = gold.build_gold(silver.filter("dimension_value = 'A'"))
    assert reconciliation.reconcile_overall(silver, short).first().overall_status == "CHECK"
    last = reconciliation.validation_summary(silver, short).collect()[-1]
    assert (last.metric_value, last.status) == ("Row count mismatch - review", "FAIL")
    empty = spark.createDataFrame([], SILVER_SCHEMA)
    assert reconciliation.reconcile_overall(empty, gold.build_gold(empty)).first().overall_status == "PASS"
    metrics = reconciliation.reconcile_metrics(silver, full).orderBy("position").collect()
    assert [m.value for m in metrics] == [2, 2, 3, 3]


def test_calendar_measures_use_months_not_rows(market, rows):
    df = fact(market, [("an", "A", "2016-01", 6), ("an", "A", "2016-03", 3), ("an", "A", "2017-01", 9), ("an", "A", "2017-02", 1)])
    rolled = {str(r.date): (r.vehicle_count, r.rolling_3) for r in measures.rolling_trend(df, FUEL).collect()}
    assert len(rolled) == 14
    assert rolled["2016-02-01"] == (0, None) and rolled["2016-03-01"] == (3, 3.0) and rolled["2016-04-01"] == (0, 1.0)
    moved = measures.gainers_decliners(df, FUEL).collect()
    assert [(str(r.date), r.change, r.direction) for r in moved] == [("2017-01-01", 3, "GAINER")]


def test_guarded_growth(market, rows):
    df = fact(market, [("an", "A", "2016-01", 5), ("an", "A", "2017-01", 10), ("an", "B", "2016-01", 50), ("an", "B", "2017-01", 60)])
    got = rows(measures.guarded_growth(df, FUEL, 20).filter("year_earlier is not null"), "fuel_name", "growth_percent")
    assert got == [("A", None), ("B", 20.0)]


def test_views_are_queryable(spark, market):
    silver = market([("Fuel", "an", "A", "2016-01", 1), ("Manufacturer", "an", "M", "2016-01", 4)])
    names = views.register_views(gold.build_gold(silver))
    assert len([n for n in names if n.startswith("vw_")]) == 19 and len(names) == 27
    assert spark.sql("select sum(total_vehicles) from vw_fuel_totals").first()[0] == 1
    assert analytics.top_values(gold.fact(silver, MANUFACTURER), MANUFACTURER).first().manufacturer_name == "M"
