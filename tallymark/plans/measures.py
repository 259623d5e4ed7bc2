"""Dashboard measures over the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tallymark.operators.growth import calendar, calendar_growth, growth, rolling
from tallymark.operators.ranking import top_k
from tallymark.operators.totals import join_on, share, totals
from tallymark.plans.analytics import priority_anomalies
from tallymark.plans.gold import Gold
from tallymark.schemas import MEASURE, Grain


def coverage_table(gold: Gold) -> DataFrame:
    """Per fact: rows, states, values, first and last date, sum.

    A first count by state and value leaves little to the two distinct counts.
    """
    cells = gold.tagged().groupBy("table_name", "state_code", "value_name").agg(
        F.count("*").alias("n"), F.sum(MEASURE).alias("total"),
        F.min("date").alias("lo"), F.max("date").alias("hi"))
    return cells.groupBy("table_name").agg(
        F.sum("n").alias("row_count"),
        F.count_distinct("state_code").alias("states"),
        F.count_distinct("value_name").alias("values"),
        F.min("lo").alias("min_date"),
        F.max("hi").alias("max_date"),
        F.sum("total").alias("total_vehicles"))


def state_ranking(fact: DataFrame) -> DataFrame:
    """States by total, equal totals on one rank, with their share of the whole."""
    by_state = share(
        totals(fact, ["state_code", "state"]), "total_vehicles", "national_share_percent")
    # One row per state is left here, so a single ordered pass is small.
    order = W.orderBy(F.desc_nulls_last("total_vehicles"))
    return by_state.withColumn("state_rank", F.rank().over(order))


def state_vs_national(fact: DataFrame) -> DataFrame:
    """Monthly sums of each state and of all states, each with its own growth."""
    def grown(df, entity, who):
        return growth(
            df, entity, "date", f"{who}_vehicles", f"{who}_previous", f"{who}_change",
            f"{who}_growth_percent")

    states = totals(fact, ["state_code", "state", "date"], "state_vehicles")
    nation = totals(states, ["date"], "national_vehicles", "state_vehicles")
    # A constant entity keeps the few national months in one window.
    nation = grown(nation.withColumn("_all", F.lit(1)), ["_all"], "national").drop("_all")
    return grown(states, ["state_code"], "state").join(nation, "date")


def state_growth(fact: DataFrame) -> DataFrame:
    return growth(
        totals(fact, ["state_code", "state", "year"]), ["state_code"], "year", "total_vehicles",
        "previous_year_vehicles", "yoy_change", "yoy_growth_percent")


def mix_trend(fact: DataFrame, grain: Grain) -> DataFrame:
    """Share of each value within its state and month."""
    cells = totals(fact, ["state_code", "state", "date", grain.column])
    return share(cells, "total_vehicles", "mix_percent", within=["state_code", "date"])


def top_in_state(fact: DataFrame, grain: Grain, k: int = 10) -> DataFrame:
    return top_k(
        totals(fact, ["state_code", "state", grain.column]), "total_vehicles", k,
        tie=[grain.column], partition=["state_code"], rank_alias="position")


def gainers_decliners(fact: DataFrame, grain: Grain, k: int = 5) -> DataFrame:
    """Per state and month the ``k`` greatest rises and falls against a year earlier.

    Values without a row exactly twelve months earlier are left out.
    """
    cells = totals(fact, ["state_code", grain.column, "date"])
    moved = calendar_growth(
        cells, ["state_code", grain.column], "date", "total_vehicles", 12,
        "year_earlier", "change", "growth_percent").filter("change IS NOT NULL")
    ends = {"GAINER": (False, "change > 0"), "DECLINER": (True, "change < 0")}
    parts = [
        top_k(
            moved.filter(sign), "change", k, tie=[grain.column],
            partition=["state_code", "date"], ascending=rising, rank_alias="position",
        ).withColumn("direction", F.lit(label))
        for label, (rising, sign) in ends.items()
    ]
    return parts[0].unionByName(parts[1])


def guarded_growth(fact: DataFrame, grain: Grain, min_base: int) -> DataFrame:
    """Growth on the same month a year earlier, NULL without a sound base."""
    cells = totals(fact, ["state_code", grain.column, "date"])
    return calendar_growth(
        cells, ["state_code", grain.column], "date", "total_vehicles", 12,
        "year_earlier", "change", "growth_percent", min_base=min_base)


def rolling_trend(fact: DataFrame, grain: Grain) -> DataFrame:
    return rolling(
        fact, ["state_code", grain.column], {"rolling_3": 3, "rolling_12": 12})


def date_table(silver: DataFrame) -> DataFrame:
    return calendar(silver)


def correlated_movement(silver: DataFrame, k: int = 3, threshold: float = 2.0) -> DataFrame:
    """For each outstanding state year the largest movers of the other reports.

    The movers of every report, state and year are cut to ``k`` before the join, which
    then meets few rows. The result tells what moved at the same time, not why.
    """
    anomalies = priority_anomalies(silver, threshold).select(
        F.col("dataset_type").alias("anomaly_dataset"), "state_code", "year",
        "anomaly_type", "z_score")
    yearly = totals(silver, ["dataset_type", "state_code", "dimension_value", "year"])
    moved = growth(
        yearly, ["dataset_type", "state_code", "dimension_value"], "year", "total_vehicles",
        "previous_year_vehicles", "yoy_change", "yoy_growth_percent",
    ).filter("yoy_change IS NOT NULL").withColumn("size", F.abs("yoy_change"))
    movers = top_k(
        moved, "size", k, tie=["dimension_value"],
        partition=["dataset_type", "state_code", "year"], rank_alias="position").drop("size")
    return (
        join_on(anomalies, movers, ["state_code", "year"])
        .filter("dataset_type <> anomaly_dataset")
    )
