"""The nineteen analytic views, as functions of the fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymark.operators.growth import growth
from tallymark.operators.ranking import ranked
from tallymark.operators.totals import totals
from tallymark.plans.gold import FACT_LEAD, Gold
from tallymark.schemas import CATEGORY, FUEL, GRAINS, MANUFACTURER, MEASURE, Grain


def monthly(fact: DataFrame, grain: Grain) -> DataFrame:
    return fact.select(*FACT_LEAD, grain.column, MEASURE, "source_file")


def value_totals(fact: DataFrame, grain: Grain) -> DataFrame:
    return totals(fact, [grain.column])


def state_totals(fact: DataFrame, grain: Grain) -> DataFrame:
    return totals(fact, ["state_code", "state", grain.column])


def yearly(fact: DataFrame, grain: Grain) -> DataFrame:
    return totals(fact, ["year", "state_code", "state", grain.column])


def monthly_growth(fact: DataFrame, grain: Grain) -> DataFrame:
    """Change against the previous row of the same state and value."""
    return growth(
        fact, ["state_code", grain.column], "date", MEASURE,
        "previous_month_vehicles", "monthly_change", "monthly_growth_percent",
        tie=["source_file", MEASURE])


def top_by_state(fact: DataFrame, grain: Grain) -> DataFrame:
    return ranked(
        state_totals(fact, grain), "total_vehicles", tie=[grain.column],
        partition=["state_code"], alias=f"{grain.name}_rank")


def state_market_summary(gold: Gold) -> DataFrame:
    """The three sums of each state side by side; states missing from a fact show 0."""
    def by_state(grain):
        sums = totals(gold.fact(grain), ["state_code", "state"], f"{grain.name}_vehicles")
        return sums.withColumnsRenamed({"state_code": f"{grain.name}_code", "state": f"{grain.name}_state"})

    c, f, m = (by_state(g) for g in (CATEGORY, FUEL, MANUFACTURER))
    joined = c.join(f, F.col("category_code") == F.col("fuel_code"), "full").join(
        m, F.coalesce("category_code", "fuel_code") == F.col("manufacturer_code"), "full")
    return joined.select(
        F.coalesce("category_code", "fuel_code", "manufacturer_code").alias("state_code"),
        F.coalesce("category_state", "fuel_state", "manufacturer_state").alias("state"),
        *[F.coalesce(f"{g.name}_vehicles", F.lit(0)).alias(f"{g.name}_vehicles") for g in GRAINS])


VIEW_BUILDERS = {
    "vw_{}_monthly": monthly,
    "vw_{}_totals": value_totals,
    "vw_state_{}_totals": state_totals,
    "vw_{}_growth": monthly_growth,
    "vw_top_{}_by_state": top_by_state,
    "vw_{}_yearly": yearly,
}


def all_views(gold: Gold) -> dict[str, DataFrame]:
    views = {
        pattern.format(g.name): build(gold.fact(g), g)
        for pattern, build in VIEW_BUILDERS.items() for g in GRAINS
    }
    views["vw_state_market_summary"] = state_market_summary(gold)
    return views


def register_views(gold: Gold) -> list[str]:
    """Make every Gold table and view known to ``spark.sql`` under its name."""
    named = {**gold.tables(), **all_views(gold)}
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    return sorted(named)
