"""Business analyses over facts and Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tallymark.functions.numbers import percent, rounded
from tallymark.operators.anomaly import safe_corr, with_zscore
from tallymark.operators.checks import outside
from tallymark.operators.growth import growth
from tallymark.operators.ranking import top_k
from tallymark.operators.totals import concentration, share, totals
from tallymark.plans.views import value_totals
from tallymark.schemas import BUSINESS_KEY, MEASURE, VALID_YEARS, Grain

REPORTED = "reported_vehicle_count"


def top_values(fact: DataFrame, grain: Grain, k: int = 10) -> DataFrame:
    return top_k(value_totals(fact, grain), "total_vehicles", k, tie=[grain.column])


def year_trend(fact: DataFrame, grain: Grain) -> DataFrame:
    return totals(fact, ["year", grain.column])


def top_values_by_year(fact: DataFrame, grain: Grain, k: int = 10) -> DataFrame:
    return top_k(
        year_trend(fact, grain), "total_vehicles", k, tie=[grain.column], partition=["year"])


def market_share(fact: DataFrame, grain: Grain, k: int | None = None) -> DataFrame:
    """Share of each value in the grain's total; ``k`` keeps the largest ones."""
    shares = share(value_totals(fact, grain), "total_vehicles", "market_share_percent")
    return shares if k is None else top_k(shares, "total_vehicles", k, tie=[grain.column])


def year_over_year(fact: DataFrame, grain: Grain) -> DataFrame:
    return growth(
        year_trend(fact, grain), [grain.column], "year", "total_vehicles",
        "previous_year_vehicles", "yoy_change", "yoy_growth_percent")


def grain_concentration(
    fact: DataFrame, grain: Grain, k: int, top_alias: str, total_alias: str,
) -> DataFrame:
    return concentration(
        value_totals(fact, grain), grain.column, k, top_alias, total_alias,
        f"top_{k}_concentration_percent")


def monthly_trend(silver: DataFrame) -> DataFrame:
    """Reported counts of all reports by month: descriptive, not a unique total."""
    return totals(silver, ["date", "year", "month", "month_name"], REPORTED)


def annual_total(silver: DataFrame) -> DataFrame:
    return totals(silver, ["year"], REPORTED)


def extreme_month(silver: DataFrame, lowest: bool = False) -> DataFrame:
    return top_k(
        monthly_trend(silver), REPORTED, 1, tie=["date"], partition=["year"], ascending=lowest)


def month_rank(silver: DataFrame) -> DataFrame:
    order = W.partitionBy("year").orderBy(F.desc_nulls_last(REPORTED))
    return monthly_trend(silver).withColumn("month_rank", F.rank().over(order))


def aligned_years(left: DataFrame, right: DataFrame, left_alias: str, right_alias: str) -> DataFrame:
    """Yearly sums of two facts next to each other, common years only."""
    return totals(left, ["year"], left_alias).join(totals(right, ["year"], right_alias), "year")


def category_fuel_comparison(category: DataFrame, fuel: DataFrame) -> DataFrame:
    c, f = "category_reported_count", "fuel_reported_count"
    return aligned_years(category, fuel, c, f).select(
        "year", c, f,
        (F.col(c) - F.col(f)).alias("reported_count_difference"),
        percent(c, f).alias("category_to_fuel_ratio_percent"))


def yearly_correlation(left: DataFrame, left_grain: Grain, right: DataFrame, right_grain: Grain) -> DataFrame:
    a, b = f"{left_grain.name}_vehicle_count", f"{right_grain.name}_vehicle_count"
    return aligned_years(left, right, a, b).agg(
        safe_corr(a, b).alias(f"{left_grain.name}_{right_grain.name}_correlation"),
        F.count("*").alias("year_count"),
        rounded(F.avg(a)).alias(f"avg_{left_grain.name}_vehicles"),
        rounded(F.avg(b)).alias(f"avg_{right_grain.name}_vehicles"))


def dataset_distribution(silver: DataFrame) -> DataFrame:
    sizes = silver.groupBy("dataset_type").agg(
        F.count("*").alias("row_count"), F.sum(MEASURE).alias("reported_vehicles"))
    return share(sizes, "reported_vehicles", "share_of_reported_records_percent")


def zero_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("dataset_type").agg(
        F.count_if(F.col(MEASURE) == 0).alias("zero_count_rows"),
        F.count("*").alias("total_rows"),
    ).withColumn("zero_count_percent_within_dataset", percent("zero_count_rows", "total_rows"))


def dq_summary(silver: DataFrame, years=VALID_YEARS, key=BUSINESS_KEY) -> DataFrame:
    """One row of quality figures, the repeated keys among them, from one shuffle."""
    per_key = silver.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(MEASURE).isNull()).alias("nulls"),
        F.count_if(F.col(MEASURE) < 0).alias("negatives"),
        F.count_if(outside("year", *years, null_is_invalid=False)).alias("years"),
        F.count_if(outside("month", 1, 12, null_is_invalid=False)).alias("months"))
    # Two steps, so that the count of types needs no second copy of the key counts.
    per_type = per_key.groupBy("dataset_type").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.sum("negatives").alias("negatives"),
        F.sum("years").alias("years"),
        F.sum("months").alias("months"),
        F.sum(F.when(F.col("date").isNull(), F.col("n")).otherwise(0)).alias("no_date"),
        F.count_if(F.col("n") > 1).alias("repeated"))

    def all_of(column, alias):
        return F.coalesce(F.sum(column), F.lit(0)).alias(alias)

    return per_type.agg(
        all_of("n", "total_rows"),
        all_of("nulls", "null_vehicle_counts"),
        all_of("negatives", "negative_vehicle_counts"),
        all_of("years", "invalid_years"),
        all_of("months", "invalid_months"),
        all_of("no_date", "null_dates"),
        F.count("dataset_type").alias("dataset_types"),
        all_of("repeated", "duplicate_business_key_groups"))


def annual_state_scores(silver: DataFrame) -> DataFrame:
    sums = totals(silver, ["dataset_type", "state_code", "state", "year"], REPORTED)
    return with_zscore(sums, ["dataset_type", "state_code"], REPORTED)


_STATE_YEAR = ["dataset_type", "state_code", "state", "year", REPORTED]


def state_anomalies(silver: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Every state and year with its z-score; the test is on the unrounded score."""
    return annual_state_scores(silver).select(
        *_STATE_YEAR,
        rounded("average").alias("average_vehicle_count"),
        rounded("deviation").alias("standard_deviation"),
        rounded("z").alias("z_score"),
        F.when(F.abs("z") >= threshold, "ANOMALY").otherwise("NORMAL").alias("anomaly_status"))


def priority_anomalies(silver: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Only the outstanding state years; here the score is rounded before the test."""
    scored = annual_state_scores(silver).select(*_STATE_YEAR, rounded("z").alias("z_score"))
    return scored.filter(F.abs("z_score") >= threshold).withColumn(
        "anomaly_type",
        F.when(F.col("z_score") >= threshold, "HIGH_SPIKE").otherwise("HIGH_DROP"))
