"""Star schema over Silver: five dimensions and one fact per report grain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallymark.operators.keys import duplicate_keys
from tallymark.operators.reconcile import volume
from tallymark.operators.totals import tag_union
from tallymark.schemas import CATEGORY, FUEL, GOLD_MESSAGE, GRAINS, MANUFACTURER, MEASURE, Grain

FACT_LEAD = ["date", "year", "month", "month_name", "period", "state_code", "state"]


def dim_date(silver: DataFrame) -> DataFrame:
    return (
        silver.filter("date IS NOT NULL")
        .select(F.col("date").alias("date_key"), "year", "month", "month_name", "period")
        .distinct()
    )


def dim_state(silver: DataFrame) -> DataFrame:
    return (
        silver.filter("state_code IS NOT NULL AND state IS NOT NULL")
        .select("state_code", "state").distinct()
    )


def dim_value(silver: DataFrame, grain: Grain) -> DataFrame:
    return (
        silver.filter(F.col("dataset_type") == grain.dataset_type)
        .select(F.col("dimension_value").alias(grain.column)).distinct()
    )


def fact(silver: DataFrame, grain: Grain) -> DataFrame:
    """Rows of one report; a partition-pruned projection when Silver is partitioned."""
    return silver.filter(F.col("dataset_type") == grain.dataset_type).select(
        *FACT_LEAD, F.col("dimension_value").alias(grain.column), MEASURE, "source_file")


@dataclass(frozen=True)
class Gold:
    """The eight tables by name."""

    dim_date: DataFrame
    dim_state: DataFrame
    dim_category: DataFrame
    dim_fuel: DataFrame
    dim_manufacturer: DataFrame
    fact_category: DataFrame
    fact_fuel: DataFrame
    fact_manufacturer: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))

    def fact(self, grain: Grain) -> DataFrame:
        return getattr(self, grain.fact)

    def facts(self) -> dict[str, DataFrame]:
        """Facts by upper-case table name, value column under one common name."""
        return {
            g.fact.upper(): self.fact(g).withColumnRenamed(g.column, "value_name")
            for g in GRAINS
        }

    def tagged(self) -> DataFrame:
        return tag_union(self.facts(), "table_name")


def build_gold(silver: DataFrame) -> Gold:
    return Gold(
        dim_date=dim_date(silver),
        dim_state=dim_state(silver),
        dim_category=dim_value(silver, CATEGORY),
        dim_fuel=dim_value(silver, FUEL),
        dim_manufacturer=dim_value(silver, MANUFACTURER),
        fact_category=fact(silver, CATEGORY),
        fact_fuel=fact(silver, FUEL),
        fact_manufacturer=fact(silver, MANUFACTURER),
    )


def gold_row_counts(gold: Gold) -> DataFrame:
    counts = {
        name.upper(): df.agg(F.count("*").alias("row_count"))
        for name, df in gold.tables().items()
    }
    return tag_union(counts, "table_name")


def silver_vs_gold(silver: DataFrame, gold: Gold) -> DataFrame:
    def sized(df):
        return df.agg(F.count("*").alias("row_count"), F.sum(MEASURE).alias("total_vehicles"))

    return tag_union({"SILVER": sized(silver), "GOLD": sized(gold.tagged())}, "source")


def gold_summary(gold: Gold) -> DataFrame:
    """Rows and sum per fact; facts without rows are listed too."""
    sized = {
        name: df.agg(F.count("*").alias("gold_rows"), F.sum(MEASURE).alias("gold_vehicles"))
        for name, df in gold.facts().items()
    }
    return tag_union(sized, "dataset_type")


def fact_duplicates(gold: Gold) -> DataFrame:
    return duplicate_keys(gold.tagged(), ["table_name", "date", "state_code", "value_name"])


def fact_null_negative(gold: Gold) -> DataFrame:
    checked = {
        name: df.agg(
            F.count_if(F.col(MEASURE).isNull()).alias("null_counts"),
            F.count_if(F.col(MEASURE) < 0).alias("negative_counts"))
        for name, df in gold.facts().items()
    }
    return tag_union(checked, "table_name")


def gold_status(gold: Gold) -> DataFrame:
    """One row: a message and the row count of each table."""
    counts = gold_row_counts(gold)
    picked = [
        F.max(F.when(F.col("table_name") == name.upper(), F.col("row_count")))
        .alias(f"{name}_rows")
        for name in gold.tables()
    ]
    return counts.agg(*picked).select(F.lit(GOLD_MESSAGE).alias("status"), "*")
