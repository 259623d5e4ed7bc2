"""Silver against Gold, and the summary that closes a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymark.operators.reconcile import reconcile, volume
from tallymark.operators.totals import tag_union
from tallymark.plans.gold import Gold
from tallymark.schemas import GRAINS, MEASURE, ROWS_DIFFER, ROWS_MATCH, SUMMARY_METRICS


def reconcile_by_dataset(silver: DataFrame, gold: Gold) -> DataFrame:
    """One row per grain, also for grains without rows."""
    labels = {g.name.upper(): g for g in GRAINS}
    silver_side = tag_union(
        {
            label: volume(silver.filter(F.col("dataset_type") == g.dataset_type))
            for label, g in labels.items()
        },
        "dataset_type")
    gold_side = tag_union(
        {label: volume(gold.fact(g)) for label, g in labels.items()}, "dataset_type")
    return reconcile(silver_side, gold_side, ["dataset_type"])


def reconcile_overall(silver: DataFrame, gold: Gold) -> DataFrame:
    return reconcile(
        volume(silver), volume(gold.tagged()), sum_name="vehicles", status="overall_status")


def reconcile_metrics(silver: DataFrame, gold: Gold) -> DataFrame:
    """Four (metric, value) rows in a fixed order, which ``position`` tells."""
    both = reconcile_overall(silver, gold)
    metrics = ["silver_rows", "gold_rows", "silver_vehicles", "gold_vehicles"]
    names = {
        "silver_rows": "SILVER_TOTAL_ROWS",
        "gold_rows": "GOLD_TOTAL_ROWS",
        "silver_vehicles": "SILVER_TOTAL_VEHICLES",
        "gold_vehicles": "GOLD_TOTAL_VEHICLES",
    }
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(names[m]).alias("metric"),
            F.col(m).cast("bigint").alias("value"))
        for i, m in enumerate(metrics, start=1)
    ]
    return both.select(F.inline(F.array(*entries)))


def validation_summary(silver: DataFrame, gold: Gold) -> DataFrame:
    """Four (metric_name, metric_value, status) rows that close a run."""
    facts = volume(gold.tagged()).select(F.col("rows").alias("n")).scalar()
    errors = F.col("nulls") + F.col("negatives") + F.col("no_date")
    figures = silver.agg(
        F.count("*").alias("n"),
        F.sum(MEASURE).alias("total"),
        F.count_if(F.col(MEASURE).isNull()).alias("nulls"),
        F.count_if(F.col(MEASURE) < 0).alias("negatives"),
        F.count_if(F.col("date").isNull()).alias("no_date"),
    ).select("n", "total", errors.alias("errors"), facts.alias("gold_rows"))
    same = F.col("n") == F.col("gold_rows")

    def entry(name, value, status):
        return F.struct(
            F.lit(name).alias("metric_name"),
            value.cast("string").alias("metric_value"),
            status.alias("status"))

    outcomes = [
        (F.col("n"), F.lit("PASS")),
        (F.col("total"), F.lit("PASS")),
        (F.col("errors"), F.when(F.col("errors") == 0, "PASS").otherwise("CHECK")),
        (F.when(same, ROWS_MATCH).otherwise(ROWS_DIFFER), F.when(same, "PASS").otherwise("FAIL")),
    ]
    entries = [entry(name, *outcome) for name, outcome in zip(SUMMARY_METRICS, outcomes)]
    return figures.select(F.inline(F.array(*entries)))
