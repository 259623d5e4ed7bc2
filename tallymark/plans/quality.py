"""Stage validation, profiles and single-figure checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymark.functions.numbers import rounded
from tallymark.operators import checks
from tallymark.operators.checks import Rule, outside, to_rows
from tallymark.operators.keys import duplicate_keys, duplicate_records
from tallymark.operators.ranking import top_k
from tallymark.operators.selection import quantiles
from tallymark.schemas import ALL_PASSED, BUSINESS_KEY, MEASURE, SILVER_COLUMNS, VALID_YEARS
from tallymark.sources.workspace import written


def dq_unified(df: DataFrame, years=VALID_YEARS, key=BUSINESS_KEY) -> DataFrame:
    """Unified validation: everything but NULL text and full duplicates is critical."""
    nulls = checks.null_rules([c for c in SILVER_COLUMNS if c in df.columns], [MEASURE])
    values = checks.value_rules(
        ["negative_counts", "invalid_dates", "invalid_years", "invalid_months",
         "unexpected_types"], years)
    return checks.report(df, nulls + values, ["duplicate_keys"], key)


def dq_silver(
    df: DataFrame, years=VALID_YEARS, key=BUSINESS_KEY, state: DataFrame | None = None,
) -> DataFrame:
    """Silver validation: negatives, years, months and dates are critical.

    A written ``state`` of the keys spares the shuffle of all rows.
    """
    values = checks.value_rules(
        ["negative_counts", "invalid_dates", "invalid_years", "invalid_months"], years)
    return checks.report(df, checks.null_rules(SILVER_COLUMNS) + values, key=key, state=state)


def dq_profile(df: DataFrame, years=VALID_YEARS, key=BUSINESS_KEY) -> DataFrame:
    """Figures only, nothing fails: NULL years pass, months other than 1..12 do not."""
    rules = [
        Rule("rows", F.lit(True)),
        Rule("negative_counts", F.col(MEASURE) < 0),
        Rule("invalid_years", outside("year", *years, null_is_invalid=False)),
        Rule("invalid_months", outside("month", 1, 12, null_is_invalid=True)),
        Rule("missing_dimension_value", F.col("dimension_value").isNull()),
        Rule("missing_source_file", F.col("source_file").isNull()),
    ]
    nulls = checks.null_rules([c for c in SILVER_COLUMNS if c in df.columns])
    counts = to_rows(checks.count_bad(df, rules + nulls), "check_name", "rows")
    repeated = to_rows(checks.duplicate_counts(df, key), "check_name", "rows")
    return counts.unionByName(repeated)


def count_statistics(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of the measure.

    Rows are folded to distinct counts first, and the quartiles come from counting these in
    ever narrower ranges: no task holds all distinct counts.
    """
    counts = df.filter(F.col(MEASURE).isNotNull())
    folded = written(counts.groupBy(MEASURE).agg(F.count("*").alias("n")), "counts")
    quartiles = quantiles(folded, MEASURE, "n", (0.25, 0.5, 0.75))
    moments = counts.agg(
        F.count("*").alias("value_count"),
        rounded(F.avg(MEASURE)).alias("mean"),
        rounded(F.stddev_samp(MEASURE)).alias("stddev"),
        F.min(MEASURE).alias("min"),
        F.max(MEASURE).alias("max"))
    return moments.select(
        "value_count", "mean", "stddev", "min",
        *[F.lit(q).cast("double").alias(name) for q, name in zip(quartiles, ("p25", "p50", "p75"))],
        "max")


def schema_errors(df: DataFrame, required, numeric=("year", "month", MEASURE)) -> list[str]:
    """Absent columns and columns that should hold numbers and do not."""
    found = {
        "missing columns": checks.missing_columns(df, required),
        "non-numeric columns": checks.non_numeric(df, numeric),
    }
    return [f"{what}: {columns}" for what, columns in found.items() if columns]


def stage_result(report: DataFrame, stage: str, rows: int, errors=()) -> dict:
    """Outcome of a (check_name, bad_rows, critical, status) report as a log entry."""
    broken = report.filter("status = 'FAIL'").select("check_name", "bad_rows").collect()
    failed = [*errors, *[f"{r.check_name}: {r.bad_rows}" for r in broken]]
    details = "; ".join(failed)
    return {
        "stage": stage,
        "status": "FAIL" if failed else "PASS",
        "rows_checked": rows,
        "critical_error_count": len(failed),
        "details": details or ALL_PASSED,
    }


def summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"), F.sum(MEASURE).alias("total_vehicles"))


def dataset_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("dataset_type").agg(
        F.count("*").alias("row_count"), F.sum(MEASURE).alias("total_vehicles"))


def coverage_summary(df: DataFrame) -> DataFrame:
    """First and last date, distinct codes and names; distinct pairs are formed first."""
    pairs = df.groupBy("state_code", "state").agg(
        F.min("date").alias("lo"), F.max("date").alias("hi"))
    return pairs.agg(
        F.min("lo").alias("min_date"), F.max("hi").alias("max_date"),
        F.count_distinct("state_code").alias("state_count"),
        F.count_distinct("state").alias("state_name_count"))


def _count_where(condition: Column, alias: str):
    return lambda df: df.agg(F.count_if(condition).alias(alias))


def null_counts(df: DataFrame) -> DataFrame:
    return _count_where(F.col(MEASURE).isNull(), "null_vehicle_counts")(df)


def negative_counts(df: DataFrame) -> DataFrame:
    return _count_where(F.col(MEASURE) < 0, "negative_vehicle_counts")(df)


def invalid_years(df: DataFrame, years=VALID_YEARS) -> DataFrame:
    return _count_where(outside("year", *years, null_is_invalid=False), "invalid_years")(df)


def invalid_months(df: DataFrame) -> DataFrame:
    return _count_where(outside("month", 1, 12, null_is_invalid=False), "invalid_months")(df)


def null_profile(df: DataFrame) -> DataFrame:
    return checks.count_bad(df, checks.null_rules(SILVER_COLUMNS))


def silver_metric_rows(df: DataFrame) -> DataFrame:
    """Four (metric, value) rows."""
    pairs = df.groupBy("state_code", "dataset_type").agg(
        F.count("*").alias("n"), F.sum(MEASURE).alias("total"))
    return to_rows(pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("SILVER_TOTAL_ROWS"),
        F.sum("total").alias("SILVER_TOTAL_VEHICLES"),
        F.count_distinct("state_code").alias("SILVER_STATE_COUNT"),
        F.count_distinct("dataset_type").alias("SILVER_DATASET_COUNT")))


def duplicate_datasets(df: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    """Rows of repeated keys and repeated keys by dataset."""
    return duplicate_keys(df, key).groupBy("dataset_type").agg(
        F.sum("duplicate_count").alias("duplicate_rows"), F.count("*").alias("duplicate_groups"))


def top_duplicate_sources(df: DataFrame, key=BUSINESS_KEY, k: int = 20) -> DataFrame:
    """The sources with most rows of repeated keys."""
    counted = duplicate_records(df, key).groupBy("source_file").agg(
        F.count("*").alias("duplicate_rows"))
    return top_k(counted, "duplicate_rows", k, tie=["source_file"])


def duplicate_sources(df: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    """Copies of repeated keys by dataset and source."""
    return duplicate_records(df, key).groupBy("dataset_type", "source_file").agg(
        F.count("*").alias("duplicate_rows"))
