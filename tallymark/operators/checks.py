"""Data-quality rules evaluated together in as few passes as possible."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallymark.operators.totals import join_on
from tallymark.schemas import BUSINESS_KEY, EXPECTED_DATASET_TYPES, MEASURE, VALID_YEARS


@dataclass(frozen=True)
class Rule:
    """A named condition that a sound row never meets."""

    name: str
    bad: Column
    critical: bool = False


def outside(column: str, low, high, null_is_invalid: bool) -> Column:
    """Value outside the range; whether NULL counts as outside is the caller's choice."""
    out = (F.col(column) < low) | (F.col(column) > high)
    return F.coalesce(out, F.lit(null_is_invalid))


def null_rules(columns, critical=()) -> list[Rule]:
    return [Rule(f"null_{c}", F.col(c).isNull(), c in critical) for c in columns]


def value_rules(
    critical, years=VALID_YEARS, null_is_invalid: bool = True, types=EXPECTED_DATASET_TYPES,
) -> list[Rule]:
    """The rules on single values; ``critical`` names those that fail a stage."""
    bad = {
        "negative_counts": F.col(MEASURE) < 0,
        "invalid_dates": F.col("date").isNull(),
        "invalid_years": outside("year", *years, null_is_invalid),
        "invalid_months": outside("month", 1, 12, null_is_invalid),
        "unexpected_types": ~F.col("dataset_type").isin(*types),
    }
    return [Rule(name, cond, name in critical) for name, cond in bad.items()]


def count_bad(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row, one column per rule: the rows that break it."""
    return df.agg(*[F.count_if(r.bad).alias(r.name) for r in rules])


def to_rows(one_row: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """Columns of a one-row frame as (name, value) rows."""
    wide = one_row.select(*[F.col(c).cast("bigint").alias(c) for c in one_row.columns])
    return wide.unpivot([], wide.columns, name, value)


def duplicate_counts(
    df: DataFrame, key=BUSINESS_KEY, state: DataFrame | None = None,
) -> DataFrame:
    """Surplus fully equal rows and surplus rows per key, from one chain of counts.

    With a written ``state`` of the keys (``keys.key_state``) only rows of repeated keys are
    compared, as no others can be equal.
    """
    if state is not None:
        repeated = join_on(
            df, state.filter("row_count > 1").select(*key), key, "left_semi")
        surplus = repeated.groupBy(*df.columns).agg((F.count("*") - 1).alias("_surplus")).agg(
            F.coalesce(F.sum("_surplus"), F.lit(0)).alias("n")).scalar()
        return state.agg(F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("n")).select(
            surplus.alias("duplicate_rows"), F.col("n").alias("duplicate_keys"))
    full = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    per_key = full.groupBy(*key).agg(
        F.sum("_copies").alias("_rows"), F.sum(F.col("_copies") - 1).alias("_surplus"))
    return per_key.agg(
        F.coalesce(F.sum("_surplus"), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_keys"))


def report(
    df: DataFrame, rules: list[Rule], duplicates_critical=(), key=BUSINESS_KEY,
    state: DataFrame | None = None,
) -> DataFrame:
    """(check_name, bad_rows, critical, status) for every rule and both duplicate counts."""
    marked = [r.name for r in rules if r.critical] + list(duplicates_critical)
    counts = to_rows(count_bad(df, rules), "check_name", "bad_rows").unionByName(
        to_rows(duplicate_counts(df, key, state), "check_name", "bad_rows"))
    critical = F.col("check_name").isin(*marked) if marked else F.lit(False)
    return counts.withColumn("critical", critical).withColumn(
        "status",
        F.when(F.col("bad_rows") == 0, "PASS").when(F.col("critical"), "FAIL").otherwise("NOTE"))


def missing_columns(df: DataFrame, required) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required) -> DataFrame:
    """The frame itself, or an error that lists the absent columns."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"Missing columns: {absent}")
    return df


def non_numeric(df: DataFrame, columns) -> list[str]:
    """Columns among ``columns`` whose type holds no numbers."""
    kinds = ("byte", "short", "integer", "long", "float", "double", "decimal")
    return [c for c in columns if c in df.columns and df.schema[c].dataType.typeName() not in kinds]
