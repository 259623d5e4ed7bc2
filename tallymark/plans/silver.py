"""Unified rows to Silver: standardise, validate, remove repeats, gate, write."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType

from tallymark.functions.numbers import count_of, whole
from tallymark.functions.reports import (
    DEFAULT_NAMING, ReportNaming, first_of_month, state_code, strip_blanks)
from tallymark.operators.checks import outside, require_columns
from tallymark.operators.keys import conflicts, duplicate_keys, duplicate_records, first_per_key
from tallymark.operators.ranking import top_k
from tallymark.schemas import (
    AGGREGATE_LABELS, BUSINESS_KEY, INDIA_STATES, MEASURE, REJECT_REASONS, SILVER_COLUMNS,
    TEXT_COLUMNS, UNIFIED_COLUMNS, UNIFIED_TO_SILVER, VALID_YEARS)


class GateError(ValueError):
    """A stage found rows that must stop the run."""


def india_states(spark: SparkSession) -> DataFrame:
    """The fixed table of state codes and names."""
    return spark.createDataFrame(list(INDIA_STATES.items()), "state_code string, state string")


def standardise(unified: DataFrame) -> DataFrame:
    """Silver names and trimmed text columns."""
    renamed = require_columns(unified, UNIFIED_TO_SILVER).withColumnsRenamed(UNIFIED_TO_SILVER)
    return renamed.withColumns({c: strip_blanks(F.col(c).cast("string")) for c in TEXT_COLUMNS})


def with_state_code(df: DataFrame, naming: ReportNaming = DEFAULT_NAMING) -> DataFrame:
    return df.withColumn("state_code", state_code("source_file", naming))


def map_state(df: DataFrame, states: DataFrame) -> DataFrame:
    """Add the state name; unknown codes keep NULL. ``states`` has one row per code.

    Spark broadcasts the table when its size allows and shuffles otherwise.
    """
    return df.join(states.select("state_code", "state"), "state_code", "left")


def coerce_types(df: DataFrame) -> DataFrame:
    """Whole years and months, counts, and the first day of the month; NULL on failure.

    Columns that already hold whole numbers are not read as text again.
    """
    def read(column, parse, kind):
        if isinstance(df.schema[column].dataType, IntegralType):
            return F.col(column).try_cast(kind)
        return parse(column).try_cast(kind)

    typed = df.withColumns({
        "year": read("year", whole, "int"),
        "month": read("month", whole, "int"),
        MEASURE: read(MEASURE, count_of, "bigint"),
    })
    return typed.withColumn("date", first_of_month("year", "month"))


def _empty(column: str) -> Column:
    return F.coalesce(F.col(column) == "", F.lit(True))


def reject_rules(years=VALID_YEARS) -> dict[str, Column]:
    """Reason -> condition, in the order of :data:`REJECT_REASONS`."""
    conditions = [
        outside("year", *years, null_is_invalid=True),
        outside("month", 1, 12, null_is_invalid=True),
        outside(MEASURE, 0, 2**63 - 1, null_is_invalid=True),
        _empty("dimension_value"),
        _empty("dataset_type"),
        F.col("state_code").isNull() | F.col("state").isNull(),
    ]
    return dict(zip(REJECT_REASONS, conditions))


def _broken(years) -> Column:
    return reduce(or_, reject_rules(years).values())


def rejected(df: DataFrame, years=VALID_YEARS) -> DataFrame:
    """Rows that break a rule, with all their reasons joined in a fixed order."""
    pieces = [
        F.when(bad, F.lit(reason + "; ")).otherwise("") for reason, bad in reject_rules(years).items()
    ]
    return df.filter(_broken(years)).withColumn("error_reason", F.concat(*pieces))


def accepted(df: DataFrame, years=VALID_YEARS) -> DataFrame:
    """Rows that break no rule; the conditions are never NULL, so no row is lost."""
    return df.filter(~_broken(years))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def transform(
    unified: DataFrame, states: DataFrame, naming: ReportNaming = DEFAULT_NAMING,
    years=VALID_YEARS,
) -> tuple[DataFrame, DataFrame]:
    """(Silver rows, rejected rows) of a Unified frame, both lazy.

    Types are settled before the state lookup: the reject rules then stand above the
    join and use finished values, where a filter on plain expressions would be pushed
    down and work them out a second time.
    """
    typed = with_state_code(coerce_types(standardise(unified)), naming)
    rows = map_state(typed, states).select(*SILVER_COLUMNS)
    return drop_exact_duplicates(accepted(rows, years)), rejected(rows, years)


def dedup(df: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    """First row per key. Only sound when :func:`require_no_conflicts` has passed."""
    return first_per_key(df, key)


def require_no_conflicts(df: DataFrame, key=BUSINESS_KEY) -> None:
    """Raise when copies of one key disagree on the count."""
    disagreeing = conflicts(df, key)
    found = disagreeing.limit(20).collect()
    if found:
        sample = "; ".join(str(r.asDict()) for r in found)
        raise GateError(
            f"Copies of {disagreeing.count()} business keys disagree on the count; none was "
            "removed, such as: " + sample)


def drop_aggregates(df: DataFrame) -> DataFrame:
    """Rows other than the sums that reports carry along."""
    label = F.coalesce(F.upper("dimension_value"), F.lit(""))
    return df.filter(~label.isin(*AGGREGATE_LABELS))


def gate_violations(df: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    """Every copy of a key that is still repeated after the aggregates are gone."""
    return duplicate_records(drop_aggregates(df), key)


def load_gate(df: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    """The rows to load, or an error when a key is repeated."""
    loadable = drop_aggregates(require_columns(df, SILVER_COLUMNS))
    found = duplicate_keys(loadable, key).agg(
        F.coalesce(F.sum("duplicate_count"), F.lit(0)).alias("n"), F.count("*").alias("g")).first()
    if found.g:
        sample = [r.asDict() for r in gate_violations(df, key).limit(20).collect()]
        raise GateError(
            f"Business keys are repeated: {found.n} rows in {found.g} groups, such as {sample}")
    return loadable


def silver_sorted(df: DataFrame, partition=()) -> DataFrame:
    """Ordered by type, state, value, year, month; columns of a ``partition`` come first.

    The range split is over the whole key, so a type or state with most of the rows is
    cut into many tasks, and files written from it have narrow value ranges. Spark samples
    the input for the split, so it should be a stored table and not a long plan.
    """
    columns = ["dataset_type", "state", "dimension_value", "year", "month"]
    order = [*partition, *[c for c in columns if c not in partition]]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def latest_sample(df: DataFrame, k: int = 20) -> DataFrame:
    """The newest rows, in a settled order."""
    return top_k(
        df, "date", k,
        tie=["dataset_type", "state_code", "dimension_value", "source_file", MEASURE])


def silver_columns(df: DataFrame) -> DataFrame:
    return df.select(*SILVER_COLUMNS)


def unified_names(df: DataFrame) -> DataFrame:
    """Snake-case Unified rows under the exchange names."""
    return df.select(*UNIFIED_COLUMNS).withColumnsRenamed(
        {v: k for k, v in UNIFIED_TO_SILVER.items()})
