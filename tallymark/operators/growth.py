"""Change against an earlier period, rolling trends and the calendar spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymark.functions.numbers import percent, rounded
from tallymark.functions.reports import month_name
from tallymark.operators.totals import join_on
from tallymark.schemas import MEASURE


def guarded_percent(change, previous, min_base: int | None = None) -> Column:
    """Growth in percent; NULL when the prior period is missing, zero or too small."""
    grown = percent(change, previous)
    if min_base is None:
        return grown
    return F.when(F.col(previous) >= min_base, grown)


def growth(
    df: DataFrame, entity, period: str, measure: str, previous: str, change: str, growth_alias: str,
    min_base: int | None = None, tie=(),
) -> DataFrame:
    """Change against the entity's previous row, whatever period that row has.

    ``tie`` orders rows that share a period, so that the answer is settled.
    """
    window = W.partitionBy(*entity).orderBy(
        F.asc_nulls_last(period), *[F.asc_nulls_last(t) for t in tie])
    return (
        df.withColumn(previous, F.lag(measure).over(window))
        .withColumn(change, F.col(measure) - F.col(previous))
        .withColumn(growth_alias, guarded_percent(change, previous, min_base))
    )


def calendar_growth(
    df: DataFrame, entity, date: str, measure: str, months: int, previous: str, change: str,
    growth_alias: str, min_base: int | None = None,
) -> DataFrame:
    """Change against the row that lies exactly ``months`` earlier; NULL when absent.

    ``df`` holds one row per entity and month.
    """
    earlier = df.select(
        *entity, F.add_months(date, months).alias(date), F.col(measure).alias(previous))
    return (
        join_on(df, earlier, [*entity, date], "left")
        .withColumn(change, F.col(measure) - F.col(previous))
        .withColumn(growth_alias, guarded_percent(change, previous, min_base))
    )


def calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Every month between the first and the last date, with year, quarter and names."""
    ends = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    months = ends.select(
        F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("date_key"))
    return months.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.quarter("date_key").alias("quarter"),
        F.month("date_key").alias("month"),
        month_name("date_key").alias("month_name"),
        F.date_format("date_key", "yyyy-MM").alias("year_month"))


def dense_months(df: DataFrame, entity, date: str = "date", measure: str = MEASURE) -> DataFrame:
    """One row per entity and month from its first to its last; absent months hold 0."""
    sums = df.groupBy(*entity, date).agg(F.sum(measure).alias(measure))
    spine = (
        df.groupBy(*entity).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
        .select(*entity, F.explode(F.expr("sequence(_lo, _hi, interval 1 month)")).alias(date))
    )
    return join_on(spine, sums, [*entity, date], "left").withColumn(
        measure, F.coalesce(measure, F.lit(0).cast("bigint")))


def rolling(
    df: DataFrame, entity, spans: dict[str, int], date: str = "date", measure: str = MEASURE,
) -> DataFrame:
    """Rolling averages over calendar months; NULL until a span is full."""
    dense = dense_months(df, entity, date, measure)
    order = W.partitionBy(*entity).orderBy(date)
    seen = F.row_number().over(order)
    out = dense
    for alias, months in spans.items():
        frame = order.rowsBetween(-(months - 1), 0)
        out = out.withColumn(
            alias, F.when(seen >= months, rounded(F.avg(measure).over(frame))))
    return out
