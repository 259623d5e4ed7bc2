"""Sums, shares and concentration."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallymark.functions.numbers import percent
from tallymark.schemas import MEASURE


def totals(df: DataFrame, by, alias: str = "total_vehicles", measure: str = MEASURE) -> DataFrame:
    """Sum of ``measure`` by the given columns."""
    return df.groupBy(*by).agg(F.sum(measure).alias(alias))


def tag_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """All frames on top of each other, each row tagged with its frame's name."""
    tagged = [df.select(F.lit(name).alias(tag), "*") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def join_on(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which two NULLs are equal; the right keys are dropped."""
    held = {k: f"_right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(held)
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in held.items()])
    return left.join(renamed, same, how).drop(*held.values())


def share(df: DataFrame, measure: str, alias: str, within=()) -> DataFrame:
    """Percent of each row's measure in the sum of its group, or of everything.

    The sum comes from its own aggregate, not from a window over the group, so
    that a group of any size is spread over tasks.
    """
    if not within:
        whole = df.agg(F.sum(measure)).scalar()
        return df.withColumn(alias, percent(measure, whole))
    sums = df.groupBy(*within).agg(F.sum(measure).alias("_group_sum"))
    joined = join_on(df, sums, within, "left")
    return joined.withColumn(alias, percent(measure, "_group_sum")).drop("_group_sum")


def concentration(
    df: DataFrame, name: str, k: int, top_alias: str, total_alias: str, percent_alias: str,
    measure: str = "total_vehicles",
) -> DataFrame:
    """Sum of the ``k`` largest entities, sum of all, and the former in percent."""
    largest = df.orderBy(F.desc(measure), F.asc_nulls_last(name)).limit(k)
    top = largest.agg(F.sum(measure)).scalar()
    return (
        df.agg(F.sum(measure).alias(total_alias))
        .select(top.alias(top_alias), total_alias)
        .withColumn(percent_alias, percent(top_alias, total_alias))
    )
