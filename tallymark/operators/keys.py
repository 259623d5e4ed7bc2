"""Repeated business keys: counting, listing, conflicts and removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallymark.operators.ranking import positions, top_k
from tallymark.operators.totals import join_on
from tallymark.schemas import BUSINESS_KEY, MEASURE
from tallymark.sources.workspace import written


def keyed_counts(df: DataFrame, key=BUSINESS_KEY, measure: str = MEASURE) -> DataFrame:
    """Rows per key and whether their measures differ. NULL parts are equal."""
    return df.groupBy(*key).agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.min(measure) != F.max(measure), F.lit(False)).alias("conflicting"))


def duplicate_keys(df: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    return (
        df.groupBy(*key).agg(F.count("*").alias("duplicate_count"))
        .filter("duplicate_count > 1")
    )


def duplicate_records(df: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    """Every copy of every repeated key.

    The repeated keys come from a count with a map-side part, so a key that many rows
    share is spread over tasks; a window over the key would gather it in one.
    """
    repeated = duplicate_keys(df, key).drop("duplicate_count")
    return join_on(df, repeated, key, "left_semi")


def first_per_key(df: DataFrame, key=BUSINESS_KEY, order=("source_file", MEASURE)) -> DataFrame:
    """One row per key, the one with the smallest source."""
    return top_k(df, order[0], 1, tie=order[1:], partition=key, ascending=True)


def _earliest(columns, order) -> Column:
    """The least row by ``order``, then by all other columns; NULL is after all else in ``order``."""
    ranks = [F.struct(F.col(c).isNull().alias("absent"), F.col(c).alias("value")).alias(f"_{c}")
             for c in order]
    return F.min(F.struct(*ranks, *[F.col(c) for c in columns if c not in order]))


def key_state(
    df: DataFrame, key=BUSINESS_KEY, measure: str = MEASURE, order=("source_file", MEASURE),
) -> DataFrame:
    """One row per key that answers what is asked of repeated keys: ``row_count``, the ``least``
    and ``most`` of the measure, and the ``first`` row in ``order``.

    Written once, it stands in for the rows in all checks of keys and in their removal; it is
    made with a map-side part, so copies of a hot key are folded before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(
        F.count("*").alias("row_count"), F.min(measure).alias("least"), F.max(measure).alias("most"),
        _earliest(rest, order).alias("first"))


def merge_states(*states: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    """The state of all rows that the given states stand for, without a look at the rows."""
    return reduce(DataFrame.unionByName, states).groupBy(*key).agg(
        F.sum("row_count").alias("row_count"), F.min("least").alias("least"),
        F.max("most").alias("most"), F.min("first").alias("first"))


def state_counts(state: DataFrame, key=BUSINESS_KEY) -> DataFrame:
    """What :func:`keyed_counts` gives, from a state."""
    return state.select(
        *key, "row_count", F.coalesce(F.col("least") != F.col("most"), F.lit(False)).alias("conflicting"))


def first_rows(
    state: DataFrame, columns, key=BUSINESS_KEY, order=("source_file", MEASURE),
) -> DataFrame:
    """What :func:`first_per_key` gives, from a state: ``columns`` of one row per key."""
    def of(name: str) -> Column:
        if name in key:
            return F.col(name)
        return F.col(f"first._{name}.value" if name in order else f"first.{name}").alias(name)

    return state.select(*[of(c) for c in columns])


def conflicts(df: DataFrame, key=BUSINESS_KEY, measure: str = MEASURE) -> DataFrame:
    """Keys whose copies disagree on the measure."""
    return keyed_counts(df, key, measure).filter("conflicting").drop("conflicting")


def dedup_summary(df: DataFrame, key=BUSINESS_KEY, measure: str = MEASURE) -> DataFrame:
    """One row: rows in, out and removed, repeated keys, conflicting keys."""
    return summary_of(keyed_counts(df, key, measure))


def summary_of(counts: DataFrame) -> DataFrame:
    """The same from the counts of each key."""
    return counts.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("input_rows"),
        F.count("*").alias("output_rows"),
        F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("removed_rows"),
        F.count_if(F.col("row_count") > 1).alias("duplicate_business_key_groups"),
        F.count_if("conflicting").alias("conflicting_value_groups"))


def multi_source_keys(df: DataFrame, key=BUSINESS_KEY, source: str = "source_file") -> DataFrame:
    """Repeated keys whose copies come from several sources, as counts and without lists."""
    return df.groupBy(*key, source).agg(F.count("*").alias("_n")).groupBy(*key).agg(
        F.sum(F.when(F.col(source).isNotNull(), F.col("_n")).otherwise(0)).cast("bigint")
        .alias("duplicate_row_count"),
        F.count(source).alias("unique_source_files")).filter("unique_source_files > 1")


def _numbered_lists(rows: DataFrame, key, value: str, alias: str, chunk: int) -> DataFrame:
    """The distinct values of each key as sorted texts of ``chunk`` values, numbered from 1.

    A key with no more than one text's values is listed by itself; the values of the others are
    put in order over all tasks first.
    """
    distinct = rows.filter(F.col(value).isNotNull()).select(*key, value).distinct()
    long = distinct.groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") > chunk).drop("_n")
    numbered = distinct.withColumn("chunk", F.lit(1).cast("bigint"))
    if not long.isEmpty():
        placed = positions(
            join_on(distinct, long, key, "left_semi"), key, [F.asc(value)], "_at")
        numbered = join_on(numbered, long, key, "left_anti").unionByName(placed.select(
            *key, value, (F.floor((F.col("_at") - 1) / chunk) + 1).cast("bigint").alias("chunk")))
    return (
        numbered.groupBy(*key, "chunk")
        .agg(F.sort_array(F.collect_list(value)).alias("_list"))
        .select(*key, "chunk", F.array_join(
            F.transform("_list", lambda v: v.cast("string")), " | ").alias(alias)))


def overlap_sources(
    df: DataFrame, key=BUSINESS_KEY, measure: str = MEASURE, source: str = "source_file",
    chunk: int = 1000,
) -> DataFrame:
    """Repeated keys with the distinct sources and distinct measures of their copies.

    A list has one row per ``chunk`` entries: ordinary keys have one row, and a key that very
    many sources share has as many as it needs. The values of such a key are put in order over
    all tasks and cut by their position, so that no task and no row holds them all.
    """
    folded = df.groupBy(*key, source, measure).agg(F.count("*").alias("_copies"))
    by_source = folded.groupBy(*key, source).agg(F.sum("_copies").alias("_n"))
    sizes = by_source.groupBy(*key).agg(
        F.sum("_n").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col(source).isNotNull(), F.col("_n"))), F.lit(0))
        .alias("duplicate_row_count"),
        F.count(source).alias("unique_source_files"))
    repeated = written(sizes.filter("_rows > 1").drop("_rows"), "overlap-keys")
    rows = written(join_on(folded, repeated.select(*key), key, "left_semi"), "overlap")
    lists = [
        _numbered_lists(rows, key, source, "source_files", chunk),
        _numbered_lists(rows, key, measure, "vehicle_counts", chunk)]
    # A chunk may be there for one list only; a key without sources and measures has one row.
    numbers = repeated.select(*key, F.lit(1).cast("bigint").alias("chunk"))
    for found in lists:
        numbers = numbers.union(found.select(*key, "chunk"))
    out = join_on(numbers.distinct(), repeated, key)
    for found in lists:
        out = join_on(out, found, [*key, "chunk"], "left")
    return out.select(
        *key, "duplicate_row_count", "unique_source_files", "chunk",
        F.coalesce("source_files", F.lit("")).alias("source_files"),
        F.coalesce("vehicle_counts", F.lit("")).alias("vehicle_counts"))
