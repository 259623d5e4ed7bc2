"""Top-k and full rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymark.operators.totals import join_on
from tallymark.sources.workspace import written


def _order(measure: str, ascending: bool) -> Column:
    return F.asc_nulls_last(measure) if ascending else F.desc_nulls_last(measure)


def top_k(
    df: DataFrame, measure: str, k: int, tie, partition=(), ascending: bool = False,
    rank_alias: str | None = None,
) -> DataFrame:
    """The ``k`` first rows by ``measure``, of the whole frame or of each partition.

    Ties are settled by the ``tie`` columns in ascending order. Without a partition
    this is sort and limit; with one, the filter right above ``row_number`` lets Spark
    cut every partition to ``k`` rows before the shuffle.
    """
    order = [_order(measure, ascending), *[F.asc_nulls_last(t) for t in tie]]
    if not partition:
        return df.orderBy(*order).limit(k)
    position = rank_alias or "_position"
    window = W.partitionBy(*partition).orderBy(*order)
    kept = df.withColumn(position, F.row_number().over(window)).filter(F.col(position) <= k)
    return kept if rank_alias else kept.drop(position)


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows dealt by ``order`` to ranges of equal size, with their range and place in it.

    Written and read back: a second sampling would draw other ranges.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(
        dealt.withColumns({
            "_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}),
        "ranges")


def positions(df: DataFrame, partition, order: list[Column], alias: str) -> DataFrame:
    """Every row with its position, from 1, in the ``order`` of its partition.

    A partition may hold a great part of all rows and many of them may be equal in the first
    columns of the order, so no task sorts a partition: rows are dealt to ranges of the whole
    order, and what the earlier ranges hold of a partition is added to the place in the range.
    """
    keys = [*partition, "_range"]
    dealt = in_ranges(df, [*[F.asc_nulls_first(p) for p in partition], *order])
    # One row per range and partition in it.
    sizes = dealt.groupBy(*keys).agg(F.count("*").alias("_size"), F.min("_place").alias("_first"))
    before = W.partitionBy(*partition).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1)
        .alias("_offset"))
    position = (F.col("_place") + F.col("_offset")).cast("bigint")
    return join_on(dealt, offsets, keys).withColumn(alias, position).select(*df.columns, alias)


def ranked(df: DataFrame, measure: str, tie, partition, alias: str) -> DataFrame:
    """Every row with its position by falling ``measure`` within its partition.

    The ``tie`` columns settle equal measures in ascending order, over all tasks alike.
    """
    order = [F.desc_nulls_last(measure), *[F.asc_nulls_last(t) for t in tie]]
    return positions(df, partition, order, alias)
