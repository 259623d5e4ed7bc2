"""Agreement of rows and sums between two layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymark.operators.totals import tag_union
from tallymark.schemas import MEASURE


def volume(df: DataFrame, by=(), measure: str = MEASURE) -> DataFrame:
    """Rows and sum, 0 when there is nothing to sum."""
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(measure), F.lit(0)).alias("total"))


def reconcile(
    source: DataFrame, target: DataFrame, by=(), sum_name: str = "total",
    status: str = "reconciliation_status",
) -> DataFrame:
    """Two :func:`volume` frames side by side with differences and PASS or CHECK.

    The sides are stacked and folded, which needs no join and keeps groups that one
    side lacks.
    """
    sides = tag_union({"silver": source, "gold": target}, "_side")

    def pick(side, column):
        return F.coalesce(F.sum(F.when(F.col("_side") == side, F.col(column))), F.lit(0))

    s, g = f"silver_{sum_name}", f"gold_{sum_name}"
    return (
        sides.groupBy(*by).agg(
            pick("silver", "rows").alias("silver_rows"),
            pick("gold", "rows").alias("gold_rows"),
            pick("silver", "total").alias(s),
            pick("gold", "total").alias(g))
        .select(
            *by, "silver_rows", "gold_rows",
            (F.col("silver_rows") - F.col("gold_rows")).alias("row_difference"),
            s, g,
            (F.col(s) - F.col(g)).alias("total_difference"),
            F.when(
                (F.col("silver_rows") == F.col("gold_rows")) & (F.col(s) == F.col(g)), "PASS")
            .otherwise("CHECK").alias(status))
    )
