"""z-scores and correlation between separately reported sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def with_zscore(df: DataFrame, entity, measure: str) -> DataFrame:
    """Mean, sample deviation and z-score of each row among its entity's periods."""
    window = W.partitionBy(*entity)
    return (
        df.withColumn("average", F.avg(measure).over(window))
        .withColumn("deviation", F.stddev_samp(measure).over(window))
        .withColumn(
            "z", (F.col(measure) - F.col("average")) / F.nullif(F.col("deviation"), F.lit(0.0)))
    )


def safe_corr(left: str, right: str) -> Column:
    """Pearson correlation, NULL for fewer than two rows or a constant series."""
    varied = (F.min(left) < F.max(left)) & (F.min(right) < F.max(right))
    # A constant series would divide by zero in corr: both variances through
    # covar_samp and stddev_samp stay defined, and the guard hides the rest.
    spread = F.nullif(F.stddev_samp(left) * F.stddev_samp(right), F.lit(0.0))
    return F.when(varied, F.covar_samp(left, right) / spread)
