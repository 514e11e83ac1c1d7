"""Reconciliation and data-quality checks (Q1-Q3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.operators.kpi import breakdown


def reconcile(source: DataFrame, target: DataFrame, source_pred=None, target_pred=None) -> DataFrame:
    """Q1: one row — source rows, target rows, and the difference.

    Both counts come from one job: the two sides are tagged, stacked and
    counted in a single aggregate (no cross join of two count frames).
    """
    s = source.filter(source_pred) if source_pred is not None else source
    t = target.filter(target_pred) if target_pred is not None else target
    stacked = s.select(F.lit(1).alias("__s")).unionByName(t.select(F.lit(0).alias("__s")))
    return (stacked.agg(F.count_if(F.col("__s") == 1).alias("source_rows"),
                        F.count_if(F.col("__s") == 0).alias("target_rows"))
            .withColumn("difference", F.col("source_rows") - F.col("target_rows")))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q2: keys held by more than one row (NULL keys are not duplicates)."""
    keys = list(keys)
    keyed = df
    for k in keys:
        keyed = keyed.filter(F.col(k).isNotNull())
    return (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def compare_breakdowns(source: DataFrame, target: DataFrame, date_col: str, value_col: str,
                       target_date_col: str | None = None, target_value_col: str | None = None) -> DataFrame:
    """Q3: per (day, value) rows in source vs target, only where they differ.

    Both sides are stacked, tagged, and counted in one aggregate; a NULL value on both
    sides is the same group.
    """
    def side(df, date, value, tag):
        return df.select(F.to_date(F.col(date)).alias("txn_day"), F.col(value).alias("filter_value"), F.lit(tag).alias("source"))

    both = side(source, date_col, value_col, True).unionByName(
        side(target, target_date_col or date_col, target_value_col or value_col, False))
    counted = both.groupBy("txn_day", "filter_value").agg(
        F.count_if("source").alias("source_rows"), F.count_if(~F.col("source")).alias("target_rows"))
    return counted.filter(F.col("source_rows") != F.col("target_rows"))
