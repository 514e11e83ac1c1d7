"""Counts, breakdowns and the KPI roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factkeeper.functions.scalar import slash_date, thousands

# Report columns in their order.
KPI_COLUMNS = ["table_name", "txn_date", "line", "deposit_cases", "deposit_amount",
               "net_profit", "active_members"]


def filtered_counts(df: DataFrame, preds: dict) -> DataFrame:
    """G1: ``COUNT(*)`` plus one count per named predicate, in one pass."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(F.coalesce(p, F.lit(False))).alias(name) for name, p in preds.items()]
    return df.agg(*aggs)


def breakdown(df: DataFrame, date_col: str, value_col: str, ordered: bool = True) -> DataFrame:
    """Rows per (day, value), newest day first."""
    out = (df.groupBy(F.to_date(F.col(date_col)).alias("txn_day"),
                      F.col(value_col).alias("filter_value"))
           .agg(F.count(F.lit(1)).alias("row_count")))
    return out.orderBy(F.col("txn_day").desc(), F.col("filter_value").asc()) if ordered else out


def money(df: DataFrame, col: str) -> Column:
    """Exact sum of ``df``'s column.

    Decimals and whole numbers are summed at their own scale (Spark widens the
    sum's precision by ten digits; more raises). Floating columns are read as
    the decimal that they print as, with 18 places, so that the sum does not
    depend on the order of the rows."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, (T.DecimalType, T.IntegralType)):
        return F.sum(c.cast("decimal(38,0)") if isinstance(df.schema[col].dataType, T.IntegralType) else c)
    return F.sum(c.cast("decimal(38,18)"))


def kpi_rollup(df: DataFrame, date_col: str = "txn_date", line_col: str = "line",
               user_col: str = "user_unique", cases_col: str = "deposit_cases",
               amount_col: str = "deposit_amount", profit_col: str = "net_profit") -> DataFrame:
    """Per (day, line) — summed cases, amount, profit (0 when all NULL)
    and active members = distinct users with deposit cases above zero."""
    active = F.coalesce(F.col(cases_col), F.lit(0)) > 0
    return (df.groupBy(F.col(date_col).alias("txn_date"), F.col(line_col).alias("line"))
            .agg(F.coalesce(F.sum(cases_col), F.lit(0)).cast("bigint").alias("deposit_cases"),
                 F.coalesce(money(df, amount_col), F.lit(0)).cast("double").alias("deposit_amount"),
                 F.coalesce(money(df, profit_col), F.lit(0)).cast("double").alias("net_profit"),
                 F.count_distinct(F.when(active, F.col(user_col))).cast("int").alias("active_members")))


def kpi_union(frames: dict, date_col="txn_date", line_col="line", user_col="user_unique",
              cases_col="deposit_cases", amount_col="deposit_amount",
              profit_col="net_profit") -> DataFrame:
    """KPI per (table, day, line); NULL line reported as ''."""
    stacked = None
    for i, (name, df) in enumerate(frames.items()):
        tagged = df.select(F.lit(name).alias("table_name"), F.lit(i).alias("market_order"),
                           F.col(date_col).alias("txn_date"), F.col(line_col).alias("line"),
                           F.col(user_col).alias("user_unique"),
                           F.col(cases_col).alias("deposit_cases"),
                           F.col(amount_col).alias("deposit_amount"),
                           F.col(profit_col).alias("net_profit"))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    active = F.coalesce(F.col("deposit_cases"), F.lit(0)) > 0
    return (stacked.groupBy("table_name", "market_order", "txn_date",
                            F.coalesce(F.col("line"), F.lit("")).alias("line"))
            .agg(F.coalesce(F.sum("deposit_cases"), F.lit(0)).cast("bigint").alias("deposit_cases"),
                 F.coalesce(money(stacked, "deposit_amount"), F.lit(0)).cast("double").alias("deposit_amount"),
                 F.coalesce(money(stacked, "net_profit"), F.lit(0)).cast("double").alias("net_profit"),
                 F.count_distinct(F.when(active, F.col("user_unique"))).cast("int")
                 .alias("active_members")))


def kpi_report(kpi: DataFrame) -> DataFrame:
    """Report rows as text — ``yyyy/MM/dd`` dates, thousands
    separators, two decimals for money, cases cut to whole numbers; ordered
    by table order, day, line."""
    return (kpi.select(
        F.col("table_name"), F.col("market_order"),
        slash_date("txn_date").alias("txn_date"),
        F.coalesce(F.col("line"), F.lit("")).alias("line"),
        thousands(F.col("deposit_cases").cast("bigint")).alias("deposit_cases"),
        thousands("deposit_amount", 2).alias("deposit_amount"),
        thousands("net_profit", 2).alias("net_profit"),
        thousands("active_members").alias("active_members"),
        F.col("txn_date").alias("__d"))
        .orderBy("market_order", "__d", "line").drop("__d"))
