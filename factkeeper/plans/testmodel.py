"""The daily activity fact over the driver's test tables.

The reference works on a per-user, per-day activity table; the test tables
have none, so it is derived from ``events`` (one row per user and day).
``orders`` stands in for the transaction-level fact of the rewrites, tiers
and retention (o_custkey = user, o_orderkey = unique key, o_orderdate = day,
o_totalprice = amount, o_orderpriority = line). The same model is written in
SQL in ``plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.functions.predicates import in_window
from factkeeper.sources.tables import read_table

# Fixed values of the test model.
EVENTS_AS_OF = date(2024, 1, 31)       # events cover 2024-01-01 .. 2024-01-30
ORDERS_AS_OF = date(2001, 8, 1)        # orders end on 2001-08-01
RUN_TS = datetime(2024, 2, 1, 6, 0, 0)
# Tier bands (name, low, high) — the reference's thresholds are not public.
EVENT_BANDS = [("BRONZE", 0.01, 500.0), ("SILVER", 500.0, 800.0), ("GOLD", 800.0, 1e18)]
ORDER_BANDS = [("BRONZE", 0.0, 100000.0), ("SILVER", 100000.0, 300000.0), ("GOLD", 300000.0, 1e18)]
MARKETS = {"staging_usc": "A0", "staging_myr": "A1", "staging_sgd": "A2"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _money_of(event_types) -> F.Column:
    """The model's amounts are kept in cents, row by row."""
    hit = F.col("event_type").isin(*event_types)
    return F.sum(F.when(hit, F.col("value")).cast("decimal(18,2)")).cast("decimal(18,2)")


def _count_of(event_types) -> F.Column:
    return F.count(F.when(F.col("event_type").isin(*event_types), F.lit(1)))


def daily_aggregates(events: DataFrame) -> DataFrame:
    """Additive per-(user, day) measures of the events; re-aggregating these
    partial rows gives the same result (used by the streaming upkeep)."""
    return (events.groupBy(F.col("user_id").alias("user_unique"), F.to_date("ts").alias("date"))
            .agg(_count_of(["purchase"]).alias("deposit_cases"),
                 _money_of(["purchase"]).alias("deposit_amount"),
                 _count_of(["error"]).alias("withdraw_cases"),
                 _money_of(["error"]).alias("withdraw_amount"),
                 _money_of(["signup"]).alias("bonus"),
                 _count_of(["click", "view"]).alias("total_bet"),
                 _money_of(["click", "view"]).alias("total_bet_amount"),
                 F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("last_purchase")))


def merge_daily(parts: DataFrame) -> DataFrame:
    """Combine several partial ``daily_aggregates`` rows of the same (user, day)."""
    def msum(c):
        return F.sum(c).cast("decimal(18,2)")
    return (parts.groupBy("user_unique", "date")
            .agg(F.sum("deposit_cases").alias("deposit_cases"), msum("deposit_amount").alias("deposit_amount"),
                 F.sum("withdraw_cases").alias("withdraw_cases"), msum("withdraw_amount").alias("withdraw_amount"),
                 msum("bonus").alias("bonus"), F.sum("total_bet").alias("total_bet"),
                 msum("total_bet_amount").alias("total_bet_amount"),
                 F.max("last_purchase").alias("last_purchase")))


def staging_columns(g: DataFrame, keep_raw: bool = False) -> DataFrame:
    """The staging fact's descriptive columns, derived from the aggregates
    (``keep_raw`` also keeps ``last_purchase`` for later merges)."""
    u = F.col("user_unique")
    line = F.concat(F.lit("L"), (u % 5).cast("string"))
    username = F.concat(F.lit("user"), u.cast("string"))
    unique_code = F.concat(F.lit("C"), F.col("last_purchase").cast("string"))
    null_int = F.lit(None).cast("int")
    null_money = F.lit(None).cast("decimal(18,2)")
    return g.select(
        u.alias("user_unique"), F.col("date"), F.col("date").alias("txn_date"),
        line.alias("line"),
        F.concat(F.lit("A"), (u % 3).cast("string")).alias("agent_code"),
        username.alias("username"),
        F.concat(F.lit("V"), (u % 4).cast("string")).alias("vip_level"),
        unique_code.alias("unique_code"),
        F.when(F.col("deposit_cases") > 0, F.concat(F.lit("op"), line)).alias("operator_username"),
        F.concat(u.cast("string"), F.lit("-"), F.date_format("date", "yyyyMMdd")).alias("unique_key"),
        F.year("date").cast("int").alias("year"),
        F.date_format("date", "yyyy-MM").alias("month_text"),
        F.lit("USD").alias("currency"),
        F.when(F.col("deposit_cases") == 0, 1).otherwise(0).cast("int").alias("absent"),
        null_int.alias("adjustment_cases"),
        "deposit_cases", "deposit_amount", "withdraw_cases", "withdraw_amount", "bonus",
        "total_bet", "total_bet_amount",
        F.col("total_bet_amount").alias("total_valid_bet_amount"),
        null_money.alias("add_bonus"), null_money.alias("deduct_bonus"),
        null_money.alias("add_transaction"), null_money.alias("deduct_transaction"),
        (F.coalesce("total_bet_amount", F.lit(0)) - F.coalesce("bonus", F.lit(0)))
        .cast("decimal(18,2)").alias("ggr"),
        (F.coalesce("deposit_amount", F.lit(0)) - F.coalesce("withdraw_amount", F.lit(0)))
        .cast("decimal(18,2)").alias("net_profit"),
        F.concat(username, F.lit("-"), unique_code, F.lit("-"), line).alias("user_key"),
        *([F.col("last_purchase")] if keep_raw else []),
    )


def staging_fact(events: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Per user and day. With a window the ``ts`` range is applied to the raw
    events, so it is pushed into the parquet scan before the aggregate."""
    if start is not None:
        events = events.filter(in_window(events, "ts", start, end))
    return staging_columns(daily_aggregates(events))


def staging(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    return staging_fact(table(spark, sf_dir, "events"), start, end)


def event_stream():
    """The model of the events for the streaming upkeep."""
    from factkeeper.streaming.recency_stream import StreamModel
    return StreamModel(daily_aggregates, merge_daily, lambda df: staging_columns(df, keep_raw=True))


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so results compare across engines."""
    from pyspark.sql import types as T
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])
