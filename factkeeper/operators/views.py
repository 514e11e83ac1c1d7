"""Summary views (V2-V9).

The reference refreshes these views but ships none of their query texts, so
the definitions below are ours, built from columns the fact is known to
have; column names are parameters. Refreshing them safely (readers keep the
old version until the switch) is ``plans.table_store.refresh_view`` (V1).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factkeeper.operators.kpi import money
from factkeeper.operators.update import key_side


@dataclass
class FactCols:
    """Which columns of a fact play which role."""

    user: str = "user_unique"
    date: str = "date"
    line: str = "line"
    amount: str = "deposit_amount"
    cases: str | None = None          # None → every row is one case


def _cases(c: FactCols) -> Column:
    if c.cases is None:
        return F.count(F.lit(1)).cast("bigint")
    return F.coalesce(F.sum(c.cases), F.lit(0)).cast("bigint")


def _measures(df: DataFrame, c: FactCols) -> list:
    return [_cases(c).alias("deposit_cases"),
            F.coalesce(money(df, c.amount), F.lit(0)).cast("double").alias("deposit_amount"),
            F.count_distinct(c.user).cast("bigint").alias("active_users")]


def month_start(col: str) -> Column:
    return F.trunc(F.col(col), "month").cast("date")


def monthly_summary(df: DataFrame, c: FactCols = FactCols()) -> DataFrame:
    """V2: per line and calendar month."""
    return (df.groupBy(F.col(c.line).alias("line"),
                       F.year(c.date).cast("int").alias("year"),
                       F.month(c.date).cast("int").alias("month"))
            .agg(*_measures(df, c)))


def line_summary(df: DataFrame, c: FactCols = FactCols()) -> DataFrame:
    """V3: overall per line, with first and last active day."""
    return (df.groupBy(F.col(c.line).alias("line"))
            .agg(*_measures(df, c),
                 F.min(F.to_date(c.date)).alias("first_day"),
                 F.max(F.to_date(c.date)).alias("last_day")))


def daily_summary(df: DataFrame, c: FactCols = FactCols()) -> DataFrame:
    """V3: per line and day."""
    return (df.groupBy(F.col(c.line).alias("line"), F.to_date(c.date).alias("day"))
            .agg(*_measures(df, c)))


def quarter_summary(df: DataFrame, c: FactCols = FactCols()) -> DataFrame:
    """V3: per line, year and quarter."""
    return (df.groupBy(F.col(c.line).alias("line"),
                       F.year(c.date).cast("int").alias("year"),
                       F.quarter(c.date).cast("int").alias("quarter"))
            .agg(*_measures(df, c)))


def customer_monthly(df: DataFrame, customers: DataFrame, cust_key: str,
                     attrs, c: FactCols = FactCols()) -> DataFrame:
    """V4: per customer, line and month, with customer attributes.

    The fact is aggregated before the join, so only one row per customer
    and month is shuffled to meet the customer table.
    """
    per = (df.groupBy(F.col(c.user).alias(cust_key), F.col(c.line).alias("line"),
                      month_start(c.date).alias("month_start"))
           .agg(_cases(c).alias("deposit_cases"),
                F.coalesce(money(df, c.amount), F.lit(0)).cast("double").alias("deposit_amount"),
                F.count_distinct(F.to_date(c.date)).cast("bigint").alias("active_days")))
    return per.join(customers.select(cust_key, *attrs), on=cust_key, how="left")


def band(amount: Column, bands) -> Column:
    """Tier name for an amount from ``[(name, low, high), ...]`` (``low <= x < high``).

    The bands are a caller parameter (a handful of rows), so the band join is
    a CASE expression in the projection — no join at all.
    """
    expr = None
    for name, lo, hi in bands:
        cond = (amount >= F.lit(lo)) & (amount < F.lit(hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def band_rank(tier: Column, bands) -> Column:
    expr = None
    for i, (name, _, _) in enumerate(bands):
        expr = F.when(tier == name, F.lit(i)) if expr is None else expr.when(tier == name, F.lit(i))
    return expr


def tier_monthly(df: DataFrame, bands, c: FactCols = FactCols()) -> DataFrame:
    """V5: monthly amount per user → tier; previous tier = tier of the user's
    previous active month; movement NEW / UP / DOWN / SAME.

    Months without a matching band get no row (the band join is inner).
    The window runs over one row per user and month, so a partition is at
    most the number of months, however many rows a user has.
    """
    monthly = (df.groupBy(F.col(c.user).alias("user_unique"), month_start(c.date).alias("month_start"))
               .agg(F.coalesce(money(df, c.amount), F.lit(0)).cast("double").alias("amount")))
    tiered = monthly.withColumn("tier_name", band(F.col("amount"), bands)).filter(
        F.col("tier_name").isNotNull())
    w = Window.partitionBy("user_unique").orderBy("month_start")
    prev = F.lag("tier_name").over(w)
    out = tiered.withColumn("prev_tier_name", prev)
    rank, prank = band_rank(F.col("tier_name"), bands), band_rank(F.col("prev_tier_name"), bands)
    movement = (F.when(F.col("prev_tier_name").isNull(), F.lit("NEW"))
                .when(rank > prank, F.lit("UP"))
                .when(rank < prank, F.lit("DOWN"))
                .otherwise(F.lit("SAME")))
    return out.select("user_unique",
                      F.year("month_start").cast("int").alias("year"),
                      F.month("month_start").cast("int").alias("month"),
                      "month_start", "amount", "tier_name", "prev_tier_name",
                      movement.alias("movement_status"))


def tier_summary(tiers: DataFrame) -> DataFrame:
    """V6: users and amount per month and tier."""
    return (tiers.groupBy("month_start", "tier_name")
            .agg(F.count(F.lit(1)).cast("bigint").alias("users"),
                 money(tiers, "amount").cast("double").alias("amount")))


def retention(df: DataFrame, user: str, period: Column, step: str = "month") -> DataFrame:
    """V7: per period — active users, users also active in the next period,
    and the ratio.

    Distinct (user, period) first (combined map-side), then ``lead`` over the
    user's own periods: no self-join. A user's window holds one row per
    active period.
    """
    active = df.select(F.col(user).alias("u"), period.alias("period_start")).filter(
        F.col("u").isNotNull() & F.col("period_start").isNotNull()).distinct()
    nxt = F.lead("period_start").over(Window.partitionBy("u").orderBy("period_start"))
    following = (F.add_months(F.col("period_start"), 1) if step == "month"
                 else F.date_add(F.col("period_start"), 1))
    flagged = active.withColumn("__kept", (nxt == following).cast("int"))
    return (flagged.groupBy("period_start")
            .agg(F.count(F.lit(1)).cast("bigint").alias("active"),
                 F.coalesce(F.sum("__kept"), F.lit(0)).cast("bigint").alias("retained"))
            .withColumn("rate", F.col("retained") / F.col("active")))


def first_event(df: DataFrame, user: str, date_col: str, order_cols, value_cols) -> DataFrame:
    """First row per user by ``order_cols`` (ascending), combinable aggregate."""
    order = F.struct(*[F.col(c) for c in order_cols])
    row = F.struct(*[F.col(c) for c in value_cols])
    return (df.filter(F.col(user).isNotNull()).groupBy(user)
            .agg(F.min_by(row, order).alias("__r"))
            .select(user, *[F.col(f"__r.{c}").alias(c) for c in value_cols]))


def new_registrations(df: DataFrame, user: str, date_col: str) -> DataFrame:
    """V8: users by the month of their first registration day."""
    first = (df.filter(F.col(user).isNotNull()).groupBy(user)
             .agg(F.min(F.to_date(date_col)).alias("register_date")))
    return (first.groupBy(month_start("register_date").alias("month_start"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("new_users")))


def new_depositors(df: DataFrame, user: str, date_col: str, amount_col: str, tiebreak: str) -> DataFrame:
    """V9: each user's first deposit day and amount."""
    first = first_event(df, user, date_col, [date_col, tiebreak], [date_col, amount_col])
    return first.select(F.col(user), F.to_date(date_col).alias("first_deposit_date"),
                        F.col(amount_col).alias("first_deposit_amount"))


def new_depositor_txns(df: DataFrame, user: str, date_col: str) -> DataFrame:
    """V9: the transactions new depositors made in their first month.

    First month per user (combinable min), then a semi join on (user, month)
    — the fact itself is shuffled once, never collected per user.
    """
    firsts = key_side(df.filter(F.col(user).isNotNull()).groupBy(user)
                      .agg(F.min(month_start(date_col)).alias("__m")))
    keyed = df.withColumn("__m", month_start(date_col))
    return keyed.join(firsts, on=[user, "__m"], how="left_semi").drop("__m")


def deposit_summary(df: DataFrame, group_cols, amount_col: str) -> DataFrame:
    """V9: deposit count, total, smallest and largest per group."""
    return (df.groupBy(*group_cols)
            .agg(F.count(F.lit(1)).cast("bigint").alias("deposits"),
                 money(df, amount_col).cast("double").alias("total_amount"),
                 F.min(amount_col).cast("double").alias("min_amount"),
                 F.max(amount_col).cast("double").alias("max_amount")))
