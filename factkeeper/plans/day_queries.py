"""Queries for what is kept by day and by change: views after a copy of two days, and recency
from a stream of inserts, moves and deletes. Each builds an older state in a fresh folder under
the shared checkpoint root, applies the change and reads the result."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.functions.scalar import recode
from factkeeper.operators import recency, rewrite
from factkeeper.plans import catalog
from factkeeper.plans import oracle as O
from factkeeper.plans.day_views import DayViews
from factkeeper.plans.table_store import by_period, replace_days
from factkeeper.plans.testmodel import EVENT_BANDS, EVENTS_AS_OF, comparable
from factkeeper.session import scratch_path

COPIED = [date(2024, 2, 1), date(2024, 2, 5)]
RECODES = {"L4": "L9"}
MOVED_FROM = date(2024, 1, 15)


def _spread(stg: DataFrame) -> DataFrame:
    """The serving rows over several months: a row moves by its day of the month modulo 4."""
    mapping = rewrite.SERVING_MAPPING + [("user_unique", "user_unique")]
    rows = stg.select(*[F.col(s).alias(t) for s, t in mapping])
    return rows.withColumn("date", F.expr("add_months(date, day(date) % 4)"))


def _views(spark: SparkSession, sf: str) -> DayViews:
    """Views of an older state of two days, refreshed after the days were copied."""
    fresh = _spread(catalog._stg(spark, sf))
    on_days = F.col("date").isin(COPIED)
    stale = (fresh.filter(~(on_days & (F.col("user_unique") % 3 == 0)))
             .withColumn("deposit_cases", F.when(on_days & (F.col("user_unique") % 2 == 0), F.lit(0)).otherwise(F.col("deposit_cases")))
             .withColumn("deposit_amount", F.when(on_days, F.col("deposit_amount") * 2).otherwise(F.col("deposit_amount")).cast("decimal(18,2)")))
    root = scratch_path(spark, "day-views")
    by_period(stale, "date").write.partitionBy("date").parquet(f"{root}/fact")
    views = DayViews(spark, f"{root}/views", f"{root}/fact", EVENT_BANDS,
                     prepare=lambda rows: rows.withColumn("line", recode("line", RECODES)))
    views.build()
    views.announce(COPIED)
    replace_days(fresh.filter(on_days), f"{root}/fact", "date", COPIED)
    views.refresh()
    return views


def day_views_monthly(spark, sf):
    return _views(spark, sf).monthly_summary()


def day_views_quarter(spark, sf):
    return _views(spark, sf).quarter_summary()


def day_views_customer(spark, sf):
    customers = catalog._stg(spark, sf).select("user_unique", "vip_level").distinct()
    return _views(spark, sf).customer_monthly(customers, ["vip_level"])


def day_views_tiers(spark, sf):
    return _views(spark, sf).tier_monthly()


def day_views_retention(spark, sf):
    return _views(spark, sf).retention_daily()


def day_views_first_txns(spark, sf):
    return comparable(_views(spark, sf).new_depositor_txns().select("uniquekey", "user_unique", "date", "line", "deposit_amount"))


def _changes(stg: DataFrame) -> DataFrame:
    """Every row comes, some change (to another key, or to no deposit), and then some users'
    newest row goes."""
    rows = stg.select("user_unique", F.col("txn_date").alias("day"), F.col("deposit_cases").alias("cases"))
    user = F.col("user_unique")
    newest = rows.groupBy("user_unique").agg(F.max("day").alias("newest"))
    moved = F.when((user % 7 == 0) & (F.col("day") >= F.lit(MOVED_FROM)), user % 11).otherwise(user)
    later = F.when(user % 5 == 1, F.lit(0).cast("long")).otherwise(F.col("cases"))
    rows = rows.join(newest, "user_unique").withColumn("key2", moved).withColumn("cases2", later)
    none, day = F.lit(None), F.col("day")

    def change(step, old, new):
        names = ["old_key", "old_date", "old_cases", "new_key", "new_date", "new_cases"]
        types = ["long", "date", "long", "long", "date", "long"]
        return [F.lit(step).alias("step"), *[c.cast(t).alias(n) for c, t, n in zip((*old, *new), types, names)]]

    gone = (none, none, none)
    comes = rows.select(*change(0, gone, (user, day, F.col("cases"))))
    changes = rows.filter((F.col("key2") != user) | (F.col("cases2") != F.col("cases"))).select(
        *change(1, (user, day, F.col("cases")), (F.col("key2"), day, F.col("cases2"))))
    goes = rows.filter((user % 3 == 0) & (day == F.col("newest"))).select(*change(2, (F.col("key2"), day, F.col("cases2")), gone))
    return comes.unionByName(changes).unionByName(goes)


def recency_change_stream(spark, sf):
    from factkeeper.streaming.change_stream import change_stream
    path = scratch_path(spark, "changes")
    log = _changes(catalog._stg(spark, sf))
    for step in range(3):    # a file of each step, in order
        log.filter(F.col("step") == step).drop("step").coalesce(1).write.mode("append").parquet(path)
    return change_stream(spark, path, EVENTS_AS_OF + timedelta(days=1), key="user_unique", max_files_per_trigger=1)


QUERIES = {
    "day_views_monthly": day_views_monthly,
    "day_views_quarter": day_views_quarter,
    "day_views_customer": day_views_customer,
    "day_views_tiers": day_views_tiers,
    "day_views_retention": day_views_retention,
    "day_views_first_txns": day_views_first_txns,
    "recency_change_stream": recency_change_stream,
}


def oracle_sql() -> dict[str, str]:
    spread = O.w(O.STAGING, """spread as (
  select unique_key, user_unique, vip_level, case when line = 'L4' then 'L9' else line end as line, deposit_cases, deposit_amount,
    cast(txn_date + (day(txn_date) % 4) * interval 1 month as date) as d from staging)""")
    sums = """cast(coalesce(sum(deposit_cases), 0) as bigint) as deposit_cases,
  cast(coalesce(sum(deposit_amount), 0) as double) as deposit_amount"""
    month = "cast(date_trunc('month', d) as date)"
    return {
        "day_views_monthly": spread + f"""
select line, cast(year(d) as integer) as year, cast(month(d) as integer) as month, {sums},
  count(distinct user_unique) as active_users from spread group by 1, 2, 3""",
        "day_views_quarter": spread + f"""
select line, cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter, {sums},
  count(distinct user_unique) as active_users from spread group by 1, 2, 3""",
        "day_views_customer": spread + f"""
select user_unique, line, {month} as month_start, {sums}, count(distinct d) as active_days, any_value(vip_level) as vip_level
from spread group by 1, 2, 3""",
        "day_views_tiers": spread + f""", amounts as (
  select user_unique, {month} as month_start, cast(coalesce(sum(deposit_amount), 0) as double) as amount from spread group by 1, 2
), tiers as (
  select *, case when amount >= 0.01 and amount < 500.0 then 'BRONZE' when amount >= 500.0 and amount < 800.0 then 'SILVER'
    when amount >= 800.0 and amount < 1e18 then 'GOLD' end as tier_name,
    case when amount >= 800.0 then 2 when amount >= 500.0 then 1 else 0 end as r from amounts
), moves as (
  select *, lag(tier_name) over w as prev_tier_name, lag(r) over w as prev_r from tiers where tier_name is not null
  window w as (partition by user_unique order by month_start)
)
select user_unique, cast(year(month_start) as integer) as year, cast(month(month_start) as integer) as month, month_start, amount, tier_name,
  prev_tier_name, case when prev_r is null then 'NEW' when r > prev_r then 'UP' when r < prev_r then 'DOWN' else 'SAME' end as movement_status
from moves""",
        "day_views_retention": spread + """, active as (select distinct user_unique, d from spread)
select a.d as period_start, count(*) as active, count(b.d) as retained, count(b.d) / count(*) as rate
from active a left join active b on a.user_unique = b.user_unique and b.d = a.d + 1 group by a.d""",
        "day_views_first_txns": spread + f""", deposits as (select * from spread where coalesce(deposit_cases, 0) > 0)
select unique_key as uniquekey, user_unique, d as date, line, cast(deposit_amount as double) as deposit_amount from deposits
where {month} = (select min({month.replace('d)', 'x.d)')}) from deposits x where x.user_unique = deposits.user_unique)""",
        "recency_change_stream": O.w(O.STAGING, """changed as (
  select case when user_unique % 7 = 0 and txn_date >= date '2024-01-15' then user_unique % 11 else user_unique end as k, txn_date,
    case when user_unique % 5 = 1 then 0 else deposit_cases end as cases
  from staging s where not (user_unique % 3 = 0 and txn_date = (select max(x.txn_date) from staging x where x.user_unique = s.user_unique)))""") + f"""
select k as user_unique, max(txn_date) as {recency.LAST_ACTIVITY}, max(txn_date) filter (cases > 0) as {recency.LAST_DEPOSIT},
  cast(datediff('day', max(txn_date) filter (cases > 0), date '2024-02-01') as integer) as {recency.DAYS_INACTIVE}
from changed group by k""",
    }


__all__ = ["QUERIES", "oracle_sql"]
