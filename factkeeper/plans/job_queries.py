"""Queries for the partition-rewriting jobs: store a target table
(partitioned by a DATE column) in a fresh folder under the shared checkpoint
root, run the job, read the stored table back."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from factkeeper.functions.time_windows import month_window, recent_days, two_days_back
from factkeeper.operators import rewrite
from factkeeper.plans import catalog, jobs
from factkeeper.plans import oracle as O
from factkeeper.plans.testmodel import EVENTS_AS_OF, RUN_TS, comparable
from factkeeper.plans.table_store import by_period, read_days
from factkeeper.session import scratch_path

FACT_OUT = ["unique_key", "txn_date", "line", "deposit_cases", "deposit_amount"]


def _store(df, label, part_col):
    spark = df.sparkSession
    path = scratch_path(spark, label)
    by_period(df, part_col).write.partitionBy(part_col).parquet(path)
    return path


def sync_job_recent_days(spark, sf):
    stg = catalog._stg(spark, sf)
    path = _store(stg.withColumn("deposit_cases", F.col("deposit_cases") * 10), "sync-target", "txn_date")
    spec = rewrite.SyncSpec(date_column="txn_date", filter_column="line", values=["L1", "L2"])
    start, end = recent_days(EVENTS_AS_OF, 3)
    jobs.sync_window_job(spark, stg, path, spec, start, end, RUN_TS)
    return comparable(read_days(spark, path).select(*FACT_OUT))


def mapped_copy_job(spark, sf):
    stg = catalog._stg(spark, sf)
    path = _store(catalog._serving(stg), "serving", "date")
    jobs.mapped_copy_job(spark, stg, path, two_days_back(EVENTS_AS_OF))
    return comparable(read_days(spark, path))


def _with_month(df):
    return df.withColumn("o_month", jobs.period_of("o_orderdate", "month"))


def upsert_job_month(spark, sf):
    orders = catalog._orders(spark, sf)
    target = _with_month(catalog._upsert_target(orders))
    path = _store(target, "upsert-target", "o_month")
    start, end = month_window(date(2001, 7, 20))
    jobs.upsert_month_job(spark, catalog._upsert_source(orders), path, "o_orderkey", "o_orderdate",
                          start, end, ["o_orderdate", "o_totalprice"], RUN_TS, part_col="o_month",
                          stamp_type=catalog.NTZ)
    return read_days(spark, path)


def year_reload_job(spark, sf):
    orders = catalog._orders(spark, sf)
    path = _store(_with_month(orders.filter(F.col("o_orderstatus") != "P")), "year-target", "o_month")
    jobs.year_reload_job(spark, orders, path, "o_orderdate", 1998, part_col="o_month", grain="month")
    return read_days(spark, path)


def _incremental(spark, stg, **store_options):
    """The serving store: built from an older state of the last two days,
    then the two days copied in and only the touched users refreshed."""
    from factkeeper.plans.serving_store import ServingStore
    from factkeeper.plans.testmodel import EVENT_BANDS
    mapping = rewrite.SERVING_MAPPING + [("user_unique", "user_unique")]
    fresh = stg.select(*[F.col(s).alias(t) for s, t in mapping])
    days = two_days_back(EVENTS_AS_OF)
    on_days = F.col("date").isin(days)
    stale = (fresh.withColumn("unique_code", F.when(on_days, F.lit("OLD")).otherwise(F.col("unique_code")))
             .withColumn("deposit_cases", F.when(on_days, F.lit(0)).otherwise(F.col("deposit_cases"))))
    store = ServingStore(spark, scratch_path(spark, "serving-store"), EVENT_BANDS, {"L4": "L9"}, **store_options)
    store.build(stale)
    store.copy_days(stg, days, mapping)
    return store.read(EVENTS_AS_OF + timedelta(days=1)).select(
        "uniquekey", "line", "update_unique_code", "userkey", "last_activity_days",
        "last_deposit_date", "days_inactive", "tier_label")


def incremental_serving(spark, sf):
    return _incremental(spark, catalog._stg(spark, sf))


def incremental_serving_short_key(spark, sf):
    """Codes are shared by users, and so are the keys without a user name."""
    stg = catalog._stg(spark, sf)
    shared = stg.withColumn("unique_code", F.concat(F.lit("S"), (F.col("user_unique") % 50).cast("string")))
    return _incremental(spark, shared, short_key=True)


QUERIES = {
    "incremental_serving": incremental_serving,
    "incremental_serving_short_key": incremental_serving_short_key,
    "sync_job_recent_days": sync_job_recent_days,
    "mapped_copy_job": mapped_copy_job,
    "upsert_job_month": upsert_job_month,
    "year_reload_job": year_reload_job,
}


def _incremental_serving_sql(short_key: bool = False) -> str:
    chain = O._recency_chain_sql()
    if short_key:
        chain = chain.replace("as line) from staging)", "as line, 'S' || (user_unique % 50) as unique_code) from staging)")
        chain = chain.replace("username || '-' || update_unique_code", "update_unique_code")
    body, final = chain.rsplit("\nselect ", 1)
    tiers = """tiers as (
  select userkey, line, case when amount >= 0.01 and amount < 500.0 then 'BRONZE'
    when amount >= 500.0 and amount < 800.0 then 'SILVER'
    when amount >= 800.0 and amount < 1e18 then 'GOLD' end as tier_label
  from (select userkey, line, cast(sum(deposit_amount) as double) as amount
        from keyed where userkey is not null group by userkey, line))"""
    return (body + ",\n" + tiers + """
select s.unique_key as uniquekey, s.line, s.update_unique_code, s.userkey, r.last_activity_days,
  r.last_deposit_date, cast(datediff('day', r.last_deposit_date, date '2024-02-01') as integer) as days_inactive,
  t.tier_label
from keyed s left join r on s.userkey = r.k
left join tiers t on s.userkey = t.userkey and s.line = t.line""")


def oracle_sql() -> dict[str, str]:
    in_win = "txn_date >= date '2024-01-28' and txn_date < date '2024-01-31'"
    day = "cast(date_trunc('month', o_orderdate) as date) as o_month"
    return {
        "incremental_serving": _incremental_serving_sql(),
        "incremental_serving_short_key": _incremental_serving_sql(short_key=True),
        "sync_job_recent_days": O.w(O.STAGING) + f"""
select unique_key, txn_date, line, deposit_cases * 10 as deposit_cases,
  cast(deposit_amount as double) as deposit_amount
from staging where not coalesce({in_win}, false)
union all
select unique_key, txn_date, line, deposit_cases, cast(deposit_amount as double)
from staging where {in_win} and line in ('L1', 'L2') and {O.ACTIVE}""",
        "mapped_copy_job": O._serving_sql(["2024-01-29", "2024-01-30"]),
        "upsert_job_month": O.w(O.UPSERT_SRC, O.UPSERT_TARGET) + f"""
select t.*, {day}, {O.RUN_TS} as last_synced_at from tgt t
where not coalesce(t.o_orderdate >= timestamp '2001-07-01' and t.o_orderdate < timestamp '2001-08-01', false)
  and not exists (select 1 from src s where s.o_orderkey = t.o_orderkey)
union all
select s.*, {day}, {O.RUN_TS} from src s""",
        "year_reload_job": f"""
select {O.ORDER_COLS}, {day} from orders where o_orderstatus <> 'P'
  and not coalesce(o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1999-01-01', false)
union all
select {O.ORDER_COLS}, {day} from orders
where o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1999-01-01'""",
    }


__all__ = ["QUERIES", "oracle_sql"]
