"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark code, straight from the operators'
semantics, over the same test tables (views ``events``, ``orders``, ...).
Decimal results are cast to DOUBLE, day differences to INTEGER, so column
types line up with the Spark side.
"""

from __future__ import annotations

# The activity columns of the daily fact, as in functions.predicates.
ACT = ["deposit_cases", "deposit_amount", "withdraw_cases", "withdraw_amount", "bonus",
       "add_transaction", "deduct_transaction", "add_bonus", "deduct_bonus", "total_bet",
       "total_bet_amount", "total_valid_bet_amount"]
ACTIVE = "(" + " or ".join(f"coalesce({c}, 0) > 0" for c in ACT) + ")"

DAILY = """daily as (
  select user_id as user_unique, cast(ts as date) as date,
    count(case when event_type = 'purchase' then 1 end) as deposit_cases,
    cast(sum(case when event_type = 'purchase' then cast(value as decimal(18,2)) end) as decimal(18,2)) as deposit_amount,
    count(case when event_type = 'error' then 1 end) as withdraw_cases,
    cast(sum(case when event_type = 'error' then cast(value as decimal(18,2)) end) as decimal(18,2)) as withdraw_amount,
    cast(sum(case when event_type = 'signup' then cast(value as decimal(18,2)) end) as decimal(18,2)) as bonus,
    count(case when event_type in ('click', 'view') then 1 end) as total_bet,
    cast(sum(case when event_type in ('click', 'view') then cast(value as decimal(18,2)) end) as decimal(18,2)) as total_bet_amount,
    max(case when event_type = 'purchase' then event_id end) as last_purchase
  from events group by 1, 2)"""

STAGING = DAILY + """,
staging as (
  select user_unique, date, date as txn_date,
    'L' || cast(user_unique % 5 as varchar) as line,
    'A' || cast(user_unique % 3 as varchar) as agent_code,
    'user' || cast(user_unique as varchar) as username,
    'V' || cast(user_unique % 4 as varchar) as vip_level,
    'C' || cast(last_purchase as varchar) as unique_code,
    case when deposit_cases > 0 then 'opL' || cast(user_unique % 5 as varchar) end as operator_username,
    cast(user_unique as varchar) || '-' || strftime(date, '%Y%m%d') as unique_key,
    cast(year(date) as integer) as year,
    strftime(date, '%Y-%m') as month_text,
    'USD' as currency,
    cast(case when deposit_cases = 0 then 1 else 0 end as integer) as absent,
    cast(null as integer) as adjustment_cases,
    deposit_cases, deposit_amount, withdraw_cases, withdraw_amount, bonus, total_bet, total_bet_amount,
    total_bet_amount as total_valid_bet_amount,
    cast(null as decimal(18,2)) as add_bonus, cast(null as decimal(18,2)) as deduct_bonus,
    cast(null as decimal(18,2)) as add_transaction, cast(null as decimal(18,2)) as deduct_transaction,
    cast(coalesce(total_bet_amount, 0) - coalesce(bonus, 0) as decimal(18,2)) as ggr,
    cast(coalesce(deposit_amount, 0) - coalesce(withdraw_amount, 0) as decimal(18,2)) as net_profit,
    'user' || cast(user_unique as varchar) || '-' || ('C' || cast(last_purchase as varchar)) || '-'
      || ('L' || cast(user_unique % 5 as varchar)) as user_key
  from daily)"""

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
RUN_TS = "timestamp '2024-02-01 06:00:00'"


def w(*parts):
    return "with " + ",\n".join(parts)


def _kpi_select(src: str) -> str:
    return f"""select txn_date, line,
  cast(coalesce(sum(deposit_cases), 0) as bigint) as deposit_cases,
  cast(coalesce(sum(deposit_amount), 0) as double) as deposit_amount,
  cast(coalesce(sum(net_profit), 0) as double) as net_profit,
  cast(count(distinct case when coalesce(deposit_cases, 0) > 0 then user_unique end) as integer) as active_members
from {src}"""


MARKETS_SQL = """markets as (
  select 'staging_usc' as table_name, 0 as market_order, * from staging where agent_code = 'A0'
  union all select 'staging_myr', 1, * from staging where agent_code = 'A1'
  union all select 'staging_sgd', 2, * from staging where agent_code = 'A2')"""

KPI_UNION = """kpi as (
  select table_name, market_order, txn_date, coalesce(line, '') as line,
    cast(coalesce(sum(deposit_cases), 0) as bigint) as deposit_cases,
    cast(coalesce(sum(deposit_amount), 0) as double) as deposit_amount,
    cast(coalesce(sum(net_profit), 0) as double) as net_profit,
    cast(count(distinct case when coalesce(deposit_cases, 0) > 0 then user_unique end) as integer) as active_members
  from markets {where} group by table_name, market_order, txn_date, coalesce(line, ''))"""

# Staging column -> serving column, in the copy's order, as in operators.rewrite.
MAPPING = [
    ("username", "user_name"),
    ("vip_level", "vip_level"),
    ("operator_username", "operator"),
    ("unique_code", "unique_code"),
    ("absent", "absent"),
    ("deposit_cases", "deposit_cases"),
    ("deposit_amount", "deposit_amount"),
    ("withdraw_cases", "withdraw_cases"),
    ("withdraw_amount", "withdraw_amount"),
    ("bonus", "bonus"),
    ("adjustment_cases", "cases_adjustment"),
    ("add_bonus", "add_bonus"),
    ("deduct_bonus", "deduct_bonus"),
    ("add_transaction", "add_transaction"),
    ("deduct_transaction", "deduct_transaction"),
    ("total_bet", "cases_bets"),
    ("total_bet_amount", "bets_amount"),
    ("total_valid_bet_amount", "valid_amount"),
    ("ggr", "ggr"),
    ("net_profit", "net_profit"),
    ("date", "date"),
    ("year", "year"),
    ("month_text", "month"),
    ("line", "line"),
    ("currency", "currency"),
    ("user_key", "userkey"),
    ("unique_key", "uniquekey"),
]
DECIMAL_TARGETS = {"deposit_amount", "withdraw_amount", "bonus", "add_bonus", "deduct_bonus",
                   "add_transaction", "deduct_transaction", "bets_amount", "valid_amount", "ggr",
                   "net_profit"}


def _serving_sql(days: list[str]) -> str:
    def out(t):
        return f"cast({t} as double) as {t}" if t in DECIMAL_TARGETS else t
    old_cols = []
    for s, t in MAPPING:
        if t == "deposit_cases":
            old_cols.append("deposit_cases * 10 as deposit_cases")
        elif t == "operator":
            old_cols.append("'legacy' as operator")
        else:
            old_cols.append(f"{s} as {t}")
    day_list = ", ".join(f"date '{d}'" for d in days)
    new_cols = [("coalesce(operator_username, '')" if s == "operator_username" else s) + f" as {t}"
                for s, t in MAPPING]
    tcols = [t for _, t in MAPPING] + ["squad_lead"]
    sel = ", ".join(out(t) for t in tcols)
    return w(STAGING, f"""serving as (select {', '.join(old_cols)}, 'S1' as squad_lead from staging)""",
             f"""result as (
  select * from serving where not coalesce(date in ({day_list}), false)
  union all
  select {', '.join(new_cols)}, cast(null as varchar) as squad_lead from staging where date in ({day_list}))""") \
        + f"\nselect {sel} from result"


RECENCY_SQL = """r as (
  select {key} as k, max(date) as last_activity_days,
    max(case when coalesce(deposit_cases, 0) > 0 then date end) as last_deposit_date
  from {src} where {key} is not null group by {key})"""


def _recency_out(src: str, key: str, as_of: str, cols: str) -> str:
    return (f"select {cols}, r.last_activity_days, r.last_deposit_date, "
            f"cast(datediff('day', r.last_deposit_date, date '{as_of}') as integer) as days_inactive "
            f"from {src} s left join r on s.{key} = r.k")


# the target of the upserts: every eleventh order has lost its date
UPSERT_TARGET = """tgt as (select * replace (case when o_orderkey % 11 <> 0 then o_orderdate end as o_orderdate)
  from (select {cols} from orders where o_orderdate < timestamp '2001-07-15'))""".format(cols=ORDER_COLS)
UPSERT_SRC = f"""src_all as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-07-01' and o_orderdate < timestamp '2001-08-01'
  union all
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, timestamp '2001-07-01 00:00:00', o_orderpriority
  from orders where o_orderdate >= timestamp '2001-06-01' and o_orderdate < timestamp '2001-07-01' and o_orderstatus = 'F'
  union all
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2, o_orderdate + interval 1 day, o_orderpriority
  from orders where o_orderdate >= timestamp '2001-07-01' and o_orderdate < timestamp '2001-08-01' and o_orderstatus = 'P'),
src as (
  select {ORDER_COLS} from (
    select *, row_number() over (partition by o_orderkey order by o_orderdate desc, o_totalprice desc) as rn
    from src_all where o_orderdate >= timestamp '2001-07-01' and o_orderdate < timestamp '2001-08-01') where rn = 1)"""

TIERS_EVENTS = """tiers as (
  select userkey, {grp}, tier_name from (
    select userkey, {grp},
      case when amount >= 0.01 and amount < 500.0 then 'BRONZE'
           when amount >= 500.0 and amount < 800.0 then 'SILVER'
           when amount >= 800.0 and amount < 1e18 then 'GOLD' end as tier_name
    from (select userkey, {grp}, cast(sum(deposit_amount) as double) as amount
          from keyed group by userkey, {grp})) where tier_name is not null)"""

KEYED = "keyed as (select *, username || '-' || line as userkey, cast(month(date) as integer) as month from staging)"

ORDER_TIERS = """monthly as (
  select o_custkey as user_unique, cast(date_trunc('month', o_orderdate) as date) as month_start,
    cast(coalesce(sum(cast(o_totalprice as decimal(28,6))), 0) as double) as amount
  from orders group by 1, 2),
tiered as (
  select *, case when amount >= 0.0 and amount < 100000.0 then 'BRONZE'
                 when amount >= 100000.0 and amount < 300000.0 then 'SILVER'
                 when amount >= 300000.0 and amount < 1e18 then 'GOLD' end as tier_name
  from monthly),
ranked as (
  select *, lag(tier_name) over (partition by user_unique order by month_start) as prev_tier_name
  from tiered where tier_name is not null),
tiers as (
  select user_unique, cast(year(month_start) as integer) as year, cast(month(month_start) as integer) as month,
    month_start, amount, tier_name, prev_tier_name,
    case when prev_tier_name is null then 'NEW'
         when (case tier_name when 'BRONZE' then 0 when 'SILVER' then 1 else 2 end)
            > (case prev_tier_name when 'BRONZE' then 0 when 'SILVER' then 1 else 2 end) then 'UP'
         when (case tier_name when 'BRONZE' then 0 when 'SILVER' then 1 else 2 end)
            < (case prev_tier_name when 'BRONZE' then 0 when 'SILVER' then 1 else 2 end) then 'DOWN'
         else 'SAME' end as movement_status
  from ranked)"""

ORDER_MEASURES = """cast(count(*) as bigint) as deposit_cases,
    cast(coalesce(sum(cast(o_totalprice as decimal(28,6))), 0) as double) as deposit_amount,
    cast(count(distinct o_custkey) as bigint) as active_users"""

LINEITEM_DEDUP = """dedup as (
  select * exclude (rn) from (
    select *, row_number() over (partition by l_orderkey, l_linenumber
      order by l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc,
               l_tax desc, l_returnflag desc, l_linestatus desc, l_shipdate desc) as rn
    from lineitem where l_orderkey is not null and l_linenumber is not null) where rn = 1)"""


def _recency_chain_sql() -> str:
    return w(
        STAGING,
        """recoded as (select * replace (case when line = 'L4' then 'L9' else line end as line) from staging)""",
        """latest as (
  select user_unique, unique_code as latest_code from (
    select user_unique, unique_code, row_number() over (
      partition by user_unique order by date desc nulls first, unique_key desc) as rn
    from recoded where user_unique is not null) where rn = 1)""",
        """coded as (
  select s.*, case when s.user_unique is not null then l.latest_code end as update_unique_code
  from recoded s left join latest l on s.user_unique = l.user_unique)""",
        """keyed as (select *, username || '-' || update_unique_code || '-' || line as userkey from coded)""",
        RECENCY_SQL.format(key="userkey", src="keyed"),
    ) + "\n" + _recency_out("keyed", "userkey", "2024-02-01",
                            "s.unique_key, s.line, s.update_unique_code, s.userkey")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["window_scan_activity"] = w(STAGING) + f"""
select unique_key, user_unique, txn_date, line, deposit_cases, cast(deposit_amount as double) as deposit_amount
from staging where txn_date >= date '2024-01-28' and txn_date < date '2024-01-31'
  and line in ('L1', 'L2') and {ACTIVE}"""
    q["auto_value_list"] = w(STAGING) + """
select distinct agent_code as filter_value from staging
where txn_date >= date '2024-01-30' and txn_date < date '2024-02-01' and agent_code is not null"""
    q["breakdown_by_date_line"] = w(STAGING) + f"""
select txn_date as txn_day, line as filter_value, count(*) as row_count
from staging where {ACTIVE} group by 1, 2"""
    q["filtered_counts"] = w(STAGING) + f"""
select count(*) as total_rows,
  count(case when txn_date >= date '2024-01-28' and txn_date < date '2024-01-31' then 1 end) as in_window,
  count(case when {ACTIVE} then 1 end) as active,
  count(case when txn_date >= date '2024-01-28' and txn_date < date '2024-01-31'
             and line in ('L1', 'L2') and {ACTIVE} then 1 end) as to_sync
from staging"""
    q["kpi_daily"] = w(STAGING) + "\n" + _kpi_select("staging") + """
where txn_date >= date '2024-01-30' and txn_date < date '2024-01-31' group by txn_date, line"""
    q["kpi_market_union"] = w(STAGING, MARKETS_SQL, KPI_UNION.format(where="")) + "\nselect * from kpi"
    q["kpi_report_format"] = w(STAGING, MARKETS_SQL, KPI_UNION.format(
        where="where txn_date >= date '2024-01-30' and txn_date < date '2024-01-31'")) + """
select table_name, market_order, strftime(txn_date, '%Y/%m/%d') as txn_date, line,
  format('{:,}', cast(deposit_cases as bigint)) as deposit_cases,
  format('{:,.2f}', deposit_amount) as deposit_amount,
  format('{:,.2f}', net_profit) as net_profit,
  format('{:,}', active_members) as active_members
from kpi"""
    q["window_replace_recent"] = f"""
select {ORDER_COLS}, {RUN_TS} as last_synced_at from orders
where not coalesce(o_orderdate >= timestamp '2001-07-29' and o_orderdate < timestamp '2001-08-01', false)
union all
select o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority, {RUN_TS}
from orders where o_orderdate >= timestamp '2001-07-29' and o_orderdate < timestamp '2001-08-01'
  and o_orderpriority in ('1-URGENT', '2-HIGH') and coalesce(o_totalprice * 2, 0) > 0"""
    q["window_replace_yesterday_today"] = f"""
select {ORDER_COLS}, {RUN_TS} as last_synced_at from orders
where not coalesce(o_orderdate >= timestamp '2001-07-30' and o_orderdate < timestamp '2001-08-01', false)
union all
select o_orderkey, o_custkey, 'R', o_totalprice, o_orderdate, o_orderpriority, {RUN_TS}
from orders where o_orderdate >= timestamp '2001-07-30' and o_orderdate < timestamp '2001-08-01'
  and o_orderpriority is not null and coalesce(o_totalprice, 0) > 0"""
    q["kpi_exact_sums"] = """
select cast(o_orderdate as date) as txn_date, o_orderpriority as line, count(*) as deposit_cases,
  cast(sum(cast(cast(round(o_totalprice * 100) as bigint) as decimal(28,4)) / 10000) as double) as deposit_amount,
  cast(sum(cast(o_orderkey as hugeint) * 1099511627776) as double) as net_profit,
  cast(count(distinct o_custkey) as integer) as active_members
from orders group by 1, 2"""
    q["month_upsert"] = w(UPSERT_SRC, UPSERT_TARGET) + f"""
select t.*, {RUN_TS} as last_synced_at from tgt t
where not coalesce(t.o_orderdate >= timestamp '2001-07-01' and t.o_orderdate < timestamp '2001-08-01', false)
  and not exists (select 1 from src s where s.o_orderkey = t.o_orderkey)
union all
select s.*, {RUN_TS} from src s"""
    q["mapped_replace"] = _serving_sql(["2024-01-29", "2024-01-30"])
    q["mapped_replace_today"] = _serving_sql(["2024-01-30", "2024-01-31"])
    q["full_reload"] = f"select {ORDER_COLS} from orders"
    q["year_reload"] = f"""
select {ORDER_COLS} from orders where o_orderstatus <> 'P'
  and not coalesce(o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1999-01-01', false)
union all
select {ORDER_COLS} from orders where o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1999-01-01'"""
    q["latest_value_per_key"] = w(STAGING, """latest as (
  select user_unique, unique_code as latest_code from (
    select user_unique, unique_code, row_number() over (
      partition by user_unique order by date desc nulls first, unique_key desc) as rn
    from staging where user_unique is not null) where rn = 1)""") + """
select s.unique_key, s.user_unique, s.date, s.unique_code, l.latest_code as update_unique_code
from staging s left join latest l on s.user_unique = l.user_unique"""
    q["distinct_on_latest"] = """
select o_custkey, month_start, o_orderkey, o_orderdate, o_totalprice from (
  select o_custkey, cast(date_trunc('month', o_orderdate) as date) as month_start, o_orderkey, o_orderdate, o_totalprice,
    row_number() over (partition by o_custkey, date_trunc('month', o_orderdate)
                       order by o_orderdate desc, o_orderkey desc) as rn
  from orders where o_custkey is not null) where rn = 1"""
    q["backfill_missing"] = """
with src as (
  select user_id, traffic, first_amount from (
    select user_id, props as traffic, value as first_amount,
      row_number() over (partition by user_id order by ts desc, event_id desc) as rn
    from events where user_id is not null) where rn = 1),
tgt as (
  select event_id, user_id,
    case when event_type in ('click', 'view') then null else props end as traffic,
    case when event_type = 'error' then null else value end as first_amount
  from events)
select t.event_id, t.user_id, coalesce(t.traffic, s.traffic) as traffic,
  coalesce(t.first_amount, s.first_amount) as first_amount
from tgt t left join src s on t.user_id = s.user_id"""
    q["update_from_two_keys"] = w(STAGING, KEYED, TIERS_EVENTS.format(grp="line")) + """
select k.unique_key, k.userkey, k.line, coalesce(t.tier_name, 'NONE') as tier_label
from keyed k left join tiers t on k.userkey = t.userkey and k.line = t.line"""
    q["update_from_four_keys"] = w(STAGING, KEYED, TIERS_EVENTS.format(grp="year, month, line")) + """
select k.unique_key, k.userkey, k.year, k.month, k.line, coalesce(t.tier_name, 'NONE') as tier_label
from keyed k left join tiers t on k.userkey = t.userkey and k.year = t.year and k.month = t.month and k.line = t.line"""
    q["tier_stamp"] = w(ORDER_TIERS, """src as (
  select * from (select *, row_number() over (partition by user_unique, year, month order by month_start desc) as rn
                 from tiers) where rn = 1)""") + """
select o.o_orderkey, o.o_custkey as user_unique, cast(year(o.o_orderdate) as integer) as year,
  cast(month(o.o_orderdate) as integer) as month, s.tier_name, s.prev_tier_name,
  cast(null as varchar) as last_active_tier_before_current, s.movement_status
from orders o left join src s on o.o_custkey = s.user_unique
  and cast(year(o.o_orderdate) as integer) = s.year and cast(month(o.o_orderdate) as integer) = s.month"""
    q["conditional_lookup_update"] = """
with lk as (
  select n.n_nationkey, r.r_name as lead from nation n
  left join (select * from region where r_name <> 'AFRICA') r on n.n_regionkey = r.r_regionkey),
t as (
  select s_suppkey, s_nationkey,
    case when s_acctbal < 0 then 'OLD' when s_acctbal < 5000 then null else 'ASIA' end as squad_lead
  from supplier)
select t.s_suppkey, t.s_nationkey,
  case when t.squad_lead is null or t.squad_lead <> lk.lead then lk.lead else t.squad_lead end as squad_lead
from t left join lk on t.s_nationkey = lk.n_nationkey"""
    q["recode_values"] = """
select o_orderkey, case o_orderpriority when '1-URGENT' then '1-CRITICAL'
  when '4-NOT SPECIFIED' then '4-UNSPECIFIED' else o_orderpriority end as o_orderpriority from orders"""
    q["user_key"] = w(STAGING, """latest as (
  select user_unique, unique_code as latest_code from (
    select user_unique, unique_code, row_number() over (
      partition by user_unique order by date desc nulls first, unique_key desc) as rn
    from staging where user_unique is not null) where rn = 1)""") + """
select s.unique_key, s.username || '-' || l.latest_code || '-' || s.line as userkey,
  l.latest_code || '-' || s.line as userkey_short
from staging s left join latest l on s.user_unique = l.user_unique"""
    q["recency_per_key"] = w(STAGING, RECENCY_SQL.format(key="user_unique", src="staging")) + "\n" + \
        _recency_out("staging", "user_unique", "2024-02-01", "s.unique_key, s.user_unique, s.date")
    q["reage_inactivity"] = w(STAGING, RECENCY_SQL.format(key="user_unique", src="staging")) + "\n" + \
        _recency_out("staging", "user_unique", "2024-02-10", "s.unique_key, s.user_unique, s.date")
    q["refresh_changed_keys"] = w(STAGING, """after as (
  select * from staging where date <= date '2024-01-30'
    and not (date = date '2024-01-29' and line = 'L0'))""",
                                  RECENCY_SQL.format(key="user_unique", src="after")) + "\n" + \
        _recency_out("after", "user_unique", "2024-02-01", "s.unique_key, s.user_unique, s.date")
    q["stream_recency"] = w(STAGING, RECENCY_SQL.format(key="user_unique", src="staging")) + "\n" + \
        _recency_out("staging", "user_unique", "2024-02-01",
                     "s.unique_key, s.user_unique, s.date, s.deposit_cases, "
                     "cast(s.deposit_amount as double) as deposit_amount")
    lost = "(select * from events where not (event_id % 7 = 0 and ts >= timestamp '2024-01-28' and ts < timestamp '2024-01-31'))"
    q["stream_trailing_reload"] = q["stream_recency"].replace("from events", f"from {lost}")
    q["monthly_summary"] = f"""
select o_orderpriority as line, cast(year(o_orderdate) as integer) as year,
  cast(month(o_orderdate) as integer) as month, {ORDER_MEASURES}
from orders group by 1, 2, 3"""
    q["materialized_monthly_summary"] = q["monthly_summary"]
    q["line_summary"] = f"""
select o_orderpriority as line, {ORDER_MEASURES},
  min(cast(o_orderdate as date)) as first_day, max(cast(o_orderdate as date)) as last_day
from orders group by 1"""
    q["daily_summary"] = f"""
select o_orderpriority as line, cast(o_orderdate as date) as day, {ORDER_MEASURES}
from orders group by 1, 2"""
    q["quarter_summary"] = f"""
select o_orderpriority as line, cast(year(o_orderdate) as integer) as year,
  cast(quarter(o_orderdate) as integer) as quarter, {ORDER_MEASURES}
from orders group by 1, 2, 3"""
    q["customer_monthly"] = """
with per as (
  select o_custkey, o_orderpriority as line, cast(date_trunc('month', o_orderdate) as date) as month_start,
    cast(count(*) as bigint) as deposit_cases,
    cast(coalesce(sum(cast(o_totalprice as decimal(28,6))), 0) as double) as deposit_amount,
    cast(count(distinct cast(o_orderdate as date)) as bigint) as active_days
  from orders group by 1, 2, 3)
select p.*, c.c_mktsegment, c.c_nationkey from per p left join customer c on p.o_custkey = c.c_custkey"""
    q["tier_monthly"] = w(ORDER_TIERS) + "\nselect * from tiers"
    q["tier_summary"] = w(ORDER_TIERS) + """
select month_start, tier_name, cast(count(*) as bigint) as users,
  cast(sum(cast(amount as decimal(28,6))) as double) as amount
from tiers group by 1, 2"""
    q["retention_monthly"] = """
with a as (select distinct o_custkey as u, cast(date_trunc('month', o_orderdate) as date) as m
           from orders where o_custkey is not null and o_orderdate is not null)
select a.m as period_start, cast(count(*) as bigint) as active, cast(count(b.u) as bigint) as retained,
  cast(count(b.u) as double) / cast(count(*) as double) as rate
from a left join a b on b.u = a.u and b.m = cast(a.m + interval 1 month as date) group by a.m"""
    q["retention_daily"] = """
with a as (select distinct user_id as u, cast(ts as date) as m from events
           where user_id is not null and ts is not null)
select a.m as period_start, cast(count(*) as bigint) as active, cast(count(b.u) as bigint) as retained,
  cast(count(b.u) as double) / cast(count(*) as double) as rate
from a left join a b on b.u = a.u and b.m = cast(a.m + interval 1 day as date) group by a.m"""
    q["new_register_monthly"] = """
select cast(date_trunc('month', register_date) as date) as month_start, cast(count(*) as bigint) as new_users
from (select user_id, min(cast(ts as date)) as register_date from events
      where event_type = 'signup' and user_id is not null group by 1) group by 1"""
    q["new_depositors"] = """
select user_id, cast(ts as date) as first_deposit_date, value as first_deposit_amount from (
  select user_id, ts, value, row_number() over (partition by user_id order by ts, event_id) as rn
  from events where event_type = 'purchase' and user_id is not null) where rn = 1"""
    q["new_depositor_txns"] = """
with firsts as (select o_custkey, min(cast(date_trunc('month', o_orderdate) as date)) as m
                from orders where o_custkey is not null group by 1)
select o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice from orders o
where exists (select 1 from firsts f where f.o_custkey = o.o_custkey
              and f.m = cast(date_trunc('month', o.o_orderdate) as date))"""
    q["deposit_summary"] = """
select cast(year(o_orderdate) as integer) as year, o_orderstatus, cast(count(*) as bigint) as deposits,
  cast(sum(cast(o_totalprice as decimal(28,6))) as double) as total_amount,
  cast(min(o_totalprice) as double) as min_amount, cast(max(o_totalprice) as double) as max_amount
from orders group by 1, 2"""
    q["reconcile_counts"] = w(LINEITEM_DEDUP) + """
select (select count(*) from lineitem) as source_rows, (select count(*) from dedup) as target_rows,
  (select count(*) from lineitem) - (select count(*) from dedup) as difference"""
    q["duplicate_keys"] = """
select l_orderkey, l_linenumber, count(*) as n from lineitem
where l_orderkey is not null and l_linenumber is not null
group by 1, 2 having count(*) > 1"""
    q["breakdown_compare"] = w(LINEITEM_DEDUP, """a as (select cast(l_shipdate as date) as txn_day, l_returnflag as filter_value,
  count(*) as source_rows from lineitem group by 1, 2)""", """b as (select cast(l_shipdate as date) as txn_day,
  l_returnflag as filter_value, count(*) as target_rows from dedup group by 1, 2)""") + """
select coalesce(a.txn_day, b.txn_day) as txn_day, coalesce(a.filter_value, b.filter_value) as filter_value,
  coalesce(a.source_rows, 0) as source_rows, coalesce(b.target_rows, 0) as target_rows
from a full outer join b on a.txn_day is not distinct from b.txn_day
  and a.filter_value is not distinct from b.filter_value
where coalesce(a.source_rows, 0) <> coalesce(b.target_rows, 0)"""
    q["parse_dates_multi"] = """
with t as (
  select o_orderkey, case o_orderpriority
      when '1-URGENT' then strftime(o_orderdate, '%Y-%m-%d')
      when '2-HIGH' then strftime(o_orderdate, '%Y/%-m/%-d')
      when '3-MEDIUM' then strftime(o_orderdate, '%-d/%-m/%Y')
      when '4-NOT SPECIFIED' then strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')
      else 'n/a' end as date_text
  from orders)
select o_orderkey, date_text, coalesce(
  cast(try_strptime(split_part(date_text, ' ', 1), '%Y-%m-%d') as date),
  cast(try_strptime(split_part(date_text, ' ', 1), '%Y/%m/%d') as date),
  cast(try_strptime(split_part(date_text, ' ', 1), '%d/%m/%Y') as date),
  cast(try_strptime(split_part(date_text, ' ', 1), '%m/%d/%Y') as date),
  date '2024-01-31') as parsed_date
from t"""
    q["daily_chain"] = _recency_chain_sql()
    return q
