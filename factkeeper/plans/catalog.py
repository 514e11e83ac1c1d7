"""The registered queries: each builds its inputs from the test tables, runs
one library operator, and returns the result frame.

Every query reads whole tables (or data Spark derives from them); windows
and day sets are the operators' own parameters, not sampling.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.functions.predicates import in_window, is_active
from factkeeper.functions.scalar import parse_date_multi, recode, strict_concat
from factkeeper.functions.time_windows import (
    h_minus_1, month_window, recent_days, two_days_back, yesterday_and_today, yesterday_today,
)
from factkeeper.operators import kpi, quality, recency, rewrite, update, views
from factkeeper.plans import testmodel as tm
from factkeeper.plans.testmodel import (
    EVENT_BANDS, EVENTS_AS_OF, MARKETS, ORDER_BANDS, ORDERS_AS_OF, RUN_TS, comparable, event_stream,
    table,
)

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]
NTZ = "timestamp_ntz"


def _orders(spark, sf):
    return table(spark, sf, "orders").select(*ORDER_COLS)


def _stg(spark, sf, start=None, end=None):
    return tm.staging(spark, sf, start, end)


# ---------------------------------------------------------------- scans / predicates

def window_scan_activity(spark: SparkSession, sf: str) -> DataFrame:
    start, end = recent_days(EVENTS_AS_OF, 3)
    spec = rewrite.SyncSpec(date_column="txn_date", filter_column="line", values=["L1", "L2"])
    rows = rewrite.sync_rows(_stg(spark, sf, start, end), spec, start, end)
    return comparable(rows.select("unique_key", "user_unique", "txn_date", "line",
                                  "deposit_cases", "deposit_amount"))


def auto_value_list(spark, sf):
    start, end = yesterday_today(EVENTS_AS_OF)
    spec = rewrite.SyncSpec(date_column="txn_date", filter_column="agent_code", mode="all")
    return rewrite.auto_value_list(_stg(spark, sf), spec, start, end).withColumnRenamed(
        "agent_code", "filter_value")


def breakdown_by_date_line(spark, sf):
    stg = _stg(spark, sf)
    return kpi.breakdown(stg.filter(is_active()), "txn_date", "line")


def filtered_counts(spark, sf):
    stg = _stg(spark, sf)
    start, end = recent_days(EVENTS_AS_OF, 3)
    win = in_window(stg, "txn_date", start, end)
    return kpi.filtered_counts(stg, {
        "in_window": win,
        "active": is_active(),
        "to_sync": win & F.col("line").isin("L1", "L2") & is_active(),
    })


# ---------------------------------------------------------------- KPI

def kpi_daily(spark, sf):
    start, end = h_minus_1(EVENTS_AS_OF)
    return kpi.kpi_rollup(_stg(spark, sf, start, end))


def kpi_exact_sums(spark, sf):
    """Amounts with four decimals and profits beyond 10^16 (multiples of 2^40, so that their
    doubles are exact)."""
    orders = _orders(spark, sf)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("decimal(28,0)")
    fact = orders.select(F.to_date("o_orderdate").alias("txn_date"), F.col("o_orderpriority").alias("line"),
                         F.col("o_custkey").alias("user_unique"), F.lit(1).alias("deposit_cases"),
                         (cents * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(28,4)").alias("deposit_amount"),
                         (F.col("o_orderkey").cast("decimal(28,0)") * F.lit(1 << 40).cast("decimal(14,0)"))
                         .cast("decimal(28,2)").alias("net_profit"))
    return kpi.kpi_rollup(fact)


def _markets(stg):
    return {name: stg.filter(F.col("agent_code") == code) for name, code in MARKETS.items()}


def kpi_market_union(spark, sf):
    return kpi.kpi_union(_markets(_stg(spark, sf)))


def kpi_report_format(spark, sf):
    start, end = h_minus_1(EVENTS_AS_OF)
    return kpi.kpi_report(kpi.kpi_union(_markets(_stg(spark, sf, start, end))))


# ---------------------------------------------------------------- rewrites

def window_replace_recent(spark, sf):
    orders = _orders(spark, sf)
    source = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    spec = rewrite.SyncSpec(date_column="o_orderdate", filter_column="o_orderpriority",
                            values=["1-URGENT", "2-HIGH"], activity_columns=["o_totalprice"])
    return rewrite.replace_recent_days(orders, source, spec, ORDERS_AS_OF, RUN_TS, NTZ)


def window_replace_yesterday_today(spark, sf):
    orders = _orders(spark, sf)
    source = orders.withColumn("o_orderstatus", F.lit("R"))
    spec = rewrite.SyncSpec(date_column="o_orderdate", filter_column="o_orderpriority", mode="all",
                            activity_columns=["o_totalprice"])
    return rewrite.replace_yesterday_today(orders, source, spec, ORDERS_AS_OF - timedelta(days=1),
                                           RUN_TS, NTZ)


def _upsert_source(orders: DataFrame) -> DataFrame:
    """July 2001 changes: every July order re-priced, June's settled orders
    moved to July 1 (keys living in another month), and July's pending
    orders sent twice, the second time a day later (duplicate keys)."""
    july = in_window(orders, "o_orderdate", date(2001, 7, 1), date(2001, 8, 1))
    june = in_window(orders, "o_orderdate", date(2001, 6, 1), date(2001, 7, 1))
    repriced = orders.filter(july).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    moved = (orders.filter(june & (F.col("o_orderstatus") == "F"))
             .withColumn("o_orderdate", F.lit("2001-07-01 00:00:00").cast(NTZ)))
    again = (orders.filter(july & (F.col("o_orderstatus") == "P"))
             .withColumn("o_totalprice", F.col("o_totalprice") + 2)
             .withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")))
    return repriced.unionByName(moved).unionByName(again)


def _upsert_target(orders: DataFrame) -> DataFrame:
    """Orders before the middle of the month; every eleventh has lost its date."""
    return (orders.filter(F.col("o_orderdate") < F.lit("2001-07-15").cast(NTZ))
            .withColumn("o_orderdate", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate"))))


def month_upsert(spark, sf):
    orders = _orders(spark, sf)
    target = _upsert_target(orders)
    start, end = month_window(date(2001, 7, 20))
    return rewrite.upsert_window(target, _upsert_source(orders), "o_orderkey", "o_orderdate",
                                 start, end, ["o_orderdate", "o_totalprice"], RUN_TS,
                                 stamp_type=NTZ)


def _serving(stg: DataFrame) -> DataFrame:
    """An earlier state of the serving table: stale cases, an operator and a
    serving-only column (squad_lead)."""
    mapped = stg.select(*[F.col(s).alias(t) for s, t in rewrite.SERVING_MAPPING])
    return (mapped.withColumn("deposit_cases", F.col("deposit_cases") * 10)
            .withColumn("operator", F.lit("legacy"))
            .withColumn("squad_lead", F.lit("S1")))


def mapped_replace(spark, sf):
    stg = _stg(spark, sf)
    return comparable(rewrite.mapped_replace(_serving(stg), stg, two_days_back(EVENTS_AS_OF)))


def mapped_replace_today(spark, sf):
    stg = _stg(spark, sf)
    days = yesterday_and_today(EVENTS_AS_OF)
    return comparable(rewrite.mapped_replace(_serving(stg), stg, days))


def full_reload(spark, sf):
    orders = _orders(spark, sf)
    cut = F.lit("1997-01-01").cast(NTZ)
    return rewrite.full_load(orders.filter(F.col("o_orderdate") < cut),
                             orders.filter(F.col("o_orderdate") >= cut), truncate=False)


def year_reload(spark, sf):
    orders = _orders(spark, sf)
    target = orders.filter(F.col("o_orderstatus") != "P")
    return rewrite.year_reload(target, orders, "o_orderdate", 1998)


# ---------------------------------------------------------------- updates

def latest_value_per_key(spark, sf):
    stg = _stg(spark, sf)
    out = update.spread_latest(stg, "user_unique", "unique_code", "update_unique_code",
                               newest=["date", "unique_key"], nulls_first=["date"])
    return out.select("unique_key", "user_unique", "date", "unique_code", "update_unique_code")


def distinct_on_latest(spark, sf):
    orders = _orders(spark, sf).withColumn("month_start", views.month_start("o_orderdate"))
    return update.latest_per_key(orders, ["o_custkey", "month_start"], ["o_orderdate", "o_orderkey"],
                                 cols=["o_orderkey", "o_orderdate", "o_totalprice"])


def _events_with_gaps(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type").isin("click", "view"), F.lit(None)).otherwise(F.col("props"))
        .alias("traffic"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value"))
        .alias("first_amount"))


def backfill_missing(spark, sf):
    events = table(spark, sf, "events")
    source = events.select("user_id", "ts", "event_id", F.col("props").alias("traffic"),
                           F.col("value").alias("first_amount"))
    out = update.backfill(_events_with_gaps(events), source, "user_id", ["traffic", "first_amount"],
                          newest=["ts", "event_id"])
    return out.select("event_id", "user_id", "traffic", "first_amount")


def _keyed_fact(stg: DataFrame) -> DataFrame:
    return (stg.withColumn("userkey", strict_concat("username", "line"))
            .withColumn("tier_label", F.lit("NONE")))


def update_from_two_keys(spark, sf):
    fact = _keyed_fact(_stg(spark, sf))
    tiers = (fact.groupBy("userkey", "line")
             .agg(kpi.money(fact, "deposit_amount").cast("double").alias("amount"))
             .withColumn("tier_name", views.band(F.col("amount"), EVENT_BANDS))
             .filter(F.col("tier_name").isNotNull()))
    out = update.update_from(fact, tiers, ["userkey", "line"], {"tier_label": "tier_name"},
                             unique=True)
    return out.select("unique_key", "userkey", "line", "tier_label")


def update_from_four_keys(spark, sf):
    fact = _keyed_fact(_stg(spark, sf)).withColumn("month", F.month("date").cast("int"))
    tiers = (fact.groupBy("userkey", "year", "month", "line")
             .agg(kpi.money(fact, "deposit_amount").cast("double").alias("amount"))
             .withColumn("tier_name", views.band(F.col("amount"), EVENT_BANDS))
             .filter(F.col("tier_name").isNotNull()))
    out = update.update_from(fact, tiers, ["userkey", "year", "month", "line"],
                             {"tier_label": "tier_name"}, unique=True)
    return out.select("unique_key", "userkey", "year", "month", "line", "tier_label")


def _order_fact(orders: DataFrame) -> views.FactCols:
    return views.FactCols(user="o_custkey", date="o_orderdate", line="o_orderpriority",
                          amount="o_totalprice", cases=None)


def tier_stamp(spark, sf):
    orders = _orders(spark, sf)
    tiers = views.tier_monthly(orders, ORDER_BANDS, _order_fact(orders))
    fact = (orders.withColumn("user_unique", F.col("o_custkey"))
            .withColumn("year", F.year("o_orderdate").cast("int"))
            .withColumn("month", F.month("o_orderdate").cast("int")))
    out = update.update_from(
        fact, tiers, ["user_unique", "year", "month"],
        {"tier_name": "tier_name", "prev_tier_name": "prev_tier_name",
         "last_active_tier_before_current": F.lit(None).cast("string"),
         "movement_status": "movement_status"},
        newest=["month_start"])
    return out.select("o_orderkey", "user_unique", "year", "month", "tier_name", "prev_tier_name",
                      "last_active_tier_before_current", "movement_status")


def _lead_lookup(spark, sf):
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region").filter(F.col("r_name") != "AFRICA")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("lead")))


def conditional_lookup_update(spark, sf):
    supplier = table(spark, sf, "supplier")
    target = supplier.select(
        "s_suppkey", "s_nationkey",
        F.when(F.col("s_acctbal") < 0, F.lit("OLD")).when(F.col("s_acctbal") < 5000, F.lit(None))
        .otherwise(F.lit("ASIA")).alias("squad_lead"))
    return update.conditional_update(target, _lead_lookup(spark, sf), "s_nationkey", "squad_lead",
                                     "lead")


def recode_values(spark, sf):
    orders = _orders(spark, sf)
    mapping = {"1-URGENT": "1-CRITICAL", "4-NOT SPECIFIED": "4-UNSPECIFIED"}
    return orders.select("o_orderkey", recode("o_orderpriority", mapping).alias("o_orderpriority"))


def _with_update_code(stg):
    return update.spread_latest(stg, "user_unique", "unique_code", "update_unique_code",
                                newest=["date", "unique_key"], nulls_first=["date"])


def user_key(spark, sf):
    out = _with_update_code(_stg(spark, sf))
    out = rewrite.set_column(out, "userkey", strict_concat("username", "update_unique_code", "line"))
    out = rewrite.set_column(out, "userkey_short", strict_concat("update_unique_code", "line"))
    return out.select("unique_key", "userkey", "userkey_short")


# ---------------------------------------------------------------- recency

RECENCY_OUT = ["unique_key", "user_unique", "date", recency.LAST_ACTIVITY, recency.LAST_DEPOSIT,
               recency.DAYS_INACTIVE]


def recency_per_key(spark, sf):
    out = recency.recency(_stg(spark, sf), "user_unique", EVENTS_AS_OF + timedelta(days=1))
    return out.select(*RECENCY_OUT)


def reage_inactivity(spark, sf):
    out = recency.recency(_stg(spark, sf), "user_unique", EVENTS_AS_OF)
    return recency.reage(out, date(2024, 2, 10)).select(*RECENCY_OUT)


def refresh_changed_keys(spark, sf):
    stg = _stg(spark, sf).select("unique_key", "user_unique", "date", "line", "deposit_cases")
    as_of = EVENTS_AS_OF + timedelta(days=1)
    base = recency.recency(stg.filter(F.col("date") < F.lit(date(2024, 1, 30))), "user_unique", as_of)
    inserts = stg.filter(F.col("date") == F.lit(date(2024, 1, 30)))
    deleted = (F.col("date") == F.lit(date(2024, 1, 29))) & (F.col("line") == "L0")
    changes = (inserts.select(F.col("user_unique").alias("new_key"),
                              F.lit(None).cast("bigint").alias("old_key"))
               .unionByName(base.filter(deleted).select(F.lit(None).cast("bigint").alias("new_key"),
                                                        F.col("user_unique").alias("old_key"))))
    after = base.filter(~deleted).unionByName(inserts, allowMissingColumns=True)
    out = recency.refresh_changed(after, recency.changed_keys(changes), "user_unique", as_of)
    return out.select(*RECENCY_OUT)


def stream_recency(spark, sf):
    from factkeeper.streaming.recency_stream import recency_stream
    out = recency_stream(spark, sf, EVENTS_AS_OF + timedelta(days=1), event_stream())
    return comparable(out.select("unique_key", "user_unique", "date", "deposit_cases",
                                 "deposit_amount", recency.LAST_ACTIVITY, recency.LAST_DEPOSIT,
                                 recency.DAYS_INACTIVE))


def stream_trailing_reload(spark, sf):
    """Every event folded, then the last three days re-read from a source that has lost
    every seventh event of them."""
    from factkeeper.session import scratch_path
    from factkeeper.streaming.recency_stream import RecencyState
    events = table(spark, sf, "events")
    days = [EVENTS_AS_OF - timedelta(days=n) for n in (1, 2, 3)]
    left = events.filter((F.col("event_id") % 7 != 0) & F.to_date("ts").isin(days))
    root = scratch_path(spark, "trailing-stream")
    RecencyState(spark, root, event_stream()).fold(events, 0)
    state = RecencyState(spark, root, event_stream(), reload=lambda: (days, left))
    state.fold(events.limit(0), 1)
    state.compact(days[-1])
    out = state.read(EVENTS_AS_OF + timedelta(days=1))
    return comparable(out.select("unique_key", "user_unique", "date", "deposit_cases",
                                 "deposit_amount", recency.LAST_ACTIVITY, recency.LAST_DEPOSIT,
                                 recency.DAYS_INACTIVE))


# ---------------------------------------------------------------- views

def monthly_summary(spark, sf):
    orders = _orders(spark, sf)
    return views.monthly_summary(orders, _order_fact(orders))


def line_summary(spark, sf):
    orders = _orders(spark, sf)
    return views.line_summary(orders, _order_fact(orders))


def daily_summary(spark, sf):
    orders = _orders(spark, sf)
    return views.daily_summary(orders, _order_fact(orders))


def quarter_summary(spark, sf):
    orders = _orders(spark, sf)
    return views.quarter_summary(orders, _order_fact(orders))


def customer_monthly(spark, sf):
    orders = _orders(spark, sf)
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return views.customer_monthly(orders, customers, "o_custkey", ["c_mktsegment", "c_nationkey"],
                                  _order_fact(orders))


def tier_monthly(spark, sf):
    orders = _orders(spark, sf)
    return views.tier_monthly(orders, ORDER_BANDS, _order_fact(orders))


def tier_summary(spark, sf):
    return views.tier_summary(tier_monthly(spark, sf))


def retention_monthly(spark, sf):
    orders = _orders(spark, sf)
    return views.retention(orders, "o_custkey", views.month_start("o_orderdate"), "month")


def retention_daily(spark, sf):
    events = table(spark, sf, "events")
    return views.retention(events, "user_id", F.to_date("ts"), "day")


def new_register_monthly(spark, sf):
    events = table(spark, sf, "events").filter(F.col("event_type") == "signup")
    return views.new_registrations(events, "user_id", "ts")


def new_depositors(spark, sf):
    events = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return views.new_depositors(events, "user_id", "ts", "value", "event_id")


def new_depositor_txns(spark, sf):
    orders = _orders(spark, sf)
    return views.new_depositor_txns(orders, "o_custkey", "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


def deposit_summary(spark, sf):
    orders = _orders(spark, sf).withColumn("year", F.year("o_orderdate").cast("int"))
    return views.deposit_summary(orders, ["year", "o_orderstatus"], "o_totalprice")


def materialized_monthly_summary(spark, sf):
    from factkeeper.plans.table_store import VersionedTable
    from factkeeper.session import scratch_path
    store = VersionedTable(spark, scratch_path(spark, "views") + "/monthly_summary")
    store.refresh(lambda: monthly_summary(spark, sf))
    return store.read()


# ---------------------------------------------------------------- quality

def _lineitem_dedup(lineitem: DataFrame) -> DataFrame:
    rest = [c for c in lineitem.columns if c not in ("l_orderkey", "l_linenumber")]
    return update.latest_per_key(lineitem, ["l_orderkey", "l_linenumber"], rest)


def reconcile_counts(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    return quality.reconcile(lineitem, _lineitem_dedup(lineitem))


def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def breakdown_compare(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    return quality.compare_breakdowns(lineitem, _lineitem_dedup(lineitem), "l_shipdate",
                                      "l_returnflag")


# ---------------------------------------------------------------- functions

# Fixed values of the test: which text layout each order priority is written in.
_TEXT_LAYOUTS = {
    "1-URGENT": "yyyy-MM-dd",
    "2-HIGH": "yyyy/M/d",
    "3-MEDIUM": "d/M/yyyy",
    "4-NOT SPECIFIED": "MM/dd/yyyy HH:mm:ss",
}


def parse_dates_multi(spark, sf):
    orders = _orders(spark, sf)
    text = F.lit("n/a")
    for prio, fmt in reversed(list(_TEXT_LAYOUTS.items())):
        text = F.when(F.col("o_orderpriority") == prio, F.date_format("o_orderdate", fmt)).otherwise(text)
    df = orders.select("o_orderkey", text.alias("date_text"))
    return df.withColumn("parsed_date", parse_date_multi("date_text", EVENTS_AS_OF))


# ---------------------------------------------------------------- chain

def daily_chain(spark, sf):
    from factkeeper.plans.steps import daily_chain as chain
    out, _log = chain(_stg(spark, sf), EVENTS_AS_OF + timedelta(days=1), {"L4": "L9"})
    return out.select("unique_key", "line", "update_unique_code", "userkey", recency.LAST_ACTIVITY,
                      recency.LAST_DEPOSIT, recency.DAYS_INACTIVE)
