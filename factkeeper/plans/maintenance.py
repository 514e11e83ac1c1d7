"""The daily run: sync (A) → staging-to-serving copy (B) → serving
maintenance (C) → KPI report (E), and the maintenance chain itself in the
reference's step order (SURVEY §2.14).

The daily run works on changed days (``maintain_days``); ``maintain_serving`` computes the
whole table and all views anew, e.g. for a first load or after a change of the rules.
Each stored output is a ``VersionedTable`` under ``root``; the step log
records every step with its status, and with ``on_error='continue'`` a
failing view does not stop the others (the runner's behaviour), with
``'stop'`` the run ends at the first error (the strict chain's behaviour).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.functions.predicates import in_window
from factkeeper.functions.scalar import LINE_RECODES, recode
from factkeeper.functions.time_windows import h_minus_1, recent_days, two_days_back
from factkeeper.operators import kpi, rewrite, update, views
from factkeeper.plans import jobs
from factkeeper.plans.day_views import DayViews
from factkeeper.plans.serving_store import ServingStore
from factkeeper.plans.steps import STEP_LOG_SCHEMA, run_steps, serving_steps
from factkeeper.plans.table_store import VersionedTable, read_days
from factkeeper.session import scratch_scope
from factkeeper.sinks.csv_export import append_run_log, run_log_row, write_csv


@dataclass
class Market:
    """What differs between markets: names, tier bands, key form, optional steps."""

    name: str
    bands: list                           # (tier, low, high), lowest first; a market's own
    short_key: bool = False               # user key without the user name
    line_recodes: dict | None = None      # None → the fixed recodes
    squad_leads: DataFrame | None = None  # (line, lead) lookup; usc only
    tier_stamp: bool = False              # monthly tier onto the fact; usc only
    customers: DataFrame | None = None    # user_unique and attributes; for the customer view


def _tier_by_key(f: DataFrame, bands) -> DataFrame:
    """Tier of each (user key, line) from its total deposits (the tier-label view)."""
    return (f.groupBy("userkey", "line")
            .agg(kpi.money(f, "deposit_amount").cast("double").alias("amount"))
            .withColumn("tier_name", views.band(F.col("amount"), bands))
            .filter(F.col("tier_name").isNotNull()))


def _tier_stamp(f: DataFrame, bands, c: views.FactCols) -> DataFrame:
    return _stamp_tiers(f, views.tier_monthly(f, bands, c))


def _stamp_tiers(f: DataFrame, tiers: DataFrame) -> DataFrame:
    monthly = tiers.withColumnRenamed("month_start", "__ms")
    return update.update_from(
        f.withColumn("__ms", views.month_start("date")), monthly, ["user_unique", "__ms"],
        {"tier_name": "tier_name", "prev_tier_name": "prev_tier_name",
         "last_active_tier_before_current": F.lit(None).cast("string"),
         "movement_status": "movement_status"}, unique=True).drop("__ms")


def maintenance_updates(market: Market) -> list:
    """Column updates of pipeline C after the key/recency chain, in order:
    ``(name, fn)`` with ``fn(fact) -> fact``."""
    c = views.FactCols(cases="deposit_cases")
    bands = market.bands
    steps = []
    if market.squad_leads is not None:
        steps.append(("squad_lead", lambda f: update.conditional_update(
            f, market.squad_leads, "line", "squad_lead", "lead")))
    steps.append(("tier_label", lambda f: update.update_from(
        f, _tier_by_key(f, bands), ["userkey", "line"], {"tier_label": "tier_name"}, unique=True)))
    if market.tier_stamp:
        steps.append(("tier_stamp", lambda f: _tier_stamp(f, bands, c)))
    return steps


def maintenance_views(market: Market) -> list:
    """Views of pipeline C: ``(name, fn)`` with ``fn(serving, view) -> view``; ``view(name)``
    reads a view that is stored already.

    None of them reads a column the updates write, so they are built from
    the stored serving table after the updates (same rows as the reference's
    interleaved order)."""
    c = views.FactCols(cases="deposit_cases")
    bands = market.bands

    def deposits(f):
        return f.filter(F.coalesce(F.col("deposit_cases"), F.lit(0)) > 0)

    first_day = lambda f: "register_date" if "register_date" in f.columns else "date"
    chain = [] if market.customers is None else [
        ("customer_monthly", lambda f, view: views.customer_monthly(
            f, market.customers, "user_unique",
            [a for a in market.customers.columns if a != "user_unique"], c))]
    return chain + [
        ("monthly_summary", lambda f, view: views.monthly_summary(f, c)),
        ("line_summary", lambda f, view: views.line_summary(f, c)),
        ("daily_summary", lambda f, view: views.daily_summary(f, c)),
        ("quarter_summary", lambda f, view: views.quarter_summary(f, c)),
        ("tier_monthly", lambda f, view: views.tier_monthly(f, bands, c)),
        ("tier_summary", lambda f, view: views.tier_summary(view("tier_monthly"))),
        ("new_register_monthly", lambda f, view: views.new_registrations(f, "user_unique", first_day(f))),
        ("deposit_summary", lambda f, view: views.deposit_summary(deposits(f), ["line"], "deposit_amount")),
        ("retention_daily", lambda f, view: views.retention(f, "user_unique", F.col("date"), "day")),
        ("retention_monthly", lambda f, view: views.retention(f, "user_unique", views.month_start("date"),
                                                        "month")),
        ("new_depositors", lambda f, view: views.new_depositors(deposits(f), "user_unique", "date",
                                                          "deposit_amount", "uniquekey")),
        ("new_depositor_txns", lambda f, view: views.new_depositor_txns(deposits(f), "user_unique", "date")),
    ]


def _write_view(table: VersionedTable, frame: DataFrame) -> int:
    table.write(frame)
    table.prune(keep=2)   # the previous version stays for readers still on it
    return table.last_rows


def maintain_serving(spark: SparkSession, serving: DataFrame, as_of: date, root: str,
                     market: Market, on_error: str = "continue"):
    """Pipeline C on the serving table; returns (stored serving frame, step log).

    The key/recency chain and the column updates form one plan, which is
    written once as a new version of the serving table; every view is then
    built from that stored version (plain scans), so the chain's shuffles run
    once, not once per view, and the write cuts the lineage.
    """
    fact, log = run_steps(serving, serving_steps(as_of, market.line_recodes, market.short_key),
                          on_error)
    rows, stop = [], on_error == "stop" and log.filter(F.col("status") == "ERROR").count() > 0
    n = log.count()

    def run(name, fn):
        nonlocal n, stop
        n += 1
        started = datetime.now()
        try:
            written = fn()
            rows.append((n, name, "OK", "", written, started, datetime.now()))
        except Exception as e:  # noqa: BLE001 - logged like the reference's runner
            rows.append((n, name, "ERROR", str(e).splitlines()[0][:500], None, started,
                         datetime.now()))
            stop = on_error == "stop"

    def apply(fn):
        nonlocal fact
        out = fn(fact)
        out.schema  # analysis errors surface here
        fact = out

    store = VersionedTable(spark, f"{root}/{market.name}/serving")
    for name, fn in maintenance_updates(market):
        if not stop:
            run(name, lambda fn=fn: apply(fn))
    if not stop:
        run("serving", lambda: _write_view(store, fact))
    failed = any(r[1] == "serving" and r[2] == "ERROR" for r in rows)
    stored = store.read() if store.exists() else fact

    def view(name):
        return VersionedTable(spark, f"{root}/{market.name}/{name}")

    for name, fn in maintenance_views(market):
        if failed:   # the stored table is an older day's; views of it would be stale
            n += 1
            rows.append((n, name, "SKIPPED", "serving was not written", None, datetime.now(), datetime.now()))
        elif not stop:
            run(name, lambda name=name, fn=fn: _write_view(view(name), fn(stored, lambda v: view(v).read())))
    return stored, log.unionByName(spark.createDataFrame(rows, STEP_LOG_SCHEMA))


#: Views small enough (lines by periods, tiers by months) to be stored anew each day.
STORED_VIEWS = ["monthly_summary", "line_summary", "daily_summary", "quarter_summary", "deposit_summary", "tier_summary",
                "new_registrations", "retention_daily", "retention_monthly"]


def _stores(spark: SparkSession, serving_path: str, root: str, market: Market) -> tuple[ServingStore, DayViews]:
    recodes = LINE_RECODES if market.line_recodes is None else market.line_recodes
    register = "register_date" if "register_date" in read_days(spark, serving_path).columns else None
    return (ServingStore(spark, f"{root}/{market.name}/store", market.bands, market.line_recodes,
                         short_key=market.short_key, fact_path=serving_path),
            DayViews(spark, f"{root}/{market.name}/views", serving_path, market.bands,
                     prepare=lambda rows: rows.withColumn("line", recode("line", recodes)), register=register))


def maintain_days(spark: SparkSession, days, serving_path: str, root: str, market: Market, staging: DataFrame | None = None,
                  mapping=None, on_error: str = "continue", log_path: str | None = None) -> DataFrame:
    """Pipeline B and C by changed days; returns the step log.

    ``days`` of the serving table are replaced from ``staging`` (without it they have changed
    already), then the per-user stamps and the views take them over (``serving_store``,
    ``day_views``): the rest of the fact is neither read nor written. The first run takes over
    the whole table. Small views are stored as versions; the large ones, by user, are kept by
    month or day and read through ``DayViews``."""
    store, view = _stores(spark, serving_path, root, market)
    rows, stop = [], False

    def run(name, fn):
        nonlocal stop
        if stop:
            return
        started = datetime.now()
        try:
            rows.append((len(rows) + 1, name, "OK", "", fn(), started, datetime.now()))
        except Exception as e:  # noqa: BLE001 - logged like the reference's runner
            rows.append((len(rows) + 1, name, "ERROR", str(e).splitlines()[0][:500], None, started, datetime.now()))
            stop = on_error == "stop"

    def copy():
        return jobs.mapped_copy_job(spark, staging, serving_path, days, mapping, log_path=log_path, market=market.name)

    if not store.exists() or not view.exists():
        if staging is not None:
            run("serving", copy)
        run("stamps", store.adopt)
        run("view_days", view.build)
    else:
        view.announce(days)
        if staging is not None:
            run("serving", lambda: store.copy_days(staging, days, mapping, log_path=log_path, market=market.name))
        else:
            run("stamps", lambda: store.refresh(days))
        run("view_days", view.refresh)
    stale = any(status == "ERROR" for _, _, status, *_ in rows)
    for name in STORED_VIEWS:
        if stale:   # the days' tables hold older rows; views of them would be stale
            rows.append((len(rows) + 1, name, "SKIPPED", "the days were not taken over", None, datetime.now(), datetime.now()))
        else:
            run(name, lambda name=name: _write_view(VersionedTable(spark, f"{root}/{market.name}/{name}"), getattr(view, name)()))
    return spark.createDataFrame(rows, STEP_LOG_SCHEMA)


def serving_rows(spark: SparkSession, serving_path: str, root: str, market: Market, as_of: date) -> DataFrame:
    """The serving table with everything the chain stamps on it, as of a day."""
    store, view = _stores(spark, serving_path, root, market)
    out = store.read(as_of)
    if market.squad_leads is not None:
        out = update.conditional_update(out, market.squad_leads, "line", "squad_lead", "lead")
    return _stamp_tiers(out, view.tier_monthly()) if market.tier_stamp else out


def daily_run(spark: SparkSession, source: DataFrame, staging_path: str, serving_path: str,
              root: str, as_of: date, spec: rewrite.SyncSpec, market: Market,
              run_ts: datetime | None = None, report_path: str | None = None,
              report_tables: dict | None = None, log_path: str | None = None):
    """A → B → C → E for one market; returns the maintenance step log.

    A: the last ``spec.days_back`` days of the staging table are replaced
    from the source; B and C: ``maintain_days`` with the serving table's two days before
    ``as_of`` (the mapping also carries ``user_unique``, which the chain keys on), read by
    ``serving_rows``; E: the KPI report of H-1 over ``report_tables`` (name → staging path of
    each market, in report order; default: this market's). With ``log_path`` every part
    appends its run-log row.
    """
    with scratch_scope(spark):   # every output is written when it ends
        return _daily_run(spark, source, staging_path, serving_path, root, as_of, spec, market,
                          run_ts, report_path, report_tables, log_path)


def _daily_run(spark, source, staging_path, serving_path, root, as_of, spec, market, run_ts,
               report_path, report_tables, log_path):
    run_ts = run_ts or datetime.now()
    start, end = recent_days(as_of, spec.days_back)
    jobs.sync_window_job(spark, source, staging_path, spec, start, end, run_ts,
                         log_path=log_path, market=market.name)
    mapping = rewrite.SERVING_MAPPING + [("user_unique", "user_unique")]
    started = datetime.now()
    log = maintain_days(spark, two_days_back(as_of), serving_path, root, market, read_days(spark, staging_path), mapping,
                        log_path=log_path)
    if log_path:
        bad = log.filter("status <> 'OK'").count()
        rows = log.agg(F.sum("rowcount")).first()[0] or 0
        append_run_log(run_log_row(spark, market.name, serving_path, root, f"{as_of}", rows, started, datetime.now(),
                                   "ERROR" if bad else "OK", f"{bad} steps failed" if bad else ""), log_path)
    if report_path:
        kpi_report_run(spark, report_tables or {market.name: staging_path}, as_of, report_path, log_path)
    return log


def kpi_report_run(spark: SparkSession, tables: dict, as_of: date, report_path: str,
                   log_path: str | None = None) -> int:
    """The KPI report of the day before ``as_of`` over all markets' tables, as one
    file, with a run-log row that keeps when it started and finished; returns its rows."""
    started = datetime.now()
    lo, hi = h_minus_1(as_of)
    frames = {name: read_days(spark, path) for name, path in tables.items()}
    report = kpi.kpi_report(kpi.kpi_union({n: f.filter(in_window(f, "txn_date", lo, hi)) for n, f in frames.items()}))
    write_csv(report.drop("market_order"), report_path, parts=1)
    rows = report.count()
    if log_path:
        append_run_log(run_log_row(spark, ",".join(tables), "staging", report_path, f"{lo} .. {hi}", rows,
                                   started, datetime.now(), "OK"), log_path)
    return rows


__all__ = ["Market", "STORED_VIEWS", "maintenance_updates", "maintenance_views", "maintain_serving", "maintain_days",
           "serving_rows", "daily_run", "kpi_report_run"]
