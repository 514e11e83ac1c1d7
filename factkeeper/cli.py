"""Command line for the maintenance jobs, exports and checks.

    spark-submit -m factkeeper.cli sync-recent --config sync.json --source ... --target ...

Tables are parquet paths (targets partitioned by their date column); the run
day is ``--as-of`` (default: today). Each command prints one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date, datetime

from factkeeper.functions.time_windows import (
    month_window, recent_days, two_days_back, yesterday_and_today, yesterday_today,
)
from factkeeper.operators import quality
from factkeeper.operators.rewrite import SERVING_MAPPING, SERVING_EXTRA, SyncSpec
from factkeeper.plans import jobs
from factkeeper.session import build_session, scratch_scope
from factkeeper.sinks import csv_export as E
from factkeeper.sources.tables import csv_row_count, read_table


def _day(text: str | None) -> date:
    return date.fromisoformat(text) if text else date.today()


def _spec(args) -> SyncSpec:
    cfg = json.load(open(args.config, encoding="utf-8")) if args.config else {}
    return SyncSpec.from_config(cfg)


def main(argv=None, spark=None) -> dict:
    p = argparse.ArgumentParser(prog="factkeeper")
    sub = p.add_subparsers(dest="cmd", required=True)

    def cmd(name, *opts):
        c = sub.add_parser(name)
        c.add_argument("--as-of")
        c.add_argument("--log")
        c.add_argument("--market", default="")
        c.add_argument("--format", default="parquet", help="of the tables read: parquet, orc, csv, table, ...")
        for o in opts:
            c.add_argument(o, required=o in ("--source", "--target", "--out", "--path", "--bands"))
        return c

    cmd("sync-recent", "--config", "--source", "--target")
    cmd("sync-today", "--config", "--source", "--target")
    cmd("sync-month", "--source", "--target", "--key", "--date-column", "--part-column", "--newest")
    cmd("copy-serving", "--source", "--target", "--days", "--with-extra")
    cmd("reload-year", "--source", "--target", "--date-column", "--year", "--part-column", "--grain")
    cmd("full-load", "--source", "--target", "--key", "--part-column", "--append")
    cmd("reconcile", "--source", "--target")
    cmd("duplicate-keys", "--source", "--key")
    cmd("kpi-report", "--source", "--out", "--tables")
    cmd("export-year", "--source", "--out", "--year-column", "--order", "--no-bom")
    cmd("export-month", "--source", "--out", "--date-column", "--month", "--name", "--order", "--no-bom")
    cmd("export-table", "--source", "--out", "--order", "--period-column", "--period", "--max-rows")
    cmd("count-csv", "--path", "--no-quoted-newlines")
    cmd("maintain", "--serving", "--root", "--bands", "--short-key", "--tier-stamp", "--squad-leads",
        "--customers", "--on-error", "--days")
    args = p.parse_args(argv)
    spark = spark or build_session()
    with scratch_scope(spark):
        out = _run(spark, args)
    print(json.dumps(out, default=str))
    return out


def _run(spark, args) -> dict:
    as_of = _day(args.as_of)
    run_ts = datetime.now()
    read = lambda name: read_table(spark, name, args.format)
    out: dict = {"command": args.cmd}

    if args.cmd in ("sync-recent", "sync-today"):
        spec = _spec(args)
        start, end = (recent_days(as_of, spec.days_back) if args.cmd == "sync-recent"
                      else yesterday_today(as_of))
        out["rows"] = jobs.sync_window_job(spark, read(args.source), args.target, spec, start, end,
                                           run_ts, log_path=args.log, market=args.market)
    elif args.cmd == "sync-month":
        start, end = month_window(as_of)
        newest = (args.newest or f"{args.date_column or 'txn_date'}").split(",")
        out["rows"] = jobs.upsert_month_job(
            spark, read(args.source), args.target, args.key or "unique_key",
            args.date_column or "txn_date", start, end, newest, run_ts,
            part_col=args.part_column or "txn_month", log_path=args.log, market=args.market)
    elif args.cmd == "copy-serving":
        days = (two_days_back(as_of) if (args.days or "two_days_back") == "two_days_back"
                else yesterday_and_today(as_of))
        mapping = SERVING_MAPPING + (SERVING_EXTRA if args.with_extra else [])
        out["rows"] = jobs.mapped_copy_job(spark, read(args.source), args.target, days, mapping,
                                           log_path=args.log, market=args.market)
    elif args.cmd == "reload-year":
        out["rows"] = jobs.year_reload_job(spark, read(args.source), args.target,
                                           args.date_column or "date", int(args.year),
                                           part_col=args.part_column, grain=args.grain or "day",
                                           log_path=args.log, market=args.market)
    elif args.cmd == "full-load":
        out |= jobs.full_load_job(spark, read(args.source), args.target, args.key or "unique_key",
                                  part_col=args.part_column, truncate=not args.append,
                                  log_path=args.log, market=args.market)
    elif args.cmd == "reconcile":
        out |= quality.reconcile(read(args.source), read(args.target)).first().asDict()
    elif args.cmd == "duplicate-keys":
        out["keys"] = quality.duplicate_keys(read(args.source), (args.key or "unique_key").split(",")).count()
    elif args.cmd == "kpi-report":
        from factkeeper.plans.maintenance import kpi_report_run
        tables = (dict(t.split("=", 1) for t in args.tables.split(",")) if args.tables
                  else {"source": args.source})
        out["rows"] = kpi_report_run(spark, tables, as_of, args.out, args.log)
        out["path"] = args.out
    elif args.cmd == "export-year":
        out["path"] = E.export_by_year(read(args.source), args.year_column or "year", args.out,
                                       order_cols=(args.order or "unique_key").split(","),
                                       bom=not args.no_bom)
    elif args.cmd == "export-month":
        out["path"] = E.export_month(read(args.source), args.date_column or "txn_date",
                                     args.month or f"{as_of:%Y-%m}", args.out, args.name or "export",
                                     order_cols=(args.order or "txn_date,unique_key").split(","),
                                     bom=not args.no_bom)
    elif args.cmd == "export-table":
        out["path"] = E.export_period(read(args.source), args.period_column, args.period, args.out,
                                      order_cols=(args.order or "unique_key").split(","),
                                      max_rows_per_file=int(args.max_rows or E.SHEET_ROW_LIMIT - 1))
    elif args.cmd == "count-csv":
        out["rows"] = csv_row_count(spark, args.path, quoted_newlines=not args.no_quoted_newlines).first()[0]
    elif args.cmd == "maintain":
        from factkeeper.plans.maintenance import Market, maintain_days, maintain_serving
        bands = [(name, float(lo), float(hi)) for name, lo, hi in json.loads(args.bands)]
        market = Market(args.market or "market", bands, short_key=bool(args.short_key),
                        customers=read(args.customers) if args.customers else None,
                        tier_stamp=bool(args.tier_stamp),
                        squad_leads=read(args.squad_leads) if args.squad_leads else None)
        how = args.on_error or "continue"
        if args.days:    # days of the serving table that have changed; the rest stays as it is
            log = maintain_days(spark, [_day(d) for d in args.days.split(",")], args.serving, args.root, market, on_error=how)
        else:
            _, log = maintain_serving(spark, read(args.serving), as_of, args.root, market, on_error=how)
        out["steps"] = {r.step_name: r.status for r in log.collect()}
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
