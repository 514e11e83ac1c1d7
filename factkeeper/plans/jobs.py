"""The maintenance jobs against stored, period-partitioned tables.

The operators in ``factkeeper.operators`` return the whole new table; these
jobs write only what changed. A target is a parquet table, given by its path or its name
in the catalog, partitioned by a DATE column holding the start of each row's period
(``grain`` 'day' or 'month'), so each job reads and writes only the partitions it touches:

* ``sync_window_job``   W1 / W2 — the periods overlapping the window
* ``mapped_copy_job``   W4 / W5 — the periods of the day set
* ``upsert_month_job``  W3      — the window's periods plus the periods a key moved from
* ``year_reload_job``   W7      — the year's periods

Rows of a touched period that the operation keeps are read from the target
(partition-pruned) and written with the new ones by Spark's dynamic partition
overwrite; when the periods are days that the window covers completely nothing is
read. Each job returns the rows written (counted while writing) and appends a
run-log row when ``log_path`` is given.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.functions.predicates import in_window, on_dates, typed_lit
from factkeeper.functions.time_windows import days_in, first_of_next_month, year_window
from factkeeper.operators import quality, rewrite
from factkeeper.operators.update import key_side, latest_per_key
from factkeeper.plans.table_store import add_column, periods_with, read_days, replace_days
from factkeeper.sinks.csv_export import append_run_log, run_log_row, write_counted


def period_of(col: str, grain: str) -> Column:
    """Start of the row's period, as DATE."""
    if grain == "day":
        return F.to_date(F.col(col))
    return F.trunc(F.col(col), "month").cast("date")


def periods_between(start: date, end: date, grain: str) -> list[date]:
    """Periods overlapping ``[start, end)``."""
    if grain == "day":
        return days_in(start, end)
    out, m = [], start.replace(day=1)
    while m < end:
        out.append(m)
        m = first_of_next_month(m)
    return out


def _with_stamp(spark: SparkSession, path: str, part_col: str, run_ts: datetime,
                stamp_type: str = "timestamp") -> DataFrame:
    """P12 / P13 on a stored target: rows without a sync stamp get ``run_ts``, once.

    Where the table lacks the column it is added with that value for the rows so far, and no
    file is written; where rows hold a NULL their partitions are."""
    target = read_days(spark, path)
    if rewrite.SYNC_STAMP not in target.columns:
        zone = "" if stamp_type == "timestamp_ntz" else f" {spark.conf.get('spark.sql.session.timeZone')}"
        add_column(spark, path, rewrite.SYNC_STAMP, stamp_type, f"{stamp_type.upper()} '{run_ts.isoformat(sep=' ')}{zone}'")
        return read_days(spark, path)
    missing = target.filter(F.col(rewrite.SYNC_STAMP).isNull())
    if missing.isEmpty():
        return target
    dtype = target.schema[rewrite.SYNC_STAMP].dataType
    stamped = target.withColumn(rewrite.SYNC_STAMP, F.coalesce(rewrite.SYNC_STAMP, typed_lit(run_ts, dtype)))
    days = [r[0] for r in missing.select(part_col).distinct().collect()]   # periods
    old = F.col(part_col).isin([d for d in days if d is not None])
    if None in days:
        old = old | F.col(part_col).isNull()
    replace_days(stamped.filter(old).select(*target.columns), path, part_col, days)
    return read_days(spark, path)


def _stamped(rows: DataFrame, target: DataFrame, run_ts: datetime) -> DataFrame:
    return rows.withColumn(rewrite.SYNC_STAMP, typed_lit(run_ts, target.schema[rewrite.SYNC_STAMP].dataType))


def _rewrite(target: DataFrame, path: str, part_col: str, periods, new_rows: DataFrame,
             keep=None) -> int:
    """Replace ``periods`` by ``keep(rows of those periods) ∪ new_rows``; None among them
    stands for the rows without a period.

    ``keep=None`` means nothing of those periods survives (no read)."""
    rows = rewrite.as_target(target, new_rows)
    if keep is not None:
        known = [p for p in periods if p is not None]
        old = F.col(part_col).isin(known)
        if len(known) < len(periods):
            old = old | F.col(part_col).isNull()
        rows = keep(target.filter(old)).select(*target.columns).unionByName(rows)
    return replace_days(rows, path, part_col, periods)


def _log(spark, log_path, market, source, target, periods, rows, started, status="OK", message=""):
    if log_path:
        known = [p for p in periods if p is not None]
        label = f"{min(known)} .. {max(known)}" if known else ""
        append_run_log(run_log_row(spark, market, source, target, label, rows, started,
                                   datetime.now(), status, message), log_path)


def sync_window_job(spark: SparkSession, source: DataFrame, target_path: str,
                    spec: rewrite.SyncSpec, start: date, end: date, run_ts: datetime,
                    part_col: str | None = None, grain: str = "day",
                    log_path: str | None = None, market: str = "",
                    stamp_type: str = "timestamp") -> int:
    """W1 / W2 on a stored target (partition column defaults to the date column)."""
    started = datetime.now()
    if spec.auto_values and rewrite.auto_value_list(source, spec, start, end).isEmpty():
        return 0   # no value in the window: the reference stops before deleting
    part_col = part_col or spec.date_column
    target = _with_stamp(spark, target_path, part_col, run_ts, stamp_type)
    new_rows = _stamped(rewrite.sync_rows(source, spec, start, end), target, run_ts)
    if part_col != spec.date_column:
        new_rows = new_rows.withColumn(part_col, period_of(spec.date_column, grain))
    periods = periods_between(start, end, grain)
    whole = grain == "day"   # day partitions inside the window are replaced whole
    keep = None if whole else (lambda old: rewrite.delete_where(
        old, in_window(old, spec.date_column, start, end)))
    n = _rewrite(target, target_path, part_col, periods, new_rows, keep)
    _log(spark, log_path, market, "source", target_path, periods, n, started)
    return n


def mapped_copy_job(spark: SparkSession, source: DataFrame, target_path: str, days,
                    mapping=None, date_column: str = "date", part_col: str | None = None,
                    grain: str = "day", log_path: str | None = None, market: str = "") -> int:
    """The day set of the serving table is replaced by the mapped copy."""
    started = datetime.now()
    mapping = list(mapping or rewrite.SERVING_MAPPING)
    tgt_date = dict(mapping).get(date_column, date_column)
    part_col = part_col or tgt_date
    target = read_days(spark, target_path)
    new_rows = rewrite.mapped_rows(source, days, mapping, date_column)
    if part_col != tgt_date:
        new_rows = new_rows.withColumn(part_col, period_of(tgt_date, grain))
    periods = sorted({d if grain == "day" else d.replace(day=1) for d in days})
    keep = None if grain == "day" else (lambda old: rewrite.delete_where(
        old, on_dates(old, tgt_date, days)))
    n = _rewrite(target, target_path, part_col, periods, new_rows, keep)
    _log(spark, log_path, market, "staging", target_path, periods, n, started)
    return n


def upsert_month_job(spark: SparkSession, source: DataFrame, target_path: str, key: str,
                     date_column: str, start: date, end: date, newest, run_ts: datetime,
                     part_col: str, grain: str = "month", log_path: str | None = None,
                     market: str = "", stamp_type: str = "timestamp") -> int:
    """The window is replaced by the de-duplicated source rows, and every
    other period holding one of their keys loses that row (the key moved).

    The moved-from periods are those whose key digest holds a hash of a source key
    (``table_store.periods_with``): no other period's key column is read. The rows without
    a date are a period of their own, from which keys move like from any other. The
    de-duplicated source is stored once for the search, the anti join and the insert.
    """
    started = datetime.now()
    target = _with_stamp(spark, target_path, part_col, run_ts, stamp_type)
    src = key_side(latest_per_key(source.filter(in_window(source, date_column, start, end)), [key], newest,
                                  keep_null_keys=True))
    src = _stamped(src, target, run_ts)
    if part_col not in src.columns:
        src = src.withColumn(part_col, period_of(date_column, grain))
    src_keys = src.select(key).filter(F.col(key).isNotNull())
    moved = periods_with(spark, target_path, key, part_col, src_keys)
    periods = sorted(set(periods_between(start, end, grain)) | set(moved), key=lambda p: (p is not None, p))

    def keep(old):
        outside = rewrite.delete_where(old, in_window(old, date_column, start, end))
        return outside.join(src_keys, on=key, how="left_anti")

    n = _rewrite(target, target_path, part_col, periods, src, keep)
    _log(spark, log_path, market, "source", target_path, periods, n, started)
    return n


def year_reload_job(spark: SparkSession, source: DataFrame, target_path: str, date_column: str,
                    year: int, part_col: str | None = None, grain: str = "day",
                    log_path: str | None = None, market: str = "") -> int:
    """The periods of ``year`` are replaced by the source's rows of the year."""
    started = datetime.now()
    lo, hi = year_window(year)
    part_col = part_col or date_column
    target = read_days(spark, target_path)
    rows = source.filter(in_window(source, date_column, lo, hi))
    if part_col not in rows.columns:
        rows = rows.withColumn(part_col, period_of(date_column, grain))
    periods = periods_between(lo, hi, grain)
    n = _rewrite(target, target_path, part_col, periods, rows, keep=None)
    _log(spark, log_path, market, "source", target_path, periods, n, started)
    return n


def full_load_job(spark: SparkSession, source: DataFrame, target_path: str, key: str,
                  part_col: str | None = None, truncate: bool = True,
                  log_path: str | None = None, market: str = "") -> dict:
    """W6 with its checks: load (or append) the whole source, then compare the counts (Q1)
    and look for repeated keys (Q2). Returns ``rows, source_rows, target_rows,
    duplicate_keys``; the run-log row says ERROR when a check fails."""
    started = datetime.now()
    n = write_counted(source, target_path, mode="overwrite" if truncate else "append",
                      partition_by=[part_col] if part_col else ())
    target = spark.read.parquet(target_path)
    counts = quality.reconcile(source, target).first()
    repeated = quality.duplicate_keys(target, [key]).count()
    ok = repeated == 0 and (not truncate or counts["difference"] == 0)
    _log(spark, log_path, market, "source", target_path, [], n, started, "OK" if ok else "ERROR",
         "" if ok else f"source {counts['source_rows']}, target {counts['target_rows']}, repeated keys {repeated}")
    return {"rows": n, "source_rows": counts["source_rows"], "target_rows": counts["target_rows"],
            "duplicate_keys": repeated}


__all__ = ["sync_window_job", "mapped_copy_job", "upsert_month_job", "year_reload_job", "full_load_job",
           "period_of", "periods_between"]
