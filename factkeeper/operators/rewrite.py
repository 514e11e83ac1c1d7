"""Table rewrites (W1-W10, J7, J8, P13): ``new_target = op(target, source, ...)``.

Each operator is a pure DataFrame function; writing the result is the job of
``factkeeper.sinks``. The windowed forms only change rows inside their
window, so on a date-partitioned table the writer rewrites just those days
(``plans.table_store.replace_days``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.functions.predicates import (
    ACTIVITY_COLUMNS, in_values, in_window, is_active, not_true, on_dates, typed_lit, year_is,
)
from factkeeper.functions.scalar import blank_if_null
from factkeeper.functions.time_windows import recent_days, yesterday_today
from factkeeper.operators.update import latest_per_key
from factkeeper.sources.tables import ensure_column, require_columns

SYNC_STAMP = "last_synced_at"

# Staging column → serving column, in the copy's order.
SERVING_MAPPING = [
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
# The four extra columns copied by the wider variant.
SERVING_EXTRA = [
    ("traffic", "traffic"),
    ("register_date", "register_date"),
    ("first_deposit_date", "first_deposit_date"),
    ("first_deposit_amount", "first_deposit_amount"),
]
# Source columns written as '' when NULL.
BLANK_WHEN_NULL = {"operator_username"}


@dataclass
class SyncSpec:
    """Parameters of a windowed sync (one per market/table pair)."""

    date_column: str = "txn_date"
    filter_column: str = "agent_code"
    mode: str = "specific"            # 'all' or 'specific'
    values: list = field(default_factory=list)
    days_back: int = 3
    order_column: str = "unique_key"
    activity_columns: list = field(default_factory=lambda: list(ACTIVITY_COLUMNS))

    def __post_init__(self):
        self.mode = self.mode.lower()
        if self.mode not in ("all", "specific"):
            raise ValueError("mode must be 'all' or 'specific'")
        if self.mode == "all":
            self.values = []

    @classmethod
    def from_config(cls, cfg: dict) -> "SyncSpec":
        """From a per-market sync config (keys ``date_column``, ``filter_column``,
        ``line_filter_mode``, ``line_values``, ``days_back``, ``order_column``);
        batch sizes and connection settings have no meaning here."""
        return cls(date_column=cfg.get("date_column", "txn_date"),
                   filter_column=cfg.get("filter_column", "agent_code"),
                   mode=cfg.get("line_filter_mode", "specific"),
                   values=list(cfg.get("line_values", [])),
                   days_back=int(cfg.get("days_back", 3)),
                   order_column=cfg.get("order_column", "unique_key"))

    @property
    def auto_values(self) -> bool:
        """'all', or 'specific' with an empty list: values come from the data."""
        return not self.values


def delete_where(df: DataFrame, pred) -> DataFrame:
    """``DELETE WHERE pred`` — rows where ``pred`` is NULL stay."""
    return df.filter(not_true(pred))


def auto_value_list(source: DataFrame, spec: SyncSpec, start, end) -> DataFrame:
    """Distinct non-NULL filter values of the source in the window."""
    c = spec.filter_column
    return (source.filter(in_window(source, spec.date_column, start, end) & F.col(c).isNotNull())
            .select(c).distinct())


def sync_rows(source: DataFrame, spec: SyncSpec, start, end) -> DataFrame:
    """The rows a windowed sync inserts: window ∧ value list ∧ activity.

    With an automatic value list the list is "every non-NULL value in the
    window", i.e. just ``filter_column IS NOT NULL`` — no list is collected.
    """
    require_columns(source, [spec.date_column, spec.filter_column, *spec.activity_columns], "source")
    pred = in_window(source, spec.date_column, start, end)
    if spec.auto_values:
        pred = pred & F.col(spec.filter_column).isNotNull()
    else:
        pred = pred & in_values(spec.filter_column, spec.values)
    return source.filter(pred & is_active(spec.activity_columns))


def _stamp(df: DataFrame, run_ts, stamp_type: str) -> DataFrame:
    return df.withColumn(SYNC_STAMP, typed_lit(run_ts, stamp_type))


def _align(target: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Append ``new_rows`` as an INSERT would: cast to the target's column
    types, target-only columns NULL; a source column the target lacks is an
    error (ANSI casts raise on values that do not fit, like the database)."""
    return target.unionByName(as_target(target, new_rows))


def as_target(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` in the target's columns and types (missing columns NULL)."""
    extra = [c for c in rows.columns if c not in target.columns]
    if extra:
        raise ValueError(f"target has no column(s): {', '.join(extra)}")
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None))
                         .cast(f.dataType).alias(f.name) for f in target.schema.fields])


def window_replace(target: DataFrame, source: DataFrame, spec: SyncSpec, start, end,
                   run_ts: datetime, stamp_type: str = "timestamp") -> DataFrame:
    """Delete every target row in ``[start, end)`` and insert the
    source rows passing window ∧ values ∧ activity, stamped with ``run_ts``.

    The delete is not limited to the value list. With an automatic value
    list and no value in the window the target is returned unchanged (the
    reference stops before deleting); that check is a one-row job.
    ``stamp_type`` is ``timestamp`` (with zone) or ``timestamp_ntz``.
    """
    target = ensure_column(target, SYNC_STAMP, stamp_type, typed_lit(run_ts, stamp_type))
    if spec.auto_values and auto_value_list(source, spec, start, end).isEmpty():
        return target
    kept = delete_where(target, in_window(target, spec.date_column, start, end))
    new_rows = _stamp(sync_rows(source, spec, start, end), run_ts, stamp_type)
    return _align(kept, new_rows)


def replace_recent_days(target, source, spec: SyncSpec, as_of: date, run_ts,
                        stamp_type: str = "timestamp") -> DataFrame:
    """window = last ``spec.days_back`` days before ``as_of``."""
    start, end = recent_days(as_of, spec.days_back)
    return window_replace(target, source, spec, start, end, run_ts, stamp_type)


def replace_yesterday_today(target, source, spec: SyncSpec, as_of: date, run_ts,
                            stamp_type: str = "timestamp") -> DataFrame:
    """window = yesterday and today (``days_back`` is ignored)."""
    start, end = yesterday_today(as_of)
    return window_replace(target, source, spec, start, end, run_ts, stamp_type)


def keys_hit_days(target: DataFrame, keys: DataFrame, key: str, date_column: str) -> list:
    """Days of ``target`` holding any of ``keys``; None stands for the rows without one.

    Only the (key, day) projection of the target is joined, never whole
    rows; the result is bounded by the number of days the table spans.
    """
    day = F.to_date(F.col(date_column)).alias("__day")
    hits = target.select(key, day).join(keys, on=key, how="left_semi")
    return sorted((r[0] for r in hits.select("__day").distinct().collect()), key=lambda d: (d is not None, d))


def upsert_window(target: DataFrame, source: DataFrame, key: str, date_column: str,
                  start, end, newest, run_ts: datetime, nulls_first=(),
                  stamp_type: str = "timestamp", prune_days: bool = True) -> DataFrame:
    """Delete the target's window, then insert the source's window
    rows with ``ON CONFLICT (key) DO UPDATE`` (all columns).

    A key that lives outside the window in the target is overwritten, i.e.
    moved. Source rows sharing a key collapse to the newest by ``newest``
    (the reference's pick among them is arbitrary). NULL keys never conflict:
    all such rows are inserted and kept.

    With ``prune_days`` the conflict search first finds the days whose rows
    hold a source key (``keys_hit_days``); only those days' rows go through
    the anti join, all other days pass through without a shuffle — and are
    the days a date-partitioned writer has to rewrite besides the window.
    """
    target = ensure_column(target, SYNC_STAMP, stamp_type, typed_lit(run_ts, stamp_type))
    src = source.filter(in_window(source, date_column, start, end))
    src = latest_per_key(src, [key], newest, nulls_first, keep_null_keys=True)
    src = _stamp(src, run_ts, stamp_type)
    src_keys = src.select(key).filter(F.col(key).isNotNull())
    kept = delete_where(target, in_window(target, date_column, start, end))
    if prune_days:
        days = keys_hit_days(kept, src_keys, key, date_column)
        if not days:
            return _align(kept, src)
        known = [d for d in days if d is not None]
        hit = on_dates(kept, date_column, known) if known else F.lit(False)
        if len(known) < len(days):
            hit = F.col(date_column).isNull() | F.coalesce(hit, F.lit(False))
        untouched = delete_where(kept, hit)
        touched = kept.filter(hit).join(src_keys, on=key, how="left_anti")
        kept = untouched.unionByName(touched)
    else:
        kept = kept.join(src_keys, on=key, how="left_anti")
    return _align(kept, src)


def mapped_replace(target: DataFrame, source: DataFrame, days, mapping=None,
                   date_column: str = "date", blank_cols=BLANK_WHEN_NULL) -> DataFrame:
    """Delete the target rows of ``days`` and copy the source rows of
    those days through the rename ``mapping`` (P8), with ''-for-NULL on
    ``blank_cols`` (P9). Target columns outside the mapping become NULL.

    Zero source rows still deletes: the days end up empty.
    """
    mapping = list(mapping or SERVING_MAPPING)
    projected = mapped_rows(source, days, mapping, date_column, blank_cols)
    tgt_date = dict(mapping).get(date_column, date_column)
    kept = delete_where(target, on_dates(target, tgt_date, days))
    return _align(kept, projected)


def mapped_rows(source: DataFrame, days, mapping=None, date_column: str = "date",
                blank_cols=BLANK_WHEN_NULL) -> DataFrame:
    """The rows W4/W5 insert: the source's rows of ``days`` through ``mapping``."""
    mapping = list(mapping or SERVING_MAPPING)
    require_columns(source, [s for s, _ in mapping], "source")
    return source.filter(on_dates(source, date_column, days)).select(
        *[(blank_if_null(s) if s in blank_cols else F.col(s)).alias(t) for s, t in mapping])


def full_load(target: DataFrame, source: DataFrame, truncate: bool) -> DataFrame:
    """Truncate-and-load, or append to what is there."""
    if truncate:
        return as_target(target, source)
    return _align(target, source)


def year_reload(target: DataFrame, source: DataFrame, date_column: str, year: int,
                delete_first: bool = True) -> DataFrame:
    """(optionally) delete the year from the target, append the source's year."""
    kept = delete_where(target, year_is(target, date_column, year)) if delete_first else target
    return _align(kept, source.filter(year_is(source, date_column, year)))


def set_column(df: DataFrame, col: str, expr) -> DataFrame:
    """``UPDATE t SET col = expr`` on every row."""
    return df.withColumn(col, expr)
