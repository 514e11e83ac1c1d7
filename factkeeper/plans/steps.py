"""Ordered maintenance steps with a step log (Q5, E10, §2.14 order).

A step is a named ``DataFrame -> DataFrame`` function. Steps only extend the
logical plan; Catalyst fuses consecutive column derivations, so running the
chain costs the shuffles of its keyed steps (latest code by user, recency
by user key), not one job per step. The log records each step's outcome;
with ``on_error='continue'`` a failing step is logged and skipped, with
``'stop'`` the chain ends there.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from factkeeper.functions.scalar import LINE_RECODES, recode, strict_concat
from factkeeper.operators import recency, rewrite, update

STEP_LOG_SCHEMA = T.StructType([
    T.StructField("step_num", T.IntegerType()),
    T.StructField("step_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("rowcount", T.LongType()),
    T.StructField("started", T.TimestampNTZType()),
    T.StructField("finished", T.TimestampNTZType()),
])


@dataclass
class Step:
    name: str
    fn: object


def run_steps(df: DataFrame, steps, on_error: str = "continue"):
    """Apply ``steps`` in order; returns (frame, step-log frame).

    Steps are validated when applied (analysis errors such as a missing
    column surface here); data is processed once, by the caller's action.
    """
    log = []
    for i, step in enumerate(steps, start=1):
        started = datetime.now()
        try:
            out = step.fn(df)
            out.schema  # analysis happens here
            df = out
            log.append((i, step.name, "OK", "", None, started, datetime.now()))
        except Exception as e:  # noqa: BLE001 - every failure is logged
            log.append((i, step.name, "ERROR", str(e).splitlines()[0][:500], None, started,
                        datetime.now()))
            if on_error == "stop":
                break
    return df, df.sparkSession.createDataFrame(log, STEP_LOG_SCHEMA)


def serving_steps(as_of: date, line_recodes: dict | None = None, short_key: bool = False,
                  name_col: str = "user_name", tiebreak: str = "uniquekey"):
    """The serving-table chain: recode lines → latest unique code per user →
    user key → recency per user key. Column names default to the serving
    table's; ``tiebreak`` orders rows of the same day (the row address in
    the reference, a unique key here)."""
    recodes = LINE_RECODES if line_recodes is None else line_recodes
    key_parts = ("update_unique_code", "line") if short_key else (name_col, "update_unique_code", "line")
    return [
        Step("recode_lines", lambda d: d.withColumn("line", recode("line", recodes))),
        Step("latest_unique_code", lambda d: update.spread_latest(
            d, "user_unique", "unique_code", "update_unique_code",
            newest=["date", tiebreak], nulls_first=["date"])),
        Step("user_key", lambda d: rewrite.set_column(d, "userkey", strict_concat(*key_parts))),
        Step("recency", lambda d: recency.recency(d, "userkey", as_of)),
    ]


def daily_chain(stg: DataFrame, as_of: date, line_recodes: dict | None = None,
                on_error: str = "stop"):
    """All of the serving chain on a staging-shaped frame."""
    return run_steps(stg, serving_steps(as_of, line_recodes, name_col="username",
                                        tiebreak="unique_key"), on_error)


__all__ = ["Step", "run_steps", "serving_steps", "daily_chain", "STEP_LOG_SCHEMA"]
