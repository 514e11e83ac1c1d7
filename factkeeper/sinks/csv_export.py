"""CSV exports (E1-E8) and the run log.

Each export is one Spark job writing part files in parallel; nothing is
pulled to the driver. Row order inside a slice follows the reference's
``ORDER BY`` through a range partitioning plus a per-task sort, so the parts,
read in name order, are in key order.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factkeeper.functions.predicates import in_window, year_of
from factkeeper.functions.scalar import as_text
from factkeeper.functions.time_windows import month_of
from factkeeper.operators.update import key_side

BOM = "﻿"
# Fixed value: the spreadsheet row limit; a part holds at most this many data rows.
SHEET_ROW_LIMIT = 1_048_576


def _writer(df: DataFrame, header: bool):
    return (df.write.mode("overwrite").option("header", header)
            .option("nullValue", "").option("emptyValue", "")
            .option("encoding", "UTF-8").option("escape", '"'))


def with_bom(df: DataFrame, skip=()) -> DataFrame:
    """The file starts with a UTF-8 BOM — the first written column's
    header name is prefixed with ``\\ufeff``."""
    first = next(c for c in df.columns if c not in skip)
    return df.withColumnRenamed(first, BOM + first)


def _ordered(df: DataFrame, order_cols, parts: int | None, lead=()) -> DataFrame:
    """Range-partition on the order columns, sort each part.

    Without ``parts`` the count is ``spark.sql.shuffle.partitions`` and AQE
    coalesces small ranges, so part files track the data size rather than
    the core count; the range bounds come from a sample, so a hot year or
    key is split over several parts instead of landing in one task.
    """
    cols = [*lead, *order_cols]
    if not cols:   # neighbouring partitions are merged, so a sorted frame stays sorted
        return df.coalesce(parts) if parts else df
    ranged = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def filled_parts(df: DataFrame, order_cols, limit: int) -> DataFrame:
    """``df`` in parts of exactly ``limit`` rows, the last one of what is left: partition ``k``
    holds the rows ``k * limit`` to ``(k + 1) * limit`` of the order.

    The sorted ranges are stored with each row's place in its range. Their counts, one for each
    range, give the ranges' first places, so no task sees more than a range or a part."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = key_side(_ordered(df, list(order_cols), None).withColumn("__range", F.spark_partition_id()).withColumn("__place", place))
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).orderBy("__range").collect()
    firsts, total = [], 0
    for r in counts:
        firsts.append((r["__range"], total))
        total += r["n"]
    if not total:
        return df.limit(0).coalesce(1)
    starts = F.broadcast(df.sparkSession.createDataFrame(firsts, "__range int, __first long"))   # a row for each range
    placed = ranged.join(starts, "__range").withColumn("__row", F.col("__first") + F.col("__place"))
    return placed.repartitionById(-(-total // limit), F.expr(f"cast(__row div {limit} as int)")).sortWithinPartitions("__row").select(*df.columns)


def write_csv(df: DataFrame, path: str, order_cols=(), bom: bool = False, header: bool = True,
              max_rows_per_file: int | None = None, parts: int | None = None,
              write_if_empty: bool = True) -> str | None:
    """The whole table as CSV, ordered by ``order_cols``; with
    ``write_if_empty=False`` an empty table writes nothing (returns None). With
    ``max_rows_per_file`` every file but the last holds exactly that many rows (E6)."""
    if not write_if_empty and df.isEmpty():
        return None
    out = filled_parts(df, order_cols, max_rows_per_file) if max_rows_per_file else _ordered(df, list(order_cols), parts)
    if bom:
        out = with_bom(out)
    _writer(out, header).csv(path)
    return path


def export_by_year(df: DataFrame, year_col: str, path: str, order_cols=(), bom: bool = True,
                   parts: int | None = None) -> str:
    """One folder per year (``_year=YYYY``); rows whose year is
    NULL are left out. The year comes from a date, a timestamp, a number or
    a text column. All years are written by one job, and a big year is
    split over many tasks by the range partitioning on (year, key).
    """
    keyed = df.withColumn("_year", year_of(df, year_col)).filter(F.col("_year").isNotNull())
    out = _ordered(keyed, list(order_cols), parts, lead=["_year"])
    if bom:
        out = with_bom(out, skip=("_year",))
    _writer(out, True).partitionBy("_year").csv(path)
    return path


def export_month(df: DataFrame, date_col: str, month: str, base: str, name: str,
                 order_cols=(), bom: bool = True, parts: int | None = None,
                 write_if_empty: bool = True) -> str | None:
    """Rows of month ``YYYY-MM`` to ``<base>/<name>_<YYYYMM>``.

    An empty month gives a header-only file, or — ``write_if_empty=False``,
    the other export variant — no file at all (``None`` is returned).
    """
    start, end = month_of(month)
    path = f"{base}/{name}_{start:%Y%m}"
    rows = df.filter(in_window(df, date_col, start, end))
    return write_csv(rows, path, order_cols, bom, parts=parts, write_if_empty=write_if_empty)


def period_values(df: DataFrame, period_col: str) -> DataFrame:
    """Distinct non-NULL periods, newest first."""
    return (df.select(F.col(period_col).alias("period")).filter(F.col("period").isNotNull())
            .distinct().orderBy(F.col("period").desc()))


def period_filter(df: DataFrame, period_col: str | None, value=None) -> DataFrame:
    """Rows of one period; all rows when the column is missing, no value
    is given, or the value is not one of the column's periods."""
    if not period_col or period_col not in df.columns or value in (None, ""):
        return df
    c = F.col(period_col)
    t = df.schema[period_col].dataType
    lit = F.lit(str(value)).try_cast(t) if not isinstance(t, T.StringType) else F.lit(str(value))
    picked = df.filter(c == lit)
    # A value that is not one of the periods is an invalid choice → all rows
    # (a one-row probe job, not a count).
    return df if picked.isEmpty() else picked


def export_period(df: DataFrame, period_col: str | None, value, path: str, order_cols=(),
                  bom: bool = True, max_rows_per_file: int | None = SHEET_ROW_LIMIT - 1,
                  write_if_empty: bool = True) -> str | None:
    """Period slice, in parts that fit a spreadsheet (header + data)."""
    return write_csv(period_filter(df, period_col, value), path, order_cols, bom,
                     max_rows_per_file=max_rows_per_file, write_if_empty=write_if_empty)


def share_ready(df: DataFrame, drop_cols=()) -> DataFrame:
    """Drop identifier columns (absent ones ignored) and turn
    every value into text with '' for NULL."""
    kept = df.drop(*drop_cols)
    return kept.select(*[as_text(c).alias(c) for c in kept.columns])


def share_export(df: DataFrame, path: str, drop_cols=(), order_cols=(),
                 max_rows_per_file: int | None = SHEET_ROW_LIMIT - 1) -> str:
    """Replace the shared copy with the share-ready table."""
    ordered = filled_parts(df, order_cols, max_rows_per_file) if max_rows_per_file else _ordered(df, list(order_cols), None)
    _writer(share_ready(ordered, drop_cols), True).csv(path)
    return path


def read_back(spark: SparkSession, path: str, schema: T.StructType, bom: bool = False) -> DataFrame:
    """Read an export with a known schema (tests and checks)."""
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
          .option("nullValue", "").schema(schema).csv(path))
    return df


# Run-log columns.
RUN_LOG_SCHEMA = T.StructType([
    T.StructField("market", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("date_range", T.StringType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("started", T.TimestampNTZType()),
    T.StructField("finished", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
])


def run_log_row(spark: SparkSession, market: str, source: str, target: str, date_range: str,
                rows: int, started: datetime, finished: datetime, status: str,
                message: str = "") -> DataFrame:
    """One run as a one-row frame."""
    return spark.createDataFrame(
        [(market, source, target, date_range, int(rows), started, finished, status, message)],
        RUN_LOG_SCHEMA)


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by=()) -> int:
    """Write ``df`` and return how many rows were written, counted by an
    ``Observation`` in the same job (no separate COUNT(*) scan)."""
    from pyspark.sql import Observation
    obs = Observation("written")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


def append_run_log(row: DataFrame, path: str) -> None:
    """Append to the run-log table (parquet)."""
    row.coalesce(1).write.mode("append").parquet(path)
