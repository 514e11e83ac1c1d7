"""Partition-rewriting jobs: only touched partitions change, empty days are
emptied, an empty automatic value list is a no-op, runs are logged."""

import os
import shutil
from datetime import date, datetime

from pyspark.sql import functions as F

from factkeeper.functions.time_windows import first_of_next_month
from factkeeper.operators.rewrite import SyncSpec
from factkeeper.plans import jobs
from factkeeper.plans.table_store import read_days

RUN = datetime(2024, 2, 1, 6, 0)
SCHEMA = "k string, txn_date date, agent_code string, deposit_cases int"


def _store(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("txn_date").parquet(path)


def test_sync_job_rewrites_only_window_days(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    _store(spark, path, [("old1", date(2024, 1, 27), "X", 1), ("old2", date(2024, 1, 28), "X", 1),
                         ("old3", date(2024, 1, 30), "X", 1)])
    before = os.path.getmtime(tmp_path / "t" / "txn_date=2024-01-27")
    src = spark.createDataFrame([], SCHEMA)   # a first run gives the table its stamp column, and writes no day
    jobs.sync_window_job(spark, src, path, SyncSpec(values=["X"], activity_columns=["deposit_cases"]),
                         date(2024, 2, 28), date(2024, 2, 29), RUN)
    assert read_days(spark, path).filter(F.col("last_synced_at") == F.lit("2024-02-01 06:00:00").cast("timestamp")).count() == 3
    src = spark.createDataFrame([("new", date(2024, 1, 29), "X", 2), ("skip", date(2024, 1, 29), "Y", 2)],
                                SCHEMA)
    n = jobs.sync_window_job(spark, src, path, SyncSpec(values=["X"], activity_columns=["deposit_cases"]),
                             date(2024, 1, 28), date(2024, 1, 31), RUN, log_path=log, market="usc")
    assert n == 1
    got = sorted((r.k, r.txn_date) for r in read_days(spark, path).collect())
    assert got == [("new", date(2024, 1, 29)), ("old1", date(2024, 1, 27))]   # 28 and 30 emptied
    assert os.path.getmtime(tmp_path / "t" / "txn_date=2024-01-27") == before   # untouched day
    logged = spark.read.parquet(log).first()
    assert (logged.market, logged.rows_inserted, logged.status) == ("usc", 1, "OK")


def test_sync_job_auto_list_without_values_is_noop(spark, tmp_path):
    path = str(tmp_path / "t")
    _store(spark, path, [("old", date(2024, 1, 29), "X", 1)])
    src = spark.createDataFrame([("s", date(2024, 1, 29), None, 1)], SCHEMA)
    n = jobs.sync_window_job(spark, src, path, SyncSpec(mode="all", activity_columns=["deposit_cases"]),
                             date(2024, 1, 28), date(2024, 1, 31), RUN)
    assert n == 0 and [r.k for r in read_days(spark, path).collect()] == ["old"]


def test_month_grain_keeps_rows_outside_window(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.createDataFrame([("a", date(2024, 1, 5), "X", 1), ("b", date(2024, 1, 29), "X", 1)], SCHEMA)
    rows.withColumn("m", jobs.period_of("txn_date", "month")).write.partitionBy("m").parquet(path)
    src = spark.createDataFrame([("c", date(2024, 1, 29), "X", 3)], SCHEMA)
    jobs.sync_window_job(spark, src, path, SyncSpec(values=["X"], activity_columns=["deposit_cases"]),
                         date(2024, 1, 28), date(2024, 1, 31), RUN, part_col="m", grain="month")
    got = sorted(r.k for r in read_days(spark, path).collect())
    assert got == ["a", "c"]   # same month, outside the window: kept
    assert jobs.periods_between(date(2024, 11, 15), date(2025, 2, 1), "month") == [
        date(2024, 11, 1), date(2024, 12, 1), date(2025, 1, 1)]
    assert read_days(spark, path).filter(F.col("k") == "c").first().deposit_cases == 3


def test_upsert_job_moves_a_key_from_a_row_without_a_date(spark, tmp_path):
    path = str(tmp_path / "u")
    target = spark.createDataFrame([("k1", None, None), ("k2", date(2024, 1, 5), date(2024, 1, 1)), ("k3", None, None)],
                                   "k string, d date, m date")
    target.write.partitionBy("m").parquet(path)
    source = spark.createDataFrame([("k1", date(2024, 2, 3)), ("k2", date(2024, 2, 4))], "k string, d date")
    jobs.upsert_month_job(spark, source, path, "k", "d", date(2024, 2, 1), date(2024, 3, 1), ["d"], RUN, part_col="m")
    got = sorted((r.k, str(r.d)) for r in read_days(spark, path).collect())
    assert got == [("k1", "2024-02-03"), ("k2", "2024-02-04"), ("k3", "None")]


def test_upsert_reads_no_key_of_other_months(spark, tmp_path):
    """Keys are looked for in the digests: a row that came in behind them isn't seen, one whose
    digest is gone is; every job on the table keeps them."""
    path = str(tmp_path / "d")
    cols = "k string, d date, m date"
    months = [date(2024, k, 1) for k in range(1, 7)]
    rows = [(f"k{i}-{j}", m.replace(day=3), m) for i, m in enumerate(months) for j in range(3)] + [("none", None, None), (None, months[0], months[0])]
    spark.createDataFrame(rows, cols).write.partitionBy("m").parquet(path)

    def upsert(keys, month):
        src = spark.createDataFrame([(k, date(2024, month, 9)) for k in keys], "k string, d date")
        jobs.upsert_month_job(spark, src, path, "k", "d", date(2024, month, 1), first_of_next_month(date(2024, month, 1)), ["d"], RUN, part_col="m")
        return {(r.k, r.d.month if r.d else None) for r in read_days(spark, path).filter("k is not null").collect()}

    got = upsert(["k0-0", "none", "new"], 6)
    assert {("k0-0", 6), ("none", 6), ("new", 6)} <= got and ("k0-0", 1) not in got and ("none", None) not in got
    # behind the digests: a copy of a key in March
    (spark.createDataFrame([("k1-1", date(2024, 3, 5), date(2024, 3, 1))], cols).withColumn("last_synced_at", F.lit(RUN))
     .write.mode("append").partitionBy("m").parquet(path))
    got = upsert(["k1-1"], 5)
    assert ("k1-1", 5) in got and ("k1-1", 2) not in got and ("k1-1", 3) in got
    shutil.rmtree(f"{path}/_keys_k/m=2024-03-01")     # unknown again
    got = upsert(["k1-1"], 5)
    assert ("k1-1", 3) not in got
    # another job replaces April, and its keys are found there
    jobs.year_reload_job(spark, spark.createDataFrame([("y", date(2024, 4, 4))], "k string, d date"), path, "d", 2024, part_col="m", grain="month")
    assert upsert(["y"], 2) == {("y", 2)}


def test_a_row_without_a_stamp_gets_one_once(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [("a", None, date(2024, 1, 1)), ("b", datetime(2023, 1, 1), date(2024, 1, 1)), ("c", datetime(2023, 1, 1), date(2024, 1, 2))]
    spark.createDataFrame(rows, "k string, last_synced_at timestamp, txn_date date").write.partitionBy("txn_date").parquet(path)
    untouched = os.path.getmtime(tmp_path / "s" / "txn_date=2024-01-02")
    for run in (RUN, datetime(2024, 3, 1)):
        jobs._with_stamp(spark, path, "txn_date", run)
    got = {r.k: r.s for r in read_days(spark, path).select("k", F.col("last_synced_at").cast("string").alias("s")).collect()}
    assert got["a"] == "2024-02-01 06:00:00" and got["b"] == got["c"]
    assert os.path.getmtime(tmp_path / "s" / "txn_date=2024-01-02") == untouched


def test_year_reload_by_day_needs_few_jobs(spark, tmp_path):
    path = str(tmp_path / "y")
    _store(spark, path, [("old", date(2024, 5, 5), "X", 1), ("other", date(2023, 5, 5), "X", 1)])
    src = spark.createDataFrame([("a", date(2024, 1, 1), "X", 1), ("b", date(2024, 12, 31), "X", 1)], SCHEMA)
    sc = spark.sparkContext
    sc.setJobGroup("year-reload", "")
    jobs.year_reload_job(spark, src, path, "txn_date", 2024)
    n = len(sc.statusTracker().getJobIdsForGroup("year-reload"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r.k for r in read_days(spark, path).collect()) == ["a", "b", "other"]
    assert n <= 10


def test_full_load_job_checks_counts_and_keys(spark, tmp_path):
    path, log = str(tmp_path / "f"), str(tmp_path / "log")
    src = spark.createDataFrame([("a", date(2024, 1, 1), "X", 1), ("b", date(2024, 1, 2), "X", 1)], SCHEMA)
    out = jobs.full_load_job(spark, src, path, "k", part_col="txn_date", log_path=log)
    assert out == {"rows": 2, "source_rows": 2, "target_rows": 2, "duplicate_keys": 0}
    out = jobs.full_load_job(spark, src, path, "k", part_col="txn_date", truncate=False, log_path=log)
    assert out == {"rows": 2, "source_rows": 2, "target_rows": 4, "duplicate_keys": 2}
    assert sorted(r.status for r in spark.read.parquet(log).collect()) == ["ERROR", "OK"]
    assert jobs.full_load_job(spark, src, path, "k", part_col="txn_date")["target_rows"] == 2
