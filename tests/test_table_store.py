"""Safe table replacement: version folders + pointer, day-partition rewrites."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from factkeeper.operators import rewrite
from factkeeper.plans import table_store
from factkeeper.plans.table_store import VersionedTable, read_days, replace_days


def test_versioned_table_reads_old_until_switch(spark, tmp_out):
    store = VersionedTable(spark, f"{tmp_out}/t")
    assert not store.exists()
    store.write(spark.createDataFrame([(1,)], "v int"), "1")
    old = store.read()
    # rewrite from the table itself: never the folder being read
    store.refresh(lambda: store.read().selectExpr("v + 1 as v"))
    assert [r.v for r in store.read().collect()] == [2]
    assert [r.v for r in old.collect()] == [1]     # the old version is untouched


def test_replace_days_empties_days_without_new_rows(spark, tmp_out):
    path = f"{tmp_out}/fact"
    fact = spark.createDataFrame([(date(2024, 1, d), d) for d in (1, 2, 3)], "date date, v int")
    fact.write.partitionBy("date").parquet(path)
    current = spark.read.parquet(path)
    source = spark.createDataFrame([(date(2024, 1, 2), 20)], "date date, v int")
    days = [date(2024, 1, 2), date(2024, 1, 3)]
    new = rewrite.mapped_replace(current, source, days, [("date", "date"), ("v", "v")])
    # only the changed days are rewritten; the input is read from the same folder
    with pytest.raises(ValueError):          # a row of another day: nothing is touched
        replace_days(new, path, "date", days)
    assert spark.read.parquet(path).count() == 3
    assert replace_days(new.filter(F.col("date").isin(days)), path, "date", days) == 1
    got = sorted((r.date, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(date(2024, 1, 1), 1), (date(2024, 1, 2), 20)]


def test_prune_keeps_newest_and_current(spark, tmp_out):
    import time
    store = VersionedTable(spark, f"{tmp_out}/p")
    for i in range(4):
        store.write(spark.createDataFrame([(i,)], "v int"), str(i))
        time.sleep(0.05)
    assert store.versions() == ["0", "1", "2", "3"]
    assert store.prune(keep=2) == ["0", "1"]
    assert store.versions() == ["2", "3"] and [r.v for r in store.read().collect()] == [3]


def test_jobs_on_one_table_keep_each_others_days(spark, tmp_out):
    """Another writer's staged files stay: each job has its own, and commits its days only."""
    from concurrent.futures import ThreadPoolExecutor
    path = f"{tmp_out}/fact"
    rows = [(date(2024, 1, d), d) for d in range(1, 7)] + [(None, 9)]
    spark.createDataFrame(rows, "date date, v int").write.partitionBy("date").parquet(path)

    def job(d):
        return replace_days(spark.createDataFrame([(d, 100), (d, 200)], "date date, v int"), path, "date", [d])

    days = [date(2024, 1, 2), date(2024, 1, 4), None]
    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(job, days)) == [2, 2, 2]
    got = sorted((str(r.date), r.v) for r in spark.read.parquet(path).collect())
    want = [(str(date(2024, 1, d)), d) for d in (1, 3, 5, 6)] + [(str(d), v) for d in days for v in (100, 200)]
    assert got == sorted(want)


def test_days_of_a_catalog_table(spark, tmp_out):
    spark.sql(f"CREATE TABLE kept_days (v int, date date) USING parquet PARTITIONED BY (date) LOCATION '{tmp_out}/k'")
    try:
        rows = [(d, date(2024, 1, d)) for d in (1, 2, 3)] + [(9, None)]
        spark.createDataFrame(rows, "v int, date date").write.insertInto("kept_days")
        table = read_days(spark, "kept_days")
        days = [date(2024, 1, 2), date(2024, 1, 3), None]
        assert replace_days(table.filter("v = 2").withColumn("v", F.col("v") * 10), "kept_days", "date", days) == 1
        assert sorted((r.v, str(r.date)) for r in spark.table("kept_days").collect()) == [(1, "2024-01-01"), (20, "2024-01-02")]
        assert spark.read.parquet(f"{tmp_out}/k").count() == 2    # the emptied days' files are gone too
        with pytest.raises(ValueError):
            replace_days(spark.table("kept_days"), "kept_days", "date", [date(2024, 1, 2)])
        assert spark.table("kept_days").count() == 2
    finally:
        spark.sql("DROP TABLE kept_days")


@pytest.mark.parametrize("catalog", [False, True])
def test_a_column_is_added_without_writing_a_day(spark, tmp_out, catalog):
    path = f"{tmp_out}/c"
    spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "v int, date date").write.partitionBy("date").parquet(path)
    target = path
    if catalog:
        target = "added_column"
        spark.sql(f"CREATE TABLE {target} (v int, date date) USING parquet PARTITIONED BY (date) LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {target}")
    try:
        files = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/date=*/*.parquet")}
        table_store.add_column(spark, target, "stamp", "timestamp", "TIMESTAMP '2024-02-01 06:00:00 UTC'")
        assert {f: os.path.getmtime(f) for f in glob.glob(f"{path}/date=*/*.parquet")} == files
        table = read_days(spark, target)
        assert table.columns == ["v", "stamp", "date"]
        assert table.filter("stamp = timestamp'2024-02-01 06:00:00 UTC'").count() == 3 and table.filter("stamp is null").count() == 0
        # a written day holds the column itself, NULLs included
        day = [date(2024, 1, 2)]
        replace_days(table.filter("v = 2").withColumn("stamp", F.lit(None).cast("timestamp")), target, "date", day)
        assert [r.v for r in read_days(spark, target).filter("stamp is null").collect()] == [2]
        table_store.add_column(spark, target, "note", "string", "'x'")
        assert sorted((r.v, r.note, r.stamp is None) for r in read_days(spark, target).collect()) == [(1, "x", False), (2, "x", True), (3, "x", False)]
    finally:
        if catalog:
            spark.sql(f"DROP TABLE {target}")


def test_a_table_emptied_whole_keeps_its_schema(spark, tmp_out):
    path = f"{tmp_out}/fact"
    df = spark.createDataFrame([(date(2024, 1, 1), 1)], "date date, v int")
    df.write.partitionBy("date").parquet(path)
    assert replace_days(df.limit(0), path, "date", [date(2024, 1, 1)]) == 0
    assert spark.read.parquet(path).count() == 0 and "v" in spark.read.parquet(path).columns
