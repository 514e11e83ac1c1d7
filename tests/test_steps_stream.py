"""Step runner (Q5, E10) and the long-running trigger of the stream (I4)."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from factkeeper.plans import testmodel as tm
from factkeeper.plans.steps import Step, daily_chain, run_steps

SF = "/root/testdata/sf0.001"


def test_steps_continue_and_stop(spark):
    df = spark.createDataFrame([(1,)], "a int")
    steps = [Step("add_b", lambda d: d.withColumn("b", F.col("a") + 1)),
             Step("broken", lambda d: d.withColumn("c", F.col("missing"))),
             Step("add_d", lambda d: d.withColumn("d", F.lit(4)))]
    out, log = run_steps(df, steps, on_error="continue")
    assert out.columns == ["a", "b", "d"]
    assert [r.status for r in log.orderBy("step_num").collect()] == ["OK", "ERROR", "OK"]
    out2, log2 = run_steps(df, steps, on_error="stop")
    assert out2.columns == ["a", "b"] and log2.count() == 2


def test_daily_chain_keys_and_recency(spark):
    out, log = daily_chain(tm.staging(spark, SF), date(2024, 2, 1), {"L4": "L9"})
    assert [r.status for r in log.collect()] == ["OK"] * 4
    rows = out.select("line", "userkey", "last_activity_days").collect()
    assert "L4" not in {r.line for r in rows}
    assert all(r.last_activity_days is not None for r in rows if r.userkey is not None)


def test_hourly_trigger_mode(spark, tmp_path):
    from factkeeper.streaming.recency_stream import RecencyState, recency_stream
    q = recency_stream(spark, SF, date(2024, 2, 1), tm.event_stream(), state_root=str(tmp_path / "s"),
                       processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = RecencyState(spark, str(tmp_path / "s"), tm.event_stream()).read(date(2024, 2, 1))
    assert out.count() == tm.staging(spark, SF).count()


def _daily(spark, tmp_path):
    from factkeeper.operators.rewrite import SERVING_MAPPING, SyncSpec
    from factkeeper.plans.maintenance import Market
    stg = tm.staging(spark, SF)
    staging_path, serving_path = str(tmp_path / "staging"), str(tmp_path / "serving")
    stg.filter(F.col("txn_date") < F.lit(date(2024, 1, 20))).write.partitionBy("txn_date").parquet(staging_path)
    (stg.select(*[F.col(s).alias(t) for s, t in SERVING_MAPPING], "user_unique")
     .withColumn("squad_lead", F.lit(None).cast("string"))
     .withColumn("tier_label", F.lit(None).cast("string"))
     .write.partitionBy("date").parquet(serving_path))
    spec = SyncSpec(date_column="txn_date", filter_column="line", mode="all", days_back=20)
    leads = spark.createDataFrame([("L1", "Ann"), ("L2", "Bo")], "line string, lead string")
    market = Market("usc", tm.EVENT_BANDS, line_recodes={"L4": "L9"}, squad_leads=leads, tier_stamp=True,
                    customers=spark.createDataFrame([(1, "x")], "user_unique long, segment string"))
    return stg, staging_path, serving_path, spec, market


def test_daily_run_end_to_end(spark, tmp_path):
    from factkeeper.plans.maintenance import STORED_VIEWS, daily_run, serving_rows
    from factkeeper.plans.table_store import read_days
    stg, staging_path, serving_path, spec, market = _daily(spark, tmp_path)
    root = str(tmp_path / "views")
    log = daily_run(spark, stg, staging_path, serving_path, root,
                    date(2024, 1, 31), spec, market, report_path=str(tmp_path / "report"),
                    report_tables={n: staging_path for n in ("usc", "myr", "sgd")}, log_path=str(tmp_path / "log"))
    statuses = {r.step_name: r.status for r in log.collect()}
    assert set(statuses.values()) == {"OK"} and set(STORED_VIEWS) <= set(statuses), log.collect()
    serving = serving_rows(spark, serving_path, root, market, date(2024, 1, 31))
    assert serving.count() == spark.read.parquet(serving_path).count()
    assert serving.filter(F.col("line") == "L1").select("squad_lead").distinct().first()[0] == "Ann"
    assert serving.filter(F.col("tier_name").isNotNull()).count() > 0
    staged = read_days(spark, staging_path)
    assert staged.filter(F.col("txn_date") >= F.lit(date(2024, 1, 20))).count() > 0   # A filled the window
    report = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert {r.table_name for r in report.collect()} == {"usc", "myr", "sgd"}
    runs = spark.read.parquet(str(tmp_path / "log")).collect()
    assert len(runs) == 4 and all(r.status == "OK" and r.started <= r.finished for r in runs)


def test_daily_runs_equal_the_full_recompute(spark, tmp_path):
    """Serving rows and views after a second day's run, with users that come, change and go, are
    those of the whole chain over the same table."""
    from factkeeper.plans.maintenance import _stores, daily_run, maintain_serving, maintenance_views, serving_rows
    from factkeeper.plans.table_store import VersionedTable
    stg, staging_path, serving_path, spec, market = _daily(spark, tmp_path)
    root, as_of = str(tmp_path / "views"), date(2024, 1, 31)
    daily_run(spark, stg, staging_path, serving_path, root, date(2024, 1, 30), spec, market)
    late = F.col("txn_date") >= F.lit(date(2024, 1, 29))
    other = (stg.filter(~late | (F.col("user_unique") % 3 != 0))
             .withColumn("deposit_amount", F.when(late, F.col("deposit_amount") + 7).otherwise(F.col("deposit_amount")).cast("decimal(18,2)"))
             .unionByName(stg.filter(late).limit(3).withColumn("user_unique", F.lit(9001).cast("long")).withColumn("unique_key", F.concat(F.lit("n"), "unique_key"))))
    log = daily_run(spark, other, staging_path, serving_path, root, as_of, spec, market)
    assert {r.status for r in log.collect()} == {"OK"}
    stored, _ = maintain_serving(spark, spark.read.parquet(serving_path).drop("tier_label", "squad_lead"), as_of, str(tmp_path / "full"), market)

    def same(a, b):
        cols = sorted(b.columns)
        assert sorted(a.columns) == cols
        assert sorted((tuple(map(str, r)) for r in a.select(*cols).collect())) == sorted((tuple(map(str, r)) for r in b.select(*cols).collect()))

    rows = serving_rows(spark, serving_path, root, market, as_of)
    assert rows.filter("user_unique = 9001").count() == 3
    same(rows.select(*stored.columns), stored)
    _, views = _stores(spark, serving_path, root, market)
    own = {"new_register_monthly": views.new_registrations(), "customer_monthly": views.customer_monthly(market.customers, ["segment"])}
    for name, _ in maintenance_views(market):
        full = VersionedTable(spark, str(tmp_path / "full" / "usc" / name)).read()
        got = own[name] if name in own else getattr(views, name)()
        if name == "new_depositor_txns":
            full = full.select("uniquekey", "user_unique", "date", "line", "deposit_cases", "deposit_amount")
            got = got.select(*full.columns)
        same(got, full)


def test_a_days_change_that_failed_is_taken_over_later(spark, tmp_path, monkeypatch):
    from factkeeper.plans import day_views
    from factkeeper.plans.table_store import replace_days
    path = str(tmp_path / "fact")
    schema = "user_unique long, line string, deposit_cases long, deposit_amount decimal(18,2), uniquekey string, date date"
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    rows = [(1, "L1", 1, D(5), "a", one), (2, "L1", 1, D(7), "b", two)]
    spark.createDataFrame(rows, schema).write.partitionBy("date").parquet(path)
    views = day_views.DayViews(spark, str(tmp_path / "v"), path, tm.EVENT_BANDS)
    views.build()
    views.announce([one])
    replace_days(spark.createDataFrame([(3, "L1", 1, D(9), "c", one)], schema), path, "date", [one])
    monkeypatch.setattr(views, "_refresh_txns", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        views.refresh()
    monkeypatch.undo()
    views.refresh([two])
    assert [tuple(r) for r in views.monthly_summary().collect()] == [("L1", 2024, 1, 2, 16.0, 2)]
    assert sorted(r.uniquekey for r in views.new_depositor_txns().collect()) == ["b", "c"]


def test_user_numbers_are_dense_and_stay(spark, tmp_path):
    from factkeeper.plans.day_views import UserNumbers
    numbers = UserNumbers(spark, str(tmp_path / "n"), "u")
    numbers.add(spark.range(100).selectExpr("concat('u', id) as u").repartition(7))
    first = {r.u: r.number for r in numbers.read().collect()}
    numbers.add(spark.createDataFrame([(None,), ("u5",), ("new",), ("new",)], "u string"))
    again = {r.u: r.number for r in numbers.read().collect()}
    assert sorted(first.values()) == list(range(1, 101)) and again == first | {"new": 101}


# -- changes with deletes and moves ---------------------------------------------

CHANGES = "old_key long, old_date date, old_cases long, new_key long, new_date date, new_cases long"


def test_change_stream_falls_back_when_the_newest_row_goes(spark, tmp_path):
    from factkeeper.streaming.change_stream import ChangeState, change_stream
    d = lambda k: date(2024, 1, k)
    source = tmp_path / "changes"
    batches = [
        [(None, None, None, 1, d(1), 1), (None, None, None, 1, d(5), 0), (None, None, None, 1, d(9), 1), (None, None, None, 2, d(3), 1),
         (None, None, None, None, d(9), 1), (None, None, None, 3, None, 1)],
        [(1, d(9), 1, 2, d(9), 1), (2, d(3), 1, 2, d(3), None)],       # the newest row of 1 moves to 2; 2's deposit goes
        [(2, d(9), 1, None, None, None), (1, d(5), 0, 1, d(6), 0)],    # and goes; a row changes its day
        [(2, d(3), None, None, None, None)],                           # nothing is left of 2
    ]
    got = []
    for rows in batches:
        spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(str(source))
        out = change_stream(spark, str(source), d(31), state_root=str(tmp_path / "state"), max_files_per_trigger=1)
        got.append(sorted((r.key, r.last_activity_days, r.last_deposit_date, r.days_inactive) for r in out.collect()))
    assert got == [[(1, d(9), d(9), 22), (2, d(3), d(3), 28)], [(1, d(5), d(1), 30), (2, d(9), d(9), 22)],
                   [(1, d(6), d(1), 30), (2, d(3), None, None)], [(1, d(6), d(1), 30)]]
    assert ChangeState(spark, str(tmp_path / "state")).read(d(31)).count() == 1


def test_changes_name_missing_columns(spark):
    from factkeeper.sources.tables import MissingColumns
    from factkeeper.streaming.change_stream import signed_rows
    with pytest.raises(MissingColumns, match="new_cases"):
        signed_rows(spark.createDataFrame([], CHANGES).drop("new_cases"))
