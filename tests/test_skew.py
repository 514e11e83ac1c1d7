"""A key holding a third of all rows: results stay exact, per-key work is
combined map-side before the shuffle, and AQE splits the hot join partition."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from factkeeper.operators import recency, update

SF = "/root/testdata/sf0.01"
HOT = -1


@pytest.fixture()
def skewed(spark):
    """Event-level rows; every third event belongs to one hot user."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    return events.select(
        F.when(F.col("event_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("user_id")).alias("user_id"),
        F.to_date("ts").alias("date"), "event_id", "event_type",
        (F.col("event_type") == "purchase").cast("int").alias("deposit_cases"),
        F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("code")
    ).repartition(8)   # like a table of many files: AQE splits along map outputs


@pytest.fixture()
def smj_with_skew_split(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_latest_value_on_hot_key_is_exact_and_split(spark, skewed, smj_with_skew_split):
    out = update.spread_latest(skewed, "user_id", "code", "latest_code", newest=["date", "event_id"])
    rows = out.collect()
    assert len(rows) == skewed.count()
    pdf = skewed.toPandas().sort_values(["user_id", "date", "event_id"], ascending=[True, False, False])
    expect = pdf.groupby("user_id").head(1).set_index("user_id")["code"].to_dict()
    assert {r.user_id: r.latest_code for r in rows} == expect
    per_key = update.latest_per_key(skewed, ["user_id"], ["date", "event_id"], cols=["code"])
    assert "partial_max_by" in per_key._jdf.queryExecution().executedPlan().toString()  # combined map-side
    plan = out._jdf.queryExecution().executedPlan().toString()   # final adaptive plan
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan   # split by AQE


def test_recency_on_hot_key(spark, skewed, smj_with_skew_split):
    out = recency.recency(skewed, "user_id", date(2024, 2, 1))
    rows = out.collect()
    assert len(rows) == skewed.count()
    hot = {(r.last_activity_days, r.last_deposit_date) for r in rows if r.user_id == HOT}
    pdf = skewed.filter(F.col("user_id") == HOT).toPandas()
    assert hot == {(pdf.date.max(), pdf[pdf.deposit_cases > 0].date.max())}
    per_key = recency.key_recency(skewed, "user_id")
    assert "partial_max" in per_key._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
