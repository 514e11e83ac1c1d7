"""The incremental serving store reads the same rows as the full daily
recompute, while a daily copy rewrites only the copied days."""

import os
import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from factkeeper.operators import rewrite, update
from factkeeper.plans import testmodel as tm
from factkeeper.plans.maintenance import Market, _tier_by_key
from factkeeper.plans.serving_store import ServingStore
from factkeeper.plans.steps import run_steps, serving_steps

SF = "/root/testdata/sf0.001"
DAYS = [date(2024, 1, 29), date(2024, 1, 30)]
MAPPING = rewrite.SERVING_MAPPING + [("user_unique", "user_unique")]
COLS = ["uniquekey", "line", "update_unique_code", "userkey", "last_activity_days",
        "last_deposit_date", "days_inactive", "tier_label"]


def test_incremental_store_equals_full_recompute(spark, tmp_path):
    stg = tm.staging(spark, SF)
    fresh = stg.select(*[F.col(s).alias(t) for s, t in MAPPING])
    on_days = F.col("date").isin(DAYS)
    # an older state of the two days: other codes, no deposits
    stale = (fresh.withColumn("unique_code", F.when(on_days, F.lit("OLD")).otherwise(F.col("unique_code")))
             .withColumn("deposit_cases", F.when(on_days, F.lit(0)).otherwise(F.col("deposit_cases"))))
    market = Market("usc", tm.EVENT_BANDS, line_recodes={"L4": "L9"})
    store = ServingStore(spark, str(tmp_path / "store"), market.bands, market.line_recodes)
    store.build(stale)
    day_dirs = {p: os.path.getmtime(tmp_path / "store" / "fact" / p)
                for p in os.listdir(tmp_path / "store" / "fact") if p.startswith("date=")}
    store.copy_days(stg, DAYS, MAPPING)
    as_of = date(2024, 2, 1)
    got = store.read(as_of)

    final = stale.filter(~on_days).unionByName(fresh.filter(on_days))
    full, _ = run_steps(final, serving_steps(as_of, market.line_recodes))
    full = update.update_from(full, _tier_by_key(full, market.bands), ["userkey", "line"],
                              {"tier_label": "tier_name"}, unique=True)
    assert sorted(got.select(*COLS).collect()) == sorted(full.select(*COLS).collect())
    changed = {p for p, t in day_dirs.items()
               if os.path.getmtime(tmp_path / "store" / "fact" / p) != t}
    assert changed == {f"date={d}" for d in DAYS}   # only the copied days were rewritten


def _rows(spark, rows):
    cols = ("user_unique long, user_name string, unique_code string, line string, date date, uniquekey string, "
            "deposit_cases long, deposit_amount decimal(18,2)")
    return spark.createDataFrame([(*r[:7], Decimal(r[7])) for r in rows], cols)


def _staged(df):
    return df.withColumnsRenamed({"user_name": "username", "uniquekey": "unique_key"})


SMALL = [("user_unique", "user_unique"), ("username", "user_name"), ("unique_code", "unique_code"), ("line", "line"),
         ("date", "date"), ("unique_key", "uniquekey"), ("deposit_cases", "deposit_cases"), ("deposit_amount", "deposit_amount")]


def test_users_are_refreshed_after_a_run_that_failed(spark, tmp_path, monkeypatch):
    day = date(2024, 1, 9)
    rows = [(1, "a", "C1", "L1", date(2024, 1, 1), "r1", 1, 5), (1, "a", "C1", "L1", day, "r2", 1, 5)]
    store = ServingStore(spark, str(tmp_path / "s"), tm.EVENT_BANDS)
    store.build(_rows(spark, rows))
    staging = _staged(_rows(spark, []))              # the day's row vanished at the source
    monkeypatch.setattr(store, "refresh", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.copy_days(staging, [day], SMALL)
    monkeypatch.undo()
    store.copy_days(staging, [date(2024, 1, 8)], SMALL)   # another day: the lost one is made good
    got = store.read(date(2024, 1, 10)).collect()
    assert [(r.uniquekey, r.last_activity_days, r.days_inactive) for r in got] == [("r1", date(2024, 1, 1), 9)]
    assert store.pending.read().count() == 0


def test_users_with_one_short_key_share_its_recency(spark, tmp_path):
    rows = [(1, "a", "C1", "L1", date(2024, 1, 1), "u1", 1, 5), (2, "b", "C1", "L1", date(2024, 1, 9), "u2", 1, 600)]
    serving = _rows(spark, rows)
    store = ServingStore(spark, str(tmp_path / "s"), tm.EVENT_BANDS, short_key=True)
    store.build(serving)
    store.copy_days(_staged(_rows(spark, rows[1:])), [date(2024, 1, 9)], SMALL)
    as_of = date(2024, 1, 10)
    full, _ = run_steps(serving, serving_steps(as_of, short_key=True))
    full = update.update_from(full, _tier_by_key(full, tm.EVENT_BANDS), ["userkey", "line"], {"tier_label": "tier_name"}, unique=True)
    got = store.read(as_of)
    assert sorted(got.select(*COLS).collect()) == sorted(full.select(*COLS).collect())
    assert {r.days_inactive for r in got.collect()} == {1} and {r.tier_label for r in got.collect()} == {"SILVER"}


def _random_rows(seed, days, n):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        user = rnd.randrange(6) or None
        day = rnd.choice([*days, None]) if rnd.random() < 0.1 else rnd.choice(days)
        out.append((user, rnd.choice(["a", "b", None]), rnd.choice(["C1", "C2", None]), rnd.choice(["L1", "L2"]), day, f"r{seed}-{k}",
                    rnd.choice([0, 1, None]), rnd.randrange(900)))
    return out


def _full(rows, as_of):
    full, _ = run_steps(rows, serving_steps(as_of))
    return update.update_from(full, _tier_by_key(full, tm.EVENT_BANDS), ["userkey", "line"], {"tier_label": "tier_name"}, unique=True)


def test_copies_of_any_days_equal_the_full_recompute(spark, tmp_path):
    """Recent days move the horizon on, an old one takes it back; what is folded stays exact."""
    days = [date(2024, 1, 1) + timedelta(days=k) for k in range(24)]
    rows = {r[5]: r for r in _random_rows(1, days[:12], 60)}
    store = ServingStore(spark, str(tmp_path / "s"), tm.EVENT_BANDS, open_days=4)
    store.build(_rows(spark, list(rows.values())))
    horizons = [store.horizon()]
    for step, copied in enumerate([days[12:14], days[20:22], days[3:5], days[22:24]]):
        fresh = [r for r in _random_rows(10 + step, copied, 12) if r[4] is not None]
        rows = {k: r for k, r in rows.items() if r[4] not in copied} | {r[5]: r for r in fresh}
        store.copy_days(_staged(_rows(spark, fresh)), copied, SMALL)
        horizons.append(store.horizon())
        as_of = date(2024, 2, 1)
        want = _full(_rows(spark, list(rows.values())), as_of)
        assert sorted(store.read(as_of).select(*COLS).collect(), key=str) == sorted(want.select(*COLS).collect(), key=str)
    assert horizons[2] > horizons[0] > horizons[3] and horizons[4] > horizons[3]


def test_a_copy_reads_no_other_day_of_the_fact(spark, tmp_path):
    days = [date(2024, 1, 1) + timedelta(days=k) for k in range(10)]
    rows = [(k % 3, "a", f"C{k}", "L1", d, f"r{k}", 1, 5) for k, d in enumerate(days)]
    store = ServingStore(spark, str(tmp_path / "s"), tm.EVENT_BANDS)
    store.build(_rows(spark, rows))
    # other rows on the other days, behind the store's back: whoever reads them gets other codes
    others = _rows(spark, [(*r[:2], "OTHER", *r[3:]) for r in rows[:-2]])
    others.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(store.fact_path)
    store.copy_days(_staged(_rows(spark, rows[-1:])), days[-2:], SMALL)    # the last day but one has lost its row
    got = {r.user_unique: r.update_unique_code for r in store.stamps.read_part("latest").collect()}
    assert got == {0: "C9", 1: "C7", 2: "C5"}
