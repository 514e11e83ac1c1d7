"""UPDATE ... FROM rewrites: lookups, backfill, latest value per key."""

from datetime import date

from factkeeper.operators import update


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_update_from_matches_nulls_and_duplicates(spark):
    target = spark.createDataFrame([("u1", "A", "old"), ("u2", "A", "old"), ("u3", "A", "old"),
                                    (None, "A", "old")], "userkey string, line string, tier_label string")
    lookup = spark.createDataFrame([("u1", "A", "GOLD"), ("u1", "A", "SILVER"),  # two matches
                                    ("u2", "A", None)],                          # matched NULL
                                   "userkey string, line string, tier_name string")
    out = update.update_from(target, lookup, ["userkey", "line"], {"tier_label": "tier_name"})
    assert out.count() == 4                                  # row count kept
    got = dict(((r.userkey, r.tier_label) for r in out.collect()))
    assert got["u1"] == "SILVER"    # deterministic pick (greatest value) among two matches
    assert got["u2"] is None        # matched NULL overwrites
    assert got["u3"] == "old"       # no match: unchanged
    assert got[None] == "old"       # NULL key never matches


def test_update_from_with_order_adds_new_column(spark):
    target = spark.createDataFrame([("u1",), ("u9",)], "k string")
    src = spark.createDataFrame([("u1", 1, "a"), ("u1", 2, "b")], "k string, m int, v string")
    out = update.update_from(target, src, ["k"], {"v": "v"}, newest=["m"])
    assert rows(out, "k", "v") == [("u1", "b"), ("u9", None)]


def test_latest_per_key_nulls_first_and_tiebreak(spark):
    df = spark.createDataFrame([
        (1, date(2024, 1, 2), "k1", "c-old"),
        (1, date(2024, 1, 3), "k2", "c-new-a"),
        (1, date(2024, 1, 3), "k3", "c-new-b"),   # same date: greatest unique_key wins
        (2, date(2024, 1, 3), "k4", "c2"),
        (2, None, "k5", "c2-nulldate"),           # NULL date ranks first (Postgres DESC)
        (None, date(2024, 1, 9), "k6", "cx"),     # NULL user: untouched
    ], "user_unique int, date date, unique_key string, unique_code string")
    out = update.spread_latest(df, "user_unique", "unique_code", "update_unique_code",
                               newest=["date", "unique_key"], nulls_first=["date"])
    got = {r.unique_key: r.update_unique_code for r in out.collect()}
    assert got["k1"] == got["k2"] == got["k3"] == "c-new-b"
    assert got["k4"] == got["k5"] == "c2-nulldate"
    assert got["k6"] is None
    assert out.count() == 6


def test_latest_per_key_keeps_null_keys_when_asked(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, v int")
    out = update.latest_per_key(df, ["k"], ["v"], keep_null_keys=True)
    assert rows(out, "k", "v") == [("a", 4), (None, 1), (None, 2)]


def test_backfill_only_fills_nulls(spark):
    target = spark.createDataFrame([("u", None, 5.0), ("u", "web", None), ("z", None, None)],
                                   "u string, traffic string, amount double")
    src = spark.createDataFrame([("u", 1, "ads", 1.0), ("u", 2, "seo", 2.0)],
                                "u string, ts int, traffic string, amount double")
    out = update.backfill(target, src, "u", ["traffic", "amount"], newest=["ts"])
    assert rows(out, "u", "traffic", "amount") == [("u", "seo", 5.0), ("u", "web", 2.0), ("z", None, None)]


def test_conditional_update_keeps_old_when_lookup_null(spark):
    target = spark.createDataFrame([(1, None), (2, "OLD"), (3, "OLD"), (4, "ASIA"), (5, "X")],
                                   "line int, squad_lead string")
    lookup = spark.createDataFrame([(1, "ASIA"), (2, "ASIA"), (3, None), (4, "ASIA")],
                                   "line int, lead string")
    out = update.conditional_update(target, lookup, "line", "squad_lead", "lead")
    assert rows(out, "line", "squad_lead") == [(1, "ASIA"), (2, "ASIA"), (3, "OLD"), (4, "ASIA"), (5, "X")]


def test_key_side_is_always_a_snapshot(spark, tmp_path):
    from factkeeper.operators.update import key_side
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    stored = key_side(spark.read.parquet(path).withColumnRenamed("id", "k"))
    spark.range(3).write.mode("overwrite").parquet(path)
    assert sorted(r.k for r in stored.collect()) == list(range(10))


def test_scratch_scope_deletes_its_own_folders_only(spark):
    import os
    from factkeeper.operators.update import key_side
    from factkeeper.session import scratch_scope
    files = lambda df: [f.replace("file://", "").replace("file:", "") for f in df.inputFiles()]
    with scratch_scope(spark):
        outer = key_side(spark.range(5))
        with scratch_scope(spark):
            inner = key_side(spark.range(5))
            gone = files(inner)
            assert inner.count() == 5
        assert outer.count() == 5 and not any(map(os.path.exists, gone))
        kept = files(outer)
    assert not any(map(os.path.exists, kept))

