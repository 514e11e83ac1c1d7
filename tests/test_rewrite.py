"""Edge rows of the windowed rewrites (FIXTURES §4) on small hand-made frames."""

import pytest
from datetime import date, datetime

from pyspark.sql import functions as F

from factkeeper.operators import rewrite
from factkeeper.operators.rewrite import SyncSpec

RUN = datetime(2024, 2, 1, 6, 0)
ACT = ["deposit_cases", "deposit_amount"]
SCHEMA = "unique_key string, txn_date date, agent_code string, deposit_cases int, deposit_amount decimal(18,2)"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_window_edges_and_null_date(spark):
    target = spark.createDataFrame([
        ("a", date(2024, 1, 28), "X", 1, None),   # start: in window → replaced
        ("b", date(2024, 1, 30), "X", 1, None),   # end-1: in window
        ("c", date(2024, 1, 31), "X", 1, None),   # end: outside
        ("d", None, "X", 1, None),                # NULL date: stays
    ], SCHEMA)
    source = spark.createDataFrame([("n", date(2024, 1, 29), "X", 2, None)], SCHEMA)
    spec = SyncSpec(values=["X"], activity_columns=ACT)
    out = rewrite.replace_recent_days(target, source, spec, date(2024, 1, 31), RUN)
    assert rows(out, "unique_key") == [("c",), ("d",), ("n",)]
    stamped = {r.unique_key: r.last_synced_at for r in out.collect()}
    assert stamped["n"] == RUN and stamped["c"] == RUN  # P12 stamps old NULLs too


def test_delete_is_wider_than_value_list(spark):
    target = spark.createDataFrame([("old", date(2024, 1, 29), "OTHER", 1, None)], SCHEMA)
    source = spark.createDataFrame([("new", date(2024, 1, 29), "X", 1, None)], SCHEMA)
    out = rewrite.replace_recent_days(target, source, SyncSpec(values=["X"], activity_columns=ACT),
                                      date(2024, 1, 31), RUN)
    assert rows(out, "unique_key") == [("new",)]


def test_empty_source_specific_list_empties_window(spark):
    target = spark.createDataFrame([("old", date(2024, 1, 29), "X", 1, None)], SCHEMA)
    source = spark.createDataFrame([], SCHEMA)
    out = rewrite.replace_recent_days(target, source, SyncSpec(values=["X"], activity_columns=ACT),
                                      date(2024, 1, 31), RUN)
    assert out.count() == 0


def test_empty_source_auto_list_leaves_target(spark):
    target = spark.createDataFrame([("old", date(2024, 1, 29), "X", 1, None)], SCHEMA)
    source = spark.createDataFrame([("s", date(2024, 1, 29), None, 1, None)], SCHEMA)
    out = rewrite.replace_recent_days(target, source, SyncSpec(mode="all", activity_columns=ACT),
                                      date(2024, 1, 31), RUN)
    assert rows(out, "unique_key") == [("old",)]


def test_activity_predicate(spark):
    source = spark.createDataFrame([
        ("nulls", date(2024, 1, 29), "X", None, None),
        ("zeros", date(2024, 1, 29), "X", 0, 0.0),
        ("negative", date(2024, 1, 29), "X", -1, -5.0),
        ("cent", date(2024, 1, 29), "X", 0, 0.01),
        ("null_value", date(2024, 1, 29), None, 1, 1.0),
    ], SCHEMA.replace("decimal(18,2)", "double"))
    spec = SyncSpec(values=["X"], activity_columns=ACT)
    got = rewrite.sync_rows(source, spec, date(2024, 1, 28), date(2024, 1, 31))
    assert rows(got, "unique_key") == [("cent",)]
    auto = rewrite.sync_rows(source, SyncSpec(mode="all", activity_columns=ACT),
                             date(2024, 1, 28), date(2024, 1, 31))
    assert rows(auto, "unique_key") == [("cent",)]  # NULL filter value never synced


def test_replace_is_idempotent(spark):
    target = spark.createDataFrame([("a", date(2024, 1, 20), "X", 1, None)], SCHEMA)
    source = spark.createDataFrame([("n", date(2024, 1, 29), "X", 2, None)], SCHEMA)
    spec = SyncSpec(values=["X"], activity_columns=ACT)
    once = rewrite.replace_recent_days(target, source, spec, date(2024, 1, 31), RUN)
    twice = rewrite.replace_recent_days(once, source, spec, date(2024, 1, 31), RUN)
    assert rows(once, "unique_key", "txn_date") == rows(twice, "unique_key", "txn_date")


UPS = "k string, d date, v int"


def test_upsert_moves_dedups_and_keeps_null_keys(spark):
    target = spark.createDataFrame([
        ("moved", date(2024, 1, 5), 1),     # key living in another month
        ("inside", date(2024, 2, 3), 1),    # in window → deleted
        (None, date(2024, 1, 7), 1),        # NULL key kept
        ("stay", date(2024, 1, 9), 1),
    ], UPS)
    source = spark.createDataFrame([
        ("moved", date(2024, 2, 10), 2),
        ("dup", date(2024, 2, 11), 3),
        ("dup", date(2024, 2, 12), 4),      # newest wins
        (None, date(2024, 2, 13), 5),
        ("outside", date(2024, 3, 1), 9),   # not in the source window
    ], UPS)
    out = rewrite.upsert_window(target, source, "k", "d", date(2024, 2, 1), date(2024, 3, 1),
                                ["d", "v"], RUN)
    got = rows(out.fillna({"k": "<null>"}), "k", "d", "v")
    assert got == sorted([("moved", date(2024, 2, 10), 2), ("<null>", date(2024, 1, 7), 1),
                          ("stay", date(2024, 1, 9), 1), ("dup", date(2024, 2, 12), 4),
                          ("<null>", date(2024, 2, 13), 5)])
    keys = out.filter(F.col("k").isNotNull()).groupBy("k").count().filter("count > 1")
    assert keys.count() == 0


def test_upsert_empty_source_only_deletes(spark):
    target = spark.createDataFrame([("a", date(2024, 2, 3), 1), ("b", date(2024, 1, 3), 1)], UPS)
    out = rewrite.upsert_window(target, spark.createDataFrame([], UPS), "k", "d",
                                date(2024, 2, 1), date(2024, 3, 1), ["d"], RUN)
    assert rows(out, "k") == [("b",)]


def test_mapped_replace_blank_and_target_only_column(spark):
    src = spark.createDataFrame([(None, date(2024, 1, 29), 5), ("op", date(2024, 1, 20), 1)],
                                "operator_username string, date date, deposit_cases int")
    mapping = [("operator_username", "operator"), ("date", "date"), ("deposit_cases", "deposit_cases")]
    target = spark.createDataFrame([("x", date(2024, 1, 29), 9, "lead"), ("y", date(2024, 1, 21), 1, "lead")],
                                   "operator string, date date, deposit_cases int, squad_lead string")
    out = rewrite.mapped_replace(target, src, [date(2024, 1, 29), date(2024, 1, 30)], mapping)
    got = rows(out.fillna({"squad_lead": "<null>"}), "operator", "date", "deposit_cases", "squad_lead")
    assert got == [("", date(2024, 1, 29), 5, "<null>"), ("y", date(2024, 1, 21), 1, "lead")]


def test_mapped_replace_zero_rows_still_deletes(spark):
    src = spark.createDataFrame([], "operator_username string, date date")
    target = spark.createDataFrame([("x", date(2024, 1, 29))], "operator string, date date")
    out = rewrite.mapped_replace(target, src, [date(2024, 1, 29)],
                                 [("operator_username", "operator"), ("date", "date")])
    assert out.count() == 0


def test_year_reload_on_timestamp_and_text(spark):
    df = spark.createDataFrame([
        (1, datetime(2023, 12, 31, 23, 59), "2023"), (2, datetime(2024, 1, 1, 0, 0), "2024"),
        (3, None, None), (4, datetime(2024, 6, 1), "bad")], "id int, ts timestamp_ntz, y string")
    tgt = spark.createDataFrame([(9, datetime(2024, 3, 3), "2024")], "id int, ts timestamp_ntz, y string")
    out = rewrite.year_reload(tgt, df, "ts", 2024)
    assert rows(out, "id") == [(2,), (4,)]
    out_text = rewrite.year_reload(tgt, df.filter("y <> 'bad' or y is null"), "y", 2024)
    assert rows(out_text, "id") == [(2,)]
    with pytest.raises(Exception, match="not a year"):   # like a cast, not left out without a word
        rewrite.year_reload(tgt, df, "y", 2024).collect()


def test_full_load_truncate_and_append(spark):
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([(2,)], "id int")
    assert rows(rewrite.full_load(a, b, truncate=True), "id") == [(2,)]
    assert rows(rewrite.full_load(a, b, truncate=False), "id") == [(1,), (2,)]


def test_inserted_rows_take_target_types(spark):
    from decimal import Decimal
    target = spark.createDataFrame([("a", date(2024, 1, 20), "X", 1, Decimal("1.50"))],
                                   "unique_key string, txn_date date, agent_code string, "
                                   "deposit_cases int, deposit_amount decimal(18,2)")
    source = spark.createDataFrame([("n", date(2024, 1, 29), "X", 2, 2.345)],
                                   "unique_key string, txn_date date, agent_code string, "
                                   "deposit_cases bigint, deposit_amount double")
    out = rewrite.replace_recent_days(target, source, SyncSpec(values=["X"], activity_columns=ACT),
                                      date(2024, 1, 31), RUN)
    assert dict(out.dtypes)["deposit_amount"] == "decimal(18,2)"
    assert dict(out.dtypes)["deposit_cases"] == "int"


def test_stamp_is_wall_clock_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        target = spark.createDataFrame([("a", date(2024, 1, 20), "X", 1, None)], SCHEMA)
        out = rewrite.replace_recent_days(target, target.limit(0), SyncSpec(values=["X"], activity_columns=ACT),
                                          date(2024, 1, 31), RUN, stamp_type="timestamp_ntz")
        assert out.first().last_synced_at == RUN
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("prune", [True, False])
def test_upsert_moves_a_key_from_a_row_without_a_date(spark, prune):
    target = spark.createDataFrame([("k1", None), ("k2", date(2024, 1, 5)), ("k3", None)], "k string, d date")
    source = spark.createDataFrame([("k1", date(2024, 2, 3))], "k string, d date")
    out = rewrite.upsert_window(target, source, "k", "d", date(2024, 2, 1), date(2024, 3, 1), ["d"],
                                datetime(2024, 3, 1), prune_days=prune)
    assert sorted((r.k, r.d) for r in out.collect() if r.d) == [("k1", date(2024, 2, 3)), ("k2", date(2024, 1, 5))]
    assert [r.k for r in out.collect() if r.d is None] == ["k3"]


def test_text_years_that_are_none_raise(spark):
    from factkeeper.functions.predicates import year_is, year_of
    good = spark.createDataFrame([("2023",), (" 2024 ",), (None,)], "y string")
    assert good.filter(year_is(good, "y", 2023)).count() == 1
    for text in ("n/a", "2023.0"):
        bad = spark.createDataFrame([("2023",), (text,)], "y string")
        with pytest.raises(Exception, match="not a year"):
            bad.filter(year_is(bad, "y", 2023)).collect()
        with pytest.raises(Exception, match="not a year"):
            bad.select(year_of(bad, "y")).collect()
