"""Recency per key, re-ageing, changed-key refresh and the streaming upkeep."""

import os
from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from factkeeper.operators import recency
from factkeeper.plans import testmodel as tm

SF = "/root/testdata/sf0.001"


def test_recency_cases(spark):
    df = spark.createDataFrame([
        ("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 5), None),   # NULL cases: not a deposit
        ("b", date(2024, 1, 3), 0),                                   # never deposited
        (None, date(2024, 1, 9), 3),                                  # NULL key untouched
    ], "userkey string, date date, deposit_cases int")
    out = recency.recency(df, "userkey", date(2024, 1, 10))
    got = {(r.userkey, r.date): (r.last_activity_days, r.last_deposit_date, r.days_inactive)
           for r in out.collect()}
    assert got[("a", date(2024, 1, 1))] == (date(2024, 1, 5), date(2024, 1, 1), 9)
    assert got[("b", date(2024, 1, 3))] == (date(2024, 1, 3), None, None)
    assert got[(None, date(2024, 1, 9))] == (None, None, None)
    again = recency.reage(out, date(2024, 1, 20))
    assert {r.userkey: r.days_inactive for r in again.collect() if r.userkey == "a"}["a"] == 19


def test_refresh_changed_equals_full_recompute(spark):
    base = spark.createDataFrame([
        ("A", date(2024, 1, 1), 1), ("A", date(2024, 1, 7), 1),
        ("B", date(2024, 1, 2), 1), ("C", date(2024, 1, 3), 1)], "userkey string, date date, deposit_cases int")
    as_of = date(2024, 1, 10)
    stamped = recency.recency(base, "userkey", as_of)
    # row of A on 01-07 moves to B (key change); newest row of C is deleted.
    moved = stamped.filter(~((F.col("userkey") == "A") & (F.col("date") == date(2024, 1, 7))))
    moved = moved.filter(F.col("userkey") != "C")
    moved = moved.unionByName(spark.createDataFrame([("B", date(2024, 1, 7), 1)],
                                                    "userkey string, date date, deposit_cases int"),
                              allowMissingColumns=True)
    changes = spark.createDataFrame([("B", "A"), (None, "C")], "new_key string, old_key string")
    out = recency.refresh_changed(moved, recency.changed_keys(changes), "userkey", as_of)
    full = recency.recency(moved.select("userkey", "date", "deposit_cases"), "userkey", as_of)
    cols = ["userkey", "date", "last_activity_days", "last_deposit_date", "days_inactive"]
    assert sorted(out.select(*cols).collect()) == sorted(full.select(*cols).collect())
    a = [r for r in out.collect() if r.userkey == "A"][0]
    assert a.last_activity_days == date(2024, 1, 1)   # date goes back after the move


def test_stream_in_several_batches_equals_batch(spark, tmp_path):
    events = pd.read_parquet(f"{SF}/events.parquet")
    src = tmp_path / "incoming"
    src.mkdir()
    for i, part in enumerate([events.iloc[i::3] for i in range(3)]):   # interleaved: same days in every file
        part.to_parquet(src / f"events-{i}.parquet", index=False)
    from factkeeper.streaming.recency_stream import recency_stream
    as_of = date(2024, 2, 1)
    out = recency_stream(spark, str(src), as_of, tm.event_stream(), glob="events-*.parquet",
                         state_root=str(tmp_path / "state"), max_files_per_trigger=1)
    batch = recency.recency(tm.staging(spark, SF), "user_unique", as_of)
    cols = ["unique_key", "user_unique", "date", "deposit_cases", "deposit_amount", "unique_code",
            "last_activity_days", "last_deposit_date", "days_inactive"]
    assert sorted(out.select(*cols).collect()) == sorted(batch.select(*cols).collect())
    versions = [p for p in os.listdir(tmp_path / "state" / "keys") if p.startswith("v=")]
    assert len(versions) == 2   # one version per micro-batch, the two newest kept
    epochs = {p.name for p in (tmp_path / "state" / "daily").glob("date=*/epoch=*")}
    assert epochs == {"epoch=0", "epoch=1", "epoch=2"}


def test_replayed_epoch_is_skipped(spark, tmp_path):
    from factkeeper.streaming.recency_stream import RecencyState
    events = spark.read.parquet(f"{SF}/events.parquet")
    state = RecencyState(spark, str(tmp_path / "st"), tm.event_stream())
    state.fold(events, 0)
    state.fold(events, 0)          # replay after a failure: no double counting
    out = state.read(date(2024, 2, 1))
    batch = recency.recency(tm.staging(spark, SF), "user_unique", date(2024, 2, 1))
    cols = ["unique_key", "deposit_cases", "deposit_amount", "last_deposit_date"]
    assert sorted(out.select(*cols).collect()) == sorted(batch.select(*cols).collect())


def test_trailing_reload_takes_rows_back(spark, tmp_path):
    """Another schema than the test model's; a vanished row, a vanished day and a new one."""
    from factkeeper.streaming.recency_stream import RecencyState, StreamModel

    def add_up(df):
        return df.groupBy("who", "day").agg(F.sum("cases").alias("cases"))

    model = StreamModel(add_up, add_up, key="who", date="day", cases="cases")
    d = lambda n: date(2024, 1, n)
    frame = lambda rows: spark.createDataFrame(rows, "who string, day date, cases long")
    root = str(tmp_path / "st")
    RecencyState(spark, root, model).fold(frame([("a", d(1), 1), ("a", d(9), 1), ("b", d(8), 1), ("b", d(2), 0), ("c", d(9), 2)]), 0)
    source = frame([("c", d(9), 1)])                      # a's row and the whole 8th are gone
    state = RecencyState(spark, root, model, reload=lambda: ([d(8), d(9)], source))
    state.fold(frame([("e", d(3), 0), ("z", d(9), 5)]), 1)  # z isn't in the source, so its day's row goes
    want = [("a", d(1), 1, d(1), d(1)), ("b", d(2), 0, d(2), None), ("c", d(9), 1, d(9), d(9)), ("e", d(3), 0, d(3), None)]
    cols = ["who", "day", "cases", "last_activity_days", "last_deposit_date"]
    assert sorted(map(tuple, state.read(d(10)).select(*cols).collect())) == want
    state.compact(d(9))
    assert sorted(map(tuple, state.read(d(10)).select(*cols).collect())) == want


def test_compaction_leaves_one_file_a_closed_day(spark, tmp_path):
    from factkeeper.streaming.recency_stream import RecencyState, StreamModel

    def add_up(df):
        return df.groupBy("who", "day").agg(F.sum("cases").alias("cases"))

    model = StreamModel(add_up, add_up, key="who", date="day", cases="cases")
    d = lambda n: date(2024, 1, n)
    frame = lambda rows: spark.createDataFrame(rows, "who string, day date, cases long")
    root = tmp_path / "st"
    state = RecencyState(spark, str(root), model)
    files = lambda: sorted(str(p.parent.relative_to(root)) for p in root.glob("*/day=*/epoch=*/*.parquet"))
    for epoch in range(6):
        state.fold(frame([("a", d(k), 1) for k in (1, 2, 3)] + [("b", d(epoch + 1), 0)]), epoch)
    before = sorted(map(tuple, state.read(d(10)).collect()))
    assert len(files()) >= 18
    state.compact(d(3))
    assert sorted(map(tuple, state.read(d(10)).collect())) == before
    assert [f for f in files() if "day=2024-01-01" in f or "day=2024-01-02" in f] == [f"whole/day=2024-01-0{k}/epoch=5" for k in (1, 2)]
    state.fold(frame([("a", d(1), 7), ("c", d(9), 1)]), 6)     # a late row of a closed day
    state.fold(frame([]), 6)                                   # a replayed epoch
    assert {r.cases for r in state.read(d(10)).filter("who = 'a' and day = '2024-01-01'").collect()} == {13}
    state.compact(d(10))
    assert len(files()) == len(set(files())) == 7 and all(f.startswith("whole/") for f in files())
    assert {r.cases for r in state.read(d(10)).filter("who = 'a' and day = '2024-01-01'").collect()} == {13}


def test_reloads_do_not_pile_up_files(spark, tmp_path):
    from factkeeper.streaming.recency_stream import RecencyState, StreamModel

    def add_up(df):
        return df.groupBy("who", "day").agg(F.sum("cases").alias("cases"))

    model = StreamModel(add_up, add_up, key="who", date="day", cases="cases")
    d = lambda n: date(2024, 1, n)
    frame = lambda rows: spark.createDataFrame(rows, "who string, day date, cases long")
    root = tmp_path / "st"
    state = RecencyState(spark, str(root), model, reload=lambda: ([d(8), d(9)], frame([("a", d(8), 2), ("b", d(9), 1)])))
    for epoch in range(5):
        state.fold(frame([("z", d(9), 1)]), epoch)
    assert len(list(root.glob("*/day=*/epoch=*"))) <= 4        # the last epoch's days, and those of the one before
    assert sorted((r.who, r.cases) for r in state.read(d(10)).collect()) == [("a", 2), ("b", 1)]
