"""Properties of the rewrites: rows outside the window are
unchanged, every update-from keeps the row count, upsert leaves unique keys."""

from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from factkeeper.operators import rewrite, update
from factkeeper.session import scale_conf

RUN = datetime(2024, 2, 1)
DAY0 = date(2024, 1, 1)
rows_st = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 20), st.integers(-3, 5)),
                   min_size=0, max_size=25)
SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    data = [(f"k{k}", DAY0 + timedelta(days=d), v) for k, d, v in rows]
    return spark.createDataFrame(data, "k string, d date, v int")


@SETTINGS
@given(target=rows_st, source=rows_st)
def test_outside_window_unchanged_and_upsert_unique(spark, target, source):
    target = list({k: (k, d, v) for k, d, v in target}.values())   # the table's keys are unique
    t, s = frame(spark, target), frame(spark, source)
    lo, hi = DAY0 + timedelta(days=5), DAY0 + timedelta(days=10)
    out = rewrite.upsert_window(t, s, "k", "d", lo, hi, ["d", "v"], RUN)
    keys = [r.k for r in out.collect()]
    assert len(keys) == len(set(keys))                     # unique keys after upsert
    spec = rewrite.SyncSpec(date_column="d", filter_column="k", mode="all", activity_columns=["v"])
    rep = rewrite.window_replace(t, s, spec, lo, hi, RUN)
    outside = sorted(tuple(r) for r in rep.filter((rep.d < lo) | (rep.d >= hi)).select("k", "d", "v").collect())
    before = sorted(tuple(r) for r in t.filter((t.d < lo) | (t.d >= hi)).collect())
    if s.filter((s.d >= lo) & (s.d < hi)).count() or spec.values:
        assert outside == before


@SETTINGS
@given(target=rows_st, source=rows_st)
def test_update_from_keeps_row_count(spark, target, source):
    t, s = frame(spark, target), frame(spark, source)
    out = update.update_from(t, s, ["k"], {"v": "v"}, newest=["d"])
    assert out.count() == t.count()
    out2 = update.backfill(t, s, "k", ["v"], newest=["d"])
    assert out2.count() == t.count()


def test_scale_conf_bounds():
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "200"
    assert int(scale_conf(20 * (1 << 40))["spark.sql.shuffle.partitions"]) == 163840
