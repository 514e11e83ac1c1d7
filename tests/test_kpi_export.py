"""KPI roll-up and report text, date functions, CSV exports."""

import glob
import os
import pytest
from datetime import date

from pyspark.sql import types as T

from pyspark.sql import functions as F
from factkeeper.functions.scalar import parse_date_multi, strict_concat
from factkeeper.functions.time_windows import month_window, yesterday_today
from factkeeper.operators import kpi, quality
from factkeeper.sinks import csv_export as E
from factkeeper.sources.tables import MissingColumns, csv_row_count, require_columns, to_struct


def test_kpi_null_amounts_and_null_line(spark):
    df = spark.createDataFrame([
        (date(2024, 1, 30), None, 1, None, None, None),
        (date(2024, 1, 30), "L1", None, None, None, 2),
        (date(2024, 1, 30), "L1", 2, 1234567.5, 10.25, 3),
    ], "txn_date date, line string, deposit_cases int, deposit_amount double, net_profit double, user_unique int")
    out = kpi.kpi_union({"t": df})
    got = {r.line: r for r in out.collect()}
    assert got[""].deposit_amount == 0.0 and got[""].deposit_cases == 1
    assert got["L1"].active_members == 1 and got["L1"].deposit_cases == 2
    rep = {r.line: r for r in kpi.kpi_report(out).collect()}
    assert rep["L1"].deposit_amount == "1,234,567.50"
    assert rep["L1"].txn_date == "2024/01/30"


def test_user_key_null_spreads(spark):
    df = spark.createDataFrame([("u", None, "L1"), ("u", "C1", "L1")], "a string, b string, c string")
    got = [r[0] for r in df.select(strict_concat("a", "b", "c")).collect()]
    assert got == [None, "u-C1-L1"]


def test_parse_dates_multi(spark):
    df = spark.createDataFrame([("2024-03-04",), ("2024/03/04",), ("04/03/2024",), ("03/25/2024",),
                                ("2024-03-04 10:11:12",), ("garbage",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_date_multi("s", date(2024, 1, 31))).collect()]
    assert got == [date(2024, 3, 4), date(2024, 3, 4), date(2024, 3, 4), date(2024, 3, 25),
                   date(2024, 3, 4), date(2024, 1, 31), date(2024, 1, 31)]


def test_windows():
    assert month_window(date(2024, 12, 15)) == (date(2024, 12, 1), date(2025, 1, 1))
    assert yesterday_today(date(2024, 3, 1)) == (date(2024, 2, 29), date(2024, 3, 2))


def test_contract_and_type_map(spark):
    df = spark.createDataFrame([(1,)], "a int")
    try:
        require_columns(df, ["a", "b", "c"])
        raise AssertionError("expected MissingColumns")
    except MissingColumns as e:
        assert "b, c" in str(e)
    st = to_struct([{"name": "x", "data_type": "numeric", "numeric_precision": 18, "numeric_scale": 2,
                     "is_nullable": "NO"}, {"name": "y", "data_type": "geometry"}])
    assert st["x"].dataType == T.DecimalType(18, 2) and not st["x"].nullable
    assert st["y"].dataType == T.StringType()


def test_csv_bom_nulls_quotes_and_count(spark, tmp_out):
    df = spark.createDataFrame([(1, "ភាសាខ្មែរ", None), (2, "", "a,b"), (3, "two\nlines", "q\"x")],
                               "id int, text string, note string")
    path = E.write_csv(df, f"{tmp_out}/t", order_cols=["id"], bom=True, parts=1)
    files = sorted(glob.glob(f"{path}/part-*.csv"))
    raw = open(files[0], "rb").read()
    assert raw.startswith(b"\xef\xbb\xbf")
    text = raw.decode("utf-8-sig")
    assert text.splitlines()[0] == "id,text,note"
    assert "1,ភាសាខ្មែរ," in text and "2,,\"a,b\"" in text
    assert csv_row_count(spark, path).first()[0] == 3


def test_row_cap_parts_have_header(spark, tmp_out):
    df = spark.range(11).withColumnRenamed("id", "n")
    path = E.export_period(df, None, None, f"{tmp_out}/cap", order_cols=["n"], bom=False,
                           max_rows_per_file=5)
    files = sorted(glob.glob(f"{path}/part-*.csv"))
    sizes = [len(open(f).read().splitlines()) - 1 for f in files]
    assert sizes == [5, 5, 1]
    assert [int(x) for f in files for x in open(f).read().splitlines()[1:]] == list(range(11))
    assert all(open(f).readline().strip() == "n" for f in files)


def test_export_by_year_leaves_out_null_year(spark, tmp_out):
    df = spark.createDataFrame([(1, date(2023, 12, 31)), (2, date(2024, 1, 1)), (3, None)],
                               "id int, d date")
    path = E.export_by_year(df, "d", f"{tmp_out}/y", order_cols=["id"], bom=False)
    years = sorted(os.path.basename(p) for p in glob.glob(f"{path}/_year=*"))
    assert years == ["_year=2023", "_year=2024"]
    back = E.read_back(spark, path, T.StructType([T.StructField("id", T.IntegerType()),
                                                  T.StructField("d", T.DateType()),
                                                  T.StructField("_year", T.IntegerType())]))
    assert sorted((r.id, r._year) for r in back.collect()) == [(1, 2023), (2, 2024)]


def test_period_filter_falls_back_to_all(spark):
    df = spark.createDataFrame([(2023,), (2024,)], "y int")
    assert E.period_filter(df, "y", 2024).count() == 1
    assert E.period_filter(df, "missing", 2024).count() == 2
    assert E.period_filter(df, "y", None).count() == 2
    assert E.period_filter(df, "y", 1999).count() == 2


def test_share_ready_text(spark):
    df = spark.createDataFrame([(1, None, "k")], "a int, b double, user_key string")
    out = E.share_ready(df, ["user_key", "not_there"])
    assert out.columns == ["a", "b"] and out.first() == ("1", "")


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "k int, l int")
    dup = quality.duplicate_keys(df, ["k", "l"]).collect()
    assert [(r.k, r.l, r.n) for r in dup] == [(1, 1, 2)]
    rec = quality.reconcile(df, df.dropDuplicates()).first()
    assert (rec.source_rows, rec.target_rows, rec.difference) == (5, 3, 2)


def test_day_runs():
    from factkeeper.functions.predicates import day_runs
    d = date
    assert day_runs([d(2024, 1, 3), d(2024, 1, 1), d(2024, 1, 2), d(2024, 1, 5)]) == [
        (d(2024, 1, 1), d(2024, 1, 4)), (d(2024, 1, 5), d(2024, 1, 6))]


def test_export_month_empty_variants(spark, tmp_out):
    df = spark.createDataFrame([(1, date(2024, 1, 5))], "id int, d date")
    assert E.export_month(df, "d", "2024-02", tmp_out, "t", write_if_empty=False) is None
    path = E.export_month(df, "d", "2024-02", tmp_out, "t", order_cols=["id"], bom=False)
    assert path.endswith("t_202402")
    text = "".join(open(f).read() for f in glob.glob(f"{path}/part-*.csv"))
    assert text.strip() == "id,d"   # header only
    dec = E.export_month(df, "d", "2024-01", tmp_out, "t", order_cols=["id"], bom=False)
    assert dec.endswith("t_202401")


def test_money_is_exact_at_every_scale(spark):
    from decimal import Decimal
    from factkeeper.operators.kpi import money
    fine = spark.range(1000).select(F.lit("0.004").cast("decimal(10,4)").alias("a"), F.lit(0.004).alias("f"),
                                    F.lit("1234567890123456.78").cast("decimal(18,2)").alias("b"))
    got = fine.agg(money(fine, "a").alias("a"), money(fine, "f").alias("f"), money(fine, "b").alias("b")).first()
    assert (got.a, got.f, got.b) == (Decimal("4.0000"), Decimal("4"), Decimal("1234567890123456780.00"))
    big = spark.createDataFrame([(123456789012345678,)], "a long")
    assert big.agg(money(big, "a").alias("a")).first().a == 123456789012345678


def test_a_period_that_is_none_gives_all_rows(spark):
    from factkeeper.sinks.csv_export import period_filter
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "k int, p int")
    assert period_filter(df, "p", "abc").count() == 2
    assert period_filter(df, "p", "2024").count() == 1 and period_filter(df, "p", "2022").count() == 2


def test_unpadded_dates(spark):
    df = spark.createDataFrame([("2024-1-5",), ("2024/1/5",), ("5/1/2024",), ("1/25/2024",), ("05/01/2024 1:2",), ("x",)], "s string")
    d = date(2024, 1, 5)
    assert [r[0] for r in df.select(parse_date_multi("s", date(2024, 1, 31))).collect()] == [
        d, d, d, date(2024, 1, 25), d, date(2024, 1, 31)]


def test_catalog_lookups_and_table_scan(spark):
    from factkeeper.sources import tables
    spark.sql("drop table if exists fk_lookup")
    spark.createDataFrame([(1, "a")], "k int, v string").write.saveAsTable("fk_lookup")
    try:
        assert tables.table_exists(spark, "fk_lookup") and not tables.table_exists(spark, "fk_none")
        df = tables.read_table(spark, "fk_lookup", "table")
        assert tables.column_type(df, "k").simpleString() == "int" and tables.column_type(df, "z") is None
        assert tables.column_nullable(df, "v") is True and tables.column_nullable(df, "z") is None
    finally:
        spark.sql("drop table fk_lookup")


def test_conform_enforces_not_null(spark):
    from factkeeper.sources import tables
    schema = tables.to_struct([{"name": "k", "data_type": "integer", "is_nullable": "NO"}, {"name": "v", "data_type": "text"}])
    good = spark.createDataFrame([("1",)], "k string")
    assert [tuple(r) for r in tables.conform(good, schema).collect()] == [(1, None)]
    with pytest.raises(Exception, match="k is NULL"):
        tables.conform(spark.createDataFrame([(None,)], "k string"), schema).collect()


def test_utf8_or_hex(spark):
    from factkeeper.functions.scalar import utf8_or_hex
    df = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"\xff\xfe"),), (None,)], "b binary")
    assert [r[0] for r in df.select(utf8_or_hex("b")).collect()] == ["ok", "FFFE", None]


def test_csv_rows_with_and_without_quoted_newlines(spark, tmp_path):
    from factkeeper.sources.tables import csv_row_count
    (tmp_path / "a.csv").write_text('k,v\n1,"two\nlines"\n2,x\n')
    assert csv_row_count(spark, str(tmp_path)).first()[0] == 2
    (tmp_path / "a.csv").write_text("k,v\n1,y\n2,x\n")
    assert csv_row_count(spark, str(tmp_path), quoted_newlines=False).first()[0] == 2


def test_parts_are_filled_in_order(spark, tmp_out):
    """All parts but the last hold exactly the limit, however the sorted ranges fall."""
    df = spark.range(1000).repartition(7).selectExpr("id % 10 as hot", "id", "concat('t', id) as t")
    path = E.write_csv(df, f"{tmp_out}/p", order_cols=["hot", "id"], max_rows_per_file=64)
    files = sorted(glob.glob(f"{path}/part-*.csv"))
    rows = [f_rows for f in files for f_rows in [open(f).read().splitlines()[1:]]]
    assert [len(r) for r in rows] == [64] * 15 + [40]
    got = [tuple(map(int, x.split(",")[:2])) for r in rows for x in r]
    assert got == sorted(got) and len(set(got)) == 1000
    shared = E.share_export(df, f"{tmp_out}/s", drop_cols=["t"], order_cols=["id"], max_rows_per_file=300)
    assert [len(open(f).read().splitlines()) - 1 for f in sorted(glob.glob(f"{shared}/part-*.csv"))] == [300, 300, 300, 100]
    empty = E.write_csv(df.limit(0), f"{tmp_out}/e", order_cols=["id"], max_rows_per_file=5)
    assert [open(f).read().strip() for f in glob.glob(f"{empty}/part-*.csv")] == ["hot,id,t"]


def test_a_split_csv_counts_like_the_multi_line_reader(spark, tmp_path):
    """Byte ranges of a few hundred bytes: breaks inside quotes, doubled quotes, blank lines."""
    import random
    rnd = random.Random(3)
    folder = tmp_path / "csv"
    folder.mkdir()
    for k in range(3):
        end = "\r\n" if k == 2 else "\n"
        out = [f"id,text,note{end}"]
        for i in range(200):
            said = "".join(rnd.choice(["a", "é", '""', "\n", ",", "\n\n", " "]) for _ in range(rnd.randint(0, 60)))
            out.append(f'{i},"{said}",{rnd.choice(["", "x", chr(34) * 2])}' + end + rnd.choice(["", "", end]))
        (folder / f"{k}.csv").write_bytes("".join(out).rstrip("\r\n" if k else "").encode())
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(folder))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("400", "1000", "100000"):
            spark.conf.set(key, size)
            assert csv_row_count(spark, str(folder)).first()[0] == reader.count() == 600
            assert csv_row_count(spark, str(folder), header=False).first()[0] == 603
        spark.conf.set(key, "400")
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20    # a file is counted by several tasks
    finally:
        spark.conf.set(key, before)
    (tmp_path / "open.csv").write_text('k,v\n1,"not closed\n2,x\n')
    assert csv_row_count(spark, str(tmp_path / "open.csv")).first()[0] == 1
    (tmp_path / "none.csv").write_text("")
    assert csv_row_count(spark, str(tmp_path / "none.csv")).first()[0] == 0
