"""Export queries (E1-E8, P7, O2, S3): write to a fresh folder under the
shared checkpoint root, read the files back, return the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factkeeper.plans import catalog
from factkeeper.plans.testmodel import table
from factkeeper.session import scratch_path
from factkeeper.sinks import csv_export as E
from factkeeper.sources.tables import csv_row_count

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def _orders(spark, sf):
    return catalog._orders(spark, sf)


def export_year_slices(spark: SparkSession, sf: str) -> DataFrame:
    path = E.export_by_year(_orders(spark, sf), "o_orderdate", scratch_path(spark, "by-year"),
                            order_cols=["o_orderkey"], bom=True)
    schema = T.StructType(ORDERS_SCHEMA.fields + [T.StructField("_year", T.IntegerType())])
    return E.read_back(spark, path, schema).withColumnRenamed("_year", "year")


def export_month(spark, sf):
    path = E.export_month(_orders(spark, sf), "o_orderdate", "2001-07", scratch_path(spark, "month"),
                          "orders", order_cols=["o_orderdate", "o_orderkey"])
    return E.read_back(spark, path, ORDERS_SCHEMA)


LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


def export_capped_parts(spark, sf):
    """Parts of at most 5,000 data rows each (header in every part);
    the rows read back must be the whole table."""
    lineitem = table(spark, sf, "lineitem").select(*LINEITEM_SCHEMA.fieldNames())
    path = E.export_period(lineitem, None, None, scratch_path(spark, "capped"),
                           order_cols=["l_orderkey", "l_linenumber"], max_rows_per_file=5000)
    return E.read_back(spark, path, LINEITEM_SCHEMA)


def share_export(spark, sf):
    orders = _orders(spark, sf)
    drop = ["o_custkey", "user_key", "userkey", "user_unique"]
    path = E.share_export(orders, scratch_path(spark, "share"), drop_cols=drop,
                          order_cols=["o_orderkey"])
    cols = [c for c in orders.columns if c not in drop]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    back = E.read_back(spark, path, schema)
    return back.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])


def export_new_depositors(spark, sf):
    firsts = catalog.new_depositors(spark, sf)
    path = E.export_by_year(firsts, "first_deposit_date", scratch_path(spark, "new-depositors"),
                            order_cols=["user_id"], bom=False)
    schema = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("first_deposit_date", T.DateType()),
                           T.StructField("first_deposit_amount", T.DoubleType()),
                           T.StructField("_year", T.IntegerType())])
    return E.read_back(spark, path, schema).withColumnRenamed("_year", "year")


def period_filter(spark, sf):
    orders = _orders(spark, sf).withColumn("o_year", F.year("o_orderdate").cast("int"))
    return E.period_filter(orders, "o_year", 1998)


def period_values(spark, sf):
    orders = _orders(spark, sf).withColumn("o_year", F.year("o_orderdate").cast("int"))
    return E.period_values(orders, "o_year")


def csv_rows(spark, sf):
    """S3: count the rows of a CSV whose text fields hold line breaks."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = E.write_csv(docs, scratch_path(spark, "docs-csv"), order_cols=["doc_id"])
    return csv_row_count(spark, path)


def sync_run_log(spark, sf):
    """Run a windowed replace, write the synced rows (counted while
    writing) and return the run-log row."""
    from factkeeper.functions.time_windows import recent_days
    from factkeeper.operators import rewrite
    from factkeeper.plans.testmodel import ORDERS_AS_OF, RUN_TS
    orders = _orders(spark, sf)
    spec = rewrite.SyncSpec(date_column="o_orderdate", filter_column="o_orderpriority",
                            values=["1-URGENT", "2-HIGH"], activity_columns=["o_totalprice"])
    start, end = recent_days(ORDERS_AS_OF, spec.days_back)
    rows = E.write_counted(rewrite.sync_rows(orders, spec, start, end), scratch_path(spark, "sync"))
    return E.run_log_row(spark, "usc", "orders", "orders_copy", f"{start} .. {end}", rows,
                         RUN_TS, RUN_TS, "OK")


def schema_conform(spark, sf):
    """Check the contract, build the target schema from a column
    catalog extract and cast the table to it (absent columns become NULL)."""
    from factkeeper.sources.tables import conform, require_columns, to_struct
    orders = require_columns(_orders(spark, sf), ["o_orderkey", "o_totalprice", "o_orderdate"])
    catalog_rows = [
        {"name": "o_orderkey", "data_type": "bigint", "is_nullable": "NO"},
        {"name": "o_totalprice", "data_type": "numeric", "numeric_precision": 18, "numeric_scale": 2},
        {"name": "o_orderdate", "data_type": "date"},
        {"name": "o_orderpriority", "data_type": "character varying"},
        {"name": "o_comment", "data_type": "text"},
    ]
    out = conform(orders, to_struct(catalog_rows))
    return out.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


def utf8_decode(spark, sf):
    """text stored as bytes, decoded back (hex when not valid UTF-8)."""
    from factkeeper.functions.scalar import utf8_or_hex
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("raw"))
    return docs.select("doc_id", utf8_or_hex("raw").alias("text"))


QUERIES = {
    "sync_run_log": sync_run_log,
    "schema_conform": schema_conform,
    "utf8_decode": utf8_decode,
    "export_year_slices": export_year_slices,
    "export_month": export_month,
    "export_capped_parts": export_capped_parts,
    "share_export": share_export,
    "export_new_depositors": export_new_depositors,
    "period_filter": period_filter,
    "period_values": period_values,
    "csv_row_count": csv_rows,
}

_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def oracle_sql() -> dict[str, str]:
    return {
        "export_year_slices": f"select {_ORDER_COLS}, cast(year(o_orderdate) as integer) as year "
                              f"from orders where o_orderdate is not null",
        "export_month": f"select {_ORDER_COLS} from orders where o_orderdate >= timestamp '2001-07-01' "
                        f"and o_orderdate < timestamp '2001-08-01'",
        "export_capped_parts": "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
                               "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
                               "l_shipdate from lineitem",
        "share_export": "select coalesce(cast(o_orderkey as varchar), '') as o_orderkey, "
                        "coalesce(cast(o_orderstatus as varchar), '') as o_orderstatus, "
                        "coalesce(cast(o_totalprice as varchar), '') as o_totalprice, "
                        "coalesce(cast(o_orderdate as varchar), '') as o_orderdate, "
                        "coalesce(cast(o_orderpriority as varchar), '') as o_orderpriority from orders",
        "export_new_depositors": """
select user_id, cast(ts as date) as first_deposit_date, value as first_deposit_amount,
  cast(year(ts) as integer) as year from (
  select user_id, ts, value, row_number() over (partition by user_id order by ts, event_id) as rn
  from events where event_type = 'purchase' and user_id is not null) where rn = 1""",
        "period_filter": f"select {_ORDER_COLS}, cast(year(o_orderdate) as integer) as o_year "
                         f"from orders where cast(year(o_orderdate) as integer) = 1998",
        "period_values": "select distinct cast(year(o_orderdate) as integer) as period from orders "
                         "where o_orderdate is not null",
        "csv_row_count": "select count(*) as rows from documents",
        "sync_run_log": """
select 'usc' as market, 'orders' as source, 'orders_copy' as target,
  '2001-07-29 .. 2001-08-01' as date_range, count(*) as rows_inserted,
  timestamp '2024-02-01 06:00:00' as started, timestamp '2024-02-01 06:00:00' as finished,
  'OK' as status, '' as message
from orders where o_orderdate >= timestamp '2001-07-29' and o_orderdate < timestamp '2001-08-01'
  and o_orderpriority in ('1-URGENT', '2-HIGH') and coalesce(o_totalprice, 0) > 0""",
        "schema_conform": "select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice, "
                          "cast(o_orderdate as date) as o_orderdate, o_orderpriority, "
                          "cast(null as varchar) as o_comment from orders",
        "utf8_decode": "select doc_id, text from documents",
    }
