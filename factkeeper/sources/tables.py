"""Table access and schema contracts.

Reads are lazy; every filter/projection applied afterwards reaches the parquet
scan through Catalyst (``PushedFilters`` / ``ReadSchema``), so there is no
separate "select these columns" API.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factkeeper.session import ship_package


class MissingColumns(ValueError):
    """Raised when a frame lacks required columns; names every one of them."""


def read_table(spark: SparkSession, name: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """One partitioned scan of a table.

    ``fmt='table'`` reads a catalog table; ``'jdbc'`` expects the usual reader
    options (url, dbtable, partitionColumn, lowerBound, upperBound,
    numPartitions, fetchsize) so the remote table is read in parallel slices
    instead of one paged cursor.
    """
    if fmt == "table":
        return spark.table(name)
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "jdbc":
        return reader.load()
    return reader.load(name)


def _split_counts(batches):
    """For each byte range of a file, from its lines: whether it holds an odd number of quotes, and
    how many rows end in it if it starts outside quotes, and if it starts inside."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = ["file", "start", "odd", "outside", "inside"]
    at, odd, ends = None, 0, [0, 0]

    def row():
        return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([odd], pa.int32()),
                                           pa.array([ends[0]], pa.int64()), pa.array([ends[1]], pa.int64())], names)

    for b in batches:
        start = b.column("start").to_numpy()
        file = b.column("file").dictionary_encode()
        edges = np.flatnonzero((np.diff(start) != 0) | (np.diff(file.indices.to_numpy()) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, b.num_rows]):
            if lo == hi:
                continue
            this = (b.column("file")[int(lo)].as_py(), int(start[lo]))
            if this != at:
                if at is not None:
                    yield row()
                at, odd, ends = this, 0, [0, 0]
            lines = b.column("value").slice(lo, hi - lo)
            after = (odd + np.cumsum(pc.count_substring(lines, '"').to_numpy())) % 2
            said = pc.binary_length(lines).to_numpy() > 0    # an empty line outside quotes is no row
            ends[0] += int(((after == 0) & said).sum())
            ends[1] += int(((after == 1) & said).sum())
            odd = int(after[-1])
    if at is not None:
        yield row()


def csv_row_count(spark: SparkSession, path: str, header: bool = True,
                  quoted_newlines: bool = True) -> DataFrame:
    """S3: data rows in a CSV file/folder; quoted newlines belong to one row.

    A large file is split. Whether a line break stands inside quotes depends on all quotes before
    it, so each byte range counts its rows for both cases and says whether it flips them; a
    prefix over a file's ranges, one row each, then tells which count holds. Quotes stand around
    fields, doubled inside (RFC 4180). Where the writer made no such line breaks,
    ``quoted_newlines=False`` leaves it to Spark's line-wise reader.

    Returned as a one-row frame (``rows``) so it composes with other checks.
    """
    if not quoted_newlines:
        df = spark.read.option("header", header).option("escape", '"').csv(path)
        return df.agg(F.count(F.lit(1)).alias("rows"))
    ship_package(spark)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("start"))
    ranges = lines.mapInArrow(_split_counts, "file string, start long, odd int, outside long, inside long")
    before = F.coalesce(F.sum("odd").over(Window.partitionBy("file").orderBy("start").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)) % 2
    counted = ranges.withColumn("n", F.when(before == 0, F.col("outside")).otherwise(F.col("inside")))
    files = counted.groupBy("file").agg((F.sum("n") + F.sum("odd") % 2 - F.lit(int(header))).alias("n"))   # an open row at the end is one
    return files.agg(F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)).cast("bigint").alias("rows"))


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog lookup."""
    return spark.catalog.tableExists(name)


def column_type(df: DataFrame, col: str) -> T.DataType | None:
    """Data type of a column, None if absent."""
    return df.schema[col].dataType if col in df.columns else None


def column_nullable(df: DataFrame, col: str) -> bool | None:
    return df.schema[col].nullable if col in df.columns else None


def require_columns(df: DataFrame, cols, what: str = "table") -> DataFrame:
    """Abort naming every missing column; no Spark job is run."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns(f"{what} lacks column(s): {', '.join(missing)}")
    return df


# Database type names and the Spark type they map to; any
# other name maps to text.
TYPE_MAP = {
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "numeric": T.DecimalType(38, 18),
    "real": T.FloatType(),
    "double precision": T.DoubleType(),
    "boolean": T.BooleanType(),
    "character": T.StringType(),
    "character varying": T.StringType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "timestamp with time zone": T.TimestampType(),
}


def to_struct(columns_meta: list[dict]) -> T.StructType:
    """``[{name, data_type, is_nullable, numeric_precision, numeric_scale}]``
    (an ``information_schema.columns`` extract) → ``StructType``.

    NUMERIC keeps precision/scale when the catalog gives them.
    """
    fields = []
    for m in columns_meta:
        name = m["name"]
        dtype_name = str(m.get("data_type", "text")).lower()
        dtype = TYPE_MAP.get(dtype_name, T.StringType())
        if dtype_name == "numeric" and m.get("numeric_precision"):
            dtype = T.DecimalType(int(m["numeric_precision"]), int(m.get("numeric_scale") or 0))
        nullable = str(m.get("is_nullable", "YES")).upper() != "NO"
        fields.append(T.StructField(name, dtype, nullable))
    return T.StructType(fields)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast/reorder ``df`` to ``schema``; absent columns become typed NULLs. A NULL in a
    column that is NOT NULL raises."""
    cols = []
    for f in schema.fields:
        c = (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"{f.name} is NULL")).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def ensure_column(df: DataFrame, name: str, dtype, default: Column | None = None) -> DataFrame:
    """Add ``name`` if absent; with ``default`` NULLs are stamped too."""
    if name not in df.columns:
        df = df.withColumn(name, F.lit(None).cast(dtype))
    if default is not None:
        df = df.withColumn(name, F.coalesce(F.col(name), default.cast(dtype)))
    return df
