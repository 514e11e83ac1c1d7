"""Safe replacement of a stored table (V1 and the writers of W*).

A job must never overwrite the folder it reads from (the overwrite deletes
the input half way). Each write therefore goes to a new version folder and
only then is it committed (a new marker file) — readers of the old version
are never disturbed (the "CONCURRENTLY" of a view refresh). Writers of a
date-partitioned table instead overwrite the partitions of the days they changed.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, _parse_datatype_string


class VersionedTable:
    """A parquet table stored as ``<root>/v=<id>/`` plus commit markers.

    A version becomes current when its marker ``<root>/_commits/<seq>_<id>``
    is created, after its data is completely written. Markers are only ever
    added (an atomic file create), never overwritten, so a reader sees either
    the old or the new version; the current version is the newest marker.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by=()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)
        self.last_rows: int | None = None

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def _commits(self) -> list[tuple[str, str]]:
        """(marker name, version id), oldest first."""
        fs, jvm = self._fs()
        marks = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_commits")
        if not fs.exists(marks):
            return []
        names = sorted(st.getPath().getName() for st in fs.listStatus(marks))
        return [(n, n.split("_", 1)[1]) for n in names if "_" in n]

    def current(self) -> str | None:
        commits = self._commits()
        return commits[-1][1] if commits else None

    def exists(self) -> bool:
        return self.current() is not None

    def read(self) -> DataFrame:
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"no version of {self.root} yet")
        return self.spark.read.parquet(f"{self.root}/v={version}")

    def write(self, df: DataFrame, version: str | None = None) -> str:
        """Write ``df`` as a new version, then commit it. The rows written are
        counted in the same job (``last_rows``)."""
        from pyspark.sql import Observation
        version = version or uuid.uuid4().hex
        obs = Observation("versioned_write")
        w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(f"{self.root}/v={version}")
        fs, jvm = self._fs()
        marker = f"{self.root}/_commits/{time.time_ns():020d}_{version}"
        fs.create(jvm.org.apache.hadoop.fs.Path(marker), False).close()
        self.last_rows = int(obs.get["rows"])
        return version

    def write_set(self, frames: dict, version: str | None = None) -> str:
        """Write several frames as parts of one version, then commit them with one marker."""
        version = version or uuid.uuid4().hex
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{self.root}/v={version}/{name}")
        fs, jvm = self._fs()
        marker = f"{self.root}/_commits/{time.time_ns():020d}_{version}"
        fs.create(jvm.org.apache.hadoop.fs.Path(marker), False).close()
        return version

    def read_part(self, name: str, version: str | None = None) -> DataFrame:
        """One part of a version written by ``write_set`` (default: the current one)."""
        return self.spark.read.parquet(f"{self.root}/v={version or self.current()}/{name}")

    def versions(self) -> list[str]:
        """Committed version ids, oldest first."""
        return [v for _, v in self._commits()]

    def prune(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` committed versions (data and
        marker); the current version is always kept."""
        commits = self._commits()
        old = commits[:-keep] if keep > 0 else commits[:-1]
        fs, jvm = self._fs()
        current = commits[-1][1] if commits else None
        dropped = []
        for marker, v in old:
            if v == current:
                continue
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/_commits/{marker}"), False)
            if v not in [c for _, c in commits[len(old):]]:
                fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/v={v}"), True)
            dropped.append(v)
        return dropped

    def refresh(self, query) -> str:
        """V1: ``REFRESH MATERIALIZED VIEW [CONCURRENTLY]``: run the view's
        query into a new version, readers switch when it is complete."""
        return self.write(query())


# -- days of a partitioned table ------------------------------------------------

# A target is the path of a parquet table partitioned by a date column, or the name of such a
# table in the catalog. Only Spark's own partition overwrite writes to it: the new files of a
# job are staged by Spark and take the place of the partitions that they belong to when the
# job commits, so ``df`` may read the target and jobs on other days don't meet.

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_OTHER_DAY = "row of a day that is not replaced"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path
    return p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _folder(date_col: str, day) -> str:
    return f"{date_col}={NULL_PARTITION if day is None else day}"


def in_catalog(target: str) -> bool:
    return "/" not in target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p(path))


def has_periods(spark: SparkSession, path: str, period: str) -> bool:
    """Whether a partitioned table has a partition."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p(path)) and any(x.getPath().getName().startswith(f"{period}=") for x in fs.listStatus(p(path)))


def read_days(spark: SparkSession, target: str) -> DataFrame:
    """The target, with the columns that were added to it."""
    if in_catalog(target):
        return spark.table(target)
    schema = _declared(spark, target)
    return spark.read.parquet(target) if schema is None else spark.read.schema(schema).parquet(target)


#: Beside the files of a target without a catalog: its schema, once a column was added.
_SCHEMA = "_schema.json"


def _declared(spark: SparkSession, path: str) -> StructType | None:
    fs, p = _hadoop(spark, path)
    if not fs.exists(p(f"{path}/{_SCHEMA}")):
        return None
    stream = fs.open(p(f"{path}/{_SCHEMA}"))
    try:
        return StructType.fromJson(json.loads(bytes(stream.readAllBytes())))
    finally:
        stream.close()


def add_column(spark: SparkSession, target: str, name: str, dtype: str, value: str) -> None:
    """Add a column whose rows so far have ``value`` (a SQL literal), without writing
    one of them: Spark fills it in where a file lacks the column, from the schema. Files
    that are written from now on hold it."""
    if in_catalog(target):
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({name} {dtype} DEFAULT {value})")
        return
    schema = read_days(spark, target).schema
    parts = [f for f in schema.fields if f.name in _partition_columns(spark, target)]
    rest = [f for f in schema.fields if f not in parts]
    added = StructField(name, _parse_datatype_string(dtype), True, {"EXISTS_DEFAULT": value, "CURRENT_DEFAULT": value})
    fs, p = _hadoop(spark, target)
    out = fs.create(p(f"{target}/{_SCHEMA}"), True)
    try:
        out.write(bytearray(StructType([*rest, added, *parts]).json().encode()))
    finally:
        out.close()


def _partition_columns(spark: SparkSession, path: str) -> set[str]:
    fs, p = _hadoop(spark, path)
    return {x.getPath().getName().split("=")[0] for x in fs.listStatus(p(path)) if x.isDirectory() and "=" in x.getPath().getName()}


@contextmanager
def _dynamic(spark: SparkSession):
    """``insertInto`` takes the mode from the session only."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def by_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of a period together, so that it gets few files; AQE splits large periods over tasks
    and puts small ones into one."""
    return df.hint("rebalance", period)


def _overwrite(df: DataFrame, target: str, date_col: str) -> None:
    spark = df.sparkSession
    if in_catalog(target):
        with _dynamic(spark):
            df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    else:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(target)


def drop_days(spark: SparkSession, target: str, date_col: str, days) -> None:
    """Remove partitions; those that are not there do no harm."""
    path = target
    if in_catalog(target):
        specs = [f"PARTITION ({date_col} = null)" if d is None else f"PARTITION ({date_col} = '{d}')" for d in days]
        for lo in range(0, len(specs), 100):
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {', '.join(specs[lo:lo + 100])}")
        path = _location(spark, target)
    fs, p = _hadoop(spark, path)
    for d in days:   # of a table that is only registered, the catalog leaves the files
        fs.delete(p(f"{path}/{_folder(date_col, d)}"), True)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def location(spark: SparkSession, target: str) -> str:
    return _location(spark, target) if in_catalog(target) else target.rstrip("/")


# -- key digests ----------------------------------------------------------------

# Beside a target, hidden from Spark's listing: for a key, the 64-bit hashes of each period's
# keys, sorted, in a table partitioned like the target. A period without a partition in it is
# one that nothing is known of. ``replace_days`` drops the digests of its periods first and writes
# them after, so a job that doesn't come to its end leaves unknown periods, never wrong ones.
_DIGEST = "_keys_"


def key_hash(key):
    return F.xxhash64(F.col(key).cast("string"))


def _digest_keys(spark: SparkSession, target: str) -> list[str]:
    path = location(spark, target)
    fs, p = _hadoop(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(p(path))] if fs.exists(p(path)) else []
    return [n[len(_DIGEST):] for n in names if n.startswith(_DIGEST)]


def _periods(spark: SparkSession, path: str, period: str) -> set[str]:
    """Folder names of a table's partitions."""
    fs, p = _hadoop(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(p(path))] if fs.exists(p(path)) else []
    return {n for n in names if n.startswith(f"{period}=")}


def _write_digest(rows: DataFrame, key: str, period: str, path: str) -> None:
    hashes = rows.filter(F.col(key).isNotNull()).select(key_hash(key).alias("h"), period)
    (by_period(hashes, period).sortWithinPartitions(period, "h").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path))


def periods_with(spark: SparkSession, target: str, key: str, period: str, keys: DataFrame) -> list:
    """The periods of ``target`` that may hold one of ``keys``: those whose digest holds its hash.

    Periods without a digest get one first, the only time that their key column is read."""
    path = f"{location(spark, target)}/{_DIGEST}{key}"
    table = read_days(spark, target)
    unknown = _periods(spark, location(spark, target), period) - _periods(spark, path, period)
    if unknown:
        names = [n.split("=", 1)[1] for n in unknown]
        old = F.col(period).cast("string").isin([n for n in names if n != NULL_PARTITION])
        if NULL_PARTITION in names:
            old = old | F.col(period).isNull()
        _write_digest(table.filter(old), key, period, path)
    if not has_periods(spark, path, period):
        return []
    wanted = keys.select(F.col(key).cast(table.schema[key].dataType).alias(key)).select(key_hash(key).alias("h")).distinct()
    held = spark.read.schema(StructType([StructField("h", LongType()), table.schema[period]])).parquet(path)
    return [r[0] for r in held.join(wanted, "h", "left_semi").select(period).distinct().collect()]   # periods


def replace_days(df: DataFrame, target: str, date_col: str, days) -> int:
    """Rewrite only the given days of ``target`` (None: the rows without a day); returns the
    number of rows written.

    ``df`` may read the target. A row of any other day fails the job before it commits, so
    nothing is touched. Days without rows lose their partition.
    """
    from pyspark.sql import Observation

    spark = df.sparkSession
    days = set(days)
    known = F.col(date_col).isin([d for d in days if d is not None])
    if None in days:
        known = known | F.col(date_col).isNull()
    other = F.raise_error(F.concat(F.lit(f"{_OTHER_DAY}: "), F.coalesce(F.col(date_col).cast("string"), F.lit("NULL"))))
    checked = df.withColumn(date_col, F.when(F.coalesce(known, F.lit(False)), F.col(date_col)).otherwise(other.cast(df.schema[date_col].dataType)))
    digests = {key: f"{location(spark, target)}/{_DIGEST}{key}" for key in _digest_keys(spark, target)}
    for path in digests.values():
        drop_days(spark, path, date_col, days)
    obs = Observation("replace_days")
    counted = by_period(checked, date_col).observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(date_col)).alias("days"),
                                                   F.count_if(F.col(date_col).isNull()).alias("no_day"))
    try:
        _overwrite(counted, target, date_col)
    except Exception as e:
        if _OTHER_DAY in str(e):
            raise ValueError(f"{_OTHER_DAY} in the rows for {target}") from e
        raise
    seen = obs.get
    present = set(seen["days"] or []) | ({None} if seen["no_day"] else set())
    drop_days(spark, target, date_col, days - present)
    if digests and present:
        known = F.col(date_col).isin([d for d in present if d is not None])
        rows = read_days(spark, target).filter(known | F.col(date_col).isNull() if None in present else known)
        for key, path in digests.items():
            _write_digest(rows, key, date_col, path)
    if not in_catalog(target) and not has_periods(spark, target, date_col):
        # the table would have no file to tell its schema
        df.limit(0).drop(date_col).write.mode("overwrite").parquet(f"{target}/{_folder(date_col, next(iter(days)))}")
    return int(seen["rows"])
