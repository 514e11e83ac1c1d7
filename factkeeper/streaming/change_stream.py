"""Recency upkeep from a stream of changes: inserts, updates, moves to another key and deletes.

A change carries the row as it was and as it is. It is split into what it takes away from the old
key's day and what it adds to the new key's, so changes are additive whatever their order.
Each key's state, in Spark's state store, is the number of rows and of deposit rows on each of its
days; a batch touches the state of the keys that it names and no other. When the newest row of
a key goes, its day's count reaches zero and the newest day left takes its place: the fact isn't
read again.

Rows of one key and day are summed in the map tasks before they are shuffled, so a hot key sends
a row for each day and batch of rows. The results of each batch are written once by epoch
(a replayed epoch overwrites its own); the newest result of a key is the valid one.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from factkeeper.functions.scalar import days_between
from factkeeper.operators import recency
from factkeeper.operators.update import latest_per_key
from factkeeper.session import scratch_path, ship_package
from factkeeper.sources.tables import require_columns

#: A change: the row's key, day and deposit cases before it (NULL key: an insert) and after (NULL key: a delete).
CHANGE_COLUMNS = ["old_key", "old_date", "old_cases", "new_key", "new_date", "new_cases"]


def signed_rows(changes: DataFrame) -> DataFrame:
    """``key, day, n, d``: rows and deposit rows that a change adds to a key's day (or takes away).

    A NULL key or date belongs to no key's days."""
    require_columns(changes, CHANGE_COLUMNS, "the changes")

    def side(prefix: str, sign: int):
        deposit = F.coalesce(F.col(f"{prefix}_cases"), F.lit(0)) > 0
        return F.struct(F.col(f"{prefix}_key").alias("key"), F.col(f"{prefix}_date").alias("day"),
                        F.lit(sign).cast("long").alias("n"), F.when(deposit, F.lit(sign)).otherwise(F.lit(0)).cast("long").alias("d"))

    return (changes.select(F.explode(F.array(side("old", -1), side("new", 1))).alias("x")).select("x.*")
            .filter(F.col("key").isNotNull() & F.col("day").isNotNull()))


def _combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        out = f.groupby(["key", "day"], as_index=False)[["n", "d"]].sum()
        yield out[(out.n != 0) | (out.d != 0)]


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Add the batch's counts to the key's; the newest days left are the result."""
    days, rows, deposits = state.get if state.exists else ([], [], [])
    n, d = dict(zip(days, rows)), dict(zip(days, deposits))
    for f in frames:
        for day, more, more_d in zip(f.day, f.n, f.d):
            n[day] = n.get(day, 0) + int(more)
            d[day] = d.get(day, 0) + int(more_d)
    left = sorted(x for x in n if n[x] or d[x])
    state.update(([*left], [n[x] for x in left], [d[x] for x in left]))
    last = max((x for x in left if n[x] > 0), default=None)
    yield pd.DataFrame({"key": [key[0]], recency.LAST_ACTIVITY: [last],
                        recency.LAST_DEPOSIT: [max((x for x in left if d[x] > 0), default=None)]})


class ChangeState:
    """Folders of one change stream under ``root``: ``results`` by epoch, and the checkpoint
    with the keys' state."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.results = f"{self.root}/results"

    def fold(self, changes: DataFrame):
        """The streaming query that keeps the keys up to date (not started)."""
        ship_package(self.spark)
        key_type = dict(changes.dtypes)["new_key"]
        counts = signed_rows(changes).mapInPandas(_combine, f"key {key_type}, day date, n long, d long")
        keys = counts.groupBy("key").applyInPandasWithState(
            _fold, f"key {key_type}, {recency.LAST_ACTIVITY} date, {recency.LAST_DEPOSIT} date",
            "days array<date>, n array<long>, d array<long>", "update", GroupStateTimeout.NoTimeout)
        return (keys.writeStream.outputMode("update").option("checkpointLocation", f"{self.root}/checkpoint")
                .foreachBatch(lambda df, epoch: df.write.mode("overwrite").parquet(f"{self.results}/epoch={epoch}")))

    def read(self, as_of: date, key: str = "key") -> DataFrame:
        """Recency of every key that has rows."""
        newest = latest_per_key(self.spark.read.parquet(self.results), ["key"], ["epoch"])
        return (newest.filter(F.col(recency.LAST_ACTIVITY).isNotNull())
                .select(F.col("key").alias(key), recency.LAST_ACTIVITY, recency.LAST_DEPOSIT,
                        days_between(as_of, recency.LAST_DEPOSIT).alias(recency.DAYS_INACTIVE)))


def change_stream(spark: SparkSession, source_dir: str, as_of: date, key: str = "key", state_root: str | None = None,
                  max_files_per_trigger: int | None = None, processing_time: str | None = None):
    """Fold every change file present (``availableNow``) and return the recency per key. With
    ``processing_time`` the stream keeps running and the running query is returned instead."""
    state = ChangeState(spark, state_root or scratch_path(spark, "change-stream"))
    reader = spark.readStream.schema(spark.read.parquet(source_dir).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = state.fold(reader.parquet(source_dir))
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    writer.trigger(availableNow=True).start().awaitTermination()
    return state.read(as_of, key)


__all__ = ["CHANGE_COLUMNS", "ChangeState", "change_stream", "signed_rows"]
