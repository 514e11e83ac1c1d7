"""Recency upkeep from a stream of new rows.

New files are read with Structured Streaming; each micro-batch (``foreachBatch``) does
work proportional to the batch and the number of keys, never to the whole history:

* its additive per-(key, day) rows are written once to
  ``<state>/daily/date=<d>/epoch=<e>/`` (dynamic partition overwrite, so a replayed epoch
  rewrites the same folders — idempotent) and read back for the fold;
* the per-key recency table (last activity, last deposit) is folded with the batch's
  maxima into version ``<e>`` of a ``VersionedTable``, whose marker commits the epoch.

A stream of new rows only appends, so folding MAX is exact. Rows that vanish or move are
taken back by the trailing reload (I3): with ``reload`` every batch also re-reads the last
days whole from the source. A whole day is written to ``<state>/whole/date=<d>/epoch=<e>/``
and listed in the version that commits it; it stands for all rows of that day up to that
epoch, and the keys seen on it, before or after, are recomputed instead of folded.
``compact`` makes whole days of closed ones, merged. What a whole day replaces is deleted
once it is committed: after a compaction at once, after a reload with the next batch, so
that readers of the version before aren't disturbed.

The stamped fact is a read-time view: additive rows merged per (key, day) and joined to
the per-key table; ``days_inactive`` is computed for the ``as_of`` of the read. Its rows
equal one batch run over all rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.functions.scalar import days_between
from factkeeper.operators import recency
from factkeeper.operators.update import key_side
from factkeeper.plans.table_store import VersionedTable, by_period, has_periods
from factkeeper.session import scratch_path


@dataclass(frozen=True)
class StreamModel:
    """What the stream's rows are: ``partial`` makes additive rows per (key, day) of raw
    rows, ``merge`` adds those up, ``finish`` makes the fact's columns of them."""

    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame] = lambda df: df
    key: str = "user_unique"
    date: str = "date"
    cases: str = "deposit_cases"


class RecencyState:
    """Folders of one stream's state under ``root``.

    ``reload()``, if given, returns the trailing days and all raw rows of them."""

    def __init__(self, spark: SparkSession, root: str, model: StreamModel,
                 reload: Callable[[], tuple[list[date], DataFrame]] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.model = model
        self.reload = reload
        self.daily_path = f"{self.root}/daily"
        self.whole_path = f"{self.root}/whole"
        self.state = VersionedTable(spark, f"{self.root}/keys")

    def committed_epoch(self) -> int:
        v = self.state.current()
        return -1 if v is None else int(v.split("_")[0])

    def _write(self, parts: DataFrame, epoch_id: int, path: str) -> None:
        (by_period(parts.withColumn("epoch", F.lit(epoch_id)), self.model.date).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.model.date, "epoch").parquet(path))

    def _whole_days(self) -> DataFrame:
        """``__day, __since``: days that are stored whole, and the epoch up to which."""
        if not self.state.exists():
            return self.spark.createDataFrame([], "__day date, __since int")
        return self.state.read_part("whole")

    def _rows(self, path: str) -> DataFrame | None:
        """The stored rows; None where there is no day yet."""
        return self.spark.read.parquet(path) if has_periods(self.spark, path, self.model.date) else None

    def parts(self, whole: DataFrame, upto: int) -> DataFrame:
        """Additive rows of the epochs up to ``upto``: whole days, and what came since."""
        day = F.col(self.model.date)
        both = None
        if (daily := self._rows(self.daily_path)) is not None:
            both = (daily.filter(F.col("epoch") <= upto).join(F.broadcast(whole), day == F.col("__day"), "left")   # a row a day
                    .filter(F.col("__since").isNull() | (F.col("epoch") > F.col("__since"))).drop("__day", "__since", "epoch"))
        if (days := self._rows(self.whole_path)) is not None:
            kept = days.join(F.broadcast(whole), (day == F.col("__day")) & (F.col("epoch") == F.col("__since"))).drop("__day", "__since", "epoch")
            both = kept if both is None else both.unionByName(kept)
        return both

    def _maxima(self, parts: DataFrame) -> DataFrame:
        m = self.model
        deposited = F.coalesce(F.col(m.cases), F.lit(0)) > 0
        return parts.groupBy(m.key).agg(F.max(m.date).alias(recency.LAST_ACTIVITY),
                                        F.max(F.when(deposited, F.col(m.date))).alias(recency.LAST_DEPOSIT))

    def fold(self, batch: DataFrame, epoch_id: int) -> None:
        if epoch_id <= self.committed_epoch():
            return  # replayed epoch: already folded in
        m = self.model
        before, old_whole = self.committed_epoch(), self._whole_days()
        self._drop_replaced(old_whole, before)
        days, whole, again = [], old_whole, None
        new_rows = m.partial(batch)
        if self.reload is not None:
            days, raw = self.reload()
            on_days = F.col(m.date).isin(days)
            if before >= 0:
                again = self.parts(old_whole, before).filter(on_days).select(m.key)
            self._write(m.partial(raw).filter(on_days), epoch_id, self.whole_path)
            new_rows = new_rows.filter(~on_days)
            marks = self.spark.createDataFrame([(d, epoch_id) for d in days], "__day date, __since int")
            whole = old_whole.join(marks, "__day", "left_anti").unionByName(marks)
        self._write(new_rows, epoch_id, self.daily_path)
        fresh = m.partial(batch).limit(0)
        for path in (self.daily_path, self.whole_path) if days else (self.daily_path,):
            if (rows := self._rows(path)) is not None:
                fresh = fresh.unionByName(rows.filter(F.col("epoch") == epoch_id).drop("epoch"))
        merged = self._maxima(fresh)
        if before >= 0:
            prev = self.state.read_part("keys")
            if again is not None:
                again = key_side(again.unionByName(fresh.filter(F.col(m.date).isin(days)).select(m.key)).distinct())
                redone = self._maxima(self.parts(whole, epoch_id).join(again, m.key, "left_semi"))
                prev = prev.join(again, m.key, "left_anti")
                merged = merged.join(again, m.key, "left_anti")
            folded = prev.join(merged.withColumnsRenamed({recency.LAST_ACTIVITY: "a", recency.LAST_DEPOSIT: "d"}), m.key, "full").select(
                m.key, F.greatest(recency.LAST_ACTIVITY, "a").alias(recency.LAST_ACTIVITY),
                F.greatest(recency.LAST_DEPOSIT, "d").alias(recency.LAST_DEPOSIT))
            merged = folded if again is None else folded.unionByName(redone)
        self.state.write_set({"keys": merged, "whole": whole.coalesce(1)}, str(epoch_id))   # the marker commits the epoch
        self.state.prune(keep=2)

    def compact(self, before: date) -> None:
        """Merge the days before ``before`` into whole ones and delete what they replace.

        The days are written beside the old ones and committed with the keys as they are; a
        compaction that is cut off leaves files that the next one replaces."""
        epoch, m = self.committed_epoch(), self.model
        whole = self._whole_days()
        daily = self._rows(self.daily_path)
        if epoch < 0 or daily is None:
            return
        loose = daily.filter((F.col(m.date) < F.lit(before)) & (F.col("epoch") <= epoch)).select(F.col(m.date).alias("__day")).distinct()
        days = [r["__day"] for r in loose.collect()]   # closed days of the calendar
        self._write(m.merge(self.parts(whole, epoch).filter(F.col(m.date).isin(days))), epoch, self.whole_path)
        marks = self.spark.createDataFrame([(d, epoch) for d in days], "__day date, __since int")
        now = whole.join(marks, "__day", "left_anti").unionByName(marks)
        self.state.write_set({"keys": self.state.read_part("keys"), "whole": now.coalesce(1)}, f"{epoch}_{uuid.uuid4().hex}")
        self.state.prune(keep=2)
        self._drop_replaced(self._whole_days(), epoch)

    def _drop_replaced(self, whole: DataFrame, epoch: int) -> None:
        """Delete the folders that the whole days of an epoch stand for."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path
        for r in whole.filter(F.col("__since") == epoch).collect():   # days of the calendar
            for path, most in ((self.daily_path, r["__since"]), (self.whole_path, r["__since"] - 1)):
                folder = p(f"{path}/{self.model.date}={r['__day']}")
                fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
                if fs.exists(folder):
                    for x in fs.listStatus(folder):
                        name = x.getPath().getName()
                        if name.startswith("epoch=") and int(name[6:]) <= most:
                            fs.delete(x.getPath(), True)
                    if not fs.listStatus(folder):
                        fs.delete(folder, True)

    def read(self, as_of: date) -> DataFrame:
        """The stamped daily fact as of the last committed epoch."""
        m = self.model
        fact = m.finish(m.merge(self.parts(self._whole_days(), self.committed_epoch())))
        keys = self.state.read_part("keys").withColumn(recency.DAYS_INACTIVE,
                                                       days_between(as_of, recency.LAST_DEPOSIT))
        return fact.join(keys, m.key, "left")


def recency_stream(spark: SparkSession, source_dir: str, as_of: date, model: StreamModel,
                   glob: str = "events.parquet", state_root: str | None = None,
                   max_files_per_trigger: int | None = None, processing_time: str | None = None,
                   reload: Callable[[], tuple[list[date], DataFrame]] | None = None):
    """Fold every file present (``availableNow``) and return the stamped fact. With
    ``processing_time='1 hour'`` the stream keeps running on an hourly trigger (I4) and the
    running query is returned instead."""
    state = RecencyState(spark, state_root or scratch_path(spark, "recency-stream"), model, reload)
    schema = spark.read.parquet(f"{source_dir}/{glob}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source_dir)
    writer = (rows.writeStream.foreachBatch(lambda df, e: state.fold(df, e))
              .option("checkpointLocation", f"{state.root}/checkpoint"))
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    writer.trigger(availableNow=True).start().awaitTermination()
    return state.read(as_of)
