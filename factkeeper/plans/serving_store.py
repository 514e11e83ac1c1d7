"""Incremental serving table: stamped values kept per user, their inputs kept per day.

The chain stamps per-user values (latest unique code, user key, recency, tier label) on all
of a user's rows and ``days_inactive`` moves with the calendar. At 100 TB a daily rewrite of
every row, or a daily read of every day, is out of reach. ``ServingStore`` keeps

* ``fact``     — the serving rows, partitioned by ``date``; only copied days are rewritten;
* ``partials`` — one row for each day, user, name and line: how many rows, whether there was
                 a deposit, the summed deposits and the newest code. Partitioned by ``date``
                 too: a copied day replaces its partials, made from that day's rows alone;
* ``folded``   — the partials of all days before its horizon, merged to one row for each
                 user, name and line. Merging is a maximum or an exact sum, so folding days
                 changes nothing. The horizon follows the copied days at a distance, and goes
                 back, from the partials, when an older day is copied;
* ``stamps``   — the per-user results: latest code, recency of each user key, tier of each
                 key and line, made from ``folded`` and the partials since. One version with one
                 commit marker, so a reader never mixes two runs.

A copy of two days therefore reads two days of the fact, the partials since the horizon and
one folded row for each user. A maximum can't be taken back, but the day that it came from can
be replaced: when a newest row vanishes, the next newest partial takes its place.

``read(as_of)`` joins the stamps to the rows and computes ``days_inactive`` for the day asked,
so the daily re-age (G8) costs nothing and users who share a short key share its recency, as in
the full recompute.

Before a copy its days are committed as pending; they are cleared once the stamps hold them. A
run that failed in between leaves them there, and the next one makes their partials again.
"""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.functions.scalar import LINE_RECODES, days_between, recode, strict_concat
from factkeeper.operators import kpi, recency, views
from factkeeper.operators.update import key_side, newest_order
from factkeeper.plans import jobs
from factkeeper.plans.table_store import VersionedTable, by_period, read_days, replace_days

USER = "user_unique"
#: Days behind the oldest copied one that stay out of ``folded``.
OPEN_DAYS = 62


class ServingStore:
    def __init__(self, spark: SparkSession, root: str, bands, line_recodes: dict | None = None,
                 name_col: str = "user_name", tiebreak: str = "uniquekey", short_key: bool = False,
                 fact_path: str | None = None, open_days: int = OPEN_DAYS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fact_path = fact_path or f"{self.root}/fact"
        self.partials_path = f"{self.root}/partials"
        self.folded = VersionedTable(spark, f"{self.root}/folded")
        self.stamps = VersionedTable(spark, f"{self.root}/stamps")
        self.pending = VersionedTable(spark, f"{self.root}/pending")
        self.bands = bands
        self.recodes = LINE_RECODES if line_recodes is None else line_recodes
        self.name_col = name_col
        self.key_parts = (("update_unique_code", "line") if short_key
                          else (name_col, "update_unique_code", "line"))
        self.tiebreak = tiebreak
        self.open_days = open_days

    # ------------------------------------------------------------ partials
    def fact(self) -> DataFrame:
        df = read_days(self.spark, self.fact_path)
        return df.withColumn("line", recode("line", self.recodes))

    def _group(self) -> list[str]:
        return [USER, self.name_col, "line"]

    def _partials_of(self, rows: DataFrame) -> DataFrame:
        """One row for each day, user, name and line of ``rows``."""
        deposited = F.coalesce(F.col("deposit_cases"), F.lit(0)) > 0
        newest = F.struct(newest_order(["date", self.tiebreak], nulls_first=["date"]).alias("order"),
                          F.col("unique_code").alias("code"))
        return (rows.filter(F.col(USER).isNotNull()).groupBy("date", *self._group()).agg(
            F.max(newest).alias("newest"),
            F.max(F.when(deposited, F.col("date"))).alias(recency.LAST_DEPOSIT),
            kpi.money(rows, "deposit_amount").alias("amount")))

    def _merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self._group()).agg(
            F.max("newest").alias("newest"), F.max(recency.LAST_ACTIVITY).alias(recency.LAST_ACTIVITY),
            F.max(recency.LAST_DEPOSIT).alias(recency.LAST_DEPOSIT), F.sum("amount").alias("amount"))

    def _day_parts(self) -> DataFrame:
        return self.spark.read.parquet(self.partials_path)

    def _as_merged(self, parts: DataFrame) -> DataFrame:
        """Day partials with the columns of merged ones; a row without a date is active on no day."""
        return parts.withColumnRenamed("date", recency.LAST_ACTIVITY).select(
            *self._group(), "newest", recency.LAST_ACTIVITY, recency.LAST_DEPOSIT, "amount")

    def horizon(self) -> date | None:
        """``folded`` holds the days before this one."""
        version = self.folded.current()
        return None if version is None else date.fromisoformat(version.split("_", 1)[0])

    def _fold(self, parts: DataFrame, until: date) -> None:
        self.folded.write(self._merged(parts), f"{until}_{uuid.uuid4().hex}")
        self.folded.prune(keep=2)

    def _move_horizon(self, days) -> None:
        oldest = min((d for d in days if d is not None), default=None)
        at = self.horizon()
        if oldest is None:
            return
        wanted = oldest - timedelta(days=self.open_days)
        day = F.col("date")
        if oldest < at:    # the folded days hold one that changed: made again from the partials
            self._fold(self._as_merged(self._day_parts().filter(day < F.lit(wanted))), wanted)
        elif wanted >= at + timedelta(days=max(1, self.open_days // 2)):
            more = self._day_parts().filter((day >= F.lit(at)) & (day < F.lit(wanted)))
            self._fold(self.folded.read().unionByName(self._as_merged(more)), wanted)

    # ------------------------------------------------------------ per-user results
    STAMPED = ["update_unique_code", "userkey", recency.LAST_ACTIVITY, recency.LAST_DEPOSIT,
               recency.DAYS_INACTIVE, "tier_label"]

    def _write_stamps(self) -> None:
        at = self.horizon()
        day = F.col("date")
        recent = self._day_parts().filter(day.isNull() | (day >= F.lit(at)))
        merged = key_side(self._merged(self.folded.read().unionByName(self._as_merged(recent))))
        latest = key_side(merged.groupBy(USER).agg(F.max("newest").alias("newest"))
                          .select(USER, F.col("newest.code").alias("update_unique_code")))
        keyed = (merged.join(latest, USER).withColumn("userkey", strict_concat(*self.key_parts))
                 .filter(F.col("userkey").isNotNull()))
        recent_days = keyed.groupBy("userkey").agg(
            *[F.max(c).alias(c) for c in (recency.LAST_ACTIVITY, recency.LAST_DEPOSIT)])
        tiers = keyed.groupBy("userkey", "line").agg(F.sum("amount").cast("double").alias("amount"))
        tiers = (tiers.withColumn("tier_label", views.band(F.col("amount"), self.bands))
                 .filter(F.col("tier_label").isNotNull()).select("userkey", "line", "tier_label"))
        self.stamps.write_set({"latest": latest, "recency": recent_days, "tiers": tiers})
        self.stamps.prune(keep=2)   # the previous version stays for readers still on it

    def exists(self) -> bool:
        return self.stamps.exists()

    def build(self, serving: DataFrame) -> None:
        """First load: store the fact by day (without stamped columns, which are derived), and
        everything that is kept of it."""
        (by_period(serving.drop(*self.STAMPED), "date").write.mode("overwrite")
         .partitionBy("date").parquet(self.fact_path))
        self.adopt()

    def adopt(self) -> None:
        """First load of a fact that is stored at ``fact_path`` already: the only time that all of
        its days are read."""
        by_period(self._partials_of(self.fact()), "date").write.mode("overwrite").partitionBy("date").parquet(self.partials_path)
        newest = self._day_parts().agg(F.max("date")).first()[0]
        until = (newest or date(1970, 1, 1)) - timedelta(days=self.open_days)
        self._fold(self._as_merged(self._day_parts().filter(F.col("date") < F.lit(until))), until)
        self._write_stamps()

    # ------------------------------------------------------------ daily change
    def _unfinished(self) -> set:
        return {r[0] for r in self.pending.read().collect()} if self.pending.exists() else set()   # days of one run

    def copy_days(self, staging: DataFrame, days, mapping, **job_options) -> int:
        """W4/W5 into the stored fact, then the partials of its days and the stamps.

        Mapped columns the store derives (the staged user key) are not copied:
        the chain would overwrite them anyway."""
        mapping = [(s, t) for s, t in mapping if t not in self.STAMPED]
        todo = self._unfinished() | set(days)   # also those of a run that did not come to its end
        self.pending.write(self.spark.createDataFrame([(d,) for d in todo], "day date").coalesce(1))
        n = jobs.mapped_copy_job(self.spark, staging, self.fact_path, days, mapping, **job_options)
        self.refresh(todo)
        return n

    def refresh(self, days) -> None:
        """Take over ``days`` of the stored fact after they changed."""
        on_days = F.col("date").isin([d for d in days if d is not None])
        if None in days:
            on_days = on_days | F.col("date").isNull()
        replace_days(self._partials_of(self.fact().filter(on_days)), self.partials_path, "date", days)
        self._move_horizon(days)
        self._write_stamps()
        if self.pending.exists():
            self.pending.write(self.spark.createDataFrame([], "day date").coalesce(1))
            self.pending.prune(keep=1)

    # ------------------------------------------------------------ read
    def read(self, as_of: date) -> DataFrame:
        """The stamped serving rows as of ``as_of``."""
        version = self.stamps.current()
        latest, rec, tiers = (self.stamps.read_part(name, version) for name in ("latest", "recency", "tiers"))
        out = (self.fact().drop(*self.STAMPED).join(latest, USER, "left")
               .withColumn("userkey", strict_concat(*self.key_parts)))
        out = out.join(rec, "userkey", "left").withColumn(
            recency.DAYS_INACTIVE, days_between(as_of, recency.LAST_DEPOSIT))
        return out.join(tiers, ["userkey", "line"], "left")
