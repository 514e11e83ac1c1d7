"""Summary views kept by day (V1-V9): a refresh reads the changed days of the fact, no others.

Three tables stand between the fact and its views, each partitioned by period and replaced
partition by partition:

* ``user_days``   — by ``date``: one row for each user and line, with counts, exact sums, the
                    deposits' extremes and the first deposit. Made from that day's fact rows;
* ``line_days``   — by ``date``: one row for each line and block of user numbers, with the same
                    sums and a bitmap of the active users. Made from that day's ``user_days``;
* ``user_months`` — by ``month_start``: one row for each user and line. Made from that month's
                    ``user_days``.

Sums and extremes merge over days; distinct users don't, so members are kept as bitmaps over a
dense numbering of the users, which merge by ``bitmap_or_agg`` and count exactly. Everything
that holds a changed day is made again from the level below; what is replaced is whole
partitions, so a refresh that is run twice changes nothing.

Which days a view holds is the set of partitions of its tables: ``refresh(days)`` replaces them.
Views over all time (first deposits, retention, tiers) read ``user_months`` or the days around
the changed ones, never the fact, but for the rows of ``new_depositor_txns``: there the months
are read again in which a user's first deposit came or went.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.functions.time_windows import first_of_next_month
from factkeeper.operators import kpi, views
from factkeeper.operators.update import key_side
from factkeeper.plans.table_store import VersionedTable, by_period, path_exists, read_days, replace_days

class UserNumbers:
    """Dense numbers (from 1) of the users seen, stored; a number never changes."""

    def __init__(self, spark: SparkSession, root: str, user: str):
        self.spark, self.user = spark, user
        self.table = VersionedTable(spark, root)

    def read(self) -> DataFrame:
        if not self.table.exists():
            return self.spark.createDataFrame([], f"{self.user} {self._type}, number long")
        return self.table.read()

    def add(self, users: DataFrame) -> None:
        """Number the users that have none yet, after the largest number so far.

        Each partition of the new ones gets a run of numbers; only the partitions' counts reach
        the driver."""
        self._type = users.schema[self.user].dataType.simpleString()
        known = self.read()
        new = users.select(self.user).filter(F.col(self.user).isNotNull()).distinct()
        new = key_side(new.join(known.select(self.user), self.user, "left_anti").withColumn("part", F.spark_partition_id())
                       .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
        counts = new.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
        if not counts:
            return
        base, starts = known.agg(F.max("number")).first()[0] or 0, []
        for r in counts:
            starts.append((r["part"], base + 1))
            base += r["n"]
        first = self.spark.createDataFrame(starts, "part int, start long")
        numbered = new.join(first, "part").select(self.user, (F.col("start") + F.col("at")).alias("number"))
        self.table.write(known.unionByName(numbered))
        self.table.prune(keep=2)


def members(col: str = "users"):
    """Exact number of distinct users of merged bitmaps (one for each block of numbers)."""
    return F.sum(F.bitmap_count(F.col(col))).cast("bigint")


class DayViews:
    """The views of one fact, which is stored by day at ``fact_path``."""

    def __init__(self, spark: SparkSession, root: str, fact_path: str, bands, c: views.FactCols = views.FactCols(cases="deposit_cases"),
                 tiebreak: str = "uniquekey", prepare=lambda rows: rows, register: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fact_path = fact_path
        self.bands = bands
        self.c = c
        self.tiebreak = tiebreak
        self.prepare = prepare              # recodes of the chain, row by row
        self.register = register or c.date  # whose first day is a user's registration
        self.pending = VersionedTable(spark, f"{self.root}/pending")
        self.numbers = UserNumbers(spark, f"{self.root}/numbers", c.user)
        self.paths = {name: f"{self.root}/{name}" for name in
                      ("user_days", "line_days", "user_months", "retention_days", "first_txns")}

    # ------------------------------------------------------------ the three levels
    def _fact(self) -> DataFrame:
        return self.prepare(read_days(self.spark, self.fact_path))

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.paths[name])

    def _user_days(self, rows: DataFrame) -> DataFrame:
        c = self.c
        deposit = F.lit(True) if c.cases is None else F.coalesce(F.col(c.cases), F.lit(0)) > 0
        amount = F.when(deposit, F.col(c.amount))
        only = rows.withColumn("__deposit", amount)
        cases = F.count(F.lit(1)) if c.cases is None else F.sum(c.cases)
        first = F.min(F.when(deposit, F.struct(F.col(self.tiebreak).alias("key"), F.col(c.amount).alias("amount"))))
        return only.groupBy(F.to_date(c.date).alias("date"), F.col(c.user).alias(c.user), F.col(c.line).alias("line")).agg(
            F.count(F.lit(1)).alias("n"), cases.cast("bigint").alias("cases"), kpi.money(rows, c.amount).alias("amount"),
            F.count_if(deposit).alias("deposits"), kpi.money(only, "__deposit").alias("deposit_total"),
            F.min("__deposit").alias("deposit_min"), F.max("__deposit").alias("deposit_max"), first.alias("first"),
            F.min(F.to_date(self.register)).alias("registered"))

    def _line_days(self, user_days: DataFrame) -> DataFrame:
        number = F.col("number")
        numbered = user_days.join(self.numbers.read(), self.c.user, "left")
        return numbered.groupBy("date", "line", F.bitmap_bucket_number(number).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("users"),
            *[F.sum(x).alias(x) for x in ("n", "cases", "amount", "deposits", "deposit_total")],
            F.min("deposit_min").alias("deposit_min"), F.max("deposit_max").alias("deposit_max"))

    def _user_months(self, user_days: DataFrame) -> DataFrame:
        c = self.c
        first = F.min(F.when(F.col("first").isNotNull(), F.struct(F.col("date").alias("day"), F.col("first"))))
        return user_days.groupBy(views.month_start("date").alias("month_start"), c.user, "line").agg(
            F.sum("cases").alias("cases"), F.sum("amount").alias("amount"), F.count("date").alias("days"),
            F.min("registered").alias("registered"), first.alias("first"))

    def exists(self) -> bool:
        """Whether the first load came to its end."""
        return path_exists(self.spark, f"{self.paths['first_txns']}/_SUCCESS")

    def announce(self, days) -> None:
        """Note days that are about to change, so that the next ``refresh`` takes them over even
        if this run doesn't come to its end."""
        todo = self._announced() | set(days)
        self.pending.write(self.spark.createDataFrame([(d,) for d in todo], "day date").coalesce(1))

    def _announced(self) -> set[date]:
        return {r[0] for r in self.pending.read().collect()} if self.pending.exists() else set()   # days of a run

    def build(self) -> None:
        """First load, the only time that all days of the fact are read."""
        def write(name, df, by):
            by_period(df, by).write.mode("overwrite").partitionBy(by).parquet(self.paths[name])

        write("user_days", self._user_days(self._fact()), "date")
        days = self._read("user_days")
        self.numbers.add(days.select(self.c.user))
        write("line_days", self._line_days(days), "date")
        write("user_months", self._user_months(days), "month_start")
        write("retention_days", self._active(days), "date")
        write("first_txns", self._txns(self._fact()), "month_start")

    def refresh(self, days=()) -> None:
        """Take over changed days of the fact (dates), and announced ones."""
        days = sorted(self._announced() | set(days))
        if not days:
            return
        months = sorted({d.replace(day=1) for d in days})
        on = lambda col, values: F.col(col).isin(list(values))
        before = key_side(self._first_months())
        fresh = self._user_days(self._fact().filter(on(self.c.date, days)))
        replace_days(fresh, self.paths["user_days"], "date", days)
        changed = self._read("user_days").filter(on("date", days))
        self.numbers.add(changed.select(self.c.user))
        replace_days(self._line_days(changed), self.paths["line_days"], "date", days)
        around = sorted({d + timedelta(days=k) for d in days for k in (-1, 0)})
        replace_days(self._active(self._read("user_days"), around), self.paths["retention_days"], "date", around)
        of_months = self._read("user_days").filter(self._within("date", months))
        replace_days(self._user_months(of_months), self.paths["user_months"], "month_start", months)
        self._refresh_txns(before, months)
        self.pending.write(self.spark.createDataFrame([], "day date").coalesce(1))
        self.pending.prune(keep=1)

    @staticmethod
    def _within(col: str, months):
        """Days of the given months, as ranges that prune partitions."""
        out = F.lit(False)
        for m in months:
            out = out | ((F.col(col) >= F.lit(m)) & (F.col(col) < F.lit(first_of_next_month(m))))
        return out

    # ------------------------------------------------------------ views of the levels
    def _summary(self, period: dict, extra=()) -> DataFrame:
        days = self._read("line_days").select("*", *[e.alias(name) for name, e in period.items()])
        by = ["line", *period]
        blocks = days.groupBy(*by, "bucket").agg(
            F.bitmap_or_agg("users").alias("users"), F.sum("cases").alias("cases"), F.sum("amount").alias("amount"),
            F.min("date").alias("first_day"), F.max("date").alias("last_day"))
        return blocks.groupBy(*by).agg(
            F.coalesce(F.sum("cases"), F.lit(0)).cast("bigint").alias("deposit_cases"),
            F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("deposit_amount"),
            members().alias("active_users"), *extra)

    def monthly_summary(self) -> DataFrame:
        return self._summary({"year": F.year("date").cast("int"), "month": F.month("date").cast("int")})

    def quarter_summary(self) -> DataFrame:
        return self._summary({"year": F.year("date").cast("int"), "quarter": F.quarter("date").cast("int")})

    def daily_summary(self) -> DataFrame:
        return self._summary({"day": F.col("date")})

    def line_summary(self) -> DataFrame:
        return self._summary({}, [F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")])

    def deposit_summary(self) -> DataFrame:
        return (self._read("line_days").groupBy("line").agg(
            F.sum("deposits").cast("bigint").alias("deposits"), F.sum("deposit_total").cast("double").alias("total_amount"),
            F.min("deposit_min").cast("double").alias("min_amount"), F.max("deposit_max").cast("double").alias("max_amount"))
            .filter(F.col("deposits") > 0))

    def customer_monthly(self, customers: DataFrame, attrs) -> DataFrame:
        per = self._read("user_months").select(
            self.c.user, "line", "month_start", F.coalesce("cases", F.lit(0)).cast("bigint").alias("deposit_cases"),
            F.coalesce("amount", F.lit(0)).cast("double").alias("deposit_amount"), F.col("days").cast("bigint").alias("active_days"))
        return per.join(customers.select(self.c.user, *attrs), on=self.c.user, how="left")

    def tier_monthly(self) -> DataFrame:
        months = self._read("user_months")
        return views.tier_monthly(months, self.bands, views.FactCols(user=self.c.user, date="month_start", amount="amount"))

    def tier_summary(self) -> DataFrame:
        return views.tier_summary(self.tier_monthly())

    def new_registrations(self) -> DataFrame:
        return views.new_registrations(self._read("user_months"), self.c.user, "registered")

    def new_depositors(self) -> DataFrame:
        first = (self._read("user_months").filter(F.col(self.c.user).isNotNull() & F.col("first").isNotNull())
                 .groupBy(self.c.user).agg(F.min("first").alias("f")))
        return first.select(self.c.user, F.col("f.day").alias("first_deposit_date"), F.col("f.first.amount").alias("first_deposit_amount"))

    def retention_monthly(self) -> DataFrame:
        return views.retention(self._read("user_months"), self.c.user, F.col("month_start"), "month")

    def retention_daily(self) -> DataFrame:
        kept = self._read("retention_days")
        return kept.select(F.col("date").alias("period_start"), "active", "retained", (F.col("retained") / F.col("active")).alias("rate"))

    def new_depositor_txns(self) -> DataFrame:
        return self._read("first_txns").drop("month_start")

    # ------------------------------------------------------------ parts that days share
    def _active(self, user_days: DataFrame, days=None) -> DataFrame:
        """``date, active, retained`` of ``days``, from these days and the ones after them."""
        if days is not None:
            user_days = user_days.filter(F.col("date").isin(sorted({d + timedelta(days=k) for d in days for k in (0, 1)})))
        out = views.retention(user_days, self.c.user, F.col("date"), "day").drop("rate").withColumnRenamed("period_start", "date")
        return out if days is None else out.filter(F.col("date").isin(list(days)))

    def _first_months(self) -> DataFrame:
        c = self.c
        return (self._read("user_months").filter(F.col(c.user).isNotNull() & F.col("first").isNotNull())
                .groupBy(c.user).agg(F.min("month_start").alias("month_start")))

    def _txns(self, rows: DataFrame, first: DataFrame | None = None) -> DataFrame:
        """Deposits of the month in which their user made the first one."""
        c = self.c
        if c.cases is not None:
            rows = rows.filter(F.coalesce(F.col(c.cases), F.lit(0)) > 0)
        first = key_side(self._first_months()) if first is None else first
        return rows.withColumn("month_start", views.month_start(c.date)).join(first, [c.user, "month_start"], "left_semi")

    def _refresh_txns(self, before: DataFrame, months: list[date]) -> None:
        """The changed months, and those in which a user's first deposit came or went."""
        c = self.c
        after = key_side(self._first_months())
        moved = before.withColumnRenamed("month_start", "was").join(after, c.user, "full").filter(
            ~F.col("was").eqNullSafe(F.col("month_start")))
        other = moved.select(F.explode(F.array("was", "month_start")).alias("m")).filter("m is not null").distinct()
        months = sorted({*months, *(r["m"] for r in other.collect())})   # months of the calendar
        replace_days(self._txns(self._fact().filter(self._within(c.date, months)), after), self.paths["first_txns"], "month_start", months)


__all__ = ["DayViews", "UserNumbers", "members"]
