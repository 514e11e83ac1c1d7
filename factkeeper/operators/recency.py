"""Recency per key and its incremental upkeep.

``recency`` is the set-based form of calling the per-key refresh for every
key: one combinable aggregate (MAX date, MAX deposit date per key) and one
join back, instead of three statements per key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.functions.scalar import days_between, distinct_from
from factkeeper.operators.update import key_side, update_from

# The three columns the refresh writes.
LAST_ACTIVITY = "last_activity_days"      # a DATE, despite its name
LAST_DEPOSIT = "last_deposit_date"
DAYS_INACTIVE = "days_inactive"


def key_recency(df: DataFrame, key: str, date_col: str = "date",
                deposit_col: str = "deposit_cases") -> DataFrame:
    """Per non-NULL key: newest date, newest date with ``deposit_col > 0``."""
    deposited = F.coalesce(F.col(deposit_col), F.lit(0)) > 0
    return (df.filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.max(date_col).alias(LAST_ACTIVITY),
                 F.max(F.when(deposited, F.col(date_col))).alias(LAST_DEPOSIT)))


def recency(df: DataFrame, key: str, as_of: date, date_col: str = "date",
            deposit_col: str = "deposit_cases") -> DataFrame:
    """Stamp every row with its key's last activity day, last deposit day
    and days since that deposit (``as_of - last_deposit``, NULL if never).

    Rows with a NULL key are left as they are (their columns stay NULL when
    newly added).
    """
    per_key = key_recency(df, key, date_col, deposit_col).withColumn(
        DAYS_INACTIVE, days_between(as_of, LAST_DEPOSIT))
    return update_from(df, per_key, [key],
                       {LAST_ACTIVITY: LAST_ACTIVITY, LAST_DEPOSIT: LAST_DEPOSIT,
                        DAYS_INACTIVE: DAYS_INACTIVE}, unique=True)


def reage(df: DataFrame, as_of: date) -> DataFrame:
    """The daily job — days_inactive from the stored last deposit day."""
    return df.withColumn(DAYS_INACTIVE, days_between(as_of, LAST_DEPOSIT))


def changed_keys(changes: DataFrame, new_key: str = "new_key", old_key: str = "old_key") -> DataFrame:
    """Keys to refresh — the new key of inserts/updates, the old key of
    deletes and of updates that moved a row to another key (IS DISTINCT FROM)."""
    new = changes.select(F.col(new_key).alias("key"))
    old = changes.filter(distinct_from(old_key, new_key)).select(F.col(old_key).alias("key"))
    return new.unionByName(old).filter(F.col("key").isNotNull()).distinct()


def refresh_changed(table: DataFrame, keys: DataFrame, key: str, as_of: date,
                    date_col: str = "date", deposit_col: str = "deposit_cases") -> DataFrame:
    """Recompute recency only for ``keys`` (column ``key``).

    ``table`` is the table after the change, carrying the recency columns of
    the previous run. The changed keys' rows are picked with a semi join,
    recomputed per key (recompute, not fold: a MAX cannot be undone when the
    newest row is deleted) and written back with ``update_from`` — rows of
    other keys do not match and keep their values. For a small change set
    both joins are broadcast by AQE, so the table itself is never shuffled.
    """
    keys = key_side(keys.select(F.col("key").alias(key)).filter(F.col(key).isNotNull()))
    touched = table.join(keys, on=key, how="left_semi")
    per_key = key_recency(touched, key, date_col, deposit_col).withColumn(
        DAYS_INACTIVE, days_between(as_of, LAST_DEPOSIT))
    return update_from(table, per_key, [key],
                       {LAST_ACTIVITY: LAST_ACTIVITY, LAST_DEPOSIT: LAST_DEPOSIT,
                        DAYS_INACTIVE: DAYS_INACTIVE}, unique=True)
