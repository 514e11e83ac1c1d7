"""UPDATE ... FROM as pure rewrites.

Every update here is ``target LEFT JOIN unique(source) ON keys`` followed by
``when(matched, new).otherwise(old)``: unmatched rows stay as they are, a
matched NULL still overwrites, and the row count of the target never changes.

The source is first made unique per key with an aggregate, never with a
window: ``max_by(row, order)`` is combined map-side, so a key that holds a
third of all rows is reduced to one row per map task before the shuffle,
instead of being sorted whole in one task. Its buffer is a struct, which Spark
aggregates by sorting, so each map task sorts its own input by key first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factkeeper.session import scratch_path

_MATCHED = "__matched"


def key_side(df: DataFrame) -> DataFrame:
    """Store a per-key result (one row per key) before it is joined back.

    AQE can only split a skewed join partition when both join inputs are
    plain shuffles; an aggregate feeding the join directly blocks it, and a
    key holding a third of the rows would then be joined in one task. The
    per-key rows are therefore always written to the shared checkpoint folder
    and read back: both sides get ordinary shuffles (the hot partition is
    split across tasks), AQE and the file size decide about a broadcast, and
    the result is a snapshot that does not follow later changes of its input.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "key-side", temporary=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def newest_order(newest, nulls_first=()) -> Column:
    """Struct whose maximum is the "latest" row.

    ``newest`` lists columns compared in turn, all descending; a column named
    in ``nulls_first`` ranks its NULLs above every value (Postgres DESC), the
    others rank NULL lowest (DESC NULLS LAST).
    """
    fields = []
    for i, c in enumerate(newest):
        if c in nulls_first:
            fields.append(F.col(c).isNull().alias(f"n{i}"))
        fields.append(F.col(c).alias(f"v{i}"))
    return F.struct(*fields)


def latest_per_key(df: DataFrame, keys, newest, nulls_first=(), cols=None,
                   keep_null_keys: bool = False) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, newest DESC``.

    Returns one row per key with ``keys + cols`` (default: all columns).
    Ties on ``newest`` must be broken by the caller adding a unique column.
    With ``keep_null_keys`` rows whose key has a NULL are passed through
    unchanged (they never conflict), otherwise they are dropped.
    """
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    keyed = df.filter(has_key)
    row = F.struct(*[F.col(c) for c in cols]) if cols else F.lit(True)
    picked = keyed.groupBy(*keys).agg(F.max_by(row, newest_order(newest, nulls_first)).alias("__row"))
    out = picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in cols])
    if keep_null_keys:
        out = out.unionByName(df.filter(~has_key).select(*keys, *cols))
    return out


def _unique_source(source: DataFrame, keys, value_cols, newest=None, nulls_first=()) -> DataFrame:
    if newest:
        return latest_per_key(source, keys, newest, nulls_first, cols=value_cols)
    # No order given: still one row per key, picked deterministically
    # (greatest value tuple) — Postgres would pick an arbitrary match.
    keyed = source
    for k in keys:
        keyed = keyed.filter(F.col(k).isNotNull())
    row = F.struct(*[F.col(c) for c in value_cols])
    return (keyed.groupBy(*keys).agg(F.max(row).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in value_cols]))


def _join_matched(target: DataFrame, src: DataFrame, keys, renames: dict) -> DataFrame:
    src = key_side(src.select(*keys, *[F.col(s).alias(a) for s, a in renames.items()],
                              F.lit(True).alias(_MATCHED)))
    return target.join(src, on=list(keys), how="left")


def update_from(target: DataFrame, source: DataFrame, keys, assignments: dict,
                newest=None, nulls_first=(), unique: bool = False) -> DataFrame:
    """``UPDATE t SET a = s.b ... FROM s WHERE t.k = s.k``.

    ``assignments`` maps target column → source column (or a Column over the
    source). Target columns that do not exist yet are added (NULL where
    unmatched). NULL keys never match. ``unique=True`` says the source is
    already one row per key (e.g. a ``groupBy`` on the keys), which saves the
    de-duplicating aggregate.
    """
    keys = list(keys)
    src = source
    value_cols = []
    for i, (t, s) in enumerate(assignments.items()):
        name = f"__v{i}"
        src = src.withColumn(name, F.col(s) if isinstance(s, str) else s)
        value_cols.append(name)
    if unique:
        src = src.select(*keys, *value_cols)
    else:
        src = _unique_source(src, keys, value_cols, newest, nulls_first)
    renames = {v: f"__new{i}" for i, v in enumerate(value_cols)}
    joined = _join_matched(target, src, keys, renames)
    matched = F.coalesce(F.col(_MATCHED), F.lit(False))
    out_cols = []
    new_cols = list(assignments)
    for c in target.columns:
        if c in assignments:
            i = new_cols.index(c)
            out_cols.append(F.when(matched, F.col(f"__new{i}")).otherwise(F.col(c)).alias(c))
        else:
            out_cols.append(F.col(c))
    for i, c in enumerate(new_cols):
        if c not in target.columns:
            out_cols.append(F.when(matched, F.col(f"__new{i}")).alias(c))
    return joined.select(*out_cols)


def backfill(target: DataFrame, source: DataFrame, key: str, cols, newest=None,
             nulls_first=()) -> DataFrame:
    """``SET c = COALESCE(t.c, s.c)`` for ``cols`` where the key matches.

    The reference only touches rows with a NULL among ``cols``; coalescing the
    others gives the same value, so no extra filter is needed. ``newest``
    pins which source row is used when a key has several.
    """
    cols = list(cols)
    src = _unique_source(source, [key], cols, newest, nulls_first)
    renames = {c: f"__src_{c}" for c in cols}
    joined = _join_matched(target, src, [key], renames)
    out = []
    for c in target.columns:
        if c in cols:
            out.append(F.coalesce(F.col(c), F.col(f"__src_{c}")).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def conditional_update(target: DataFrame, lookup: DataFrame, key: str, col: str,
                       lookup_col: str) -> DataFrame:
    """``SET col = f(key) WHERE col IS NULL OR col != f(key)``.

    ``lookup`` holds ``f`` as rows (key, value). If ``f`` gives NULL (no row,
    or a NULL value) an existing value is kept: ``!=`` against NULL is not
    true.
    """
    src = _unique_source(lookup, [key], [lookup_col])
    joined = _join_matched(target, src, [key], {lookup_col: "__lk"})
    old, new = F.col(col) if col in target.columns else F.lit(None), F.col("__lk")
    value = F.when(old.isNull() | (old != new), new).otherwise(old)
    out = [value.alias(c) if c == col else F.col(c) for c in target.columns]
    if col not in target.columns:
        out.append(value.alias(col))
    return joined.select(*out)


def spread_latest(df: DataFrame, key: str, value_col: str, out_col: str, newest,
                  nulls_first=()) -> DataFrame:
    """Value of the newest row of each key, written to every row of it.

    ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY newest DESC) = 1`` joined
    back on the key. Rows with a NULL key keep their ``out_col``. Built as a
    combinable aggregate plus a join (AQE splits a skewed key's partition) so
    no single task sorts a hot key's rows.
    """
    latest = latest_per_key(df, [key], newest, nulls_first, cols=[value_col])
    return update_from(df, latest, [key], {out_col: value_col}, unique=True)
