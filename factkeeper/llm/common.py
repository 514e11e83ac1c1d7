"""Helpers shared by the operators of this subpackage.

Inputs: every operator takes a frame with ``doc_id`` and ``text`` and selects
just these at once, so further columns, whatever their names, can't clash with
its own. A null ``text`` is an empty one unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.session import scratch_path, ship_package

SHARD_BYTES = 4 << 20
SLICE_BYTES = 4 << 20


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the shared folder, with a writer's options, and read back: cuts lineage, computed
    once. Inside a ``scratch_scope`` the folder goes when the scope ends."""
    path = scratch_path(df.sparkSession, f"llm-{label}", temporary=True)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def doc_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sharded(docs: DataFrame) -> DataFrame:
    """``doc_id, text, shard``: shards of about ``SHARD_BYTES`` of text.

    The shard comes from a hash of the row, so neither a source nor a group of
    copies can fill one; plans that group by ``shard`` again reuse the exchange.
    """
    d = doc_text(docs)
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(4 * shuffle_partitions(d.sparkSession), -(-total // SHARD_BYTES))
    return d.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows with an aggregate of one row for each value of a long ``key``.

    The aggregate would feed the join in the partitions it was made in, and Spark can't
    split those; joined by an expression of the key, both sides get shuffles of their own,
    and a hot key's rows are split."""
    apart = lambda c: F.col(c).bitwiseXOR(F.lit(1).cast("long"))
    right = per_key.withColumn("__apart", apart(key)).drop(key)
    return rows.join(right, apart(key) == F.col("__apart"), how).drop("__apart")


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``most`` bytes of text (one row at least)."""
    for b in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0)
                           .to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        ends = np.cumsum(sizes)
        while lo < b.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + most, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


# -- words as numbers ---------------------------------------------------------

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD1342543DE82EF95)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of many texts at once: the joined bytes, each
    word's start and end in them, and the index of its text."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    solid = ~_SPACE[buf]
    edge = np.diff(solid.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return buf, starts, ends, np.searchsorted(at, starts, "right") - 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty span of bytes (spans in order, not overlapping)."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    pos = np.arange(int(lens.sum())) - np.repeat(first, lens)
    val = _BYTE[buf[pos + np.repeat(starts, lens)]] * powers(_P, int(lens.max()))[pos]
    return mix(np.add.reduceat(val, first) + lens.astype(np.uint64))


def rolled(r: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive numbers, by doubling."""
    n = len(r) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done, cur, size, q = None, 0, r, 1, _Q
    left = k
    while left:
        if left & 1:
            part = cur[done:done + n]
            out = part.copy() if out is None else out * q + part
            done += size
        left >>= 1
        if left:
            cur = cur[:len(cur) - size] * q + cur[size:]
            q, size = np.uint64(int(q) ** 2 & (1 << 64) - 1), size * 2
    return mix(out)


def sliding(r: np.ndarray, k: int, pick=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of every ``k`` consecutive numbers, by doubling."""
    n = len(r) - k + 1
    if n <= 0:
        return r[:0]
    cur, size = r, 1
    while size * 2 <= k:
        cur = pick(cur[:len(cur) - size], cur[size:])
        size *= 2
    return pick(cur[:n], cur[k - size:k - size + n])


# -- linking inside a task ----------------------------------------------------

class Links:
    """Connected labels of the rows 0..n-1 of a task; pairs come in arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            other = x != y
            if not other.any():
                return
            a, b, x, y = a[other], b[other], x[other], y[other]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows that aren't their own root, and their roots."""
        rows = np.flatnonzero(self.root != np.arange(len(self.root)))
        return rows, self.root[rows]


# -- session and workers -----------------------------------------------

#: Arrow batches between Spark and Python: rows, and bytes, since texts can be long.
ARROW_ROWS, ARROW_BYTES = "2000", str(8 << 20)


def prepare(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, and give the executors' Python this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    ship_package(spark)
