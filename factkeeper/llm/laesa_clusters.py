"""Centroid clustering with a LAESA pivot table.

Vectors become whole numbers (``floor(scale * x)``). Their distances to a few fixed pivots are
computed once and stored beside them. In each round the centroids' distances to the same pivots
give ``|d(x, p) - d(c, p)| <= d(x, c)``, so most centroids are ruled out without looking at the
vector; those whose lower bound doesn't exceed the best distance found get their exact distance
in 64-bit whole numbers. Each task returns one sum and count for each centroid that it met, and
the new centroids, of a number and size fixed by the parameters, are the only thing that
reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import stored

PIVOTS = 8
#: Rows whose bounds are computed at once.
ROWS = 4096
#: Rounding that a square root may carry, as a share of it.
SLACK = 1e-12


def whole_vectors(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """``vec_id, v``: vectors of exactly ``dim`` components, none null or non-finite, as packed
    64-bit whole numbers. A component too large for distances in 64 bits raises."""
    most = int(np.sqrt(2.0 ** 62 / dim)) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column("e").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            x = np.floor(flat * scale)
            if x.size and np.abs(x).max() > most:
                raise OverflowError(f"a component times {scale} is beyond {most}")
            rows = x.astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array([r.tobytes() for r in rows], pa.binary())], ["vec_id", "v"])

    e = F.col("embedding").cast("array<double>")
    fit = (F.size(e) == dim) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.filter(F.coalesce(fit, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"))
            .mapInArrow(run, "vec_id long, v binary"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(-1, dim)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows ``x`` from one vector ``y``."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vec_id, v, d``: the distances of each vector from the pivots, as packed doubles."""
    sent, dim = rows.sparkSession.sparkContext.broadcast(pivots), pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"), dim)
            d = np.sqrt(np.stack([_squares(x, p) for p in sent.value], axis=1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array([r.tobytes() for r in d], pa.binary())],
                                             ["vec_id", "v", "d"])

    return rows.mapInArrow(run, "vec_id long, v binary, d binary")


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row and its exact squared distance (ties: the smaller number),
    and how many exact distances that took."""
    of_pivots = np.sqrt(np.stack([_squares(centroids, p) for p in pivots], axis=1).astype(np.float64))
    n, k = len(x), len(centroids)
    low = np.zeros((n, k))
    for p in range(len(pivots)):
        a, b = to_pivots[:, p, None], of_pivots[None, :, p]
        np.maximum(low, np.abs(a - b) - SLACK * (a + b), out=low)
    low = np.square(low) * (1 - SLACK)
    # the centroid of the smallest bound first: its exact distance rules out most others
    first = low.argmin(axis=1)
    d = x - centroids[first]
    best, at = np.einsum("ij,ij->i", d, d), first
    exact = n
    for c in range(k):
        left = np.flatnonzero((low[:, c] <= best) & (first != c))
        if not len(left):
            continue
        exact += len(left)
        d = _squares(x[left], centroids[c])
        better = (d < best[left]) | ((d == best[left]) & (c < at[left]))
        best[left[better]], at[left[better]] = d[better], c
    return at, best, exact


def _blocks(b: pa.RecordBatch, dim: int, n_pivots: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for lo in range(0, b.num_rows, ROWS):
        part = b.slice(lo, ROWS)
        yield part, _matrix(part.column("v"), dim), np.frombuffer(b"".join(part.column("d").to_pylist()), dtype="<f8").reshape(-1, n_pivots)


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: the floor of each centroid's mean; an empty one stays."""
    k, dim = centroids.shape
    sent = table.sparkSession.sparkContext.broadcast((centroids, pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), dtype=object), np.zeros(k, dtype=np.int64)
        for b in batches:
            for _, x, d in _blocks(b, dim, len(sent.value[1])):
                at, _, _ = nearest(x, d, *sent.value)
                for c in np.unique(at).tolist():
                    mine = x[at == c]
                    sums[c] += mine.sum(axis=0).astype(object)   # ROWS components of 31 bits at most: fits
                    counts[c] += len(mine)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some], pa.int64()),
             pa.array([[str(s) for s in sums[c]] for c in some], pa.list_(pa.string()))], ["c", "n", "s"])

    parts = table.select("v", "d").mapInArrow(run, "c int, n long, s array<string>")
    each = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim)]
    out = centroids.copy()
    for r in parts.groupBy("c").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), *each).collect():   # one row a centroid
        out[r["c"]] = [int(r[f"s{i}"]) // int(r["n"]) for i in range(dim)]
    return out


def _starts(rows: DataFrame, k: int, dim: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``1:<vec_id>``."""
    rank = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = rows.filter(F.col("vec_id").isNotNull()).orderBy(rank, "v").limit(k).select("v").collect()   # k rows
    return np.array([np.frombuffer(r["v"], dtype="<i8") for r in first], dtype=np.int64).reshape(-1, dim)


def cluster(vectors: DataFrame, dim: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every usable
    row of ``vectors(vec_id, embedding)``.

    Usable vectors have exactly ``dim`` components, none null or non-finite; other rows give
    none. A component ``x`` becomes ``floor(scale * x)``. The first ``k`` centroids are the usable
    vectors with the smallest SHA-256 of ``1:<vec_id>``, in that order (fewer vectors, fewer
    centroids; equal ``vec_id``: by the vector's bytes; a null ``vec_id`` starts none but is
    clustered). Ties go to the smaller centroid. Repeated rows count as often. An empty table
    gives an empty one, as does one without a ``vec_id``. Components whose distances might pass 64 bits raise."""
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    rows = stored(whole_vectors(vectors, dim, scale), "whole-vectors")
    centroids = _starts(rows, k, dim)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    fixed = centroids[:pivots]
    table = stored(pivot_table(rows, fixed), "pivot-table")
    for _ in range(rounds):
        centroids = _moved(table, centroids, fixed)

    sent = spark.sparkContext.broadcast((centroids, fixed))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, x, d in _blocks(b, dim, len(sent.value[1])):
                at, best, _ = nearest(x, d, *sent.value)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(at, pa.int32()), pa.array(best, pa.int64())],
                                                 ["vec_id", "cluster", "distance"])

    placed = stored(table.mapInArrow(assign, "vec_id long, cluster int, distance long"), "vector-clusters")
    sums = {r["cluster"]: int(r["s"]) for r in
            placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}   # one row a centroid
    of = [(c, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
          for c in sorted(sums)]
    named = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
