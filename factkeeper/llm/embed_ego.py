"""Embedding near-dedup by an epsilon grid order join.

Vectors are scaled to length 1, so a cosine of ``c`` or more is a distance of
``sqrt(2 - 2c)`` or less. They are rotated onto the principal axes of a bounded sample
(``AXIS_SAMPLE`` vectors of each dimension, by a hash; the rotation moves no distance, so the
sample decides how much is pruned and not what is found), cells of that
width are laid on the leading axes, and vectors are sorted by their cells in turn: the
epsilon grid order. Sorted rows become sequence intervals of ``BLOCK_BYTES`` of vectors. Two
intervals are joined only if, on the leading axes, their extents are not provably farther
apart than epsilon; inside a task the pair of intervals is halved recursively with the
same test until small parts are compared in double precision, by the cosine itself.

Equal vectors are merged before the join and counted, so copies cost nothing. Tasks return
counts for each vector and stars in place of links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import Links, join_per_key, shuffle_partitions, stored
from factkeeper.llm.components import components

BLOCK_BYTES = 2 << 20
AXIS_SAMPLE = 4096
LEAF_ROWS = 128
AXES = 6
#: Rounding that distances on the axes may carry.
SLACK = 1e-6


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Packed vectors (little-endian doubles) as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v, dim``: rows that can link, the vector as packed doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, label, e in zip(*(b.column(c).to_pylist() for c in ("vec_id", "label", "embedding"))):
                if label is None or not e or None in e:
                    continue
                v = np.array(e, dtype="<f8")
                with np.errstate(over="ignore"):
                    length = float((v * v).sum())
                if not np.isfinite(v).all() or not v.any():
                    continue
                if not 1e-200 < length < 1e200:
                    v = v / np.abs(v).max()
                rows.append((i, label, (v + 0.0).tobytes(), len(e)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.int64(), pa.string(), pa.binary(), pa.int32()))],
                ["vec_id", "label", "v", "dim"])

    d = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    return d.mapInArrow(run, "vec_id long, label string, v binary, dim int")


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension, ``AXES`` leading axes of a sample's second moments."""
    out: dict[int, np.ndarray] = {}
    for r in vectors.select("dim").distinct().collect():   # dimensions
        some = vectors.filter(F.col("dim") == r["dim"]).orderBy(F.xxhash64("v")).limit(AXIS_SAMPLE).select("v").collect()
        u = _unit(np.frombuffer(b"".join(x["v"] for x in some), dtype="<f8").reshape(-1, r["dim"]))
        out[r["dim"]] = np.linalg.eigh(u.T @ u)[1][:, ::-1][:, :AXES]
    return out


def block_rows(dim: int) -> int:
    return max(LEAF_ROWS, BLOCK_BYTES // (8 * dim))


def _ordered(nodes: DataFrame, axes: dict[int, np.ndarray], epsilon: float) -> DataFrame:
    """Nodes in epsilon grid order within label and dimension, cut into packed intervals:
    ``label, dim, block, n, nodes, copies, vectors, low, high``."""
    sent = nodes.sparkSession.sparkContext.broadcast(axes)
    cells = [f"c{k}" for k in range(AXES)]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            cell = np.zeros((b.num_rows, AXES), dtype=np.int32)
            for dim in np.unique(dims).tolist():
                of = dims == dim
                p = _unit(_matrix(b.column("v").filter(pa.array(of)), dim)) @ sent.value[dim]
                cell[of, :p.shape[1]] = np.floor(p / epsilon)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c) for c in cell.T)], [*b.schema.names, *cells])

    placed = nodes.mapInArrow(project, "label string, dim int, v binary, node long, copies long, " + ", ".join(f"{c} int" for c in cells))
    order = ["label", "dim", *cells, "node"]
    spread = placed.repartitionByRange(shuffle_partitions(nodes.sparkSession), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, dim, rows in _runs(batches):
            v = _matrix(rows.column("v").combine_chunks(), dim)
            p = _unit(v) @ sent.value[dim]
            wide = np.zeros((len(v), AXES))
            wide[:, :p.shape[1]] = p
            node = rows.column("node").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in (
                    (label, pa.string()), (dim, pa.int32()), (int(node.min()), pa.int64()), (len(v), pa.int32()),
                    (node.astype("<i8").tobytes(), pa.binary()), (rows.column("copies").to_numpy().astype("<i8").tobytes(), pa.binary()),
                    (v.tobytes(), pa.binary()), (wide.min(axis=0).tolist(), pa.list_(pa.float64())), (wide.max(axis=0).tolist(), pa.list_(pa.float64())))],
                ["label", "dim", "block", "n", "nodes", "copies", "vectors", "low", "high"])

    return spread.select("label", "dim", "v", "node", "copies").mapInArrow(
        pack, "label string, dim int, block long, n int, nodes binary, copies binary, vectors binary, low array<double>, high array<double>")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Table]]:
    """Intervals of at most ``block_rows`` sorted rows of one label and dimension."""
    held: list[pa.RecordBatch] = []
    key, n = None, 0
    for b in batches:
        labels, dims = b.column("label").to_pylist(), b.column("dim").to_pylist()
        lo = 0
        for k in range(b.num_rows):
            if (labels[k], dims[k]) != key or n + k - lo >= block_rows(dims[k]):
                if k > lo:
                    held.append(b.slice(lo, k - lo))
                if held:
                    yield *key, pa.Table.from_batches(held)
                held, n, lo, key = [], 0, k, (labels[k], dims[k])
        if b.num_rows > lo:
            held.append(b.slice(lo))
            n += b.num_rows - lo
    if held:
        yield *key, pa.Table.from_batches(held)


def _halve(a: tuple[int, int], b: tuple[int, int], p: np.ndarray, q: np.ndarray, epsilon: float, same: bool) -> Iterator[tuple[tuple[int, int], tuple[int, int]]]:
    """Recursive join of two sequence intervals: small pairs of parts that may hold links."""
    x, y = p[a[0]:a[1]], q[b[0]:b[1]]
    gap = np.maximum(0, np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)))
    if (gap * gap).sum() > epsilon * epsilon + SLACK:
        return
    if max(len(x), len(y)) <= LEAF_ROWS:
        yield a, b
        return
    am, bm = (a[0] + a[1]) // 2, (b[0] + b[1]) // 2
    halves_a = [(a[0], am), (am, a[1])] if len(x) > LEAF_ROWS else [a]
    halves_b = [(b[0], bm), (bm, b[1])] if len(y) > LEAF_ROWS else [b]
    for s in halves_a:
        for t in halves_b:
            if not same or t[0] >= s[0]:
                yield from _halve(s, t, p, q, epsilon, same and s == t)


def join_blocks(u: np.ndarray, w: np.ndarray, p: np.ndarray, q: np.ndarray, copies_u: np.ndarray, copies_w: np.ndarray,
                cosine: float, epsilon: float, same: bool) -> tuple[np.ndarray, np.ndarray, Links]:
    """Links of each row of both intervals (copies of partners counted), and their components;
    rows of ``w`` follow those of ``u`` in the latter."""
    n_u, n_w = np.zeros(len(u), dtype=np.int64), np.zeros(len(w), dtype=np.int64)
    links = Links(len(u) + (0 if same else len(w)))
    shift = 0 if same else len(u)
    for (a0, a1), (b0, b1) in _halve((0, len(u)), (0, len(w)), p, q, epsilon, same):
        near = u[a0:a1] @ w[b0:b1].T >= cosine
        if same and a0 == b0:
            np.fill_diagonal(near, False)
        if not near.any():
            continue
        n_u[a0:a1] += near @ copies_w[b0:b1]
        if not (same and a0 == b0):
            (n_u if same else n_w)[b0:b1] += near.T @ copies_u[a0:a1]
        i, j = np.nonzero(near)
        links.add(i + a0, j + b0 + shift)
    return n_u, n_w, links


def _join(batches: Iterator[pa.RecordBatch], axes: dict[int, np.ndarray], cosine: float) -> Iterator[pa.RecordBatch]:
    """Counts (``a`` the node, ``n``) and stars (``a, b``) of pairs of intervals."""
    epsilon = math.sqrt(2 - 2 * cosine)
    for batch in batches:
        for r in batch.to_pylist():
            dim, same = r["dim"], r["block"] == r["block2"]

            def side(k: str) -> tuple[np.ndarray, ...]:
                v = _unit(np.frombuffer(r["vectors" + k], dtype="<f8").reshape(-1, dim))  # noqa: B023
                return v, v @ axes[dim], np.frombuffer(r["nodes" + k], dtype="<i8"), np.frombuffer(r["copies" + k], dtype="<i8")  # noqa: B023

            u, p, nodes, copies = side("")
            w, q, nodes2, copies2 = (u, p, nodes, copies) if same else side("2")
            n_u, n_w, links = join_blocks(u, w, p, q, copies, copies2, cosine, epsilon, same)
            every = nodes if same else np.concatenate([nodes, nodes2])
            count = n_u if same else np.concatenate([n_u, n_w])
            child, root = links.stars()
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([every[some], every[child]])), pa.array(np.concatenate([np.full(len(some), -1), every[root]])),
                 pa.array(np.concatenate([count[some], np.zeros(len(child), dtype=np.int64)])),
                 pa.array(np.repeat([False, True], [len(some), len(child)]))], ["a", "b", "n", "star"])


def near_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, label, embedding)``.

    Vectors link if their labels are equal and not null, their dimensions are equal and
    their cosine in double precision is ``cosine`` or more. Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing. ``component_id`` is the
    smallest ``vec_id`` reachable. A null ``vec_id`` links too but names no component
    (null, ``kept`` false, if no other is in it). A row that is repeated counts as often; an empty
    table gives an empty one."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors).withColumn("key", F.struct("label", "dim", "v")).select("vec_id", "key"), "vectors")
    nodes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"))
                   .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    plain = nodes.select("key.label", "key.dim", "key.v", "node", "copies")
    axes = principal_axes(plain)
    blocks = stored(_ordered(plain, axes, math.sqrt(2 - 2 * cosine)), "vector-blocks")

    # pairs of intervals: the first axis's extent, in cells, is what they are joined by
    width = math.sqrt(2 - 2 * cosine)
    extents = blocks.select("label", "dim", "block", "low", "high")
    cell_of = lambda x: F.floor(x / width)
    left = extents.select("label", "dim", "block", "low", "high",
                          F.explode(F.sequence(cell_of(F.col("low")[0]), cell_of(F.col("high")[0]) + 1)).alias("cell"))
    right = extents.select("label", "dim", F.col("block").alias("block2"), F.col("low").alias("low2"), F.col("high").alias("high2"),
                           F.explode(F.sequence(cell_of(F.col("low")[0]), cell_of(F.col("high")[0]) + 1)).alias("cell"))
    gap2 = sum((F.pow(F.greatest(F.lit(0.0), F.col("low")[k] - F.col("high2")[k], F.col("low2")[k] - F.col("high")[k]), 2)
                for k in range(AXES)), F.lit(0.0))
    pairs = (left.join(right, ["label", "dim", "cell"]).filter((F.col("block") <= F.col("block2")) & (gap2 <= width * width + SLACK))
             .select("label", "dim", "block", "block2").distinct())
    packed = blocks.select("label", "dim", "block", "nodes", "copies", "vectors")
    second = blocks.select("label", "dim", F.col("block").alias("block2"), F.col("nodes").alias("nodes2"),
                           F.col("copies").alias("copies2"), F.col("vectors").alias("vectors2"))
    todo = pairs.join(packed, ["label", "dim", "block"]).join(second, ["label", "dim", "block2"])
    sent = spark.sparkContext.broadcast(axes)
    found = stored(todo.repartition(shuffle_partitions(spark)).mapInArrow(
        lambda batches: _join(batches, sent.value, cosine), "a long, b long, n long, star boolean"), "vector-links")

    counts = found.filter("not star").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    comp = components(found.filter("star").select("a", "b")).select(F.col("node").alias("node_"), "component")
    named = stored(nodes.join(counts, "node", "left").join(comp, F.col("node") == F.col("node_"), "left")
                   .select("key", "low", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                           F.coalesce("component", "node").alias("c")), "vector-named")
    lows = named.groupBy("c").agg(F.min("low").alias("component_id"))
    of_key = join_per_key(named, lows, "c").select("key", "n_links", "component_id")
    linked = rows.join(of_key, "key").select("vec_id", "n_links", "component_id")
    alone = _lonely(vectors)
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _lonely(vectors: DataFrame) -> DataFrame:
    """The rows that can't link, each its own component."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fit = F.col("label").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0)
    return (vectors.filter(~F.coalesce(fit, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                    F.col("vec_id").cast("long").alias("component_id")))
