"""Connected components of a distributed set of links, by alternating stars.

Every round takes each node's smallest neighbour with a combining aggregate and
joins it back (the join is one that Spark can split where a hub is large), then
writes the links to the shared folder. No link reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import Links, join_per_key, stored

CONTRACT_ROWS = 1 << 20


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of a run of rows by stars with the same components."""
    def stars(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        a = np.concatenate([p.column(0).to_numpy() for p in parts])
        b = np.concatenate([p.column(1).to_numpy() for p in parts])
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        links = Links(len(nodes))
        links.add(at[:len(a)], at[len(a):])
        child, root = links.stars()
        return pa.RecordBatch.from_arrays([pa.array(nodes[child]), pa.array(nodes[root])], ["a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CONTRACT_ROWS:
            held, rows = [stars(held)], 0
            yield held.pop()
    if held:
        yield stars(held)


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (join_per_key(both.filter("b > a"), low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("low"))
    return (join_per_key(e, low, "a").select(F.explode(F.array(
        F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
        F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("x"))
        .select("x.*").filter("a > b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)`` (long ids).

    The component is its smallest node. Self links and null ends are dropped;
    repeated links do no harm; no links give an empty result."""
    e = (edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
         .filter("a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    # the exchange keeps this Python step out of the stage that made the links
    e = stored(e.distinct().mapInArrow(_contract, "a long, b long"), "links")
    seen = None
    while True:
        e = stored(_small_star(_large_star(e)), "links")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
