"""SimHash near-dedup: binary trie self-join over 64-bit fingerprints.

Equal fingerprints are merged first. The 64 bits are cut into ``blocks`` runs;
two fingerprints that differ in at most ``budget`` bits agree on ``blocks -
budget`` of the runs at least, so for every choice of that many runs the
fingerprints are dealt out by these runs' bits, which are then the top levels of
a trie in which the other bits follow. Each task joins its tries with
themselves: pairs of nodes are traversed together, differing bits are added up,
and a pair is pruned once it exceeds the budget. Large tries are cut into parts
and joined part by part. Tasks report stars, not pairs.

The choice of ``blocks`` only sets how deep the dealt levels are; every choice
finds the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import Links, doc_text, join_per_key, shuffle_partitions, stored, text_slices
from factkeeper.llm.components import components

BITS = 64
PART_ROWS = 4096
CHUNK_ROWS = 1 << 17
LEAF_PAIRS = 64
PAIR_SLICE = 1 << 18


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority of the bits of every word shingle's XXH64 (seed 42); 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        spans = [(0, len(line))]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(line[s:e], 42) for s, e in spans]), dtype=np.uint8)
    rows = raw.reshape(-1, 8)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(rows), 1 << 15):
        ones += np.unpackbits(rows[at:at + (1 << 15)], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, told, fp``: a hash that tells texts apart, and the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("told"), pa.array(fps.view(np.int64))], ["doc_id", "told", "fp"])

    return doc_text(docs).withColumn("told", F.xxhash64("text")).mapInArrow(run, "doc_id long, told long, fp long")


def _cuts(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of each run of bits."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def choose_blocks(n: int, budget: int) -> int:
    """Fewest runs at which a dealt trie holds about ``PART_ROWS`` of ``n`` spread fingerprints."""
    for blocks in range(budget + 1, 2 * budget + 1):
        depth = (blocks - budget) * (BITS // blocks)
        if n / 2.0**depth <= PART_ROWS:
            return blocks
    return 2 * budget + 1


def _keys(fp: Column, blocks: int, budget: int) -> Column:
    """Array of (choice, bits of its runs) under which a fingerprint is dealt."""
    cuts = _cuts(blocks)
    each = []
    for i, chosen in enumerate(combinations(cuts, blocks - budget)):
        key = F.lit(0).cast("long")
        for shift, width in chosen:
            key = F.shiftleft(key, width).bitwiseOR(
                F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long")))
        each.append(F.struct(F.lit(i).alias("choice"), key.alias("key")))
    return F.array(*each)


def _rotated(fp: np.ndarray, mask: int) -> np.ndarray:
    """The bits outside ``mask``, packed to the top in their order."""
    out = np.zeros(len(fp), dtype=np.uint64)
    at = BITS
    for bit in range(BITS - 1, -1, -1):
        if not mask >> bit & 1:
            at -= 1
            out |= (fp >> np.uint64(bit) & np.uint64(1)) << np.uint64(at)
    return out


def _spread(count_a: np.ndarray, count_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of ranges, all (range index, offset in a, offset in b)."""
    n = count_a * count_b
    which = np.repeat(np.arange(len(n)), n)
    off = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return which, off // count_b[which], off % count_b[which]


def join_tries(bits: np.ndarray, pairs: np.ndarray, budget: int, found) -> None:
    """Traverse pairs of trie nodes (rows ``lo_a, hi_a, lo_b, hi_b`` of ranges of the
    sorted ``bits``, equal for a trie with itself) level by level; ``found(i, j)`` gets
    the pairs of rows within ``budget``."""
    a0, a1, b0, b1 = pairs.T
    used = np.zeros(len(pairs), dtype=np.int64)
    for level in range(BITS):
        leaf = (a1 - a0) * (b1 - b0) <= LEAF_PAIRS
        _leaves(bits, a0[leaf], a1[leaf], b0[leaf], b1[leaf], budget, found)
        a0, a1, b0, b1, used = (x[~leaf] for x in (a0, a1, b0, b1, used))
        if not len(a0):
            return
        am, bm = _middle(bits, a0, a1, level), _middle(bits, b0, b1, level)
        same = a0 == b0
        nxt = [(a0, am, b0, bm, used), (am, a1, bm, b1, used), (a0, am, bm, b1, used + 1),
               tuple(x[~same] for x in (am, a1, b0, bm, used + 1))]
        a0, a1, b0, b1, used = (np.concatenate(x) for x in zip(*nxt))
        keep = (a1 > a0) & (b1 > b0) & (used <= budget)
        a0, a1, b0, b1, used = (x[keep] for x in (a0, a1, b0, b1, used))
    _leaves(bits, a0, a1, b0, b1, budget, found)


def _middle(bits: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    """First row in each node [lo, hi) whose bit at ``level`` is 1 (binary search, all nodes at once)."""
    shift, one = np.uint64(BITS - 1 - level), np.uint64(1)
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        is1 = np.zeros(len(lo), dtype=bool)
        is1[open_] = (bits[mid[open_]] >> shift & one) == one
        hi = np.where(open_ & is1, mid, hi)
        lo = np.where(open_ & ~is1, mid + 1, lo)


def _leaves(bits, a0, a1, b0, b1, budget, found) -> None:
    """Compare the rows of small node pairs, and of equal-bit ones of any size, slice by slice."""
    na, nb = a1 - a0, b1 - b0
    total = np.cumsum(na * nb)
    lo = 0
    while lo < len(na):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + PAIR_SLICE, "right")))
        if hi == lo + 1 and na[lo] * nb[lo] > PAIR_SLICE:  # by rows of a
            step = max(1, PAIR_SLICE // int(nb[lo]))
            todo = [(np.array([s]), np.array([min(s + step, a1[lo])]), b0[lo:hi], b1[lo:hi])
                    for s in range(int(a0[lo]), int(a1[lo]), step)]
        else:
            todo = [(a0[lo:hi], a1[lo:hi], b0[lo:hi], b1[lo:hi])]
        for x0, x1, y0, y1 in todo:
            which, oa, ob = _spread(x1 - x0, y1 - y0)
            i, j = x0[which] + oa, y0[which] + ob
            near = (i != j) & (np.bitwise_count(bits[i] ^ bits[j]) <= budget)
            if near.any():
                found(i[near], j[near])
        lo = hi


def _join_chunk(t: pa.Table, masks: list[int], budget: int) -> pa.RecordBatch:
    choice, key, i, j, side = (t.column(c).to_numpy() for c in ("choice", "key", "i", "j", "side"))
    fp = t.column("fp").to_numpy().view(np.uint64)
    bits = np.zeros(len(fp), dtype=np.uint64)
    for c in np.unique(choice):
        of = choice == c
        bits[of] = _rotated(fp[of], masks[c])
    order = np.lexsort((bits, side, j, i, key, choice))
    choice, key, i, j, side, fp, bits = (x[order] for x in (choice, key, i, j, side, fp, bits))
    new = np.ones(len(fp), dtype=bool)
    new[1:] = (np.diff(choice) != 0) | (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(fp))
    mid = lo + np.add.reduceat((side == 0).astype(np.int64), lo)
    alone = i[lo] == j[lo]
    pairs = np.stack([lo, np.where(alone, hi, mid), np.where(alone, lo, mid), hi], axis=1)
    pairs = pairs[(pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2]) & (hi - lo > 1)]
    links = Links(len(fp))
    join_tries(bits, pairs, budget, links.add)
    rows, roots = links.stars()
    return pa.RecordBatch.from_arrays([pa.array(fp[rows].view(np.int64)), pa.array(fp[roots].view(np.int64))], ["a", "b"])


def similar_fingerprints(fps: DataFrame, budget: int) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` with the same components as
    all pairs of at most ``budget`` differing bits."""
    n = fps.count()
    blocks = choose_blocks(n, budget)
    chosen = list(combinations(_cuts(blocks), blocks - budget))
    masks = [sum(((1 << w) - 1) << s for s, w in c) for c in chosen]
    dealt = fps.select("fp", F.explode(_keys(F.col("fp"), blocks, budget)).alias("k")).select("fp", "k.choice", "k.key")
    large = (dealt.groupBy("choice", "key").count().filter(F.col("count") > PART_ROWS)
             .select("choice", "key", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda o: F.struct(
        F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j"),
        (F.col("mine") > o).cast("int").alias("side")))
    rows = (dealt.join(large, ["choice", "key"], "left").withColumn("mine", mine)
            .select("fp", "choice", "key", F.explode(pairs).alias("p"))
            .select("fp", "choice", "key", "p.*"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for b in batches:
            held.append(b)
            n_held += b.num_rows
            if n_held >= CHUNK_ROWS:
                t = pa.Table.from_batches(held)
                cut = _last_start(t)
                if cut:
                    yield _join_chunk(t.slice(0, cut).combine_chunks(), masks, budget)
                    held = t.slice(cut).to_batches()
                    n_held = t.num_rows - cut
        if n_held:
            yield _join_chunk(pa.Table.from_batches(held).combine_chunks(), masks, budget)

    by = ["choice", "key", "i", "j"]
    return (rows.repartition(shuffle_partitions(fps.sparkSession), *by).sortWithinPartitions(*by)
            .mapInArrow(run, "a long, b long"))


def _last_start(t: pa.Table) -> int:
    """Row at which the last group of a sorted table begins."""
    same = np.ones(t.num_rows, dtype=bool)
    for c in ("choice", "key", "i", "j"):
        x = t.column(c).to_numpy()
        same &= x == x[-1]
    return int(np.argmax(same))


def _linked(docs: DataFrame, shingle: int, budget: int) -> DataFrame:
    """``doc_id, told, fp, component_id``."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-nodes")
    comp = components(similar_fingerprints(nodes.select("fp"), budget))
    named = nodes.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("component", "fp").alias("c"))
    lows = named.groupBy("c").agg(F.min("low").alias("component_id"))
    of_fp = join_per_key(named, lows, "c").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", "told", "fp", "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` among the documents that links lead to.
    Null or wordless texts have fingerprint 0 and link like others. Rows with a null
    ``doc_id`` link too, but name no component: it is null if no other row is in it.
    Repeated rows come out as often as they came in; an empty table gives an empty one."""
    return _linked(docs, shingle, budget).select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    """A signed long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_dedup_stage(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row, of its smallest ``doc_id``
    (of texts that repeat it, the first by hash). Rows with a null ``doc_id`` can't be named and stay."""
    named = _linked(docs, shingle, budget).filter("doc_id = component_id")
    keep = stored(named.groupBy("doc_id").agg(F.min("told").alias("told"), F.count(F.lit(1)).alias("n")), "simhash-kept")
    ids = keep.select(F.col("doc_id").alias("__kept_id"), F.col("told").alias("__kept_text"))
    left = docs.join(ids, (F.col("doc_id") == F.col("__kept_id"))
                     & (F.xxhash64(F.col("text").cast("string")) == F.col("__kept_text")), "left_semi")
    if keep.filter("n > 1").limit(1).count():
        left = left.dropDuplicates(["doc_id"])
    return left.unionByName(docs.filter(F.col("doc_id").isNull()))
