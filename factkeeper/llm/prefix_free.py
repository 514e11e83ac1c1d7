"""Removal of repeated byte strings by prefix-free parsing.

A string of ``length`` bytes that starts at ``i`` hangs on a trigger: of the ``REACH``
positions from ``i`` on, the one at which a rolling window of 8 bytes has the smallest hash
(the first of equal ones). Equal strings hang on the same place within them. The triggers
parse a text into phrases; what hangs on one trigger, a run of starts, is a block, and all
its strings hold the trigger's core, the ``length - REACH + 1`` bytes behind it.

1. Cores that occur once in the corpus are dropped: nothing that hangs on them recurs.
2. Blocks that occur twice or more recur as a whole.
3. Other blocks share a core with different ones, so some of their strings may recur. The
   blocks of one core are the dictionary: they are sorted by what stands before the trigger
   (backwards) and by what stands behind the core, with the longest common prefixes of
   neighbours, in place of suffix arrays of dictionary and parse. A string that reaches ``a`` bytes before
   the trigger recurs if another block is in its group in both orders, cut at ``a`` and at
   ``REACH - 1 - a`` bytes. Cores with more than ``DICTIONARY_BLOCKS`` blocks are worked string
   by string over all tasks instead, with the same result.
4. What recurs is marked in the texts and cut out.

All steps work on documents dealt into shards of bounded size through one exchange, and a
shard reports equal things once, so a hot passage makes a row for each shard at most. Spans are
told apart by 64-bit hashes in steps 1 and 2 and under the large cores of step 3, by their bytes
in the rest of step 3.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factkeeper.llm.common import join_per_key, mix, powers, sharded, shuffle_partitions, sliding

LENGTH = 400
REACH = 128
DICTIONARY_BLOCKS = 512
CHUNK_BYTES = 1 << 17
CHUNK_BLOCKS = 1 << 15

_rng = np.random.default_rng(19680607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_TRIGGER = np.uint64(0xD6E8FEB86659FD93)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_POWERS: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = powers(np.uint64(base), max(n, CHUNK_BYTES * 2))
    return _POWERS[base][:n]


class Chunk:
    """Blocks of some documents: first start ``lo``, end of starts ``hi``, trigger ``at``
    (positions in ``buf``), and hashes of core and block."""

    def __init__(self, texts: list[bytes], length: int):
        self.length, self.core_length = length, length - REACH + 1
        self.lens = np.array([len(t) for t in texts], dtype=np.int64)
        self.offsets = np.cumsum(self.lens) - self.lens
        self.buf = np.frombuffer(b"".join(texts) + bytes(8), dtype=np.uint8)
        n = len(self.buf) - 8
        starts = np.maximum(0, self.lens - length + 1)
        total = max(0, n - length + 1)
        mark = np.zeros(total + 1, dtype=np.int8)
        some = starts > 0
        np.add.at(mark, self.offsets[some], 1)
        np.add.at(mark, (self.offsets + starts)[some], -1)
        whole = np.cumsum(mark[:total], dtype=np.int8) > 0
        if not whole.any():
            self.lo = self.hi = self.at = np.zeros(0, dtype=np.int64)
            self.core = self.block = np.zeros(0, dtype=np.uint64)
            return
        eight = np.ndarray((n,), dtype="<u8", buffer=self.buf.data, strides=(1,))
        h = eight * _TRIGGER
        h ^= h >> np.uint64(29)
        h = ((h * _TRIGGER) & _HIGH) | np.arange(n, dtype=np.uint64)
        anchor = np.where(whole, (sliding(h, REACH)[:total] & _LOW).astype(np.int64), -1)
        first = np.flatnonzero(np.diff(anchor, prepend=-2) != 0)
        end = np.append(first[1:], total)
        real = anchor[first] >= 0
        self.lo, self.hi = first[real], end[real]
        self.at = anchor[self.lo]
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.buf[:n]] * _power(_P, n), out=self.sums[1:])
        self.core = self.spans(self.at, self.at + self.core_length)
        shape = ((self.at - self.lo) * REACH + (self.hi - self.lo)).astype(np.uint64)
        self.block = mix(self.spans(self.lo, self.hi - 1 + length) ^ mix(shape + np.uint64(1)))

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of spans of bytes."""
        h = (self.sums[stop] - self.sums[start]) * _power(_P_INVERSE, len(self.sums))[start]
        return mix(h + (stop - start).astype(np.uint64))


def chunks(docs: pa.Table, length: int) -> Iterator[tuple[np.ndarray, Chunk]]:
    """Row numbers and blocks of some documents at a time."""
    rows: list[int] = []
    texts: list[bytes] = []
    size = 0
    for k, text in enumerate(docs.column("text").cast(pa.binary()).to_pylist()):
        rows.append(k)
        texts.append(text or b"")
        size += len(texts[-1])
        if size >= CHUNK_BYTES:
            yield np.array(rows), Chunk(texts, length)
            rows, texts, size = [], [], 0
    if rows:
        yield np.array(rows), Chunk(texts, length)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _unsigned(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def _find(x: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``x`` are in ``ordered``, and where."""
    if not len(ordered):
        return np.zeros(len(x), dtype=bool), np.zeros(len(x), dtype=np.int64)
    k = np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)
    return ordered[k] == x, k


def _pair(core: np.ndarray, block: np.ndarray) -> np.ndarray:
    return mix(core ^ mix(block))


CORES = "core long, shard int, n long"
BLOCKS = "core long, block long, shard int, n long"
PARTS = "kind int, key long, shard int, core long, block long, whole boolean, low int, high int, before binary, behind binary, strings binary"
RANGES = "shard int, core long, block long, low int, high int"
_PARTS = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("shard", pa.int32()), ("core", pa.int64()), ("block", pa.int64()),
                    ("whole", pa.bool_()), ("low", pa.int32()), ("high", pa.int32()), ("before", pa.binary()), ("behind", pa.binary()),
                    ("strings", pa.binary())])
_RANGES = pa.schema([("shard", pa.int32()), ("core", pa.int64()), ("block", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])
_STRING = np.dtype([("core", "<i8"), ("block", "<i8"), ("a", "<i4"), ("whole", "?")])


def report_cores(docs: pa.Table, length: int) -> pa.Table:
    each = [c.core for _, c in chunks(docs, length)]
    cores, n = np.unique(np.concatenate(each) if each else np.zeros(0, dtype=np.uint64), return_counts=True)
    return pa.table({"core": _signed(cores), "shard": pa.repeat(docs.column("shard")[0], len(cores)), "n": pa.array(n)})


def report_blocks(docs: pa.Table, shared: pa.Table, length: int) -> pa.Table:
    """Blocks on shared cores, each once, with its count."""
    cores = np.sort(_unsigned(shared.column("core")))
    found = [np.zeros((2, 0), dtype=np.uint64)]
    if len(cores):
        for _, c in chunks(docs, length):
            there, _ = _find(c.core, cores)
            found.append(np.stack([c.core[there], c.block[there]]))
    core, block = np.concatenate(found, axis=1)
    _, first, n = np.unique(_pair(core, block), return_index=True, return_counts=True)
    shard = docs.column("shard")[0] if docs.num_rows else pa.scalar(0, pa.int32())
    return pa.table({"core": _signed(core[first]), "block": _signed(block[first]), "shard": pa.repeat(shard, len(first)), "n": pa.array(n)})


def report_parts(docs: pa.Table, wanted: pa.Table, length: int) -> pa.Table:
    """What the dictionary needs of the wanted blocks: bytes before the trigger (backwards) and
    behind the core; for large dictionaries the hashes of all strings."""
    out = {name: [] for name in _PARTS.names}
    if not docs.num_rows or not wanted.num_rows:
        return pa.table(out, schema=_PARTS)
    shard = docs.column("shard")[0].as_py()
    keys = _pair(_unsigned(wanted.column("core")), _unsigned(wanted.column("block")))
    order = np.argsort(keys)
    keys = keys[order]
    whole, large = (np.array(wanted.column(c).to_pylist(), dtype=bool)[order] for c in ("whole", "large"))
    done = np.zeros(len(keys), dtype=bool)
    strings: list[tuple[np.ndarray, np.ndarray]] = []
    for _, c in chunks(docs, length):
        there, k = _find(_pair(c.core, c.block), keys)
        core, block, raw = c.core.view(np.int64), c.block.view(np.int64), c.buf.tobytes()
        for b in np.flatnonzero(there).tolist():
            w = k[b]
            if done[w]:
                continue
            done[w] = True
            lo, hi, at = int(c.lo[b]), int(c.hi[b]), int(c.at[b])
            if large[w]:
                starts = np.arange(lo, hi)
                told = np.zeros(len(starts), dtype=_STRING)
                told["core"], told["block"], told["a"], told["whole"] = core[b], block[b], at - starts, whole[w]
                strings.append((c.spans(starts, starts + length), told))
                continue
            for name, x in zip(_PARTS.names, (0, int(core[b]), shard, int(core[b]), int(block[b]), bool(whole[w]), at - hi + 1, at - lo,
                                              raw[lo:at][::-1], raw[at + c.core_length:hi - 1 + length], None)):
                out[name].append(x)
    if strings:
        hashes, told = np.concatenate([h for h, _ in strings]), np.concatenate([t for _, t in strings])
        order = np.argsort(hashes, kind="stable")
        hashes, told = hashes[order], told[order]
        first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0)
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(hashes)]):
            for name, x in zip(_PARTS.names, (1, int(hashes[a].view(np.int64)), shard, None, None, None, None, None, None, None, told[a:b].tobytes())):
                out[name].append(x)
    return pa.table(out, schema=_PARTS)


def _padded(parts: list[bytes]) -> np.ndarray:
    """Parts as rows of ``REACH`` bytes."""
    flat = np.zeros((len(parts), REACH), dtype=np.uint8)
    lens = np.array([len(p) for p in parts])
    flat[np.arange(REACH) < lens[:, None]] = np.frombuffer(b"".join(parts), dtype=np.uint8)
    return flat


def _order(core: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row in the order of (core, bytes), and the longest common prefix of each
    sorted row with the one before it (-1 where the core changes)."""
    words = rows.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], core))
    s = rows[order]
    other = np.ones((len(s), REACH + 1), dtype=bool)
    other[1:, :REACH] = s[1:] != s[:-1]
    common = other.argmax(axis=1)
    c = core[order]
    common[0] = -1
    common[1:][c[1:] != c[:-1]] = -1
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return rank, common


def resolve(core: np.ndarray, before: list[bytes], behind: list[bytes], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For blocks of whole dictionaries, whether the string that reaches ``a`` bytes before
    the trigger recurs (rows by ``a``)."""
    rank_l, common_l = _order(core, _padded(before))
    rank_r, common_r = _order(core, _padded(behind))
    out = np.zeros((len(core), REACH), dtype=bool)
    for a in range(REACH):
        rows = np.flatnonzero((low <= a) & (a <= high))
        if len(rows) < 2:
            continue
        group_l = np.cumsum(common_l < a)[rank_l[rows]]
        group_r = np.cumsum(common_r < REACH - 1 - a)[rank_r[rows]]
        key = group_l * (len(core) + 1) + group_r
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        twice = np.append(same, False) | np.append(False, same)
        out[rows[order[twice]], a] = True
    return out


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of ``a`` of recurring strings of blocks that don't recur whole; rows come sorted by kind and key."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= CHUNK_BLOCKS:
            t = pa.Table.from_batches(held)
            last = (t.column("key").to_numpy() == t.column("key")[-1].as_py()) & (t.column("kind").to_numpy() == t.column("kind")[-1].as_py())
            cut = int(np.argmax(last))
            if cut:
                yield _resolved(t.slice(0, cut))
                held, n = t.slice(cut).to_batches(), t.num_rows - cut
    if n:
        yield _resolved(pa.Table.from_batches(held))


def _resolved(t: pa.Table) -> pa.RecordBatch:
    kind = t.column("kind").to_numpy()
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    small = t.filter(pa.array(kind == 0))
    if small.num_rows:
        core, shard, block, low, high = (small.column(c).to_numpy() for c in ("core", "shard", "block", "low", "high"))
        again = resolve(core, small.column("before").to_pylist(), small.column("behind").to_pylist(), low, high)
        again[np.array(small.column("whole").to_pylist(), dtype=bool)] = False
        step = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, a = np.nonzero(step == 1)
        _, z = np.nonzero(step == -1)
        for k, x in enumerate((shard[row], core[row], block[row], a, z - 1)):
            out[k].append(x)
    large = t.filter(pa.array(kind == 1))
    if large.num_rows:
        packed = large.column("strings").to_pylist()
        n = np.array([len(p) // _STRING.itemsize for p in packed])
        told = np.frombuffer(b"".join(packed), dtype=_STRING)
        key, shard = (np.repeat(large.column(c).to_numpy(), n) for c in ("key", "shard"))
        _, at, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = (count[at] > 1) & ~told["whole"]
        for k, x in enumerate((shard[hit], told["core"][hit], told["block"][hit], told["a"][hit], told["a"][hit])):
            out[k].append(x)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(out, _RANGES)], schema=_RANGES)


def cut(docs: pa.Table, ranges: pa.Table, length: int) -> pa.Table:
    """Documents without the bytes of recurring strings; ``low`` of -1 means the whole block."""
    keys, order = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if ranges.num_rows:
        keys = _pair(_unsigned(ranges.column("core")), _unsigned(ranges.column("block")))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        low, high = (ranges.column(c).to_numpy()[order] for c in ("low", "high"))
    kept, spans, lens = [], [], []
    for _, c in chunks(docs, length):
        mark = np.zeros(len(c.buf) - 7, dtype=np.int64)
        pair = _pair(c.core, c.block)
        first, last = np.searchsorted(keys, pair), np.searchsorted(keys, pair, "right")
        n = last - first
        b = np.repeat(np.arange(len(pair)), n)
        r = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        if len(r):
            whole = low[r] < 0
            start = np.where(whole, c.lo[b], c.at[b] - high[r])
            stop = np.where(whole, c.hi[b] - 1, c.at[b] - low[r]) + length
            np.add.at(mark, start, 1)
            np.add.at(mark, stop, -1)
        gone = np.cumsum(mark[:-1]) > 0
        raw = c.buf.tobytes()
        for o, size in zip(c.offsets.tolist(), c.lens.tolist()):
            g = gone[o:o + size]
            lens.append(size)
            if not g.any():
                kept.append(raw[o:o + size])
                spans.append([])
                continue
            edge = np.diff(np.pad(g.astype(np.int8), 1))
            lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(lo, hi)])
            kept.append(c.buf[o:o + size][~g].tobytes())
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.table({"doc_id": docs.column("doc_id") if docs.num_rows else pa.array([], pa.int64()), "n_bytes": pa.array(lens, pa.int64()),
                     "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())})


def byte_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row of ``docs``.

    Removed is each byte that a string of ``length`` bytes covers which also starts anywhere
    else, in any row. ``spans`` are the maximal removed runs (``start, stop`` in bytes), ``kept`` is
    what remains. Matches don't cross rows and are judged on the input; rows that repeat remove
    each other. A null text is empty; an empty table gives an empty one."""
    if length < 2 * REACH:
        raise ValueError(f"strings of {2 * REACH} bytes or more")
    spark = docs.sparkSession
    by_shard = sharded(docs).groupBy("shard")
    cores = by_shard.applyInArrow(lambda t: report_cores(t, length), CORES)
    shared = (cores.withColumn("total", F.sum("n").over(Window.partitionBy("core"))).filter("total > 1").select("core", "shard"))
    same = Window.partitionBy("core", "block")
    blocks = (by_shard.cogroup(shared.groupBy("shard")).applyInArrow(lambda t, s: report_blocks(t, s, length), BLOCKS)
              .withColumn("total", F.sum("n").over(same)).withColumn("teller", F.min("shard").over(same)))
    each = blocks.filter("shard = teller").select("core", "block", "shard", (F.col("total") > 1).alias("whole"))
    dictionaries = (each.groupBy("core").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(~F.col("whole")).alias("open"))
                    .filter("open > 0").select("core", (F.col("blocks") > DICTIONARY_BLOCKS).alias("large")))
    wanted = join_per_key(each, dictionaries, "core").select("shard", "core", "block", "whole", "large")
    parts = by_shard.cogroup(wanted.groupBy("shard")).applyInArrow(lambda t, w: report_parts(t, w, length), PARTS)
    partly = (parts.repartition(shuffle_partitions(spark), "kind", "key").sortWithinPartitions("kind", "key")
              .mapInArrow(_ranges, RANGES))
    wholly = blocks.filter("total > 1").select("shard", "core", "block", F.lit(-1).alias("low"), F.lit(-1).alias("high"))
    ranges = wholly.unionByName(partly)
    return by_shard.cogroup(ranges.groupBy("shard")).applyInArrow(
        lambda t, r: cut(t, r, length), "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def removed(spans: Column) -> Column:
    """Bytes in an array of spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
