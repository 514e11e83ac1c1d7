"""Phrase collocation mining with an FM-index per shard over word ids.

Each task cuts its part of the documents into shards by language, in place, and writes a shard's
pieces as word ids with the shard's vocabulary, both deflated. From then on a level is one pass over what is
left of the shards, without a shuffle of them: every shard builds an FM-index of its ids and one
of the reversed ids, finds its phrases of ``k`` words that may be frequent over all shards, and
extends their paired intervals by one word to the left and to the right. A phrase of ``k + 1``
words is a candidate if both its parts are, so if it is found from either side at the same
interval. What no candidate covers leaves the shard.

Most candidates are rare, so their counts are first summed across shards by hashed bucket (a
fixed number of counters, each stopping at the threshold): a phrase in a bucket below the
threshold can't be frequent. The next pass has one bit for each bucket, finds the phrases that
remain, and only of those writes the counts, packed by hashed range, which are summed exactly.
Buckets decide how many counts that are, never which phrases are found.

Suffixes are sorted by as many words as the level's phrases have: that is all that their
intervals need. A shard ends where a piece ends; a piece that alone is larger is cut, the words
that both sides of the cut hold form a shard that counts with the opposite sign.

Scores come from the summed counts, in whole numbers (``decimal(38, 0)``).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factkeeper.llm.common import mix, shuffle_partitions, span_hashes, stored

DEPTH = 5
#: Text of a shard; a task holds up to twice that for unfinished shards of all languages, and a level one shard's indexes.
SHARD_BYTES = 1 << 20
#: Counters that candidates share, and counters in a row of them. Their bits are broadcast.
BUCKETS = 1 << 26
RANGE = 1 << 17
#: Counters and counts that a task holds before it merges, and counters that it merges before it hands them on.
HELD_ROWS = 1 << 20
HELD_BUCKETS = 1 << 22
#: Buckets that are merged at once, and ranges in a batch of rows.
SLICE = 1 << 22
RANGE_ROWS = 64
#: Parts of a language that are ranked on their own first.
RANK_PARTS = 64

#: A-Z to a-z; white space to a space; what ends a piece to a line break.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))

#: Rows of a pass: shards (``codes``, ``words`` one a line, ``n`` all words), counts of phrases (``range``,
#: ``phrases`` one a line, ``counts``) and buckets (``range``, ``at``, ``counts``). All bytes are deflated.
_ROWS = pa.schema([("lang", pa.string()), ("sign", pa.int32()), ("codes", pa.binary()), ("words", pa.binary()), ("n", pa.int64()),
                   ("range", pa.int32()), ("at", pa.binary()), ("phrases", pa.binary()), ("counts", pa.binary())])
_DDL = "lang string, sign int, codes binary, words binary, n long, range int, at binary, phrases binary, counts binary"


# -- shards -------------------------------------------------------------------

def encode(buf: bytes) -> tuple[np.ndarray, pa.Array]:
    """Word ids of folded text, from 1, with a 0 after every piece; and the words."""
    b = np.frombuffer(buf, dtype=np.uint8)
    solid = (b != 32) & (b != 10)
    edge = np.diff(solid.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(b[solid].tobytes())).dictionary_encode()
    ids = words.indices.to_numpy().astype(np.int32) + 1
    lines = np.flatnonzero(b == 10)
    piece = np.searchsorted(lines, starts)
    cut = np.append(piece[1:] != piece[:-1], True)[:len(ids)]
    out = np.zeros(len(ids) + int(cut.sum()), dtype=np.int32)
    out[np.arange(len(ids)) + np.cumsum(cut) - cut] = ids
    return out, words.dictionary.cast(pa.string())


def _pieces(text: bytes, most: int) -> Iterator[tuple[bytes, bytes]]:
    """Folded text in parts of about ``most`` bytes that end with a piece; a longer piece is cut
    after a word. With each part come the words that the next one repeats."""
    lo = 0
    while len(text) - lo > most:
        at = text.rfind(b"\n", lo, lo + most) + 1
        if at:
            yield text[lo:at], b""
            lo = at
            continue
        after = text.find(b"\n", lo + most) + 1 or len(text)
        space = text.find(b" ", lo + most, after)
        last = text[lo:space].rsplit(None, DEPTH - 1)[1:] if space > 0 else []
        if len(last) < DEPTH - 1:
            yield text[lo:after], b""
            lo = after
            continue
        shared = b" ".join(last)
        # the next part starts with the shared words: they stand right before the space
        start = space
        for w in reversed(last):
            start = text.rfind(w, lo, start)
        yield text[lo:space], shared
        lo = start
    yield text[lo:], b""


def _rows(size: int, /, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in _ROWS], schema=_ROWS)


def _shard_row(lang: str, sign: int, ids: np.ndarray, words: pa.Array, n: int) -> pa.RecordBatch:
    planes = np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py()
    return _rows(1, lang=pa.array([lang]), sign=pa.array([sign], pa.int32()), codes=pa.array([zlib.compress(planes.tobytes(), 1)], pa.binary()),
                 words=pa.array([zlib.compress(lines.encode(), 1)], pa.binary()), n=pa.array([n], pa.int64()))


def _unpacked(codes: bytes, words: bytes) -> tuple[np.ndarray, pa.Array]:
    """A shard's ids and words."""
    ids = np.ascontiguousarray(np.frombuffer(zlib.decompress(codes), dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel()
    lines = zlib.decompress(words).decode()
    return ids.astype(np.int64), pc.split_pattern(pa.array([lines]), "\n").flatten() if lines else pa.array([], pa.string())


def _shards(batches: Iterator[pa.RecordBatch], most: int, least: int) -> Iterator[pa.RecordBatch]:
    """The shards of a task's documents, and its words' buckets."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    shared: dict[str, list[bytes]] = {}
    buckets = Buckets(least)

    def flush(lang: str, texts: list[bytes], sign: int) -> pa.RecordBatch:
        ids, words = encode(b"\n".join(texts) + b"\n")
        counts = np.bincount(ids, minlength=len(words) + 1)[1:]
        if sign > 0:
            buckets.add(word_hashes(words, lang), counts)
        return _shard_row(lang, sign, ids, words, int(counts.sum()) * sign)

    for b in batches:
        langs, texts = b.column("lang").to_pylist(), b.column("text").cast(pa.binary())
        for lang, text in zip(langs, texts):
            if not text.is_valid:
                continue
            for piece, again in _pieces(text.as_py().translate(_FOLD), most):
                if size.get(lang, 0) + len(piece) > most and lang in held:
                    yield flush(lang, held.pop(lang), 1)
                    size[lang] = 0
                held.setdefault(lang, []).append(piece)
                size[lang] = size.get(lang, 0) + len(piece) + 1
                if again:
                    shared.setdefault(lang, []).append(again)
            if sum(size.values()) > 2 * most:
                most_held = max(size, key=size.get)
                yield flush(most_held, held.pop(most_held), 1)
                del size[most_held]
            if buckets.full():
                yield from buckets.rows()
    for lang, texts in held.items():
        yield flush(lang, texts, 1)
    for lang, texts in shared.items():
        yield flush(lang, texts, -1)
    yield from buckets.rows()


# -- buckets --------------------------------------------------------------------

def word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    """A 64-bit hash of each word of a language."""
    offsets, data = words.buffers()[1:]
    ends = np.frombuffer(offsets, dtype=np.int32)[words.offset:words.offset + len(words) + 1]
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    return mix(span_hashes(np.frombuffer(data, dtype=np.uint8), ends[:-1].astype(np.int64), ends[1:].astype(np.int64))
               ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))


def phrase_hashes(words: np.ndarray, phrases: np.ndarray) -> np.ndarray:
    """Hashes of phrases (rows of ids from 1) from those of their words."""
    h = words[phrases[:, 0] - 1]
    for column in phrases.T[1:]:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[column - 1])
    return h


class Buckets:
    """A task's counters, each stopping at the threshold: sums over tasks, or over what a task hands
    on at a time, reach it if and only if the sums of the full counts do."""

    def __init__(self, least: int):
        self.least = least
        self.kind = np.min_scalar_type(least)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.merged, self.held = 0, 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append(self._summed((hashes % np.uint64(BUCKETS)).astype(np.uint32), counts))
        self.held += len(self.parts[-1][0])
        if self.held > 2 * self.merged + HELD_ROWS:
            self._merge()

    def _summed(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, dtype=np.int64)
        sums = np.add.reduceat(np.minimum(counts, self.least)[order].astype(np.int64), first) if len(at) else at
        return at[first], np.minimum(sums, self.least).astype(self.kind)

    def _merge(self) -> None:
        if len(self.parts) > 1:
            slices = []
            for lo in range(0, BUCKETS, SLICE):
                spans = [slice(*np.searchsorted(at, np.array([lo, lo + SLICE], dtype=np.uint32))) for at, _ in self.parts]
                slices.append(self._summed(*(np.concatenate([x[s] for x, s in zip(xs, spans)]) for xs in zip(*self.parts))))
            self.parts = [tuple(np.concatenate(x) for x in zip(*slices))]
        self.merged = self.held = sum(len(at) for at, _ in self.parts)

    def full(self) -> bool:
        return self.merged > HELD_BUCKETS

    def rows(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        if not self.held:
            return
        at, counts = self.parts[0]
        self.parts, self.merged, self.held = [], 0, 0
        bounds = [0, *(np.flatnonzero(np.diff(at // RANGE)) + 1).tolist(), len(at)]
        for lo in range(0, len(bounds) - 1, RANGE_ROWS):
            spans = list(zip(bounds[lo:lo + RANGE_ROWS], bounds[lo + 1:lo + RANGE_ROWS + 1]))
            yield _rows(len(spans), range=pa.array([int(at[a]) // RANGE for a, _ in spans], pa.int32()),
                        at=pa.array([_gaps(at[a:b] % RANGE) for a, b in spans], pa.binary()),
                        counts=pa.array([zlib.compress(counts[a:b].tobytes(), 1) for a, b in spans], pa.binary()))


def _gaps(at: np.ndarray) -> bytes:
    """Ascending numbers as the gaps between them, a byte each, deflated; 255 goes on without a number."""
    gap = np.diff(at.astype(np.int64), prepend=0)
    skips = gap // 255
    out = np.full(int(skips.sum()) + len(gap), 255, dtype=np.uint8)
    out[np.cumsum(skips + 1) - 1] = gap % 255
    return zlib.compress(out.tobytes(), 1)


def _numbers(gaps: bytes) -> np.ndarray:
    g = np.frombuffer(zlib.decompress(gaps), dtype=np.uint8)
    return np.cumsum(g, dtype=np.int64)[g < 255]


class Counts:
    """A task's counts of phrases, summed over its shards as far as they are held."""

    def __init__(self, ranges: int):
        self.ranges = ranges
        self.parts: list[pa.Table] = []
        self.held = 0

    def add(self, lang: str, phrases: pa.Array, hashes: np.ndarray, n: np.ndarray) -> None:
        ranges = (mix(hashes) % np.uint64(self.ranges)).astype(np.int32)
        self.parts.append(pa.table({"lang": pa.repeat(lang, len(n)), "range": ranges, "phrase": phrases.cast(pa.string()), "n": pa.array(n, pa.int64())}))
        self.held += len(n)

    def full(self) -> bool:
        if self.held <= HELD_ROWS // 2:
            return False
        self.parts = [_summed(self.parts, ["lang", "range", "phrase"])]
        self.held = self.parts[0].num_rows
        return self.held > HELD_ROWS // 4

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            t = _summed(self.parts, ["lang", "range", "phrase"]).sort_by([("lang", "ascending"), ("range", "ascending"), ("phrase", "ascending")]).combine_chunks()
            lang, ranges = t["lang"].combine_chunks().dictionary_encode(), t["range"].to_numpy()
            cuts = np.flatnonzero((np.diff(ranges) != 0) | (np.diff(lang.indices.to_numpy()) != 0)) + 1
            n = t["n"].to_numpy().astype("<i8")
            bounds = [0, *cuts.tolist(), t.num_rows]
            for lo in range(0, len(bounds) - 1, RANGE_ROWS):
                spans = list(zip(bounds[lo:lo + RANGE_ROWS], bounds[lo + 1:lo + RANGE_ROWS + 1]))
                yield _rows(len(spans), lang=pa.array([t["lang"][a].as_py() for a, _ in spans]), range=pa.array([int(ranges[a]) for a, _ in spans], pa.int32()),
                            phrases=pa.array([zlib.compress("\n".join(t["phrase"].slice(a, b - a).to_pylist()).encode(), 1) for a, b in spans], pa.binary()),
                            counts=pa.array([zlib.compress(n[a:b].tobytes(), 1) for a, b in spans], pa.binary()))
        self.parts, self.held = [], 0


def _summed(parts: list[pa.Table], by: list[str]) -> pa.Table:
    return pa.concat_tables(parts).group_by(by).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select([*by, "n"])


def _frequent(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sum the counts of each language's ranges; rows come by language and range."""
    now, parts, held = None, [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        t = _summed(parts, ["phrase"])
        for b in t.filter(pc.greater_equal(t["n"], least)).to_batches(max_chunksize=1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array([now[0]] * b.num_rows, pa.string()), b.column("phrase"), b.column("n")], ["lang", "phrase", "f"])

    for b in batches:
        for lang, r, phrases, n in zip(*(b.column(c).to_pylist() for c in ("lang", "range", "phrases", "counts"))):
            if (lang, r) != now:
                if parts:
                    yield from rows()
                now, parts, held = (lang, r), [], 0
            parts.append(pa.table({"phrase": pa.array(zlib.decompress(phrases).decode().split("\n"), pa.string()), "n": np.frombuffer(zlib.decompress(n), dtype="<i8")}))
            held += parts[-1].num_rows
            if held > HELD_ROWS:
                parts = [_summed(parts, ["phrase"])]
                held = -parts[0].num_rows   # as many more again before the next merge
    if parts:
        yield from rows()


def _full(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sum the counters of each range; rows come by range. A bit for each full bucket."""
    kind, now, sums = np.min_scalar_type(least), None, np.zeros(RANGE, dtype=np.int64)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(sums >= least, bitorder="little").tobytes()])], ["range", "bits"])

    for b in batches:
        for r, at, counts in zip(*(b.column(c).to_pylist() for c in ("range", "at", "counts"))):
            if r != now:
                if now is not None and (sums >= least).any():
                    yield row()
                now, sums = r, np.zeros(RANGE, dtype=np.int64)
            sums[_numbers(at)] += np.frombuffer(zlib.decompress(counts), dtype=kind)
    if now is not None and (sums >= least).any():
        yield row()


def full_buckets(rows: DataFrame, least: int) -> np.ndarray:
    """One bit for each bucket whose sum over all tasks reaches ``least``: ``BUCKETS`` bits in the driver."""
    ranges = rows.filter(F.col("at").isNotNull()).select("range", "at", "counts").repartition("range").sortWithinPartitions("range")
    bits = np.zeros(BUCKETS // 8, dtype=np.uint8)
    for r in ranges.mapInArrow(lambda batches: _full(batches, least), "range int, bits binary").collect():
        lo = r["range"] * RANGE // 8
        bits[lo:lo + RANGE // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return bits


def _may(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


# -- the index ----------------------------------------------------------------

def _order(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``t`` (cyclic) sorted by their first ``depth`` ids, by doubling."""
    rank, size = t.astype(np.int64), 1
    while size * 2 < depth:
        _, rank = np.unique(rank * (rank.max() + 1) + np.roll(rank, -size), return_inverse=True)
        size *= 2
    if size < depth:
        rank = rank * (int(rank.max()) + 1) + np.roll(rank, size - depth)   # two halves that may overlap
    return np.argsort(rank, kind="stable")


@dataclass
class FMIndex:
    """Start of each id's rows, BWT, and the rows of each id in it (the ranks)."""

    first: np.ndarray
    bwt: np.ndarray
    keys: np.ndarray
    order: np.ndarray

    @classmethod
    def build(cls, t: np.ndarray, n_ids: int, depth: int = DEPTH) -> FMIndex:
        order = _order(t, depth)
        bwt = t[order - 1].astype(np.int64)
        by_id = np.argsort(bwt, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=n_ids))])
        return cls(first, bwt, bwt[by_id] * (len(t) + 1) + by_id, order)

    def step(self, ids: np.ndarray, row: np.ndarray) -> np.ndarray:
        """First row of ``id`` + the suffixes before ``row``: start of an extended interval."""
        return np.searchsorted(self.keys, ids * (len(self.bwt) + 1) + row)

    def find(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of phrases (rows of ids): their intervals."""
        lo, hi = self.first[phrases[:, -1]], self.first[phrases[:, -1] + 1]
        for k in range(phrases.shape[1] - 2, -1, -1):
            lo, hi = self.step(phrases[:, k], lo), self.step(phrases[:, k], hi)
        return lo, hi

    def before(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids before the rows of each interval: the interval's number, id, count, start of the
        extended interval, and how many rows of the interval have a smaller id before them."""
        n = hi - lo
        node = np.repeat(np.arange(len(n)), n)
        rows = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        key, count = np.unique(node * len(self.first) + self.bwt[rows], return_counts=True)
        node, ids = key // len(self.first), key % len(self.first)
        less = np.cumsum(count) - count
        less -= np.repeat(less[np.searchsorted(node, np.arange(len(n)))], np.bincount(node, minlength=len(n))) if len(n) else 0
        some = ids > 0
        node, ids, count, less = node[some], ids[some], count[some], less[some]
        return node, ids, count, self.step(ids, lo[node]), less


@dataclass
class Extended:
    """Phrases of one word more: their ids, their count, and their first row in the forward index."""

    phrases: np.ndarray
    n: np.ndarray
    lo: np.ndarray


def extend(forward: FMIndex, backward: FMIndex, phrases: np.ndarray) -> Extended:
    """Extend the intervals of ``phrases`` in both directions; a phrase of one word more counts if
    its first words and its last words are both among them."""
    lo, hi = forward.find(phrases)
    back, _ = backward.find(phrases[:, ::-1])
    node, word, n, start, _ = forward.before(lo, hi)                   # word + phrase
    node_r, word_r, _, _, less = backward.before(back, back + hi - lo)  # phrase + word
    start_r = lo[node_r] + less   # the paired interval: rows with a smaller word after the phrase come first
    # a phrase found from either side is the same where its rows in the forward index are
    _, a, b = np.intersect1d(start, start_r, assume_unique=True, return_indices=True)
    return Extended(np.column_stack([phrases[node_r[b]], word_r[b]]), n[a], start[a])


def _kept_text(t: np.ndarray, forward: FMIndex, found: Extended) -> np.ndarray:
    """What the found phrases cover, other ids left out; where two of them don't overlap by all
    but one word, a 0 parts them."""
    k = found.phrases.shape[1]
    node = np.repeat(found.lo - (np.cumsum(found.n) - found.n), found.n)
    starts = np.zeros(len(t), dtype=bool)
    starts[forward.order[node + np.arange(len(node))]] = True
    at = np.flatnonzero(starts)
    if not len(at):
        return np.zeros(0, dtype=t.dtype)
    new = np.append(True, np.diff(at) > 1)   # a run of neighbouring starts is one piece
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
    lo, hi = at[new], at[ends] + k
    size = hi - lo + 1
    out = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    text = t[np.minimum(out, len(t) - 1)]
    text[np.cumsum(size) - 1] = 0
    return text


def _level(row: dict, k: int, bits: np.ndarray, counts: Counts, buckets: Buckets) -> Iterator[pa.RecordBatch]:
    """One shard, one level: counts its phrases of ``k`` words that may be frequent, puts their
    extensions by one word into the buckets, and gives the shard of what those cover."""
    t, words = _unpacked(row["codes"], row["words"])
    hashes = word_hashes(words, row["lang"])
    if k == 1:    # words that may be frequent, renumbered; the rest parts pieces
        used = np.append(False, _may(bits, hashes))
        t, words, hashes = (np.cumsum(used) * used)[t], words.filter(pa.array(used[1:])), hashes[used[1:]]
        t = t[(t > 0) | np.append(False, t[:-1] > 0)]
        t = np.append(t, 0) if not len(t) or t[-1] else t
    if not len(words):
        return
    depth = min(k + 1, DEPTH)
    forward, backward = FMIndex.build(t, len(words) + 1, depth), FMIndex.build(t[::-1], len(words) + 1, depth)
    phrases, n = np.arange(1, len(words) + 1)[:, None], np.diff(forward.first)[1:]
    for _ in range(1, k):    # all that the text holds are candidates
        found = extend(forward, backward, phrases)
        phrases, n = found.phrases, found.n
    of = phrase_hashes(hashes, phrases)
    left = _may(bits, of)
    phrases, n, of = phrases[left], n[left], of[left]
    if not len(n):
        return
    parts = [words.take(pa.array(c - 1)) for c in phrases.T]
    said = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " ")
    counts.add(row["lang"], said, of, n * row["sign"])
    if k == DEPTH:
        return
    found = extend(forward, backward, phrases)
    if not len(found.n):
        return
    if row["sign"] > 0:
        buckets.add(phrase_hashes(hashes, found.phrases), found.n)
    text = _kept_text(t, forward, found)
    some = np.unique(text[text > 0])
    number = np.zeros(len(words) + 1, dtype=np.int64)
    number[some] = np.arange(1, len(some) + 1)
    yield _shard_row(row["lang"], row["sign"], number[text], words.take(pa.array(some - 1)), 0)


def _pass(batches: Iterator[pa.RecordBatch], k: int, bits: np.ndarray, least: int, ranges: int) -> Iterator[pa.RecordBatch]:
    counts, buckets = Counts(ranges), Buckets(least)
    for b in batches:
        for i in range(b.num_rows):
            row = {c: b.column(c)[i].as_py() for c in ("lang", "sign", "codes", "words")}
            yield from _level(row, k, bits, counts, buckets)
            if counts.full():
                yield from counts.rows()
            if buckets.full():
                yield from buckets.rows()
    yield from counts.rows()
    yield from buckets.rows()


# -- levels and scores ------------------------------------------------------

def mine(docs: DataFrame, least: int = 100, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of all phrases of up to ``DEPTH`` words with ``least`` occurrences, and
    ``lang, n`` (all words of the language)."""
    spark = docs.sparkSession
    d = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    rows = stored(d.mapInArrow(lambda batches: _shards(batches, shard_bytes, least), _DDL), "phrase-shards", compression="none")
    totals = stored(rows.filter(F.col("codes").isNotNull()).groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    counted, ranges = None, max(64, shuffle_partitions(spark))
    for k in range(1, DEPTH + 1):
        bits = spark.sparkContext.broadcast(full_buckets(rows, least))
        text = rows.filter(F.col("codes").isNotNull()).select("lang", "sign", "codes", "words")
        rows = stored(text.mapInArrow(_pass_of(k, bits, least, ranges), _DDL), f"phrase-level-{k}", compression="none")
        packed = rows.filter(F.col("phrases").isNotNull()).select("lang", "range", "phrases", "counts")
        counted = packed if counted is None else counted.unionByName(packed)
    dealt = counted.repartition("lang", "range").sortWithinPartitions("lang", "range")
    return stored(dealt.mapInArrow(lambda batches: _frequent(batches, least), "lang string, phrase string, f long"), "phrases"), totals


def _pass_of(k: int, bits: Broadcast, least: int, ranges: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: _pass(batches, k, bits.value, least, ranges)


def score() -> Column:
    """``floor(1000 * a * n / (l * r))`` in whole numbers of up to 38 digits."""
    return F.expr("cast(a as decimal(19,0)) * cast(n as decimal(15,0)) * cast(1000 as decimal(4,0))"
                  " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of ``docs(lang, text)``: each language's first
    ``top`` phrases of 2 to ``DEPTH`` words.

    Text is folded to a-z and split into pieces at ``[.,;:!?\\x0A-\\x0D]``, pieces into words at
    spaces and tabs; other white space and digits are letters of words. A null text is empty, a
    null ``lang`` is ``und``. ``a`` is the phrase's count (``least`` or more), ``n`` all words of
    the language, ``l`` and ``r`` the counts of the two parts at the cut with the smallest
    ``floor(1000 * a * n / (l * r))``, which is the score (ties: the earlier cut). A phrase
    inside a longer one that is counted as often is left out. Ranks go by score and ``a``,
    largest first, then the phrase's bytes. Repeated rows count as often; an empty table, or one
    without a frequent phrase, gives an empty result."""
    phrases, totals = mine(docs, least, shard_bytes)
    words = F.split("phrase", " ")
    long_ones = phrases.filter(F.size(words) > 1)
    joined = lambda lo, n: F.array_join(F.slice(words, lo, n), " ")
    cuts = (long_ones.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", joined(F.lit(1), F.col("k")).alias("first"),
        joined(F.col("k") + 1, F.size(words) - F.col("k")).alias("rest"), (F.size(words) - 1).alias("last_k")))
    count_of = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = stored(cuts.join(count_of("first", "l"), ["lang", "first"]).join(count_of("rest", "r"), ["lang", "rest"]), "phrase-cuts")

    # a phrase with an extension of one word that is counted as often (so one of any length) is left out
    inside = (cuts.filter("k = 1 and r = a").select("lang", F.col("rest").alias("phrase"))
              .unionByName(cuts.filter("k = last_k and l = a").select("lang", F.col("first").alias("phrase"))).distinct())
    scored = cuts.join(totals, "lang").withColumn("score", score())
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select(
        "lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")
    best = best.join(inside, ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    near = best.withColumn("part", part).withColumn("i", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("i") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return near.select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "n", "score").filter(F.col("rank") <= top)
