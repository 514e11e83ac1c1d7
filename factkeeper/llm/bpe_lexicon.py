"""Byte-level BPE through a minimal acyclic transducer of frequent words.

The corpus's most frequent pieces (as the pre-tokenizer cuts them) are encoded
once and compiled into an automaton whose equal suffixes are shared. Its arcs
carry numbers that add up to a word's place, and the place leads to the word's
ids, so one walk over the bytes puts out the ids. Workers map the compiled file
into memory; words that it lacks are merged exactly, by rank.

The tokenizer file's path is a parameter; its vocabulary travels to the workers
as a broadcast of fixed size, as does the automaton (``LEXICON_WORDS`` words).
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import struct
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.llm.common import stored, text_slices

LEXICON_WORDS = 50_000
LONGEST_WORD = 64
COUNTED_WORDS = 200_000
CACHED_WORDS = 300_000

# The byte-level pre-tokenizer's pattern, and the same over Latin-1 alone.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN_PIECES = re.compile(
    rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def pieces(text: str) -> list[str]:
    """The pre-tokenizer's cut of a text."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return PIECES.findall(text)
    return LATIN_PIECES.findall(text)


def byte_letters() -> dict[int, str]:
    """The printable letter by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """Exact BPE of one word, as the tokenizer file states it."""

    def __init__(self, raw: str):
        spec = json.loads(raw)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        of = {c: b for b, c in letters.items()}
        self.tokens = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.tokens[i] = bytes(of[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.added.items():
            self.tokens[i] = token.encode()
        self.first = [vocab[letters[b]] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank.setdefault((vocab[a], vocab[b]), r)
            self.made.append(vocab[a + b])

    def ids(self, word: bytes) -> list[int]:
        out = [self.first[b] for b in word]
        if len(out) > LONGEST_WORD:
            return self._long(out)
        get, none = self.rank.get, len(self.made)
        ranks = [get(p, none) for p in zip(out, out[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            new = self.made[best]
            out[i:i + 2] = [new]
            del ranks[i]
            if i:
                ranks[i - 1] = get((out[i - 1], new), none)
            if i < len(ranks):
                ranks[i] = get((new, out[i + 1]), none)
        return out

    def _long(self, out: list[int]) -> list[int]:
        """The same by a heap, for words without any bound."""
        n = len(out)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = [(rank[p], i, p) for i, p in enumerate(zip(out, out[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            best, i, pair = heapq.heappop(heap)
            j = after[i] if out[i] >= 0 else n
            if j >= n or (out[i], out[j]) != pair:
                continue
            out[i], out[j] = self.made[best], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := (out[a], out[b])) in rank:
                    heapq.heappush(heap, (rank[p], a, p))
        return [x for x in out if x >= 0]


# -- the automaton ------------------------------------------------------------

def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic transducer of ``words`` as one block of bytes."""
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    register: dict[tuple, int] = {}

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # open nodes along the last word: final, arcs
    last = b""
    ordered = sorted(words)

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            child = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], child))

    for w in ordered:
        same = len(os.path.commonprefix([w, last]))
        close(same)
        path.extend([False, []] for _ in w[same:])
        path[-1][0] = True
        last = w
    close(0)
    root = freeze(path[0])

    below = []  # words that end at or below a state; children come first
    first, labels, targets, outs = [0], [], [], []
    for final, arcs in states:
        passed = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            outs.append(passed)
            passed += below[target]
        below.append(passed)
        first.append(len(labels))
    ids = [words[w] for w in ordered]
    parts = [np.array(x, dtype=np.uint32) for x in (
        first, targets, outs, labels, [final for final, _ in states],
        np.cumsum([0, *map(len, ids)]), [i for x in ids for i in x])]
    head = np.array([root, *map(len, parts)], dtype=np.uint32)
    return b"".join(x.tobytes() for x in (head, *parts))


class Lexicon:
    """A compiled automaton, mapped into memory from a file that has no name any more."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(block)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        all_ = memoryview(self.map).cast("I")
        sizes = list(all_[1:8])
        at = np.cumsum([8, *sizes]).tolist()
        self.root = all_[0]
        (self.first, self.targets, self.outs, self.labels, self.final, self.id_at,
         self.id_list) = (all_[a:b] for a, b in zip(at, at[1:]))
        lo, hi = self.first[self.root], self.first[self.root + 1]
        self.start = {self.labels[k]: k for k in range(lo, hi)}  # the root has the most arcs

    def ids(self, word: bytes) -> memoryview | None:
        """The word's ids, or None if the lexicon lacks it."""
        first, labels = self.first, self.labels
        state, place = self.root, 0
        if word:
            arc = self.start.get(word[0])
            if arc is None:
                return None
            state, place = self.targets[arc], self.outs[arc]
        for byte in word[1:]:
            lo, end = first[state], first[state + 1]
            hi = end
            while lo < hi:
                mid = (lo + hi) >> 1
                if labels[mid] < byte:
                    lo = mid + 1
                else:
                    hi = mid
            if lo == end or labels[lo] != byte:
                return None
            place += self.outs[lo]
            state = self.targets[lo]
        if not self.final[state]:
            return None
        return self.id_list[self.id_at[place]:self.id_at[place + 1]]


def frequent_pieces(docs: DataFrame, most: int) -> list[str]:
    """The frequent pieces of all texts: those with at least the lowest count, in sixteenths
    of a doubling, that ``most`` pieces at most reach. No more than these reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["piece", "n"])
            seen.clear()
            return rows

        for b in text_slices(batches):
            for text in b.column("text").to_pylist():
                seen.update(pieces(text or ""))
            if len(seen) > COUNTED_WORDS:
                yield out()
        yield out()

    counts = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "piece string, n long")
              .groupBy("piece").agg(F.sum("n").alias("n")))
    counts = stored(counts.filter((F.col("n") > 1) & (F.octet_length("piece") <= LONGEST_WORD))
                    .withColumn("step", F.floor(F.log2("n") * 16)), "bpe-pieces")
    total, least = 0, None
    for step, n in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += n
        if total > most:
            break
        least = step
    if least is None:
        return []
    return [r[0] for r in counts.filter(F.col("step") >= least).select("piece").collect()]


class Encoder:
    """Texts to packed ids: lexicon first, exact merges for the rest, and a bounded memory of both."""

    def __init__(self, raw: str, block: bytes):
        self.merges, self.lexicon = Merges(raw), Lexicon(block)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.added = re.compile("|".join(map(re.escape, self.merges.added))) if self.merges.added else None

    def _word(self, piece: str) -> bytes:
        packed = self.known.get(piece) or self.older.get(piece) or self._fresh(piece)
        if len(self.known) >= CACHED_WORDS:
            self.known, self.older = {}, self.known
        if len(piece) <= LONGEST_WORD:
            self.known[piece] = packed
        return packed

    def _fresh(self, piece: str) -> bytes:
        word = piece.encode()
        ids = self.lexicon.ids(word)
        if ids is None:
            ids = self.merges.ids(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        known, word = self.known.get, self._word
        return b"".join([known(p) or word(p) for p in pieces(text)])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.added.finditer(text):
            out += [self._plain(text[at:m.start()]), np.array([self.merges.added[m[0]]], dtype="<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, packed: bytes) -> str:
        tokens = self.merges.tokens
        return b"".join(map(tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist())).decode("utf-8", "replace")


def default_tokenizer() -> str:
    """Path of the public byte-level tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def compiled(spark: SparkSession, docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> bytes:
    """The lexicon of a corpus's frequent pieces."""
    merges = Merges(tokenizer)
    top = [p.encode() for p in frequent_pieces(docs, words)]
    return compile_lexicon({w: merges.ids(w) for w in top})


_ENCODERS: dict[object, Encoder] = {}


def encode(docs: DataFrame, tokenizer_path: str, words: int = LEXICON_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for every row of ``docs``.

    ``ids`` packs the token ids as little-endian unsigned 32-bit integers; ``decoded``
    is the text that they decode to. A null text counts as empty: no ids, empty text.
    Rows come out as often as they came in, an empty table gives an empty one."""
    spark = docs.sparkSession
    raw = load_tokenizer(tokenizer_path)
    block = compiled(spark, docs, raw, words)
    sent = spark.sparkContext.broadcast((raw, block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sent.value is not _ENCODERS.get("of"):
            _ENCODERS.clear()
            _ENCODERS.update({"of": sent.value, "encoder": Encoder(*sent.value)})
        enc = _ENCODERS["encoder"]
        for b in text_slices(batches):
            ids = [enc.encode(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([enc.decode(x) for x in ids], pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string"))


def encode_stage(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (packed) and digests of the ids and of the decoded text."""
    return encode(docs, tokenizer_path).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
