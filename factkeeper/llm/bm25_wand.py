"""Benchmark decontamination: a BM25 index of test items, searched block-max WAND style.

Items are indexed in shards of bounded size (``SHARD_BYTES`` of text). The frequencies of terms
are counted over all items and joined to the shards' terms; a task builds each shard's
index, and the indexes are a table in the shared folder. ``PASS_SHARDS`` of them at a time are
broadcast, and the documents are read once for each such group, so once for up to 8 MB of items.

A document is cut into passages of ``PASSAGE_WORDS`` words that overlap by half, and every
passage is a query. A term's impact on an item is its BM25 weight as a share of what the
item scores against itself, so that one threshold holds for all items. Passages whose terms'
largest impacts can't add up to the threshold are skipped, then blocks of items whose
block maxima can't. Postings lie by term and block, and only those of the blocks left are
read; an item is dropped as soon as what it has and what the terms to come could add to
its block don't reach the threshold. Each hit is verified by five-word shingles: the share
of the item's that stand near the passage, and those of its question and its answer.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import doc_text, stored, text_slices

PASSAGE_WORDS = 64
SHARD_BYTES = 1 << 20
PASS_SHARDS = 8
BLOCKS = 64
THRESHOLD = 0.65
SHINGLE = 5
MIN_OVERLAP = 0.8
MIN_PART_OVERLAP = 0.5
K1, B = 1.2, 0.75

WORD = re.compile(r"[^\W_]+")
SENTENCE_END = re.compile(r"[.?!:]\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Question and answer: cut at the last sentence end that leaves ``SHINGLE`` words
    on both sides, else the last third of the words is the answer."""
    for m in reversed(list(SENTENCE_END.finditer(text))):
        q, a = words_of(text[:m.end()]), words_of(text[m.end():])
        if len(q) >= SHINGLE and len(a) >= SHINGLE:
            return q, a
    w = words_of(text)
    cut = len(w) - len(w) // 3
    return w[:cut], w[cut:]


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    """Distinct runs of ``size`` words; of fewer words the whole run."""
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def sure_share(n: int) -> float:
    """Share of an item of ``n`` words that some passage holds, wherever the item stands."""
    half = PASSAGE_WORDS / 2
    return min(1.0, max((half / 2 + n / 2) / n, 0.0), PASSAGE_WORDS / n) if n > half else 1.0


def share(part: set, words: list[str]) -> float:
    """Share of a part's shingles (all of one size) that stand in ``words``."""
    return len(part & shingles(words, len(next(iter(part))))) / len(part) if part else 1.0


@dataclass
class Index:
    """One shard: items, term numbers, and impacts by term and block."""
    item_ids: list[int]
    items: list[list[str]]
    question: list[set]
    answer: list[set]
    whole: list[set]
    terms: dict[str, int] = field(default_factory=dict)

    def build(self, df: dict[str, int], n_items: int, mean_words: float) -> Index:
        postings: list[tuple[int, int, float]] = []
        for i, words in enumerate(self.items):
            tf = Counter(words)
            norm = K1 * (1 - B + B * len(words) / mean_words)
            weight = {t: np.log1p((n_items - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm) for t, n in tf.items()}
            own = sum(weight.values()) * sure_share(len(words))
            postings += [(self.terms.setdefault(t, len(self.terms)), i, w / own) for t, w in weight.items()]
        n, v = len(self.items), len(self.terms)
        term, item, impact = (np.array(x) for x in zip(*sorted(postings)))
        self.item, self.impact = item, impact
        self.block_size = -(-n // BLOCKS)
        blocks = -(-n // self.block_size)
        # items ascend within a term, so the postings of a term and block lie together
        self.first = np.searchsorted(term * blocks + item // self.block_size, np.arange(v * blocks + 1))
        self.block_max = np.zeros((v + 1, blocks), dtype=np.float32)
        np.maximum.at(self.block_max, (term, item // self.block_size), impact)
        self.block_max = np.nextafter(self.block_max, np.float32(np.inf)) * (self.block_max > 0)
        self.term_max = self.block_max.max(axis=1)
        return self

    def candidates(self, tids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first word, last word, blocks) of passages that may reach the threshold; ``tids`` are
        the term numbers of words of many documents, ``doc`` the document of each."""
        half = PASSAGE_WORDS // 2
        new = np.flatnonzero(np.diff(doc, prepend=-1))
        lens = np.diff(np.append(new, len(doc)))
        halves = -(-lens // half)
        which = np.repeat(np.arange(len(new)), halves)
        nth = np.arange(int(halves.sum())) - np.repeat(np.cumsum(halves) - halves, halves)
        start = new[which] + nth * half
        end = np.minimum(start + PASSAGE_WORDS, (new + lens)[which])
        follows = np.append(which[1:] == which[:-1], False)
        at = start[:, None] + np.arange(half)
        grid = np.where(at < (new + lens)[which][:, None], tids[np.minimum(at, len(tids) - 1)], len(self.terms))
        bound = self.term_max[grid].sum(axis=1)
        some = np.flatnonzero(bound + np.where(follows, np.append(bound[1:], 0), 0) >= THRESHOLD * (1 - 1e-5))
        if not len(some):
            return
        need = np.unique(np.concatenate([some, (some + 1)[follows[some]]]))
        sums = np.zeros((len(need) + 1, self.block_max.shape[1]), dtype=np.float32)
        for column in grid[need].T:
            sums[:-1] += self.block_max[column]
        row = np.full(len(start) + 1, len(need))
        row[need] = np.arange(len(need))
        total = sums[row[some]] + np.where(follows[some, None], sums[row[some + 1]], 0)
        hit = total >= THRESHOLD * (1 - 1e-5)
        for k in np.flatnonzero(hit.any(axis=1)):
            yield int(start[some[k]]), int(end[some[k]]), np.flatnonzero(hit[k])

    def scores(self, tids: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[int, float]]:
        """Exact scores at or above the threshold, of the items in some blocks."""
        terms = np.unique(tids)
        terms = terms[terms < len(self.terms)]
        width = self.block_max.shape[1]
        for block in blocks.tolist():
            most = self.block_max[terms, block]
            order = np.argsort(-most, kind="stable")
            order = order[most[order] > 0]
            left = np.append(np.cumsum(most[order][::-1], dtype=np.float64)[::-1], 0.0)   # what terms from here on can add
            found: dict[int, float] = {}
            for k, t in enumerate(terms[order].tolist()):
                lo, hi = self.first[t * width + block:t * width + block + 2]
                new = left[k] >= THRESHOLD * (1 - 1e-5)   # else an item that has no term yet can't reach it
                for i, x in zip(self.item[lo:hi].tolist(), self.impact[lo:hi].tolist()):
                    if i in found:
                        found[i] += x
                    elif new:
                        found[i] = x
                found = {i: x for i, x in found.items() if x + left[k + 1] >= THRESHOLD * (1 - 1e-5)}
                if not found and left[k + 1] < THRESHOLD * (1 - 1e-5):
                    break
            yield from ((i, x) for i, x in found.items() if x >= THRESHOLD)

    def matches(self, texts: list[str | None]) -> list[tuple[int, int, int, float, float, float, float]]:
        """(text, item, first word, score, overlap, question's, answer's), best passage of each."""
        get, none = self.terms.get, len(self.terms)
        docs = [words_of(t) for t in texts]
        tids = np.array([get(w, none) for d in docs for w in d], dtype=np.int64)
        if not len(tids):
            return []
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        base = np.cumsum([0, *map(len, docs)])
        best: dict[tuple[int, int], tuple] = {}
        for lo, hi, blocks in self.candidates(tids, doc):
            d = int(doc[lo])
            for i, score in self.scores(tids[lo:hi], blocks):
                if (d, i) in best and best[d, i][1] >= score:
                    continue
                n, at = len(self.items[i]), lo - int(base[d])
                near = docs[d][max(0, at - n):at + PASSAGE_WORDS + n]
                over = share(self.whole[i], near), share(self.question[i], near), share(self.answer[i], near)
                if over[0] >= MIN_OVERLAP and min(over[1:]) >= MIN_PART_OVERLAP:
                    best[d, i] = (at, score, *over)
        return [(d, self.item_ids[i], *x) for (d, i), x in sorted(best.items())]


def index_table(items: DataFrame) -> tuple[DataFrame | None, int]:
    """``shard, index`` (pickled) over the distinct rows of ``item_id, text``, and the number of
    shards; items without words are left out. None where there is no other."""
    d = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
         .filter("text is not null").distinct())
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * total // SHARD_BYTES))
    d = d.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            df: Counter[tuple[int, str]] = Counter()
            words = 0
            for shard, text in zip(b.column("shard").to_pylist(), b.column("text").to_pylist()):
                own = words_of(text)
                df.update((shard, w) for w in set(own))
                df[-1, ""] += bool(own)
                words += len(own)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in df], pa.int32()), pa.array([w for _, w in df], pa.string()),
                                              pa.array(list(df.values()), pa.int64()), pa.array([0 if w else words for _, w in df], pa.int64())],
                                             ["of_shard", "term", "df", "words"])

    terms = stored(d.mapInArrow(run, "of_shard int, term string, df long, words long").groupBy("of_shard", "term")
                   .agg(F.sum("df").alias("df"), F.sum("words").alias("words")), "bm25-terms")
    whole = terms.filter("term = ''").first()
    if whole is None or not whole["df"]:
        return None, 0
    size, mean = whole["df"], whole["words"] / whole["df"]
    freq = terms.groupBy("term").agg(F.sum("df").alias("of_all"))
    known = terms.select("of_shard", "term").join(freq, "term")

    def build(rows: pa.Table, df: pa.Table) -> pa.Table:
        said = sorted(((i, t) for i, t in zip(rows["item_id"].to_pylist(), rows["text"].to_pylist()) if words_of(t)), key=lambda r: (r[0] is not None, r))
        out = []
        if said:
            words = [words_of(t) for _, t in said]
            parts = [split_item(t) for _, t in said]
            index = Index([i for i, _ in said], words, [shingles(q) for q, _ in parts], [shingles(a) for _, a in parts], [shingles(w) for w in words])
            out = [pickle.dumps(index.build(dict(zip(df["term"].to_pylist(), df["of_all"].to_pylist())), size, mean))]
        return pa.table({"shard": pa.array(rows["shard"].to_pylist()[:len(out)], pa.int32()), "index": pa.array(out, pa.binary())})

    both = d.groupBy("shard").cogroup(known.groupBy("of_shard"))
    return stored(both.applyInArrow(build, "shard int, index binary"), "bm25-shards"), n


def indexes(items: DataFrame) -> Iterator[Index]:
    """The shards' indexes, one at a time."""
    table, n = index_table(items)
    for k in range(n if table is not None else 0):
        row = table.filter(F.col("shard") == k).first()   # a shard's index
        if row is not None:
            yield pickle.loads(row["index"])


def _passes(items: DataFrame) -> Iterator[list[Index]]:
    """The indexes that one reading of the documents searches."""
    held: list[Index] = []
    for index in indexes(items):
        held.append(index)
        if len(held) == PASS_SHARDS:
            yield held
            held = []
    if held:
        yield held


def find_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document and item found in it: ``doc_id, item_id, passage_start``
    (word), ``score`` (share of the item's own), ``overlap, question_overlap, answer_overlap``.

    Null and empty texts match nothing, nor do items without words; no items or no
    documents give an empty result; repeated documents give repeated results, a repeated item
    is one. Ties go to the first passage."""
    d = doc_text(docs)
    schema = ("doc_id long, item_id long, passage_start long, score double, overlap double, "
              "question_overlap double, answer_overlap double")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.float64()] * 4
    out = None
    for some in _passes(items):
        sent = d.sparkSession.sparkContext.broadcast(some)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in text_slices(batches):
                ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
                rows = [(ids[k], *x) for index in sent.value for k, *x in index.matches(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, kinds)], names)

        found = d.mapInArrow(run, schema)
        if len(some) == PASS_SHARDS:    # there may be more: this group's indexes can go
            found = stored(found, "bm25-matches")
            sent.unpersist()
        out = found if out is None else out.unionByName(found)
    return d.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate_stage(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    for some in _passes(items):
        sent = docs.sparkSession.sparkContext.broadcast(some)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in text_slices(batches):
                texts = b.column("text").to_pylist()
                dirty = {x[0] for index in sent.value for x in index.matches(texts)}
                yield b.filter(pa.array([k not in dirty for k in range(b.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if len(some) == PASS_SHARDS:
            docs = stored(docs, "bm25-clean")
            sent.unpersist()
    return docs
