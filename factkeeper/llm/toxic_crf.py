"""Toxicity by a linear-chain conditional random field over words.

Labels are of documents, so token labels come first: in labelled toxic texts a word
counts as toxic if its use depends on the label (``MIN_G2`` on the likelihood ratio of
document counts, in favour of toxic) and stands in contexts of its own, as copies of
one text would not give it. The chain has two states; a word of the lexicon has its
association and a weight of its own as features, every other word the bias alone. It is
fitted by gradient ascent on the conditional likelihood of runs of ``RUN_WORDS`` words.
Forward-backward marginals give each word's probability; a document's score is a logistic
function of their maximum, sum and mean, and offending offsets are runs of words at 0.5
or more.

Fitted on a bounded sample (``SAMPLE_DOCS`` labelled rows taken by a hash of the id, texts
of ``SAMPLE_TEXT_BYTES`` at most); applied to all texts whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factkeeper.llm.common import stored, text_slices

SAMPLE_DOCS = 20_000
SAMPLE_TEXT_BYTES = 200_000
LEXICON_WORDS = 5_000
FIT_RUNS = 20_000
RUN_WORDS = 64
MIN_G2 = 25.0
MIN_CONTEXTS = 3
OWN_CONTEXTS = 0.5
STEPS = 150

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


@dataclass
class Crf:
    """``place`` numbers the lexicon from 1; ``emit[place]`` is the toxic state's score less
    the clean one's, ``emit[0]`` that of other words; ``trans`` is the transitions' scores."""
    place: dict[str, int]
    emit: np.ndarray
    trans: np.ndarray
    head: np.ndarray

    def marginals(self, at: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Probability of the toxic state of each word of whole texts, which come as runs (rows,
        padded, those of a ``doc`` one after the other): what the words before and after a run
        say about its ends is carried over its borders."""
        score = self.emit[at]
        start, end = _borders(score, self.trans, length, doc)
        return _forward_backward(score, self.trans, length, start, end)[0]


def _borders(score: np.ndarray, trans: np.ndarray, length: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the states of each run's first word from all words before it, and of its last
    word from all words behind it."""
    rows, width = score.shape
    psi = np.stack([np.ones_like(score), np.exp(np.clip(score, -30, 30))], axis=2)
    step = np.exp(trans)
    first = np.append(True, doc[1:] != doc[:-1])[:rows]
    # what a run makes of the state before it: the product of its words' steps
    over = np.where(first[:, None, None], np.eye(2), step) * psi[:, 0][:, None, :]
    for j in range(1, width):
        live = (j < length)[:, None, None]
        more = over @ step * psi[:, j][:, None, :]
        over = np.where(live, more / more.sum(axis=(1, 2), keepdims=True), over)
    place = np.arange(rows) - np.maximum.accumulate(np.where(first, np.arange(rows), 0))
    start, end, into = np.ones((rows, 2)), np.ones((rows, 2)), np.ones((rows, 2))
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(1, place.max(initial=0) + 2))
    for lo, hi in zip(cuts[:-1], cuts[1:]):     # the second runs of all texts, the third ones, ...
        r = order[lo:hi]
        before = np.einsum("ri,rij->rj", into[r - 1], over[r - 1])
        into[r] = before / before.sum(axis=1, keepdims=True)
        start[r] = into[r] @ step
    for lo, hi in zip(cuts[-2::-1], cuts[:0:-1]):
        r = order[lo:hi]
        behind = np.einsum("rij,rj->ri", over[r], end[r])
        end[r - 1] = behind / behind.sum(axis=1, keepdims=True)
    return start, end


def _forward_backward(score: np.ndarray, trans: np.ndarray, length: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None):
    """Marginals, expected transitions (sum) and log partition of runs with ``score`` for state 1;
    ``start`` and ``end`` are the weights of their first and last words' states (default: 1)."""
    rows, width = score.shape
    psi = np.stack([np.ones_like(score), np.exp(np.clip(score, -30, 30))], axis=2)
    step = np.exp(trans)
    alpha, scale = np.empty((rows, width, 2)), np.ones((rows, width))
    for j in range(width):
        a = psi[:, 0] * (1 if start is None else start) if j == 0 else (alpha[:, j - 1] @ step) * psi[:, j]
        live = j < length
        a = np.where(live[:, None], a, alpha[:, j - 1] if j else a)
        z = np.where(live, a.sum(axis=1), 1.0)
        alpha[:, j], scale[:, j] = a / z[:, None], z
    beta = np.ones((rows, 2)) if end is None else end
    out, pairs = np.zeros((rows, width)), np.zeros((2, 2))
    for j in range(width - 1, -1, -1):
        g = alpha[:, j] * beta
        g /= g.sum(axis=1, keepdims=True)
        out[:, j] = np.where(j < length, g[:, 1], 0)
        if j:
            live = (j < length)[:, None]
            tail = psi[:, j] * beta
            joint = alpha[:, j - 1][:, :, None] * step * tail[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            pairs += (joint * live[:, :, None]).sum(axis=0)
            back = tail @ step.T
            beta = np.where(live, back / back.sum(axis=1, keepdims=True), beta)
    return out, pairs, np.log(scale).sum()


def fit_chain(at: np.ndarray, gold: np.ndarray, length: np.ndarray, assoc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Emission scores by lexicon place and transition scores, by AdaGrad on the
    regularised conditional likelihood of labelled runs."""
    n = max(1, len(at))
    own = np.zeros(len(assoc))
    bias, slope, trans = -4.0, 1.0, np.zeros((2, 2))
    live = np.arange(at.shape[1]) < length[:, None]
    follow = live[:, 1:]
    seen = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & follow).sum() for b in (0, 1)] for a in (0, 1)], dtype=float)
    sums = [1e-8, 1e-8, np.full((2, 2), 1e-8), np.full(len(assoc), 1e-8)]
    for _ in range(STEPS):
        emit = bias + slope * assoc + own
        p, pairs, _ = _forward_backward(emit[at], trans, length)
        err = np.where(live, gold - p, 0)
        by_word = np.bincount(at.ravel(), err.ravel(), minlength=len(assoc))
        by_word[0] = 0
        grads = [err.sum() / n, (err * assoc[at]).sum() / n - 1e-3 * slope, (seen - pairs) / n - 1e-3 * trans, by_word / n - 1e-4 * own]
        moves = []
        for k, g in enumerate(grads):
            sums[k] = sums[k] + g * g
            moves.append(0.3 * g / np.sqrt(sums[k]))
        bias, slope, trans, own = bias + moves[0], slope + moves[1], trans + moves[2], own + moves[3]
    return bias + slope * assoc + own, trans


def fit_head(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is 1."""
    w = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge @ w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, grad)
    return w


# -- texts to runs ------------------------------------------------------------

def runs_of(docs: list[list[str]], place: dict[str, int]):
    """Places of the words of all documents, cut into runs: ``(at, length, doc, first word)``."""
    get = place.get
    flat = np.array([get(w, 0) for d in docs for w in d], dtype=np.int64)
    lens = np.array([len(d) for d in docs], dtype=np.int64)
    n = -(-lens // RUN_WORDS)
    doc = np.repeat(np.arange(len(docs)), n)
    first = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * RUN_WORDS
    length = np.minimum(RUN_WORDS, lens[doc] - first)
    start = (np.cumsum(lens) - lens)[doc] + first
    cell = start[:, None] + np.arange(RUN_WORDS)
    at = np.where(np.arange(RUN_WORDS) < length[:, None], flat[np.minimum(cell, max(len(flat) - 1, 0))] if len(flat) else 0, 0)
    return at, length, doc, first


class Scorer:
    def __init__(self, crf: Crf):
        self.crf = crf

    def evidence(self, texts: list[str | None]) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]:
        """Rows (1, max, log of 1 + sum, 10 x mean) and the runs with marginals at 0.5 or more."""
        docs = [words_of(t) for t in texts]
        at, length, doc, first = runs_of(docs, self.crf.place)
        top, total = np.zeros(len(docs)), np.zeros(len(docs))
        hits = []
        if len(at):
            p = self.crf.marginals(at, length, doc)
            np.add.at(total, doc, p.sum(axis=1))
            np.maximum.at(top, doc, p.max(axis=1))
            hits = [(int(doc[r]), int(first[r]), p[r]) for r in np.flatnonzero(p.max(axis=1) >= 0.5)]
        n = np.maximum(1, [len(d) for d in docs]) if docs else np.ones(0)
        return np.stack([np.ones(len(docs)), top, np.log1p(total), 10 * total / n], axis=1), hits

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[dict]]]:
        x, hits = self.evidence(texts)
        score = 1 / (1 + np.exp(-np.clip(x @ self.crf.head, -30, 30)))
        of: dict[int, dict[int, float]] = {}
        for d, f, p in hits:
            of.setdefault(d, {}).update({f + int(j): float(p[j]) for j in np.flatnonzero(p >= 0.5)})
        return score, [self._spans(t, of[d]) if d in of else [] for d, t in enumerate(texts)]

    @staticmethod
    def _spans(text: str, marked: dict[int, float]) -> list[dict]:
        out, last = [], -2
        for k, m in enumerate(_lowered_words(text)):
            if k not in marked:
                continue
            if k == last + 1:
                out[-1]["stop"], out[-1]["score"] = m[1], max(out[-1]["score"], marked[k])
            else:
                out.append({"start": m[0], "stop": m[1], "score": marked[k]})
            last = k
        return out


def _lowered_words(text: str) -> Iterator[tuple[int, int]]:
    """Offsets in ``text`` of the words of its lower case (which may be longer)."""
    low = text.lower()
    if len(low) == len(text):
        yield from (m.span() for m in WORD.finditer(low))
        return
    back = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
    back += [len(text)] * (len(low) + 1 - len(back))
    yield from ((back[m.start()], back[m.end() - 1] + 1) for m in WORD.finditer(low))


# -- fitting ------------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Distinct ``text, toxic`` of about ``most`` labelled rows outside the held-out fold."""
    y = (labels.select(F.col("doc_id").cast("long").alias("y_id"), F.col("toxic").cast("int").alias("toxic"))
         .filter("y_id is not null and toxic is not null").groupBy("y_id").agg(F.max("toxic").alias("toxic"))
         .filter(F.pmod(F.crc32(F.col("y_id").cast("string")), F.lit(5)) != 0))
    n = y.count()
    if n > most:
        y = y.filter(F.pmod(F.xxhash64("y_id", F.lit("sample")), F.lit(1 << 20)) < int(most / n * (1 << 20)))
    d = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
         .filter(F.octet_length("text") <= SAMPLE_TEXT_BYTES))
    return d.join(y, d["doc_id"] == y["y_id"]).groupBy("text").agg(F.max("toxic").alias("toxic"))


def _g2(t, c, n_t, n_c):
    """Likelihood ratio of a word's document counts against independence of the label."""
    share = (t + c) / (n_t + n_c)

    def part(k, n):
        p = k / n
        return k * np.log(np.maximum(p, 1e-12) / share) + (n - k) * np.log(np.maximum(1 - p, 1e-12) / np.maximum(1 - share, 1e-12))

    return 2 * (part(t, n_t) + part(c, n_c))


def _lexicon(train: DataFrame, n_t: int, n_c: int) -> dict[str, float]:
    """Toxic words and their associations (log odds)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            t, c = Counter(), Counter()
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                (t if toxic else c).update(set(words_of(text)))
            words = list({**t, **c})
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([t[w] for w in words], pa.int64()),
                                              pa.array([c[w] for w in words], pa.int64())], ["word", "t", "c"])

    counts = train.mapInArrow(counted, "word string, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    rows = (counts.filter((F.col("t") >= MIN_CONTEXTS) & (F.col("t") * n_c > 4 * F.col("c") * n_t))
            .orderBy(F.desc(F.col("t") / (F.col("c") + 1)), F.desc("t"), "word").limit(10 * LEXICON_WORDS).collect())
    if not rows:
        return {}
    t, c = (np.array([r[k] for r in rows], dtype=float) for k in ("t", "c"))
    odds = np.log((t + 0.5) / (n_t + 1)) - np.log((c + 0.5) / (n_c + 1))
    g2 = _g2(t, c, max(n_t, 1), max(n_c, 1))
    words = {r["word"]: (float(o), float(x)) for r, o, g, x in zip(rows, odds, g2, t) if g >= MIN_G2}
    sent = train.sparkSession.sparkContext.broadcast(set(words))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in text_slices(batches):
            seen = set()
            for text in b.column("text").to_pylist():
                w = ["", *words_of(text), ""]
                seen.update((x, f"{w[k - 1]} {w[k + 1]}") for k, x in enumerate(w) if x in known)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*seen) if seen else ([], []))], ["word", "beside"])

    own = (train.filter("toxic = 1").select("text").mapInArrow(around, "word string, beside string")
           .distinct().groupBy("word").count().collect())
    own = {r[0]: r[1] for r in own}
    kept = sorted((w for w, (_, n) in words.items() if own.get(w, 0) >= max(MIN_CONTEXTS, OWN_CONTEXTS * n)),
                  key=lambda w: (-words[w][0], w))
    return {w: words[w][0] for w in kept[:LEXICON_WORDS]}


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> Crf:
    """Fit chain and head. Without labelled rows of both kinds every text scores the share of
    toxic rows (0 without any)."""
    spark = docs.sparkSession
    train = stored(training_rows(docs, labels, most), "toxic-sample")
    sizes = {r[0]: r[1] for r in train.groupBy("toxic").count().collect()}
    n_t = sum(n for y, n in sizes.items() if y >= 1)
    n_c = sum(sizes.values()) - n_t
    lexicon = _lexicon(train, n_t, n_c) if n_t and n_c else {}
    place = {w: i + 1 for i, w in enumerate(lexicon)}
    assoc = np.array([0.0, *lexicon.values()])
    sent = spark.sparkContext.broadcast(place)

    def gold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            toxic = np.array(b.column("toxic").to_pylist()) >= 1
            at, length, doc, _ = runs_of([words_of(t) for t in b.column("text").to_pylist()], sent.value)
            marked = at.any(axis=1)
            every = marked | (np.arange(len(at)) % 16 == 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.astype(np.uint16).tobytes() for x in at[every]], pa.binary()), pa.array(length[every], pa.int64()),
                 pa.array(toxic[doc[every]], pa.bool_()), pa.array(marked[every], pa.bool_())], ["at", "length", "toxic", "marked"])

    emit, trans = np.array([-8.0]), np.zeros((2, 2))
    if lexicon:
        runs = (train.mapInArrow(gold, "at binary, length long, toxic boolean, marked boolean")
                .orderBy(F.desc("marked"), F.xxhash64("at", "length")).limit(FIT_RUNS).collect())
        at = np.array([np.frombuffer(r["at"], dtype=np.uint16) for r in runs]).astype(np.int64)
        length = np.array([r["length"] for r in runs])
        y = (at > 0) & np.array([r["toxic"] for r in runs])[:, None]
        emit, trans = fit_chain(at, y.astype(int), length, assoc)
    crf = Crf(place, emit, trans, np.zeros(4))
    if not (n_t and n_c):
        crf.head = np.array([30.0 if n_t else -30.0, 0, 0, 0])
        return crf
    chain = spark.sparkContext.broadcast(crf)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(chain.value)
        for b in text_slices(batches):
            x, _ = scorer.evidence(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), pa.array(np.array(b.column("toxic").to_pylist(), dtype=float))],
                                             ["one", "top", "total", "mean", "y"])

    rows = np.array([tuple(r) for r in train.mapInArrow(evidence, "one double, top double, total double, mean double, y double").collect()])
    crf.head = fit_head(rows[:, :4], np.minimum(rows[:, 4], 1))
    return crf


def score(docs: DataFrame, crf: Crf) -> DataFrame:
    """``doc_id, score, spans`` for every row; spans are ``start, stop`` (code points) and the
    largest marginal of each run of offending words. Null texts score as empty ones; repeated
    rows come out as often; an empty table gives an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(crf)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in text_slices(batches):
            s, spans = scorer.score(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double, spans array<struct<start:int,stop:int,score:double>>"))


def held_out():
    """True for the fold whose labels are never read."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
