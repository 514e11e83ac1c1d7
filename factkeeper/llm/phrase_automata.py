"""Substring dedup by repeated-phrase automata.

A passage is a window of ``window`` consecutive words; it recurs if its words also start
somewhere else. Three passes, each over documents dealt into shards of bounded size (all
passes use one exchange):

1. Every window is stood for by the smallest hash among its phrases of ``phrase`` words.
   A shard reports each such phrase once, with its count; phrases that occur once in the
   corpus can't be in a recurring window and are dropped.
2. Windows that a remaining phrase stands for are reported once for each shard, with count
   and first place. Those with two places or more are the confirmed passages.
3. A shard gets its confirmed passages, takes their text from their first place in it and compiles an Aho-Corasick automaton: passages that
   follow one another are laid end to end, and of every ``window - phrase + 1`` words the phrase
   that starts there is a pattern, so each passage holds one. All its documents stream
   through the automaton, which finds every place of every pattern; passages around these
   places are looked up with the first place they have in the corpus.

A hot phrase makes one row for each shard, however often it occurs. Phrases and windows are
told apart by 64-bit hashes of their words, patterns by their text.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factkeeper.llm.common import mix, rolled, sharded, sliding, span_hashes, word_spans

WINDOW = 20
PHRASE = 10
#: Bits of a word's place in its document, in packed marks.
START_BITS = 36
#: Stands for a null doc_id, which comes before all others.
NO_ID = np.iinfo(np.int64).min
_SEED = np.uint64(0xC2B2AE3D27D4EB4F)


class Shard:
    """The words of a shard's documents, in the order of their ids."""

    def __init__(self, docs: pa.Table, window: int, phrase: int):
        ids = docs.column("doc_id").fill_null(NO_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        texts = docs.column("text").to_pylist()
        self.texts = [(texts[k] or "").encode() for k in order]
        self.buf, self.starts, self.ends, self.doc = word_spans(self.texts)
        self.window, self.phrase = window, phrase
        words = span_hashes(self.buf, self.starts, self.ends)
        self.first_word = np.searchsorted(self.doc, np.arange(len(self.texts)))
        n = max(0, len(words) - window + 1)
        self.whole = self.doc[:n] == self.doc[window - 1:]
        self.windows = rolled(words, window)
        phrases = mix(rolled(words, phrase) ^ _SEED)
        phrases[phrases == 0] = 1  # 0 stands for no window
        self.phrases = phrases
        self.least = np.where(self.whole, sliding(phrases, window - phrase + 1), np.uint64(0))

    def chosen(self) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that stand for a window, and how often (at places of their own)."""
        span = self.window - self.phrase + 1
        pad = np.zeros(span - 1, dtype=np.uint64)
        top = sliding(np.concatenate([pad, self.least, pad]), span, np.maximum)[:len(self.phrases)]
        return np.unique(self.phrases[:len(top)][top == self.phrases[:len(top)]], return_counts=True)

    def word(self, k: int) -> bytes:
        return self.buf[self.starts[k]:self.ends[k]].tobytes()

    def start_in_doc(self, at: np.ndarray) -> np.ndarray:
        return at - self.first_word[self.doc[at]]


def _member(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _unsigned(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def report_phrases(docs: pa.Table, window: int, phrase: int) -> pa.Table:
    """Chosen phrases; ``mark`` is twice the shard, and one more if there are several in it."""
    phrases, n = Shard(docs, window, phrase).chosen()
    return pa.table({"phrase": _signed(phrases), "mark": pa.array(2 * docs.column("shard")[0].as_py() + (n > 1).astype(np.int64))})


def report_windows(docs: pa.Table, phrases: pa.Table, window: int, phrase: int) -> pa.Table:
    """Windows that the phrases stand for, each once with its first place in the shard;
    ``mark`` packs the shard, the first start and whether there are several."""
    empty = pa.table({"window": pa.array([], pa.int64()), "mark": pa.array([], pa.int64()), "doc": pa.array([], pa.int64())})
    if not docs.num_rows or not phrases.num_rows:
        return empty
    s = Shard(docs, window, phrase)
    at = np.flatnonzero(s.whole & _member(s.least, np.sort(_unsigned(phrases.column("phrase")))))
    if not len(at):
        return empty
    hashes, first, n = np.unique(s.windows[at], return_index=True, return_counts=True)
    at = at[first]
    mark = (docs.column("shard")[0].as_py() << START_BITS + 1) + 2 * s.start_in_doc(at) + (n > 1)
    return pa.table({"window": _signed(hashes), "mark": pa.array(mark), "doc": pa.array(s.ids[s.doc[at]])})


def compile_patterns(s: Shard, at: np.ndarray) -> ahocorasick.Automaton | None:
    """Automaton of the patterns of passages at the given words of a shard."""
    if not len(at):
        return None
    step = s.window - s.phrase + 1
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (s.doc[at[1:]] != s.doc[at[:-1]])
    lo = np.flatnonzero(new)
    out = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for a, b in zip(at[lo].tolist(), at[np.append(lo[1:], len(at)) - 1].tolist()):
        for p in range(a, b + step, step):  # the last one starts at b + step - 1 at most
            words = [s.word(k) for k in range(p, p + s.phrase)]
            out.add_word((b" " + b" ".join(words) + b" ").decode("latin-1"))
    out.make_automaton()
    return out


def locate(s: Shard, automaton: ahocorasick.Automaton, d: int) -> np.ndarray:
    """Words of document ``d`` (numbers in the shard) at which a pattern starts."""
    words = s.texts[d].split()
    if len(words) < s.window:
        return np.zeros(0, dtype=np.int64)
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    ends = np.array([e for e, _ in automaton.iter(line)], dtype=np.int64)
    after = np.cumsum([1 + len(w) for w in words])
    return s.first_word[d] + np.searchsorted(after, ends) - s.phrase + 1


def remove(docs: pa.Table, passages: pa.Table, window: int, phrase: int) -> pa.Table:
    """Each document without the words of windows whose words also start earlier."""
    if not docs.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                         "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})
    s = Shard(docs, window, phrase)
    drop = np.zeros(len(s.starts) + 1, dtype=np.int64)
    if passages.num_rows:
        hashes = _unsigned(passages.column("window"))
        order = np.argsort(hashes)
        hashes = hashes[order]
        first_doc, first_start = (passages.column(c).to_numpy()[order] for c in ("first_doc", "first_start"))
        there = np.flatnonzero(s.whole & _member(s.windows, hashes))
        at = there[np.unique(s.windows[there], return_index=True)[1]]
        automaton = compile_patterns(s, np.sort(at))
        step = window - phrase + 1
        for d in range(len(s.texts)):
            places = locate(s, automaton, d)
            if not len(places):
                continue
            around = np.unique(places[:, None] - np.arange(step))
            lo = s.first_word[d]
            hi = s.first_word[d + 1] if d + 1 < len(s.texts) else len(s.starts)
            around = around[(around >= lo) & (around + window <= hi)]
            k = np.minimum(np.searchsorted(hashes, s.windows[around]), len(hashes) - 1)
            known = hashes[k] == s.windows[around]
            around, k = around[known], k[known]
            later = (first_doc[k] < s.ids[d]) | ((first_doc[k] == s.ids[d]) & (first_start[k] < around - lo))
            np.add.at(drop, around[later], 1)
            np.add.at(drop, around[later] + window, -1)
    gone = np.cumsum(drop[:-1]) > 0
    n_words = np.bincount(s.doc, minlength=len(s.texts))
    n_gone = np.bincount(s.doc[gone], minlength=len(s.texts))
    kept = []
    for d, text in enumerate(s.texts):
        words = text.split()
        if n_gone[d]:
            left = ~gone[s.first_word[d]:s.first_word[d] + n_words[d]]
            words = [w for w, stays in zip(words, left.tolist()) if stays]
        kept.append(b" ".join(words))
    return pa.table({"doc_id": pa.array(s.ids, mask=s.ids == NO_ID), "n_words": pa.array(n_words), "n_removed": pa.array(n_gone),
                     "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})


def substring_dedup(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs``.

    Removed is each word that a window covers whose words also start earlier: in a smaller
    ``doc_id`` (a null one comes before all), or before in the same document. Rows that
    repeat an id count as one document's place: neither comes before the other. Windows are
    judged on the input. A null text has no words; an empty table gives an empty one."""
    d = sharded(docs)
    by_shard = d.groupBy("shard")
    phrases = by_shard.applyInArrow(lambda t: report_phrases(t, window, phrase), "phrase long, mark long")
    several = F.col("mark").bitwiseAND(F.lit(1).cast("long"))
    total = F.sum(several + 1)
    shared = (phrases.withColumn("total", total.over(Window.partitionBy("phrase"))).filter("total > 1")
              .select("phrase", F.shiftright("mark", 1).cast("int").alias("shard")))
    windows = by_shard.cogroup(shared.groupBy("shard")).applyInArrow(
        lambda t, p: report_windows(t, p, window, phrase), "window long, mark long, doc long")
    same = Window.partitionBy("window")
    start = F.shiftright("mark", 1).bitwiseAND(F.lit((1 << START_BITS) - 1).cast("long"))
    place = F.struct("doc", start.alias("start"))
    passages = (windows.withColumn("total", total.over(same)).withColumn("first", F.min(place).over(same))
                .filter((F.col("total") > 1) & ~((several == 0) & (F.col("first") == place)))
                .select(F.shiftright("mark", START_BITS + 1).cast("int").alias("shard"), "window",
                        F.col("first.doc").alias("first_doc"), F.col("first.start").alias("first_start")))
    return by_shard.cogroup(passages.groupBy("shard")).applyInArrow(
        lambda t, p: remove(t, p, window, phrase), "doc_id long, n_words long, n_removed long, kept_text string")
