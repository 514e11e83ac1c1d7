"""Language identification: words first, then shorter and shorter character n-grams.

Known words are scored by their log frequency in each language. A word that no
training text holds falls back to its character n-grams, longest first, and to the
next shorter ones where none of a length is known. Every language has the same prior.

The model is fitted on a bounded sample of labelled rows and has a fixed size: each language
has an equal share of ``SAMPLE_DOCS`` rows (taken by a hash of the id), of ``MODEL_WORDS`` words
and of ``MODEL_GRAMS`` n-grams of each length, its own most frequent ones, so that a small language
learns as much as a large one has room for. Words and letter runs of any length teach their
n-grams; words of up to ``LONGEST_WORD`` letters are kept as words. The text is all that a
prediction sees.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factkeeper.llm.common import stored, text_slices

SAMPLE_DOCS = 20_000
MODEL_WORDS = 100_000
MODEL_GRAMS = 20_000
LONGEST_GRAM = 4
LONGEST_WORD = 64
CACHED_WORDS = 200_000
RUN_WORDS = 10_000
UNDECIDED = "und"
#: Words that a text's evidence counts for at most, so that scores of long texts stay below 1.
EVIDENCE_WORDS = 12.0
#: A language with a lower score isn't accepted by the pipeline: less likely than all others together.
LEAST_SCORE = 0.5

WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def grams_of(word: str, n: int) -> list[str]:
    w = f"<{word}>"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


@dataclass
class Table:
    """Keys, and a row of smoothed log frequencies by language for each."""
    keys: list[str]
    rows: np.ndarray

    def places(self) -> dict[str, int]:
        return {k: i for i, k in enumerate(self.keys)}


@dataclass
class Model:
    langs: list[str]
    words: Table
    grams: dict[int, Table]


def _counts(train: DataFrame) -> DataFrame:
    """``lang, size, key, n`` of the training texts: words (``size`` 0), and n-grams by their length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            seen: dict[str, Counter[str]] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                seen.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in seen.items():
                yield _batch(lang, 0, {w: n for w, n in words.items() if len(w) <= LONGEST_WORD})
                for size in range(1, LONGEST_GRAM + 1):
                    grams: Counter[str] = Counter()
                    for w, n in words.items():
                        for g in grams_of(w, size):
                            grams[g] += n
                    yield _batch(lang, size, grams)

    return (train.select("lang", "text").mapInArrow(run, "lang string, size int, key string, n long")
            .groupBy("lang", "size", "key").agg(F.sum("n").alias("n")))


def _batch(lang: str, size: int, counts: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(counts), pa.string()), pa.array([size] * len(counts), pa.int32()), pa.array(list(counts), pa.string()),
         pa.array(list(counts.values()), pa.int64())], ["lang", "size", "key", "n"])


def _table(rows: list, langs: list[str], totals: dict[str, float]) -> Table:
    """Smoothed log frequency of each key in each language."""
    at = {lang: i for i, lang in enumerate(langs)}
    keys = {k: i for i, k in enumerate(sorted({r[0] for r in rows}))}
    counts = np.zeros((len(keys), len(langs)))
    for key, lang, n in rows:
        counts[keys[key], at[lang]] = n
    size = np.array([totals.get(lang, 0.0) for lang in langs])
    return Table(list(keys), np.log((counts + 0.5) / (size + 0.5 * (len(keys) + 1))).astype(np.float32).reshape(len(keys), len(langs)))


def training_rows(docs: DataFrame, most: int = SAMPLE_DOCS) -> DataFrame:
    """``lang, text`` of about ``most`` labelled rows, an equal share of each language (all rows
    of one that has fewer), taken by a hash of the id."""
    d = docs.filter("lang is not null and text is not null").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"))
    have = {r[0]: r[1] for r in d.groupBy("lang").count().collect()}   # languages
    share = max(1, most // max(1, len(have)))
    part = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20))
    for lang, n in have.items():
        if n > share:
            d = d.filter((F.col("lang") != lang) | (part < max(1, int(share / n * (1 << 20)))))
    return d.select("lang", "text")


def fit(train: DataFrame, most_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on ``doc_id, lang, text``; rows without a language or a text are left out."""
    counts = stored(_counts(training_rows(train, most_docs)), "lang-counts")
    totals: dict[int, dict[str, float]] = {}
    for lang, size, n in counts.groupBy("lang", "size").agg(F.sum("n")).collect():
        totals.setdefault(size, {})[lang] = float(n)
    langs = sorted({lang for of in totals.values() for lang in of})
    share = F.when(F.col("size") == 0, MODEL_WORDS // max(1, len(langs))).otherwise(MODEL_GRAMS // max(1, len(langs)))
    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "key"))
    kept = counts.withColumn("place", place).filter(F.col("place") <= F.greatest(share, F.lit(1))).select("size", "key").distinct()
    rows: dict[int, list] = {}
    for size, key, lang, n in counts.join(F.broadcast(kept), ["size", "key"]).select("size", "key", "lang", "n").collect():   # the model
        rows.setdefault(size, []).append((key, lang, n))
    tables = {size: _table(rows.get(size, []), langs, totals.get(size, {})) for size in range(LONGEST_GRAM + 1)}
    return Model(langs, tables.pop(0), tables)


class Scorer:
    """Scores texts; words that the model lacks get rows of their own, as far as there is room."""

    def __init__(self, model: Model):
        self.model = model
        self.grams = {n: (t.places(), t.rows) for n, t in model.grams.items()}
        known = model.words.rows
        self.rows = np.concatenate([known, np.zeros((CACHED_WORDS, len(model.langs)), dtype=np.float32)])
        self._forget()

    def _forget(self) -> None:
        self.place = self.model.words.places()
        self.used = len(self.place)

    def _unseen(self, w: str) -> int:
        """Place of a word that falls back to its n-grams."""
        self.rows[self.used] = self._backoff(w)
        if len(w) <= LONGEST_WORD:
            self.place[w] = self.used
        self.used += 1
        return self.used - 1

    def _backoff(self, w: str) -> np.ndarray:
        """Mean of the log frequencies of a word's longest known n-grams."""
        for n in range(LONGEST_GRAM, 0, -1):
            places, rows = self.grams[n]
            hits = [places[g] for g in grams_of(w, n) if g in places]
            if hits:
                return rows[hits].mean(axis=0)
        return np.zeros(len(self.model.langs), dtype=np.float32)

    def _total(self, words: list[str]) -> np.ndarray:
        """Sum of the words' log frequencies."""
        get, total = self.place.get, np.zeros(len(self.model.langs))
        for lo in range(0, len(words), RUN_WORDS):
            run = words[lo:lo + RUN_WORDS]
            if self.used + len(run) > len(self.rows):
                self._forget()
                get = self.place.get
            at = [p if (p := get(w)) is not None else self._unseen(w) for w in run]
            total += self.rows[at].sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not self.model.langs or not has_letter(words):
            return UNDECIDED, 0.0
        total = self._total(words) / len(words) * min(len(words), EVIDENCE_WORDS)
        p = np.exp(total - total.max())
        best = int(np.argmax(p))
        return self.model.langs[best], float(p[best] / p.sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``lang_score`` behind them.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned;
    ties go to the first language by name. Rows come out as they came in; an empty
    table gives an empty one. A ``lang_pred`` or ``lang_score`` of the input is replaced."""
    d = docs.drop("lang_pred", "lang_score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields), "lang_pred string, lang_score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in text_slices(batches):
            got = [scorer.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())],
                                             [*b.schema.names, "lang_pred", "lang_score"])

    return d.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """True for the fold that nothing is learned from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2


def identify(docs: DataFrame, most_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Fit on the rows of ``docs`` outside the held-out fold (a null id belongs to none
    of the folds and isn't learned from), then predict every row."""
    return predict(docs, fit(docs.filter(~held_out()), most_docs))


def accepted_stage(docs: DataFrame, languages: list[str] | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose predicted language is among ``languages`` (default: all that were
    learned) with a score of ``least`` or more; the others go, those without a letter too."""
    names = [f"`{c}`" for c in docs.columns]
    out = identify(docs).filter((F.col("lang_pred") != UNDECIDED) & (F.col("lang_score") >= least))
    if languages is not None:
        out = out.filter(F.col("lang_pred").isin(list(languages)))
    return out.select(*names)
