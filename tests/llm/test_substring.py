"""Substring dedup and byte dedup against brute force."""

import collections
import random

import pytest

from factkeeper.llm import phrase_automata, prefix_free

SCHEMA = "doc_id long, text string, shard string, n long"


def brute_words(rows, window):
    key = lambda i: -(1 << 63) if i is None else i
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in docs:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, (key(i), s)), (key(i), s))
    out = []
    for i, w in docs:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (key(i), s):
                gone.update(range(s, s + window))
        out.append((str(i), len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return sorted(out)


def brute_bytes(rows, length):
    docs = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[s:s + length] for _, b in docs for s in range(len(b) - length + 1))
    out = []
    for i, b in docs:
        gone = [False] * (len(b) + 1)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = [True] * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out.append((str(i), len(b), sum(gone), spans, bytes(x for k, x in enumerate(b) if not gone[k])))
    return sorted(out)


def words_rows(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}é" for i in range(30)]
    base = [[rnd.choice(vocab) for _ in range(rnd.randint(15, 60))] for _ in range(8)]
    rows = []
    for k in range(120):
        w = []
        for _ in range(rnd.randint(0, 4)):
            b = rnd.choice(base)
            a = rnd.randint(0, len(b) - 1)
            w += b[a:a + rnd.randint(5, 50)]
        if k % 17 == 0:
            w = ["a"] * rnd.randint(18, 60)
        if k % 13 == 0:
            w = (["x", "y", "z"] * 30)[:rnd.randint(20, 80)]
        rows.append((k, rnd.choice([" ", "\n", "\t "]).join(w)))
    rows.append((300, " ".join(rnd.choice(vocab) for _ in range(30_000))))
    return rows + [(200, None), (201, ""), (None, " ".join(base[0])), (5, rows[5][1]), (7, rows[9][1]), (None, None)]


def bytes_rows(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdeé \n") for _ in range(rnd.randint(200, 1500))) for _ in range(5)]
    rows = []
    for k in range(80):
        w = ""
        for _ in range(rnd.randint(0, 4)):
            b = rnd.choice(base)
            a = rnd.randint(0, len(b) - 1)
            w += b[a:a + rnd.randint(100, 900)]
            if rnd.random() < 0.5:
                w += "".join(rnd.choice("xyz") for _ in range(rnd.randint(1, 300)))
        if k % 17 == 0:
            w = "a" * rnd.randint(350, 900)
        if k % 13 == 0:
            w = ("xyzw" * 300)[:rnd.randint(300, 1000)]
        rows.append((k, w))
    return rows + [(200, None), (201, ""), (None, base[0]), (5, rows[5][1]), (7, rows[9][1]), (None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    rows = words_rows(seed)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text)
                 for r in phrase_automata.substring_dedup(frame(spark, rows)).collect())
    assert got == brute_words(rows, 20)


def test_words_of_other_lengths(spark):
    rows = words_rows(3)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text)
                 for r in phrase_automata.substring_dedup(frame(spark, rows), window=8, phrase=3).collect())
    assert got == brute_words(rows, 8)


@pytest.mark.parametrize("length, most", [(400, 512), (400, 3), (300, 0)])
def test_bytes(spark, monkeypatch, length, most):
    """Dictionaries of every size give the same result."""
    monkeypatch.setattr(prefix_free, "DICTIONARY_BLOCKS", most)
    rows = bytes_rows(length + most)
    got = sorted((str(r.doc_id), r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), bytes(r.kept))
                 for r in prefix_free.byte_dedup(frame(spark, rows), length).collect())
    assert got == brute_bytes(rows, length)


def test_empty(spark):
    none = frame(spark, []).limit(0)
    assert phrase_automata.substring_dedup(none).collect() == []
    assert prefix_free.byte_dedup(none).collect() == []
