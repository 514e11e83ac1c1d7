"""Main text, collocations and centroid clusters against brute force."""

import collections
import hashlib
import html
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from factkeeper.llm import fm_collocations, laesa_clusters, line_blocks

SF = "/root/testdata/sf0.01"
P = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna."


# -- main text ----------------------------------------------------------------

def plain_article(page):
    """The given pages' article by plain cutting: its tags are few and known."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    if not inner:
        return ""
    blocks = re.split(r"</?(?:p|h1)\b[^>]*>", re.sub(r"</?b>|<br>", " ", inner[1]))
    said = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in blocks]
    return "\n\n".join(x for x in said if x)


def test_pages_equal_plain_cutting(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in line_blocks.extract(pages).collect()}
    want = {r.page_id: (r.url, plain_article(r.html), len(plain_article(r.html))) for r in pages.collect()}
    assert got == want and any(n for _, _, n in want.values())


@pytest.mark.parametrize("page, want", [
    (f"<div id=header>Site</div><ul class=menu><li><a href=/>Home</a><li><a href=/b>B</a></ul><div id=c><h1>Title</h1><p>{P}<p>Short.<p>{P} {P}</div>"
     "<div>&copy; 2024 Site</div>", f"Title\n\n{P}\n\nShort.\n\n{P} {P}"),
    (f"<div><a href=/>Home</a> <a href=/b>About</a></div><div><h1>Title</h1><p>{P}</p><p>End.</p></div><div>All rights reserved</div>", f"Title\n\n{P}\n\nEnd."),
    ("<nav><a>x</a></nav><article><p>Hi.</p></article><footer>f</footer>", "Hi."),
    (f"<div class='cookie-notice'>We use cookies {P}</div><main><h1>T</h1><p>{P}<p>two &amp; 3<aside>Related: {P}</aside><p>four<form>Name <input></form></main>"
     f"<section id=comments><article><p>nice {P}</p></article></section>", f"T\n\n{P}\n\ntwo & 3\n\nfour"),
    (f"<article><header><h1>T</h1><p class=byline>By X</p></header><p>{P}</p><div class=ad>Buy</div><p>more</p><article><p>a reader: {P}</p></article></article>",
     f"T\n\n{P}\n\nmore"),
    ("<article><table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table><pre>x\n  y</pre></article>", "a b\n\nc\n\nx y"),
    ("<article><p title=don't>one</p><p>it's</p><!-- <p>no</p> --><script>var a = '<p>';</script><style>p{}</style></article>", "one\n\nit's"),
    (f"<div class=wrap><div>{P}</div><div>short one</div><div>{P}</div></div>", f"{P}\n\nshort one\n\n{P}"),
    ("<article><p>a < b &lt; c&nbsp;&nbsp;d</p><p><a title='x>y' href=z>l</a></p></article>", "a < b < c d\n\nl"),
    (f"<body class='has-sidebar'><div class=sidebar-page-content><p>{P}</p></div>", P),
    ("just text &amp; more", "just text & more"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>cut <a href='/x", "cut"),
    ("", ""), (None, ""), ("<p> </p>", ""), ("<script>x", ""), ("<div hidden>x</div>", ""),
])
def test_parts_of_pages(page, want):
    assert line_blocks.main_text(page) == want


def test_surge_and_dive():
    groups = np.array([0, 0, 1, 1, 1, 9, 10])
    assert line_blocks.between(np.array([5, 0, 400, 3, 300, 0, 4]), groups).tolist() == [False, False, True, True, True, False, False]
    assert line_blocks.between(np.array([0, 0]), np.array([0, 1])).tolist() == [False, False]
    assert line_blocks.between(np.array([1, 0, 2]), np.array([0, 0, 7]), 1).tolist() == [True, False, True]


def test_pages_of_any_kind(spark):
    rows = [(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x"), (2, None, "<article>" + "<p>long " * 200_000, "x"), (3, "v", "no markup", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.n_chars) for r in line_blocks.extract(pages).collect()), key=str)
    assert got == sorted([(None, None, 0), (1, "u", 0), (1, "u", 0), (2, None, 6 * 200_000 - 2), (3, "v", 9)], key=str)
    assert line_blocks.extract(pages.limit(0)).collect() == []


# -- collocations -----------------------------------------------------------------

def brute_collocations(rows, least, top):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(fold)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if a >= least}
    out = collections.defaultdict(list)
    for p, a in often.items():
        lang, w = p[0], p[1:]
        if len(w) < 2:
            continue
        if any(len(q) > len(p) and q[0] == lang and b >= a and any(q[i:i + len(w)] == w for i in range(1, len(q))) for q, b in often.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
            for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def mined(spark, rows, least, top, **kw):
    docs = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, n int, phrase string")
    return {tuple(r) for r in fm_collocations.collocations(docs, least, top, **kw).collect()}


def invented(seed, n, words, long=30):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(words)] + ["A", "É", "the"]
    fixed = ["the big house of a", "É a é", "a a a a a a", "w1 w2 w3"]
    out = []
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(vocab) for _ in range(rnd.randint(0, long))]
        out.append((rnd.choice(["en", "fr", None]), "".join(p + rnd.choice([" ", " ", "  ", "\t", ", ", ".\n", " "]) for p in parts)))
    return out


@pytest.mark.parametrize("seed, words, least, top, kw", [(1, 6, 5, 2000, {}), (2, 40, 3, 10, {}), (3, 4, 8, 2000, {"shard_bytes": 200}), (4, 12, 4, 25, {"shard_bytes": 64})])
def test_collocations_equal_brute_force(spark, seed, words, least, top, kw):
    rows = [*invented(seed, 120, words), (None, None), ("und", "the big house of a"), ("en", ""), ("en", " .,; ")]
    want = brute_collocations(rows, least, top)
    assert mined(spark, rows, least, top, **kw) == want and len(want) > 5


def test_a_piece_longer_than_a_shard(spark):
    """Cut after a word; what both sides hold is counted once."""
    rnd = random.Random(5)
    text = " ".join(rnd.choice(["a", "bb", "ccc", "dd dd"]) for _ in range(3000))
    rows = [("en", text), ("en", "x" * 5000 + " " + "y" * 300), ("en", text[:1000])]
    want = brute_collocations(rows, 20, 2000)
    for most in (100, 333, 5000):
        assert mined(spark, rows, 20, 2000, shard_bytes=most) == want


def test_no_phrase_at_all(spark):
    assert mined(spark, [], 2, 10) == set()
    assert mined(spark, [("en", None), (None, "a b c")], 2, 10) == set()


def test_intervals_of_both_indexes():
    rnd = np.random.default_rng(6)
    t = np.append(rnd.integers(0, 5, 400), 0)
    forward, backward = fm_collocations.FMIndex.build(t, 5), fm_collocations.FMIndex.build(t[::-1], 5)
    grams = lambda k: collections.Counter(g for i in range(len(t) - k + 1) if 0 not in (g := tuple(t[i:i + k].tolist())))
    phrases = np.array([[k] for k in range(1, 5)])
    for k in range(2, 6):
        found = fm_collocations.extend(forward, backward, phrases)
        assert {tuple(p): n for p, n in zip(found.phrases.tolist(), found.n.tolist())} == grams(k)
        lo, hi = forward.find(found.phrases)
        assert (lo == found.lo).all() and (hi - lo == found.n).all()
        phrases = found.phrases


def test_scores_beyond_64_bits(spark):
    """Counts like those of a large corpus: the products pass 64 bits."""
    from pyspark.sql import functions as F
    a, n, left, right = 9 * 10**11, 3 * 10**13, 10**12 + 7, 11 * 10**11 + 3
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(n).alias("n"), F.lit(left).alias("l"), F.lit(right).alias("r"))
    assert row.select(fm_collocations.score()).first()[0] == 1000 * a * n // (left * right)


def test_memory_of_a_task():
    """Shards take less room than their text, and a level takes little more for several than for one."""
    rnd = np.random.default_rng(10)
    words = np.minimum(rnd.zipf(1.3, 1_200_000), 40_000)
    text = "".join(f"word{w}" + (". " if k % 11 == 0 else " ") for k, w in enumerate(words.tolist()))
    docs = [pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text[k:k + 100_000]])], ["lang", "text"]) for k in range(0, len(text), 100_000)]
    rows = list(fm_collocations._shards(iter(docs), fm_collocations.SHARD_BYTES, 100))
    shards = [b.select(["lang", "sign", "codes", "words"]) for b in rows if b.column("codes").null_count == 0]
    assert sum(b.nbytes for b in shards) < len(text) / 2
    bits = np.full(fm_collocations.BUCKETS // 8, 255, dtype=np.uint8)
    tracemalloc.start()
    try:
        for _ in fm_collocations._pass(iter(shards), 1, bits, 100, 64):
            pass
        assert tracemalloc.get_traced_memory()[1] < 26 << 20
    finally:
        tracemalloc.stop()


def test_counters_are_merged_in_little_room_and_handed_on(monkeypatch):
    monkeypatch.setattr(fm_collocations, "HELD_BUCKETS", 1 << 20)
    rnd = np.random.default_rng(11)
    b, rows = fm_collocations.Buckets(100), []
    tracemalloc.start()
    try:
        for _ in range(40):
            b.add(rnd.integers(0, 2**63, 100_000, dtype=np.uint64), np.ones(100_000, dtype=np.int64))
            if b.full():
                rows += list(b.rows())
        rows += list(b.rows())
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()
    told = [r for x in rows for r in x.to_pylist()]
    assert len({r["range"] for r in told}) < len(told) and not b.held    # handed on more than once
    assert sum(int(np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint8).sum()) for r in told) == 4_000_000


# -- clusters -----------------------------------------------------------------------

def brute_clusters(rows, dim=64, scale=64, k=16, rounds=3):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cent = [v for _, v in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))[::-1] for _, v in kept]
    for _ in range(rounds):
        at = [c for c, _ in assign()]
        cent = [[sum(x) // len(x) for x in zip(*mine)] if (mine := [v for (_, v), c in zip(kept, at) if c == j]) else old for j, old in enumerate(cent)]
    out = assign()
    of = collections.Counter()
    for c, d in out:
        of[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return collections.Counter((i, c, d, of[c], sum(of.values()), sha[c]) for (i, _), (c, d) in zip(kept, out))


def clustered(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, cluster int")
    return collections.Counter(tuple(r) for r in laesa_clusters.cluster(df, **kw).collect())


def test_clusters_equal_brute_force(spark):
    rnd = np.random.default_rng(7)
    base = rnd.normal(size=(20, 64))
    rows = [(k, (base[k % 20] + rnd.normal(size=64) * 0.4).round(3).tolist()) for k in range(400)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (401, [0.0] * 64), (402, [0.0] * 64)]
    rows += [(500, None), (501, []), (502, [1.0] * 63), (503, [None] + [1.0] * 63), (504, [float("nan")] * 64), (505, [float("-inf")] + [1.0] * 63)]
    assert clustered(spark, rows) == brute_clusters(rows)


def test_ties_few_vectors_and_none(spark):
    rows = [(k, [float(k % 2)] * 4) for k in range(9)]
    assert clustered(spark, rows, dim=4, k=5, rounds=2) == brute_clusters(rows, dim=4, k=5, rounds=2)
    assert clustered(spark, rows[:2], dim=4) == brute_clusters(rows[:2], dim=4)
    assert not clustered(spark, []) and not clustered(spark, [(None, [1.0] * 64)])
    with pytest.raises(Exception, match="beyond"):
        clustered(spark, [(1, [1e300] * 4)], dim=4)


def test_pivots_rule_out_most_centroids():
    rnd = np.random.default_rng(8)
    cent = rnd.integers(-60, 60, (16, 64))
    x = np.repeat(cent, 50, axis=0) + rnd.integers(-4, 5, (800, 64))
    d = np.sqrt(((x[:, None] - cent[None, :8]) ** 2).sum(axis=2))
    at, best, exact = laesa_clusters.nearest(x, d, cent, cent[:8])
    every = ((x[:, None] - cent[None]) ** 2).sum(axis=2)
    assert (best == every.min(axis=1)).all() and (at == every.argmin(axis=1)).all()
    assert exact < len(x) * 6


def test_buckets_are_full_if_and_only_if_their_sums_are(spark, monkeypatch):
    monkeypatch.setattr(fm_collocations, "HELD_ROWS", 50)
    rnd = np.random.default_rng(9)
    for least in (3, 100, 1000):
        want, rows = collections.Counter(), []
        for _ in range(3):    # tasks
            b = fm_collocations.Buckets(least)
            for _ in range(4):
                hashes = rnd.integers(0, 2**63, 60, dtype=np.uint64) >> np.uint64(rnd.integers(35, 63))
                counts = rnd.integers(1, least + 2, 60)
                b.add(hashes, counts)
                for h, n in zip(hashes.tolist(), counts.tolist()):
                    want[h % fm_collocations.BUCKETS] += n
            rows += list(b.rows())
        table = sorted((r for x in rows for r in x.to_pylist()), key=lambda r: r["range"])
        sums = collections.Counter()
        for r in table:
            at = fm_collocations._numbers(r["at"])
            for a, n in zip(at.tolist(), np.frombuffer(zlib.decompress(r["counts"]), dtype=np.min_scalar_type(least)).tolist()):
                sums[r["range"] * fm_collocations.RANGE + a] += n
        assert {a for a, n in sums.items() if n >= least} == {a for a, n in want.items() if n >= least} and set(sums) == set(want)
    some = np.unique(rnd.integers(0, 16384, 500))
    assert (fm_collocations._numbers(fm_collocations._gaps(some)) == some).all()
