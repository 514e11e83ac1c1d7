"""Decontamination, personal data, BPE, language, licenses and toxicity."""

import random
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from factkeeper.llm import bm25_wand, bpe_lexicon, lang_backoff, license_minhash, pii_disclosure, toxic_crf

SF = "/root/testdata/sf0.01"
ODD = [(None, None, None), (1, None, "en"), (2, "", "fr"), (2, "", "fr"), (3, "123 !!", None), (4, "a" * 300_000, "en")]


def odd(spark):
    return spark.createDataFrame([(*r, "x", 1, []) for r in ODD], "doc_id long, text string, lang string, score string, ids int, spans array<int>")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# -- decontamination ----------------------------------------------------------

def items_of(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def brute_matches(docs, items):
    out = set()
    for i, text in docs:
        w = bm25_wand.words_of(text)
        for k, item in items:
            own = bm25_wand.shingles(bm25_wand.words_of(item))
            if own and bm25_wand.share(own, w) >= bm25_wand.MIN_OVERLAP:
                out.add((i, k))
    return out


def test_matches_are_those_of_brute_force(spark, documents):
    got = {(r.doc_id, r.item_id) for r in bm25_wand.find_matches(documents, items_of(spark)).collect()}
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = brute_matches(docs, [(r.item_id, r.text) for r in items_of(spark).collect()])
    assert got == want and len(want) > 10


def test_bounds_are_never_below_the_scores(spark, documents):
    index = next(bm25_wand.indexes(items_of(spark)))
    docs = [bm25_wand.words_of(r.text) for r in documents.select("text").limit(60).collect()]
    docs += [[*d[:40], *index.items[k % len(index.items)], *d[40:]] for k, d in enumerate(docs)]
    tids = np.array([index.terms.get(w, len(index.terms)) for d in docs for w in d])
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    found = {(lo, b) for lo, _, blocks in index.candidates(tids, doc) for b in blocks.tolist()}
    every = np.arange(index.block_max.shape[1])
    base, hits = 0, 0
    for d in docs:
        for at in range(0, len(d), bm25_wand.PASSAGE_WORDS // 2):
            for i, _ in index.scores(tids[base + at:base + min(at + bm25_wand.PASSAGE_WORDS, len(d))], every):
                assert (base + at, i // index.block_size) in found
                hits += 1
        base += len(d)
    assert hits >= 60


def test_scores_are_those_of_all_postings(spark, documents):
    """Skipping blocks and dropping items early loses no item at the threshold and no part of its score."""
    index = next(bm25_wand.indexes(items_of(spark)))
    every = np.arange(index.block_max.shape[1])
    rnd, hits = random.Random(2), 0
    term = np.repeat(np.arange(len(index.terms)), np.diff(index.first[::len(every)]))
    for _ in range(200):
        words = rnd.choice(index.items)[:64] + rnd.choice(index.items)[:rnd.randrange(30)]
        tids = np.array([index.terms[w] for w in words] + [len(index.terms)])
        plain = np.bincount(index.item, np.where(np.isin(term, tids), index.impact, 0), len(index.items))
        want = {i: x for i, x in enumerate(plain.tolist()) if x >= bm25_wand.THRESHOLD}
        got = dict(index.scores(tids, every))
        assert set(got) == set(want) and all(abs(got[i] - want[i]) < 1e-9 for i in got)
        hits += len(got)
    assert hits >= 100


def test_items_in_shards(spark, documents, monkeypatch):
    want = {(r.doc_id, r.item_id) for r in bm25_wand.find_matches(documents, items_of(spark)).collect()}
    monkeypatch.setattr(bm25_wand, "SHARD_BYTES", 4096)
    monkeypatch.setattr(bm25_wand, "PASS_SHARDS", 3)
    assert sum(1 for _ in bm25_wand.indexes(items_of(spark))) > 1
    assert {(r.doc_id, r.item_id) for r in bm25_wand.find_matches(documents, items_of(spark)).collect()} == want
    clean = bm25_wand.decontaminate_stage(documents, items_of(spark))
    assert clean.count() == documents.count() - len({d for d, _ in want})


def test_decontamination_of_odd_rows(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (None, "a null item of seven words here")], "item_id long, text string")
    docs = odd(spark).unionByName(spark.createDataFrame([(9, "and now Two, words!", "en", "x", 1, [])], odd(spark).schema))
    assert [(r.doc_id, r.item_id) for r in bm25_wand.find_matches(docs, items).collect()] == [(9, 3)]
    assert bm25_wand.decontaminate_stage(docs, items).count() == len(ODD)
    assert bm25_wand.decontaminate_stage(docs, items).columns == docs.columns
    assert bm25_wand.find_matches(docs, items.limit(0)).collect() == []
    assert bm25_wand.find_matches(docs.limit(0), items).collect() == []


# -- personal data ------------------------------------------------------------

# The patterns as stated.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def luhn(d):
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
        return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0

    return ([("email", *m.span()) for m in EMAIL.finditer(t)]
            + [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
            + [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
            + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15])


def test_base_spans():
    rnd = random.Random(7)
    bits = ["a", "1", "2", "255", ".", "@", "-", " ", "+", "(", ")", "4111111111111111", "b.c", "é", "@x.y", "1.2.3.4", ".5", "0000"]
    for _ in range(20_000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        assert pii_disclosure.base_spans(t) == brute_spans(t)


def test_base_spans_of_very_long_tokens():
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+" * 200_000, "a@" * 100_000):
        pii_disclosure.base_spans(t)


def disclosing(spark):
    rows = [(k, f"filler word{k} is seen, agent Smith writes from j.doe@mail.example today, number{k}") for k in range(6)]
    rows += [(100 + k, f"plain other{k} text that has no data but is seen today") for k in range(60)]
    return rows, spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, n_chars long, rid string")


def test_terms_are_those_of_brute_force(spark):
    rows, docs = disclosing(spark)
    near, df = {}, {}
    for i, t in rows:
        spans = pii_disclosure.base_spans(t)
        for value, word, *_ in pii_disclosure.contexts(t, spans):
            near.setdefault((value, word), set()).add(i)
        for w in set(re.findall(r"[^\W\d_]+", t.lower())):
            df[w] = df.get(w, 0) + 1
    values = {}
    for (v, _), ids in near.items():
        values.setdefault(v, set()).update(ids)
    want = {w for (v, w), ids in near.items() if len(ids) >= 3 and np.log2(len(ids) / df[w]) >= -1
            and np.log2(len(ids) * len(rows) / (df[w] * len(values[v]))) >= 4}
    got = set()
    for r in pii_disclosure.detect(docs).collect():
        got |= {dict(rows)[r.doc_id][s.start:s.stop].lower() for s in r.spans if s.kind == "term"}
    assert got == want
    monkey = pii_disclosure.detect(docs).filter(F.size("base") > 0).first()
    assert [s.kind for s in monkey.spans][0] == "email"


def test_terms_that_disclose_go(spark, monkeypatch):
    monkeypatch.setattr(pii_disclosure, "MIN_GAIN_BITS", 3.0)
    rows, docs = disclosing(spark)
    out = {r.doc_id: r for r in pii_disclosure.sanitise_stage(docs).collect()}
    assert "Smith" not in out[0].text and "j.doe" not in out[0].text and "[EMAIL]" in out[0].text
    assert "seen" in out[0].text and out[0].n_chars == len(out[0].text)
    assert all(out[i].text == t for i, t in rows if i >= 100)


def test_terms_anywhere_in_the_documents_of_a_value(spark):
    """Far from the value, with digits, named twice, or in capitals that lower-case to two letters; a letter-only
    word and 200 characters are no bound."""
    far = " ".join(f"pad{k % 7}" for k in range(90))
    rows = [(k, f"EMP4471 and Kowalski, {far} j.doe@mail.example {far} again KOWALSKI of \u0130zmir") for k in range(4)]
    rows += [(100 + k, f"{far} and again of plain text") for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii_disclosure.sanitise_stage(docs).collect()}
    assert all(out[i] == f" and , {far} [EMAIL] {far} again  of " for i in range(4))
    assert all(out[i] == t for i, t in rows if i >= 100)
    for r in pii_disclosure.detect(docs).filter("doc_id < 100").collect():
        text = rows[r.doc_id][1]
        assert [text[s.start:s.stop] for s in r.spans] == ["j.doe@mail.example", "EMP4471", "Kowalski", "KOWALSKI", "\u0130zmir"]


@pytest.mark.parametrize("every", [2, 3, 10])
def test_terms_of_a_value_in_a_large_share_of_the_documents(spark, every):
    """Production constants. ``few`` (five documents) may be chance, and half the documents of ``common`` lack the value."""
    rows, want = [], {}
    for k in range(240):
        start = f"plain words{k} of text" + (" common" if k % (2 * every) < 2 else "") + (" few" if k < 5 * every and k % every == 0 else "")
        rows.append((k, start if k % every else f"{start} office Kowalski desk j.doe@mail.example"))
        want[k] = start if k % every else f"{start}    [EMAIL]"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii_disclosure.sanitise_stage(docs).collect()} == want


def brute_terms(rows):
    """Terms of each document by the rules as stated, values and words counted one by one."""
    held, has, df = {}, {}, {}
    for i, t in rows:
        spans = pii_disclosure.base_spans(t)
        inside = lambda m: any(s < m.end() and m.start() < e for _, s, e in spans)  # noqa: B023, E731
        has[i] = {m[0].lower() for m in re.finditer(r"[^\W_]+", t) if not inside(m)}
        for w in {m.lower() for m in re.findall(r"[^\W_]+", t)}:
            df[w] = df.get(w, 0) + 1
        for v in pii_disclosure.values_of(t, spans):
            held.setdefault(v, set()).add(i)
    n, want = len(rows), {i: set() for i, _ in rows}
    for ids in held.values():
        for w in set().union(*(has[i] for i in ids)):
            c = sum(w in has[i] for i in ids)
            if c < 3 or -np.log2(c / df[w]) > 1:
                continue
            gain, p = np.log2(c * n / (df[w] * len(ids))), len(ids) / n
            evidence = c * np.log2(c / df[w] / p) + (df[w] - c and (df[w] - c) * np.log2((1 - c / df[w]) / (1 - p)))
            if gain >= 4 or gain >= 0.8 * -np.log2(p) and evidence >= 24:
                for i in ids:
                    want[i] |= {w} & has[i]
    return want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_terms_equal_brute_force(spark, seed):
    """Values of few and of many documents, alone and in company, with the evidence rule."""
    rnd = random.Random(seed)
    people = [(f"p{k}@mail.example", f"Name{k}", f"10.0.{k}.7") for k in range(12)]
    rows = []
    for i in range(300):
        said = [rnd.choice(["the", "of", f"w{rnd.randrange(60)}", f"u{i}"]) for _ in range(12)]
        for mail, name, ip in rnd.sample(people, rnd.choice([0, 0, 1, 3])) + ([people[0]] if i % 3 == 0 else []):
            said += [mail, name if rnd.random() < 0.9 else "he", *([ip, f"host{ip[5:-2]}"] if rnd.random() < 0.5 else [])]
        rnd.shuffle(said)
        rows.append((i, " ".join(said)))
    want = brute_terms(rows)
    got = {r.doc_id: {dict(rows)[r.doc_id][s.start:s.stop].lower() for s in r.spans if s.kind == "term"}
           for r in pii_disclosure.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and sum(map(bool, want.values())) > 50


def test_pairs_grow_with_the_text(spark):
    """An address list and its copies: one address stands for all that the same documents hold."""
    def pairs(n):
        text = " ".join(f"a{k}@mail.example Name{k} of place{k}" for k in range(n))
        rows = [(k, text) for k in range(3)] + [(9, "of other words"), (10, "of more")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        base = pii_disclosure.found(docs.withColumnRenamed("doc_id", "rid")).withColumnRenamed("__base", "base")
        return pii_disclosure.value_words(base.filter(F.size("__values") > 0), docs).count()

    assert pairs(100) == 3 * 201 and pairs(400) == 3 * 801


def test_no_term_of_a_value_in_all_documents(spark):
    rows = [(k, f"office Kowalski writes{k} j.doe@mail.example") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.text == rows[r.doc_id][1].replace("j.doe@mail.example", "[EMAIL]") for r in pii_disclosure.sanitise_stage(docs).collect())


def test_sanitise():
    s = lambda *x: [dict(zip(("kind", "start", "stop"), y)) for y in x]
    assert pii_disclosure.sanitise("ab 1.2.3.4 cd", s(("ip", 3, 10), ("term", 0, 2))) == " [IP] cd"
    assert pii_disclosure.sanitise("abcdef", s(("card", 1, 4), ("phone", 3, 5))) == "a[CARD]f"
    assert pii_disclosure.sanitise(None, []) is None


def test_personal_data_of_odd_rows(spark):
    out = pii_disclosure.detect(odd(spark)).collect()
    assert len(out) == len(ODD) and all(r.spans == [] for r in out)
    assert pii_disclosure.detect(odd(spark).limit(0)).collect() == []
    same = pii_disclosure.sanitise_stage(odd(spark))
    assert same.schema == odd(spark).schema
    assert sorted(map(str, same.collect())) == sorted(map(str, odd(spark).collect()))


# -- BPE ----------------------------------------------------------------------

def test_encoding_is_that_of_the_library(spark, documents):
    from tokenizers import Tokenizer

    path = bpe_lexicon.default_tokenizer()
    ref = Tokenizer.from_file(path)
    out = bpe_lexicon.encode(documents, path, words=2000).join(documents.select("doc_id", "text"), "doc_id").collect()
    assert len(out) == documents.count()
    for r in out:
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == ref.encode(r.text, add_special_tokens=False).ids
        assert r.decoded == r.text and r.n_tokens * 4 == len(r.ids)


def test_encoding_of_any_characters():
    from tokenizers import Tokenizer

    path = bpe_lexicon.default_tokenizer()
    ref = Tokenizer.from_file(path)
    raw = bpe_lexicon.load_tokenizer(path)
    merges = bpe_lexicon.Merges(raw)
    words = {w: merges.ids(w) for w in (b" the", b"the", b" then", b" een", b"'s", "é".encode())}
    enc = bpe_lexicon.Encoder(raw, bpe_lexicon.compile_lexicon(words))
    rnd = random.Random(8)
    pool = [chr(k) for k in range(256)] + list(" 　 ᠎​½²٣中文字हिन्दी😀👍🏽ǅ﻿̀") + ["<|endoftext|>", "'re", "'ll", " the", "  "]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rnd.choice("abehort") for _ in range(rnd.randint(65, 300))) for _ in range(50)] + ["", "ab" * 5000]
    for t in texts:
        ids = ref.encode(t, add_special_tokens=False).ids
        packed = enc.encode(t)
        assert np.frombuffer(packed, dtype="<u4").tolist() == ids
        assert enc.decode(packed) == ref.decode(ids, skip_special_tokens=False)


def test_lexicon():
    rnd = random.Random(9)
    words = {bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 7))): [rnd.randrange(50_000) for _ in range(rnd.randint(1, 4))] for _ in range(300)}
    block = bpe_lexicon.compile_lexicon(words)
    lex = bpe_lexicon.Lexicon(block)
    for w, ids in words.items():
        assert list(lex.ids(w)) == ids
    for _ in range(500):
        w = bytes(rnd.choice(b"abcd") for _ in range(rnd.randint(0, 8)))
        assert (lex.ids(w) is None) == (w not in words)
    # suffixes are shared: words that end alike need few states
    alike = {p + b"tion": [1] for p in (b"ab", b"cd", b"ef", b"gh")}
    assert len(bpe_lexicon.compile_lexicon(alike)) < 4 * (8 + 3 * 14 + 2 * 16 + 30)
    assert bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon({})).ids(b"a") is None


def test_encoding_of_odd_rows(spark):
    out = bpe_lexicon.encode(odd(spark), bpe_lexicon.default_tokenizer()).collect()
    assert sorted(r.decoded for r in out) == sorted((t or "") for _, t, _ in ODD)
    assert bpe_lexicon.encode(odd(spark).limit(0), bpe_lexicon.default_tokenizer()).collect() == []


# -- language -----------------------------------------------------------------

def test_language_held_out(spark, documents):
    out = lang_backoff.identify(documents).filter(lang_backoff.held_out()).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    assert all(0 <= r.lang_score <= 1 for r in out)


def test_language_sees_the_text_only(spark, documents):
    model = lang_backoff.fit(documents.filter(~lang_backoff.held_out()))
    one = lang_backoff.predict(documents, model).select("doc_id", "lang_pred").collect()
    two = lang_backoff.predict(documents.withColumn("lang", F.lit("xx")), model).select("doc_id", "lang_pred").collect()
    assert sorted(one) == sorted(two)


def test_unseen_words_fall_back(spark):
    train = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(
        [("thing things thinking", "en"), ("straße straßen schön", "de")] * 3)], "doc_id long, text string, lang string")
    scorer = lang_backoff.Scorer(lang_backoff.fit(train))
    assert scorer.predict("thingly")[0] == "en" and scorer.predict("straßig")[0] == "de"
    assert "thingly" not in scorer.model.words.keys and "thing" in scorer.model.words.keys


def test_scores_do_not_depend_on_what_is_remembered(spark, monkeypatch, documents):
    texts = [r.text for r in documents.select("text").limit(80).collect()]
    model = lang_backoff.fit(documents.limit(100))
    want = [lang_backoff.Scorer(model).predict(t) for t in texts]
    monkeypatch.setattr(lang_backoff, "CACHED_WORDS", 60)
    monkeypatch.setattr(lang_backoff, "RUN_WORDS", 50)
    scorer = lang_backoff.Scorer(model)
    for t, (lang, score) in zip(texts, want):
        got = scorer.predict(t)
        assert got[0] == lang and abs(got[1] - score) < 1e-5


def test_language_of_odd_rows(spark):
    out = lang_backoff.identify(odd(spark)).collect()
    assert len(out) == len(ODD)
    assert {r.lang_pred for r in out if not (r.text or "").startswith("a")} == {"und"}
    assert lang_backoff.identify(odd(spark).limit(0)).collect() == []
    assert lang_backoff.accepted_stage(odd(spark)).columns == odd(spark).columns


def test_language_equals_a_plain_scorer(spark, documents):
    rows = [(r.doc_id, r.text, r.lang) for r in documents.select("doc_id", "text", "lang").limit(400).collect()]
    rows += [(9001, "x" * 90 + " Ünïcode ẞtraße", "de"), (9002, None, "en"), (9003, "no label at all", None), (None, "never learned from", "xx"), (9005, "42 !", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    predict = brute.language_model(rows)
    got = lang_backoff.identify(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = predict(r.text)
        assert r.lang_pred == lang and abs(r.lang_score - score) < 1e-4, r


def test_a_language_without_spaces_is_learned(spark):
    """Runs of letters beyond the longest word teach their n-grams."""
    rnd = random.Random(4)
    rows = [(k, "".join(rnd.choice("天地玄黄宇宙洪荒") for _ in range(90)), "zz") if k % 2 else (k, "the house of things and more", "en") for k in range(400)]
    out = lang_backoff.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.lang_pred == r.lang for r in out)


def test_a_small_language_keeps_its_words(spark, monkeypatch):
    """Quotas: the large language's vocabulary and rows don't crowd out the small one's."""
    monkeypatch.setattr(lang_backoff, "MODEL_WORDS", 60)
    monkeypatch.setattr(lang_backoff, "MODEL_GRAMS", 200)
    rnd = random.Random(5)
    big = [(k, " ".join(f"big{''.join(rnd.choice('abcdef') for _ in range(3))}" for _ in range(40)), "aa") for k in range(300)]
    small = [(1000 + k, "nunc est bibendum nunc pede libero", "zz") for k in range(12)]
    docs = spark.createDataFrame(big + small, "doc_id long, text string, lang string")
    model = lang_backoff.fit(docs, most_docs=40)
    assert {"nunc", "est", "bibendum", "pede", "libero"} <= set(model.words.keys) and len(model.words.keys) <= 60
    share = lang_backoff.training_rows(docs, 40).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in share}["zz"] == 12
    assert lang_backoff.Scorer(model).predict("bibendum nunc")[0] == "zz"


def test_the_stage_depends_on_the_prediction(spark, documents):
    docs = documents.select("doc_id", "text", "lang").limit(300)
    odd_rows = [(9001, "αβγ δεζ ηθι κλμ", None), (9002, "!!! 123", None), (9003, None, None)]   # no word or n-gram of it is known
    both = docs.unionByName(spark.createDataFrame(odd_rows, docs.schema))
    said = {r.doc_id: (r.lang_pred, r.lang_score) for r in lang_backoff.identify(both).collect()}
    ids = lambda **kw: {r.doc_id for r in lang_backoff.accepted_stage(both, **kw).collect()}
    assert ids() == {i for i, (lang, score) in said.items() if lang != "und" and score >= 0.5}
    assert 9001 not in ids() and 9001 in ids(least=0.0) and 9002 not in ids(least=0.0) and len(ids()) == 300
    assert ids(languages=["fr"]) == {i for i, (lang, score) in said.items() if lang == "fr" and score >= 0.5} != ids()


# -- licenses -----------------------------------------------------------------

def brute_licenses(docs, templates):
    norm = lambda t: " " + " ".join(license_minhash.words_of(t)) + " "
    return {(i, k) for i, t in docs for k, v in templates.items() if norm(v) in norm(t)}


def test_licenses(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    out = license_minhash.scan(documents).collect()
    assert {(r.doc_id, r.license) for r in out} == brute_licenses(docs, license_minhash.TEMPLATES) and len(out) > 20
    texts = dict(docs)
    for r in out:
        assert license_minhash.words_of(texts[r.doc_id][r.start:r.stop]) == license_minhash.words_of(license_minhash.TEMPLATES[r.license])


def test_changed_licenses(spark):
    rnd = random.Random(10)
    rows, want = [], set()
    for k in range(120):
        name = rnd.choice([n for n in license_minhash.TEMPLATES if len(license_minhash.words_of(license_minhash.TEMPLATES[n])) >= 20])
        w = license_minhash.words_of(license_minhash.TEMPLATES[name])
        w[rnd.choice([0, 1, len(w) - 2, len(w) - 1])] = "changed"
        rows.append((k, " ".join([f"f{rnd.randrange(900)}" for _ in range(rnd.randint(0, 300))] + w + ["end"] * rnd.randint(0, 9))))
        own = license_minhash.words_of(license_minhash.TEMPLATES[name])
        have = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        if sum(tuple(own[i:i + 5]) in have for i in range(len(own) - 4)) / len({tuple(own[i:i + 5]) for i in range(len(own) - 4)}) >= 0.8:
            want.add((k, name))
    got = {(r.doc_id, r.license) for r in license_minhash.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert want and len(want - got) <= 0.02 * len(want)


def test_licenses_in_slices_of_short_documents():
    """Documents that lie strictly inside a window, whatever their neighbours' lengths."""
    names = [n for n, t in license_minhash.TEMPLATES.items() if len(license_minhash.words_of(t)) >= 20]
    own = {n: license_minhash.words_of(license_minhash.TEMPLATES[n]) for n in names}
    parts = {n: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for n, w in own.items()}
    rnd = random.Random(23)
    t = license_minhash.Templates(names, list(own.values()))
    for _ in range(20):
        docs, want = [], set()
        for k in range(60):
            name, n = rnd.choice(names), rnd.randint(70, 126)
            w = list(own[name])
            if rnd.random() < 0.5:
                w[rnd.choice([0, 1, len(w) - 2, len(w) - 1])] = "changed"
            lead = rnd.randint(0, max(0, n - len(w)))
            filler = [f"f{rnd.randrange(900)}" for _ in range(n)]
            docs.append([*filler[:lead], *w, *filler[lead + len(w):]] if k % 3 else filler)
            have = {tuple(docs[-1][i:i + 5]) for i in range(len(docs[-1]) - 4)}
            want |= {(k, m) for m in names if len(parts[m] & have) / len(parts[m]) >= 0.8}
        assert want and {(d, m) for d, m, *_ in t.scan([" ".join(d) for d in docs])} == want


def test_licenses_of_odd_rows(spark):
    assert license_minhash.scan(odd(spark)).collect() == []
    assert license_minhash.scan(odd(spark).limit(0)).collect() == []
    with pytest.raises(ValueError):
        license_minhash.scan(odd(spark), {"short": "three words only"})


# -- toxicity -----------------------------------------------------------------

def toxic_rows(seed, n):
    rnd = random.Random(seed)
    vocab = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}word" for k in range(400)]
    bad = ["vile", "rotten", "awful", "nasty"]
    rows = []
    for k in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(30, 120))]
        toxic = int(rnd.random() < 0.15)
        for _ in range(3 * toxic):
            w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        rows.append((k, " ".join(w).capitalize(), toxic))
    return rows, bad


def test_toxicity_held_out(spark):
    rows, bad = toxic_rows(11, 900)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    crf = toxic_crf.fit(docs, labels)
    assert set(crf.place) == set(bad)
    truth, texts = {i: y for i, _, y in rows}, {i: t for i, t, _ in rows}
    for r in toxic_crf.score(docs, crf).collect():
        assert (r.score >= 0.5) == bool(truth[r.doc_id])
        assert {w for s in r.spans for w in texts[r.doc_id][s.start:s.stop].lower().split()} <= set(bad)
        assert bool(r.spans) == bool(truth[r.doc_id])


def test_copies_are_no_lexicon(spark):
    """Words that occur in copies of one toxic text only aren't learned."""
    rows, bad = toxic_rows(12, 600)
    rows += [(5000 + k, f"unique phrasing of copied text stands here again {k} vile", 1) for k in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    assert not {"unique", "phrasing", "copied"} & set(toxic_crf.fit(docs, labels).place)


def test_marginals():
    """Forward-backward against the sum over all state sequences."""
    rng = np.random.default_rng(13)
    score, trans, length = rng.normal(size=(6, 5)), rng.normal(size=(2, 2)), np.array([5, 4, 3, 2, 1, 5])
    got, pairs, log_z = toxic_crf._forward_backward(score, trans, length)
    want_pairs, want_z = np.zeros((2, 2)), 0.0
    for k in range(6):
        total, ones = 0.0, np.zeros(5)
        seqs = [[s >> j & 1 for j in range(length[k])] for s in range(1 << length[k])]
        weight = [np.exp(sum(score[k, j] * y for j, y in enumerate(s)) + sum(trans[a, b] for a, b in zip(s, s[1:]))) for s in seqs]
        total = sum(weight)
        for s, w in zip(seqs, weight):
            ones[:length[k]] += np.array(s) * w / total
            for a, b in zip(s, s[1:]):
                want_pairs[a, b] += w / total
        want_z += np.log(total)
        assert np.allclose(got[k], ones)
    assert np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_marginals_of_whole_texts():
    """Cut into runs or not, a text has the same marginals; so have the same words at every offset."""
    rng = np.random.default_rng(14)
    place = {f"v{k}": k for k in range(1, 6)}
    crf = toxic_crf.Crf(place, np.array([-3.0, 2.5, 1.0, 3.0, -1.0, 0.5]), np.array([[0.6, -0.9], [-0.7, 1.1]]), np.zeros(4))
    docs = [[rng.choice([*place, "x", "y", "z"], p=[0.04] * 5 + [0.3, 0.3, 0.2]) for _ in range(n)] for n in (1, 64, 65, 128, 1000, 3, 200, 0, 63, 5000)]
    at, length, doc, first = toxic_crf.runs_of(docs, place)
    got = crf.marginals(at, length, doc)
    for d, words in enumerate(docs):
        if words:
            whole = np.array([[place.get(w, 0) for w in words]])
            want = toxic_crf._forward_backward(crf.emit[whole], crf.trans, np.array([len(words)]))[0][0]
            mine = np.concatenate([got[r][:length[r]] for r in np.flatnonzero(doc == d)])
            assert np.allclose(mine, want, atol=1e-9)
    words = toxic_crf.Crf({"qa": 1, "qb": 2, "qc": 3}, crf.emit, crf.trans, np.zeros(4))
    tops = [toxic_crf.Scorer(words).evidence([" ".join([*["x"] * k, "qa", "qb", "qc", *["x"] * (500 - k)])])[0][0] for k in range(150, 290)]
    assert np.ptp(np.array(tops), axis=0).max() < 1e-9 and tops[0][1] > 0.8


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(None, 1), (4, None)], "doc_id long, toxic int")
    crf = toxic_crf.fit(odd(spark), labels)
    out = toxic_crf.score(odd(spark), crf).collect()
    assert len(out) == len(ODD) and all(0 <= r.score < 0.5 and r.spans == [] for r in out)
    assert toxic_crf.score(odd(spark).limit(0), toxic_crf.fit(odd(spark).limit(0), labels.limit(0))).collect() == []
    assert [x for x in toxic_crf._lowered_words("İ vile")][-1] == (2, 6)
