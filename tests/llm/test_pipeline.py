"""Queries of the subpackage and the pipeline over small tables."""

import os
import sys

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
import corpus_pipeline
from factkeeper.llm import bm25_wand, pii_disclosure, queries, simhash_trie

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

SF = "/root/testdata/sf0.001"

# The columns that each query's contract names.
COLUMNS = {
    1: ["doc_id", "n_words", "n_removed", "kept_sha256"],
    3: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    4: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    5: ["doc_id", "held_out", "lang_pred", "score"],
    7: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    8: ["doc_id", "held_out", "score", "predicted"],
    9: ["vec_id", "n_links", "component_id", "kept"],
    10: ["doc_id", "fingerprint", "component_id"],
    11: ["page_id", "url", "text", "n_chars"],
    12: ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    13: ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}
TABLES = {9: "embeddings", 11: "pages", 13: "embeddings"}


def test_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(se.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_and_rows(spark, name):
    out = se.queries()[name](spark, SF)
    n = int(name[2:].split("_")[0])
    if n in COLUMNS:
        assert out.columns[:len(COLUMNS[n])] == COLUMNS[n]
        if n != 12:    # phrases of at least 100 occurrences, if any
            assert out.count() == spark.read.parquet(f"{SF}/{TABLES.get(n, 'documents')}.parquet").count()
    else:
        assert "doc_id" in out.columns and out.count() > 0


def brute_rows(spark):
    """What the stages but the last leave, document by document."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    predict = brute.language_model([(r.doc_id, r.text, r.lang) for r in docs.values()])
    docs = {i: r for i, r in docs.items() if (said := predict(r.text))[0] != "und" and said[1] >= 0.5}
    fp = {i: simhash_trie.fingerprint(r.text) for i, r in docs.items()}
    comp = {i: i for i in docs}
    ids, bits = np.array(sorted(fp)), np.array([fp[i] for i in sorted(fp)], dtype=np.uint64)
    changed = True
    while changed:
        changed = False
        for k, i in enumerate(ids.tolist()):
            low = min(comp[j] for j in ids[np.bitwise_count(bits ^ bits[k]) <= 4].tolist())
            changed |= low < comp[i]
            comp[i] = min(comp[i], low)
    docs = {i: r for i, r in docs.items() if comp[i] == i}
    items = [bm25_wand.shingles(bm25_wand.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return {i: r for i, r in docs.items()
            if all(bm25_wand.share(s, bm25_wand.words_of(r.text)) < 0.8 for s in items)}


def test_pipeline(spark):
    from tokenizers import Tokenizer

    want = brute_rows(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(texts) == set(want)
    for i, t in texts.items():
        left = pii_disclosure.base_spans(t)
        assert not left
        if not pii_disclosure.base_spans(want[i].text):
            assert t == want[i].text
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == set(want)
    ref = Tokenizer.from_file(queries.bpe_lexicon.default_tokenizer())
    for i, r in out.items():
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == ref.encode(texts[i], add_special_tokens=False).ids


def test_pipeline_of_odd_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = spark.createDataFrame(
        [(None, "some words", None, None, None, "x"), (1, None, "en", "a", 3, "x"), (2, "", None, None, 0, "x"),
         (3, "words of mine", "en", "a", None, "x"), (3, "words of mine", "en", "a", None, "x")],
        "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == odd.columns
        left = docs.agg(F.count(F.lit(1))).first()[0]
        assert left == (2 if rows is odd else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == left


def test_oracles(spark):
    from compare import canon, duck

    con = duck("/root/testdata/sf0.01")
    for name, sql in queries.oracle_sql().items():
        df = se.queries()[name](spark, "/root/testdata/sf0.01")
        rel = con.sql(sql)
        assert sorted(df.columns) == sorted(rel.columns)
        assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())
