"""The queries of this subpackage: each applies one operator, with production
parameters, to its whole table and derives the digest columns from its output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factkeeper.llm import (
    bm25_wand, bpe_lexicon, embed_ego, fm_collocations, laesa_clusters, lang_backoff, license_minhash, line_blocks, phrase_automata,
    pii_disclosure, prefix_free, simhash_trie, toxic_crf,
)
from factkeeper.llm.common import prepare


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrase_automata.substring_dedup(_table(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_wand.find_matches(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op3_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii_disclosure.detect(_table(spark, sf_dir))
    counts = [pii_disclosure.counted(out.base, kind).alias(f"n_{kind}") for kind in pii_disclosure.KINDS]
    return out.select("doc_id", *counts, F.sha2(pii_disclosure.joined(out.base), 256).alias("base_sha256"),
                      pii_disclosure.joined(out.spans).alias("spans"))


def op4_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_lexicon.encode(_table(spark, sf_dir), bpe_lexicon.default_tokenizer())
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_lang_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir).select("doc_id", "text", "lang")
    out = lang_backoff.identify(docs)
    return out.select("doc_id", F.coalesce(lang_backoff.held_out(), F.lit(False)).alias("held_out"), "lang_pred",
                      F.col("lang_score").alias("score"))


def op6_license_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_minhash.scan(_table(spark, sf_dir))


def op7_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prefix_free.byte_dedup(_table(spark, sf_dir))
    return out.select("doc_id", "n_bytes", prefix_free.removed(out.spans).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir)
    out = toxic_crf.score(docs, toxic_crf.fit(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", toxic_crf.held_out().alias("held_out"), "score",
                      (out.score >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


def op9_embed_ego(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_ego.near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_trie.simhash_dedup(_table(spark, sf_dir), shingle=4, budget=4)
    return out.select("doc_id", simhash_trie.hex16(out.fp).alias("fingerprint"), "component_id")


def op11_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.extract(_table(spark, sf_dir, "pages"))


def op12_fm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_collocations.collocations(_table(spark, sf_dir), least=100, top=2000)


def op13_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laesa_clusters.cluster(_table(spark, sf_dir, "embeddings"), dim=64, scale=64, k=16, rounds=3)


QUERIES = {
    "op1_phrase_automata": op1_phrase_automata,
    "op2_bm25_wand": op2_bm25_wand,
    "op3_pii_disclosure": op3_pii_disclosure,
    "op4_bpe_lexicon": op4_bpe_lexicon,
    "op5_lang_backoff": op5_lang_backoff,
    "op6_license_minhash": op6_license_minhash,
    "op7_prefix_free": op7_prefix_free,
    "op8_toxic_crf": op8_toxic_crf,
    "op9_embed_ego": op9_embed_ego,
    "op10_simhash_trie": op10_simhash_trie,
    "op11_line_blocks": op11_line_blocks,
    "op12_fm_collocations": op12_fm_collocations,
    "op13_laesa_clusters": op13_laesa_clusters,
}


_OP1_SQL = """
WITH words AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+') IF x <> ''] AS w FROM documents
), starts AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM starts) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, i + o AS p FROM later, range(0, 20) AS t(o)
), each AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
  SELECT e.doc_id, count(*) FILTER (g.p IS NOT NULL) AS n_removed, string_agg(e.x, ' ' ORDER BY e.p) FILTER (g.p IS NULL) AS t
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept ON words.doc_id = kept.doc_id
"""

_OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a
), low AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN low ON e.vec_id = low.vec_id
"""


_OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM documents
), words AS (
  SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[ \\t]+') IF x <> ''] AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS t(k) WHERE len(w) >= k)
), f AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*)::HUGEINT AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT f.lang, f.phrase, f.k, f.a, j, p.a AS l, q.a AS r, p.phrase AS head, q.phrase AS tail, (1000 * f.a * n) // (p.a * q.a) AS score, n
  FROM (SELECT lang, phrase, w, k, a, unnest(range(1, k)) AS j FROM f WHERE k > 1) f
  JOIN f p ON p.lang = f.lang AND p.phrase = array_to_string(f.w[1:j], ' ')
  JOIN f q ON q.lang = f.lang AND q.phrase = array_to_string(f.w[j + 1:f.k], ' ')
  JOIN totals ON totals.lang = f.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT lang, tail AS phrase FROM cuts WHERE j = 1 AND r = a UNION SELECT lang, head FROM cuts WHERE j = k - 1 AND l = a
), ranked AS (
  SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank, best.phrase, a, l, r, n, score
  FROM best ANTI JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


def _op13_sql(rounds: int = 3) -> str:
    """The rounds, one after the other; a distance is the sum over the components' differences."""
    assigned = """{name} AS MATERIALIZED (
  SELECT vec_id, id, v, arg_min(c, (d, c))::INT AS cluster, min(d) AS distance FROM (
    SELECT x.vec_id, x.id, x.v, m.c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x.v, m.m)])::BIGINT AS d FROM whole x, {centroids} m)
  GROUP BY vec_id, id, v
)"""
    moved = """{name} AS MATERIALIZED (
  SELECT o.c, coalesce(n.m, o.m) AS m FROM {old} o LEFT JOIN (
    SELECT cluster, list(s ORDER BY i) AS m FROM (
      SELECT cluster, i, (sum(y) - ((sum(y) % count(*) + count(*)) % count(*)))::HUGEINT // count(*) AS s
      FROM (SELECT cluster, unnest(v) AS y, unnest(range(1, 65)) AS i FROM {assigned}) GROUP BY cluster, i)
    GROUP BY cluster) n ON o.c = n.cluster
)"""
    steps = ["""whole AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)""", """m0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1)::INT AS c, v::HUGEINT[] AS m FROM whole
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16
)"""]
    for k in range(rounds + 1):
        steps.append(assigned.format(name=f"a{k}", centroids=f"m{k}"))
        if k < rounds:
            steps.append(moved.format(name=f"m{k + 1}", old=f"m{k}", assigned=f"a{k}"))
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN m{rounds} ON c = cluster
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express; tests hold the others against brute force."""
    return {"op1_phrase_automata": _OP1_SQL, "op9_embed_ego": _OP9_SQL, "op12_fm_collocations": _OP12_SQL, "op13_laesa_clusters": _op13_sql()}
