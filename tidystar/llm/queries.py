"""Registered queries of the training-data operators, and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidystar.llm import (byte_bpe, exact_topk, html_extract, language_id, near_dedup, packing,
                          periodic_runs, permutation_index, quality, token_alignment, url_filter, warc,
                          word_transducer)
from tidystar.llm.common import hash_remainder, read_table, share_package, small_batches, tokenizer_path


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encode(read_table(spark, sf_dir, "documents"), ranks, pattern, ["doc_id"])
    return byte_bpe.decode(coded, ranks, pattern).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        byte_bpe.ids_digest("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_byte_cnn_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(hash_remainder("doc_id", 3) == 1, F.lit(False))
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"),
                                                               "lang_pred", "score")


def op3_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_digest(warc.archive_round_trip(spark, read_table(spark, sf_dir, "pages"), min_bytes=0))


#: Host rules of the query, and patterns that decide where none of them fits.
URL_RULES = [
    url_filter.host_rule("allow", "org/"), url_filter.host_rule("block", "example.org/es/"),
    url_filter.host_rule("block", "example.org/en/1"), url_filter.host_rule("allow", "com/fr/"),
    url_filter.host_rule("block", "com/de/"),
    url_filter.pattern_rule("block", "^cheap-pills^"), url_filter.pattern_rule("block", "^free-bets^"),
    url_filter.pattern_rule("block", "^spam-farm^"),
]


def op4_rarest_token_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark, read_table(spark, sf_dir, "pages"), URL_RULES)


def op5_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(small_batches(spark), sf_dir, "documents")
    held_out = F.coalesce(hash_remainder("doc_id", 5) == 0, F.lit(False))
    model = quality.fit(spark, docs, read_table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_consensus_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(spark, read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k_inner_product(read_table(spark, sf_dir, "embeddings"),
                                          F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest_neighbours(read_table(spark, sf_dir, "embeddings"),
                                                F.col("vec_id") % 100 == 0, k=10)


def op9_bbit_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, read_table(spark, sf_dir, "documents"),
                                      shingle_words=2, threshold=0.8)


def op10_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces_digest(packing.pack_documents(
        read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))


def op11_exact_text_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokenizers(spark, read_table(spark, sf_dir, "documents"),
                                            tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_transducer_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    coded = word_transducer.encode(spark, read_table(spark, sf_dir, "documents"), path, ["doc_id"])
    return word_transducer.decode(coded, path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_branching_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(read_table(spark, sf_dir, "documents"), arrange=periodic_runs.planted)
    return periodic_runs.runs_digest(found)


def queries() -> dict:
    named = {name: fn for name, fn in globals().items() if name.startswith("op")}
    return {name: lambda spark, sf_dir, fn=fn: fn(share_package(spark), sf_dir)
            for name, fn in named.items()}


# Links by counting the shingles that two documents share; a shingle that only
# one document has is left out of the join.
_OP9 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                      ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y
           FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
                AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
           GROUP BY a.doc_id, b.doc_id, a.n, b.n
           HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, s.y FROM reach r JOIN shared s ON r.other = s.x),
least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least_id l USING (doc_id)
"""


_USABLE = """len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

_OP7 = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND {_USABLE}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


# sha1() gives hex; base32 takes five hex digits (20 bits) to four of its own.
_OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT page_id, strlen(body) AS payload_bytes, hex,
                list_transform(range(0, 8), lambda i: ('0x' || substr(hex, (5 * i + 1)::INT, 5))::BIGINT) AS g FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(g, lambda v:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31)::INT + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31)::INT + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31)::INT + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31)::INT + 1, 1)), '') AS payload_digest FROM bits),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

_OP4 = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, rest, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule, rule_host, rule_path, action) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
m AS (SELECT h.page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
      FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY h.page_id),
p AS (SELECT page_id, unnest(['cheap-pills', 'free-bets', 'spam-farm']) AS word, rest FROM h),
b AS (SELECT page_id, min(CASE word WHEN 'cheap-pills' THEN 1 WHEN 'free-bets' THEN 2 ELSE 3 END) AS n FROM p
      WHERE regexp_matches(lower(rest), '(^|[^a-z0-9])' || word || '([^a-z0-9]|$)') GROUP BY page_id)
SELECT h.page_id, host, path, m.rule, coalesce(m.action, CASE WHEN b.n IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN m.rule IS NULL THEN ['^cheap-pills^', '^free-bets^', '^spam-farm^'][b.n] END AS pattern
FROM h LEFT JOIN m USING (page_id) LEFT JOIN b USING (page_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc_transactions": _OP3,
            "op4_rarest_token_url_rules": _OP4,
            "op7_ball_tree_top_k": _OP7,
            "op9_bbit_minhash_near_dedup": _OP9}
