"""Queries of the operators over the driver's tables, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    op1_packing,
    op2_decontamination,
    op3_substring,
    op4_topk,
    op5_warc,
    op6_near_dup,
    op7_url_filter,
    op8_html,
    op9_pitman_yor,
    op10_quality,
    op11_pii,
    op12_lexical,
    op13_negatives,
)
from footfall.llm.common import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    """The tokenizer's file; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return op1_packing.pack(table(spark, folder, "documents"), vocabulary()).drop("loss")


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return op2_decontamination.contaminated(docs, items)


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return op3_substring.remove_repeats(table(spark, folder, "documents"), window=20)


def op4_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return op4_topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64.0)


def op5_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return op5_warc.round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return op6_near_dup.near_duplicates(table(spark, folder, "documents"), width=2, threshold=0.8)


def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return op7_url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return op8_html.extract_main_text(table(spark, folder, "pages"))


def op9_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return op9_pitman_yor.score_texts(table(spark, folder, "documents"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return op10_quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return op11_pii.find_personal_data(table(spark, folder, "documents"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return op12_lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return op13_negatives.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES = {
    "op1_packing": op1_packing_pieces,
    "op2_decontaminate": op2_decontaminate,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_warc": op5_warc_round_trip,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_url_filters": op7_url_filters,
    "op8_main_text": op8_main_text,
    "op9_pitman_yor": op9_language_model,
    "op10_quality": op10_quality_classifier,
    "op11_personal_data": op11_personal_data,
    "op12_lexical_search": op12_lexical_search,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op5_warc": r"""
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
         strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
h AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS holder FROM p
  WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM p LEFT JOIN h USING (payload_digest, payload_bytes)""",
    "op4_exact_top_k": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op7_url_filters": r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
q AS (
  SELECT page_id,
         translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM p),
r AS (
  SELECT *, CASE
    WHEN ('.' || host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM q)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark)),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
t AS (
  SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT row, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM t, c GROUP BY term, n_docs),
p AS (
  SELECT item, item_id, row, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total))))::BIGINT AS score
  FROM (SELECT DISTINCT item, item_id, unnest(terms) AS term FROM q) JOIN t USING (term) JOIN w USING (term), c
  GROUP BY ALL),
r AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
    "op13_hard_negatives": r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id, own)
  WHERE s.label <> own AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
