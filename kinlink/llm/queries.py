"""Registered queries of the operators, over whole tables, and their DuckDB SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinlink.llm import (
    chunking, conversations, crf, line_dedup, line_labels, mixing, ngram_join, periodic, pii, quality, sentencepiece_dropout, topk, toxicity,
    warc)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that has exact or near copies, with the line that stays for it."""
    return line_dedup.line_classes(_read(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(_read(spark, sf_dir, "documents")))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    docs = _read(spark, sf_dir, "documents")
    vocabulary = sentencepiece_dropout.Vocabulary.load(sentencepiece_dropout.MODEL)
    return sentencepiece_dropout.round_trip(docs, vocabulary)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return line_labels.label_lines(docs, crf.train(docs, _read(spark, sf_dir, "labels"), neighbours=False))


MIX_ENTROPY = 0.95


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws of documents for a mixture of 0.95 of the largest entropy, with as many tokens as there are."""
    return mixing.mix(_read(spark, sf_dir, "documents"), target_entropy=MIX_ENTROPY)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, _read(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.expr("crc32(cast(doc_id AS string)) % 5 = 0").alias("held_out"), "score",
                         F.expr("cast(score >= 0.5 AS int)").alias("predicted"), "n_found")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_read(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, crf.train(docs, _read(spark, sf_dir, "labels"), neighbours=True))
    return scored.select("doc_id", F.expr("crc32(cast(doc_id AS string)) % 5 = 0").alias("held_out"), "score",
                         F.expr("cast(score >= 0.3 AS int)").alias("predicted"), "n_lines", "content_share")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), F.expr("vec_id % 100 = 0"), 10)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that stands before elsewhere, with the documents that hold the originals."""
    return chunking.repeated_spans(_read(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back."""
    records = warc.page_records(_read(spark, sf_dir, "pages"))
    return warc.page_digest(warc.read_archives(warc.write_archives(records)))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired at least cost."""
    return conversations.repair_summary(conversations.with_damage(_read(spark, sf_dir, "conversations")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every document, one in ten with a planted period."""
    return periodic.digest(periodic.word_runs(periodic.with_planted_period(_read(spark, sf_dir, "documents"))))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_pii, op3_sentencepiece, op4_quality_rules, op5_mixing, op6_toxicity, op7_ngram_join, op8_quality_classifier,
    op9_top_k, op10_substring_dedup, op11_warc, op12_conversation_repair, op13_periodic_runs)}

ORACLE = {
    "op11_warc": f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages
), ranked AS (
  SELECT *, octet_length(encode(payload)) AS n, row_number() OVER own AS r, first_value(page_id) OVER own AS first_id
  FROM payloads WINDOW own AS (PARTITION BY payload ORDER BY page_id NULLS LAST)
)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
  CASE WHEN n >= {warc.MIN_SHARED} AND r > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.MIN_SHARED} AND r > 1 THEN first_id END AS refers_to
FROM ranked""",
    "op9_top_k": """
WITH scaled AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM scaled q, scaled c WHERE q.vec_id % 100 = 0 AND q.vec_id != c.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op5_mixing": f"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, source, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents
), sources AS (
  SELECT source, count(*) AS n_docs, sum(n_tokens)::BIGINT AS n_tokens FROM tokens WHERE n_tokens > 0 GROUP BY source
), shares AS (
  SELECT *, n_tokens / (sum(n_tokens) OVER ())::DOUBLE AS share, count(*) OVER () AS k FROM sources
), bisect(step, low, high) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN met THEN mid ELSE low END, CASE WHEN met THEN high ELSE mid END
  FROM (SELECT step, low, high, (low + high) / 2 AS mid,
          (SELECT ln(sum(pow(share, (low + high) / 2))) - (low + high) / 2 * sum(pow(share, (low + high) / 2) * ln(share)) / sum(pow(share, (low + high) / 2))
             >= {MIX_ENTROPY} * ln(max(k)) FROM shares) AS met
        FROM bisect WHERE step < {mixing.HALVINGS})
), a AS (SELECT low AS a FROM bisect WHERE step = {mixing.HALVINGS}
), weights AS (
  SELECT source, n_docs, n_tokens, greatest(1, round(pow(share, a) / sum(pow(share, a)) OVER () * {mixing.WEIGHT_UNITS}))::BIGINT AS weight
  FROM shares, a
), plan AS (
  SELECT *, ((sum(n_tokens) OVER ())::HUGEINT * weight // {mixing.WEIGHT_UNITS})::BIGINT AS quota, ceil(n_docs / {mixing.BLOCK_ROWS}.0)::BIGINT AS blocks
  FROM weights
), placed AS (
  SELECT t.source, e.epoch, t.doc_id, t.n_tokens, p.quota, p.n_tokens AS all_tokens, p.blocks,
    ('0x' || substr(md5('0:' || e.epoch || ':' || t.doc_id), 1, 15))::BIGINT AS h
  FROM tokens t JOIN plan p ON t.source IS NOT DISTINCT FROM p.source, LATERAL (SELECT unnest(range(0, p.quota // p.n_tokens + 1)) AS epoch) e
  WHERE t.n_tokens > 0
), running AS (
  SELECT *, h % blocks AS block, coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY h % blocks, h, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM placed
)
SELECT source, epoch::INT AS epoch, block, doc_id, n_tokens::BIGINT AS n_tokens, start FROM running
WHERE epoch < quota // all_tokens OR start < quota % all_tokens""",
}
