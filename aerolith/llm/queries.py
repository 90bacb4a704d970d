"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, chat, counts, exact, html_text, lines, minhash, negatives, packing, pieces, spans, topk, toxicity

#: Vocabularies of operators 8 and 12; parameters, never copied.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity and ``n_tokens`` count white-space words."""
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048, source_col="source")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.fuzzy_lines(table(spark, sf_dir, "documents"), bands=12)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.remove_repeated_spans(docs, **spans.FINE)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), PIECES)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), BYTES, limit=1024)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of rows whose id is divisible by 7 are moved on by one first."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_chat_formatting, op2_best_fit_packing, op3_line_dedup, op4_substring_dedup, op5_exact_dedup, op6_toxicity,
        op7_html_extraction, op8_sentencepiece, op9_exact_top_k, op10_minhash_near_dedup,
        op11_filter_audit, op12_token_counts, op13_hard_negatives, pipeline,
    )
    return {f.__name__: f for f in own}


OP5_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY len DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY len DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""

OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings WHERE embedding IS NOT NULL),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
f AS (
  SELECT part, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS bad,
         list_filter([
           CASE WHEN len(words) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
           CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 3 * length(x) THEN 'C' END,
           CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 'E' END],
           lambda k: k IS NOT NULL) AS failed
  FROM t LEFT JOIN labels USING (doc_id)),
h AS (
  SELECT part, good, bad, failed, count(*) AS n FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (
  SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, string_split(left(filter_order, step - 1), '') AS gone FROM o, range(1, 6) r(step)),
c AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
         sum(n) FILTER (NOT list_contains(failed, own) AND NOT list_has_any(failed, gone)) AS kept,
         sum(n) FILTER (list_contains(failed, own) AND NOT list_has_any(failed, gone)) AS removed,
         sum(n) FILTER (list_contains(failed, own) AND list_has_any(failed, gone)) AS redundant,
         sum(n) FILTER (failed = [own]) AS unique_fails,
         sum(n) FILTER (good AND list_contains(failed, own) AND NOT list_has_any(failed, gone)) AS good_lost,
         sum(n) FILTER (bad AND list_contains(failed, own) AND NOT list_has_any(failed, gone)) AS toxic_lost
  FROM h, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM c
"""

OP13_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, c.id AS id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.id % 100 = 0 AND a.id <> c.id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": OP5_SQL, "op9_exact_top_k": OP9_SQL, "op11_filter_audit": OP11_SQL, "op13_hard_negatives": OP13_SQL}
