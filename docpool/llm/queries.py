"""The operators applied to the given tables, with production parameters, and SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpool.llm import byte_bpe, common, decontaminate, language_id, line_dedup, matroska, near_dedup, token_counts, token_files, toxicity, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"), shortest=line_dedup.EVERY, places=line_dedup.ANYWHERE)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    detector = toxicity.learn(docs, table(spark, sf_dir, "labels"), common.id_bucket(F.col("doc_id"), 4) != 2)
    scored = toxicity.score(docs, detector)
    return scored.select("doc_id", (common.id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs, common.id_bucket(F.col("doc_id"), 3) != 1)
    found = language_id.predict(docs, model)
    return found.select("doc_id", (common.id_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.page_outcomes(table(spark, sf_dir, "labels")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.media_digest(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.token_index(spark, path)


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_near_dedup, op3_line_dedup, op4_byte_bpe, op5_toxicity, op6_language_id, op7_url_filter, op8_decontaminate, op9_matroska, op10_token_files)}

#: Words and five-word shingles of texts, as common.py has them: a macro-like fragment over (key, text).
_SHINGLES = r"""
{name}_words AS (
  SELECT {key} AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {table}),
{name}_sets AS (
  SELECT k, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM {name}_words)"""

_OP2 = (
    "WITH RECURSIVE "
    + _SHINGLES.format(name="d", key="doc_id", table="documents")
    + """,
classes AS (SELECT min(k) AS rep, s FROM (SELECT k, list_sort(s) AS s FROM d_sets WHERE len(s) > 0) GROUP BY s),
members AS (SELECT d.k, c.rep FROM d_sets d JOIN classes c ON list_sort(d.s) = c.s),
grams AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM grams a JOIN grams b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
roots AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY a)
SELECT d.k AS doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(r.root, d.k) AS component_id, coalesce(r.root, d.k) = d.k AS kept
FROM d_sets d LEFT JOIN members m ON m.k = d.k LEFT JOIN roots r ON r.rep = m.rep
"""
)

_OP8 = (
    "WITH "
    + _SHINGLES.format(name="d", key="doc_id", table="documents")
    + ","
    + _SHINGLES.format(name="t", key="item_id", table="benchmark")
    + """,
items AS (SELECT k AS item_id, len(s) AS n, unnest(s) AS g FROM t_sets),
docs AS (SELECT k AS doc_id, unnest(s) AS g FROM d_sets)
SELECT doc_id, item_id, n::BIGINT AS n_item_shingles, count(*)::BIGINT AS n_shared, count(*)::DOUBLE / n AS containment
FROM docs JOIN items USING (g) GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 75 * n
"""
)

ORACLES = {"op2_near_dedup": _OP2, "op7_url_filter": url_filter.ORACLE_SQL, "op8_decontaminate": _OP8}
