"""One query for each training-data operator, over the whole of its table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudweft.llm import bpe, exact, jaccard, language, license_scan, mixing, pii, quality, sharding, token_count
from cloudweft.llm.common import documents, labels, written

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = written(quality.signal_table(documents(spark, sf_dir).select("doc_id", "text")), "quality")
    judged = quality.judged(table, quality.fit_table(table))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.extract(documents(spark, sf_dir).select("doc_id", "text")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out"))
    model = language.fit(docs.where(~F.col("held_out")))
    return language.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_table(documents(spark, sf_dir).select("doc_id", "text"), with_ids=False, digests=True)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), "text")
    return jaccard.classes(docs, 4, 85).select(F.col("id").alias("doc_id"), "n_shingles", F.col("class_id").alias("component_id"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string")))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"), F.array_join(spans, ",").alias("spans"), F.round(F.array_max(F.transform("matches", lambda m: m["containment"])), 6).alias("containment"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(documents(spark, sf_dir).select("doc_id", "text"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(documents(spark, sf_dir).select("doc_id", "text"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(documents(spark, sf_dir).select("doc_id", "text"), 40)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(documents(spark, sf_dir), labels(spark, sf_dir))
    shares = [F.round(f"p{k}", 6).alias(f"p_{name}") for k, name in enumerate(mixing.DOMAINS)]
    return found.select(F.col("id").alias("doc_id"), "tokens", *shares, F.round("rate", 6).alias("rate"), "copies")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_quality_rules, op2_personal_data, op3_language_id, op4_byte_bpe, op5_ngram_jaccard, op6_license_scan, op7_token_counts, op8_exact_dedup, op9_sharding, op10_mixing)}


def oracle_sql() -> dict[str, str]:
    return {"op5_ngram_jaccard": JACCARD_SQL, "op8_exact_dedup": EXACT_SQL}


EXACT_SQL = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS normal FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY normal) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(normal) AS text_sha256
FROM t WINDOW w AS (PARTITION BY normal ORDER BY n DESC, doc_id)
"""

JACCARD_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle FROM w
), n AS (
  SELECT w.doc_id, count(s.shingle) AS n_shingles FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n_shingles + y.n_shingles - shared)
), r(a, b) AS (
  SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT n.doc_id, n.n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id FROM n LEFT JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""
