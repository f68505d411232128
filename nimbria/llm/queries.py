"""The registered queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbria.llm import ann, decontam, dialogue, linededup, lm, mixing, pieces, quality, secrets, simhash, spelling, tokenfile, urlfilter


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.plan(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file; it is never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(_read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_read(spark, sf_dir, "embeddings"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_read(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_read(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, tokenizer("piece_bpe_32k.model"), decode=True)
    decoded = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return coded.select("doc_id", "n_pieces", "ids_crc32", decoded, (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents"))


def op11_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.digests(dialogue.repair(dialogue.damage(_read(spark, sf_dir, "conversations"))))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"))


def op13_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, (F.col("n_hit") > 0).alias("contaminated"))


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, list_extract(parts, i) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS t(i)),
keyed AS (
  SELECT doc_id, i, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.doc_id, k.i, k.line, r.largest IS NOT NULL AND k.doc_id <> r.largest AS lost FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (lost) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_secrets": op2_secrets,
        "op3_line_dedup": op3_line_dedup,
        "op4_mixing": op4_mixing,
        "op5_token_files": op5_token_files,
        "op6_ann": op6_ann,
        "op7_lm_score": op7_lm_score,
        "op8_url_filter": op8_url_filter,
        "op9_quality": op9_quality,
        "op10_sentencepiece": op10_sentencepiece,
        "op11_dialogue": op11_dialogue,
        "op12_spelling": op12_spelling,
        "op13_decontam": op13_decontam,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": OP3_SQL,
        "op4_mixing": mixing.PLAN_SQL.format(docs="documents"),
        "op8_url_filter": urlfilter.judge_sql(),
        "op11_dialogue": dialogue.REPAIR_SQL,
        "op12_spelling": spelling.VARIANTS_SQL,
        "op13_decontam": decontam.DIGEST_SQL,
    }
