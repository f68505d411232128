"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing and SentencePiece, each on all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the
next stage's documents. All but the last return the columns of documents; other columns, whatever their names, are left
out, and an empty table gives an empty one. Bytes that are no UTF-8 pass through to the last stage, which reads them as
U+FFFD. What the run writes to the shared folder can go once its result is written: ``nimbria.sources.shared.clean_up``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbria.llm import linededup, mixing, pieces, quality, similar
from nimbria.llm.common import shared_path
from nimbria.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go.

    Null and empty texts have no words and go. Null languages and sources are groups of their own. Rows that repeat an id
    stay only if all of them pass; a null id is judged by its own row.
    """
    return quality.keep(docs).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more in 3 documents or more go from all but the largest id; n_chars follows the text.

    Null and empty texts stay as they are, with their n_chars; a text that loses all lines is empty and stays. Rows that
    repeat an id share their decisions; a null id is below any other.
    """
    kept = linededup.line_dedup(docs.select(COLUMNS))
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest id: classes link texts whose sets of 5-word
    shingles are alike to 0.8 or more. Null, empty and blank texts are one class. Of rows that repeat a kept id one stays;
    a null id stays only where its whole class has none, one row a class."""
    return similar.dedup(docs.select(COLUMNS)).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks, at most three times.

    A source without words has no target and goes, so null and empty texts stay only in a source that has other words, as
    often as their hashes say. Null sources are one source; rows that repeat an id share its decision, null ids too.
    """
    return mixing.mix(docs.select(COLUMNS)).select(COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, piece_ids, n_pieces, ids_crc32, round_trip) of each row; round_trip tells that the ids decode to
    its text. Null and empty texts have no pieces and decode to an empty text. Repeated rows each return one."""
    coded = pieces.encode(docs.select(COLUMNS), tokenizer("piece_bpe_32k.model"), decode=True)
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), pieces.MARK, " ")
    return coded.select("doc_id", "lang", "source", "piece_ids", "n_pieces", "ids_crc32", same.alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing", mix),
    ("sentencepiece", sentencepiece),
]

#: No SQL: the outlier rule, SimHash and BPE have no SQL form; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
