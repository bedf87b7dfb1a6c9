"""Queries of this subpackage and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warehaus.llm import chat, exact_dedup, jaccard, language, licenses, merkle, mixing, neighbours, pages, pieces, quality, sql, tries, warc
from warehaus.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = chat.as_transcript(table(spark, sf_dir, "conversations"))
    return chat.parse(raw, role=F.when(~chat.held_out(F.col("conv_id")), F.col("role")))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("placements")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_exact(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), check=True)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.evaluate(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tamper=tampered)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(tries.rebuilt(table(spark, sf_dir, "conversations")))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_warc, op2_chat, op3_license_scan, op4_exact_dedup, op5_sentencepiece, op6_ngram_jaccard, op7_language,
             op8_html_text, op9_neighbours, op10_mixing, op11_merkle, op12_prefix_trie, op13_quality)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return sql.queries()
