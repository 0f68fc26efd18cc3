"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import (
    ann, html_text, lang_crf, lexical, merkle, mixing, near_dup, piece_codec, quality, secrets, simhash, toxicity, url_filter)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.sampled(_table(spark, sf_dir, "documents"), carry=False)
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode(_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op10_lang_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_crf.identify(_table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_table(spark, sf_dir, "documents"), merkle.third_by_crc(F.col("doc_id")))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_near_dup, op3_html_text, op4_mixing, op5_toxicity,
    op6_ann, op7_secrets, op8_piece_codec, op9_url_filter, op10_lang_crf,
    op11_lexical, op12_merkle, op13_simhash)}

ORACLES = {"op4_mixing": mixing.ORACLE, "op7_secrets": secrets.ORACLE, "op9_url_filter": url_filter.ORACLE,
           "op11_lexical": lexical.ORACLE, "op12_merkle": merkle.ORACLE}
