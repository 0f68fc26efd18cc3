"""From raw documents to token ids: five stages, each over all rows that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.  All stages but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import lang_crf, mixing, near_dup, piece_codec, secrets
from martflow.llm.staging import staged

#: Documents whose words have a best language of a mean probability under this are no text in known languages.
LEAST_LANGUAGE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those whose words no learned language explains; a text may switch languages."""
    mark = "_" * (1 + max((len(c) for c in docs.columns), default=0))  # longer than any column's name
    out = lang_crf.predict(docs, lang_crf.train(docs), "text", docs.columns, mark)
    return out.filter((F.col(f"{mark}lang_pred") != lang_crf.UNKNOWN) & (F.col(f"{mark}sure") >= LEAST_LANGUAGE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity 0.8."""
    return near_dup.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each secret by its kind in square brackets, and counts the characters anew."""
    found = secrets.find_secrets(docs)
    hit = F.size("spans") > 0
    new = {"text": F.when(hit, secrets.redacted(found)).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        count = F.length(secrets.redacted(found)).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(hit, count).otherwise(F.col("row.n_chars"))
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's target asks for."""
    return mixing.emitted(mixing.sampled(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return piece_codec.encode(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secret_scan), ("mix", mix), ("encode", encode)]

#: The language, deduplication and encoding stages go beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
