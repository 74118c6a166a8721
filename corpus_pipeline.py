"""From raw documents to training ids: five stages, each over all that the one before it kept.

Every stage is written as Parquet in the shared folder and read again as the next
one's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import language_id, line_dedup, near_dedup, sentencepiece_codec, source_mixing
from rosterflow.session import scratch, settle

# Texts whose language the model tells with less than this are rejected; chance is a quarter among four languages.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; texts without letters and those it cannot tell go.

    The columns stay as they are, the stated language included.
    """
    predicted = language_id.identify(docs, language_id.fit(docs), keep=docs.columns)
    return predicted.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line stands for; documents with no line left go, ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs, drop_emptied=True)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates over five-word shingles; rows that share a key share their fate."""
    marked = near_dedup.near_duplicates(docs)
    return docs.join(marked.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their target weights."""
    return source_mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return sentencepiece_codec.codec(docs, sentencepiece_codec.default_model())


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_documents),
    ("mixing to target weights", mix_sources),
    ("SentencePiece encoding", encode),
]

# The stages learn models and hash by methods that SQL cannot express; tests/llm compares them with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch():
        for _, stage in STAGES[:-1]:
            docs = settle(stage(spark, docs, sf_dir), "stage")
        return settle(STAGES[-1][1](spark, docs, sf_dir), "corpus", outlives=True)
