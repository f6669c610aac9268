"""From raw documents to packed sequences, stage by stage; each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrace.llm import language, mixing, packing, simhash, substrings
from stagetrace.llm.queries import tokenizer_path
from stagetrace.llm.store import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly; the model learns from those that have a label."""
    model = language.learn(docs)
    return language.identify(docs, model).filter("accepted").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints lie within three bits: three-word shingles, as in op1."""
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that an earlier document also holds."""
    found = substrings.remove_repeats(docs)
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them: not at all, once or twice."""
    return mixing.mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's tokens in sequences of 2048."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("pack", pack),
]

# Compression, hashes of shingles, a knapsack and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over ``documents``; every stage's result is written and read again."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
