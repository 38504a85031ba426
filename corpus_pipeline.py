"""Cleaning and packing of a corpus: five stages, each one operator on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollout_quality.llm import decontaminate, lines, pack, similar, toxicity
from rollout_quality.llm.common import ready, store, table
from rollout_quality.llm.queries import toxicity_model


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.reject(docs, toxicity_model(spark, docs, sf_dir))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; every document stays, with the length of what is left of it."""
    ready(spark)
    done = lines.drop_boilerplate(docs)
    length = F.when(F.col("__n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", length.cast("long")).select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8 or more."""
    return similar.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences with the mixture of sources in every one."""
    return pack.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_boilerplate),
    ("near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]
# Trained trees, fingerprints and subword ids are beyond SQL: the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is a stored table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
