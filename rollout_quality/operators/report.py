"""Split reports over processed rows (`prepare.with_metrics`).

Reports read only narrow columns: split, error, answer type, difficulty, word count, 32-byte prompt key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollout_quality.functions.records import ANSWER_TYPES, DIFFICULTIES
from rollout_quality.functions.text import digest, exact_round
from rollout_quality.session import cut_lineage, is_small


def _good() -> Column:
    return F.col("error").isNull()


def split_list(spark: SparkSession, splits: Sequence[str]) -> DataFrame:
    """(ord, split) of the configured splits."""
    return spark.range(1).select(F.posexplode(F.array(*[F.lit(s) for s in splits])).alias("ord", "split"))


def failure_reasons(processed: DataFrame) -> DataFrame:
    """Quarantined rows per split and reason text, with the short code next to it.

    Reasons are grouped by digest, so that equal long texts are compared in 32 bytes and travel once per task.
    """
    return (
        processed.where(F.col("error").isNotNull())
        .groupBy("split", "error_code", digest(F.col("error")).alias("error_key"))
        .agg(F.any_value("error").alias("error"), F.count(F.lit(1)).alias("n"))
        .select("split", "error", "error_code", "n")
    )


def failure_codes(processed: DataFrame) -> DataFrame:
    """Quarantined rows per split and short code: few rows whatever the table size."""
    return (
        processed.where(F.col("error").isNotNull())
        .groupBy("split", "error_code")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def split_counts(processed: DataFrame) -> DataFrame:
    """Good, failed and raw rows and the error rate per split."""
    counted = processed.groupBy("split").agg(
        F.count_if(_good()).alias("record_count"),
        F.count_if(~_good()).alias("failed_count"),
        F.count(F.lit(1)).alias("raw_count"),
    )
    return counted.withColumn("error_rate", F.col("failed_count") / F.greatest(F.col("raw_count"), F.lit(1)))


def difficulty_distribution(processed: DataFrame) -> DataFrame:
    label = F.col("metadata.difficulty")
    rows = processed.where(_good() & label.isNotNull())
    return rows.groupBy("split", label.alias("difficulty")).agg(F.count(F.lit(1)).alias("n"))


def answer_type_distribution(processed: DataFrame) -> DataFrame:
    return processed.where(_good()).groupBy("split", "answer_type").agg(F.count(F.lit(1)).alias("n"))


def prompt_length_summary(processed: DataFrame, splits: Sequence[str], max_prompt_length: int = 512) -> DataFrame:
    """Shortest, longest and mean prompt in words, and prompts over the limit; zeros for an empty split."""
    words = F.when(_good(), F.col("prompt_words"))
    found = processed.groupBy("split").agg(
        F.min(words).alias("min_words"),
        F.max(words).alias("max_words"),
        F.avg(words).alias("avg_words"),
        F.count_if(words > max_prompt_length).alias("truncation_risk_count"),
    )
    names = ("min_words", "max_words", "avg_words", "truncation_risk_count")
    listed = split_list(processed.sparkSession, splits).join(found, "split", "left")
    return listed.select("split", *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names])


def duplicate_prompts(processed: DataFrame) -> DataFrame:
    """Surplus copies of equal prompts per split; copies are counted before the shuffle."""
    per_prompt = (
        processed.where(_good()).groupBy("split", "prompt_key").agg(F.count(F.lit(1)).alias("copies"))
    )
    return per_prompt.groupBy("split").agg(F.sum(F.col("copies") - 1).alias("duplicate_prompt_count"))


def difficulty_of(rows: DataFrame) -> Column:
    """The difficulty of records, null if they were built without it."""
    known = "difficulty" in rows.schema["metadata"].dataType.names
    return F.col("metadata.difficulty") if known else F.lit(None).cast("string")


def split_report(processed: DataFrame, splits: Sequence[str], max_prompt_length: int = 512) -> DataFrame:
    """All report figures of every configured split, one row per split, in one pass over the rows.

    The first level groups by prompt key, so that duplicates fall out of the same shuffle as every other
    figure; all figures combine from partial counts, so a heavily repeated prompt shrinks before it moves.
    """
    words = F.when(_good(), F.col("prompt_words").cast("bigint"))
    label = difficulty_of(processed)
    counters = {
        "record_count": _good(),
        "failed_count": ~_good(),
        "truncation_risk_count": words > max_prompt_length,
        **{f"difficulty_{d}": _good() & (label == d) for d in DIFFICULTIES},
        **{f"answer_{t}": _good() & (F.col("answer_type") == t) for t in ANSWER_TYPES},
    }
    per_prompt = processed.groupBy("split", "prompt_key").agg(
        F.min(words).alias("min_words"),
        F.max(words).alias("max_words"),
        F.sum(words).alias("sum_words"),
        *[F.count_if(c).alias(n) for n, c in counters.items()],
    )
    found = per_prompt.groupBy("split").agg(
        F.min("min_words").alias("min_words"),
        F.max("max_words").alias("max_words"),
        F.sum("sum_words").alias("sum_words"),
        F.sum(F.greatest(F.col("record_count") - 1, F.lit(0))).alias("duplicate_prompt_count"),
        *[F.sum(n).alias(n) for n in counters],
    )
    listed = split_list(processed.sparkSession, splits).join(found, "split", "left")

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)

    average = F.coalesce(F.col("sum_words") / F.col("record_count"), F.lit(0.0))
    return (
        listed.withColumn("avg_words", F.when(F.col("record_count") > 0, average).otherwise(0.0))
        .withColumn("raw_count", F.col("record_count") + F.col("failed_count"))
        .select(
            "ord",
            "split",
            filled("record_count"),
            filled("failed_count"),
            filled("raw_count"),
            *[filled(f"difficulty_{d}") for d in DIFFICULTIES],
            *[filled(f"answer_{t}") for t in ANSWER_TYPES],
            filled("min_words"),
            filled("max_words"),
            (exact_round(F.col("avg_words"), 2) / 100.0).alias("avg_words"),
            filled("truncation_risk_count"),
            filled("duplicate_prompt_count"),
        )
    )


def dataset_summary(records: DataFrame) -> DataFrame:
    """Row count, columns and the first record (by index) of every split; reads stored `records` twice, first
    only their indices. The few rows found are exchanged, so that a writer of one file does not scan all records."""
    firsts = cut_lineage(
        records.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("idx").alias("first_idx"))
    )
    side = F.broadcast(firsts) if is_small(firsts) else firsts
    first = F.struct("idx", "question", "reference_answer", difficulty_of(records).alias("difficulty"))
    return (
        records.select("split", F.col("idx").alias("first_idx"), first.alias("first"))
        .join(side, ["split", "first_idx"])
        .select(
            "split",
            "n_rows",
            F.lit(",".join(records.columns)).alias("columns"),
            "first_idx",
            F.col("first.question").alias("first_question"),
            F.col("first.reference_answer").alias("first_answer"),
            F.col("first.difficulty").alias("first_difficulty"),
        )
        .repartition("split")
    )
