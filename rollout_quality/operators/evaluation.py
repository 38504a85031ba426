"""Evaluation metrics over scored completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "unknown"


def _sums(scored: DataFrame) -> DataFrame:
    """Count and reward sums per difficulty: the only step that touches the scored rows."""
    return scored.groupBy(F.coalesce(F.col("difficulty"), F.lit(UNKNOWN)).alias("difficulty")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("exact_match").alias("exact"),
        F.sum("reward").alias("reward"),
        F.sum("format").alias("format"),
    )


def _mean(total: str) -> Column:
    return F.coalesce(F.sum(total) / F.greatest(F.sum("n"), F.lit(1)), F.lit(0.0))


def eval_summary(scored: DataFrame) -> DataFrame:
    """One row: samples, exact-match accuracy, mean composite and mean format reward; zeros if empty."""
    if "difficulty" not in scored.columns:
        scored = scored.withColumn("difficulty", F.lit(None).cast("string"))
    return _sums(scored).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_samples"),
        _mean("exact").alias("exact_match_accuracy"),
        _mean("reward").alias("mean_composite_reward"),
        _mean("format").alias("mean_format_reward"),
    )


def eval_by_difficulty(scored: DataFrame) -> DataFrame:
    """Samples, accuracy and mean reward per difficulty; a missing label counts as `unknown`."""
    return _sums(scored).select(
        "difficulty",
        "n",
        (F.col("exact") / F.col("n")).alias("accuracy"),
        (F.col("reward") / F.col("n")).alias("mean_reward"),
    )


def eval_rollup(scored: DataFrame) -> DataFrame:
    """Both levels in one scan: rows per difficulty (`level` 0) and the total (`level` 1).

    The roll-up expands the handful of per-difficulty sums, not the scored rows.
    """
    return (
        _sums(scored)
        .rollup("difficulty")
        .agg(
            F.grouping_id().cast("bigint").alias("level"),
            F.sum("n").alias("n"),
            _mean("exact").alias("accuracy"),
            _mean("reward").alias("mean_reward"),
            _mean("format").alias("mean_format"),
        )
        .select(
            F.when(F.col("level") == 1, F.lit("all")).otherwise(F.col("difficulty")).alias("difficulty"),
            "level",
            "n",
            "accuracy",
            "mean_reward",
            "mean_format",
        )
    )


def eval_sample(records: DataFrame, n: int) -> DataFrame:
    """The first `n` records by index."""
    if n < 0:
        raise ValueError("n must not be negative")
    return records.orderBy("idx").limit(n)
