"""Batch plans: which record goes into which batch, and how large each batch is."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollout_quality.functions.records import prompt_words
from rollout_quality.operators.indexing import ROWS_PER_BUCKET, with_position


def assign_batches(
    records: DataFrame, batch_size: int, seed: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add `position` and `batch_no` within the split, in record order or in a seeded shuffled order.

    The last batch of a split may be smaller; nothing is dropped.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    if seed is None:
        placed = with_position(records, "idx", "position", rows_per_bucket=rows_per_bucket)
    else:
        mixed = records.withColumn("__order", F.xxhash64(F.lit(seed), F.col("idx")))
        placed = with_position(
            mixed, "__order", "position", ties=("idx",), rows_per_bucket=rows_per_bucket
        ).drop("__order")
    return placed.withColumn("batch_no", F.floor(F.col("position") / batch_size))


def batch_plan(records: DataFrame, batch_size: int, seed: int | None = None) -> DataFrame:
    """One row per batch: size, index range and longest prompt in words (the padding estimate)."""
    narrow = records.select("split", "idx", prompt_words(F.col("prompt_messages")).alias("words"))
    return (
        assign_batches(narrow, batch_size, seed)
        .groupBy("split", "batch_no")
        .agg(
            F.count(F.lit(1)).alias("batch_size"),
            F.min("idx").alias("first_idx"),
            F.max("idx").alias("last_idx"),
            F.max("words").cast("bigint").alias("max_words"),
        )
    )


def steps_per_epoch(records: DataFrame, batch_size: int) -> DataFrame:
    """Batches per split, without assigning any."""
    rows = records.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumn("steps", F.ceil(F.col("n_rows") / batch_size))
