"""Explicit schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.ArrayType(MESSAGE)

RAW = T.StructType(
    [
        T.StructField("src_id", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
    ]
)

COMPLETIONS = T.StructType(
    [
        T.StructField("prompt_id", T.LongType()),
        T.StructField("gen_idx", T.IntegerType()),
        T.StructField("reference", T.StringType()),
        T.StructField("completion", T.StringType()),
    ]
)

# The public record fields, in contract order.
PUBLIC_FIELDS = (
    "idx",
    "split",
    "question",
    "reference_answer",
    "prompt_messages",
    "metadata",
)
ANALYSIS_FIELDS = PUBLIC_FIELDS + ("reference_solution",)


def metadata_type(add_difficulty: bool = True) -> T.StructType:
    """`original_idx` always, `difficulty` only when the build computes it."""
    fields = [T.StructField("original_idx", T.LongType())]
    if add_difficulty:
        fields.append(T.StructField("difficulty", T.StringType()))
    return T.StructType(fields)


def record_type(analysis: bool = False, add_difficulty: bool = True) -> T.StructType:
    """Schema of the trainer view, or of the analysis view with the reasoning text."""
    fields = [
        T.StructField("idx", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("reference_answer", T.StringType()),
        T.StructField("prompt_messages", MESSAGES),
        T.StructField("metadata", metadata_type(add_difficulty)),
    ]
    if analysis:
        fields.append(T.StructField("reference_solution", T.StringType()))
    return T.StructType(fields)
