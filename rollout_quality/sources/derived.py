"""Input tables derived by Spark from the benchmark tables (`FIXTURES.md` §2).

Every row of the source table yields rows here and every text is used whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rollout_quality.config import ANSWER_MARKER
from rollout_quality.session import spread

_DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
_CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
GENERATIONS = 4


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.schema(_DOCUMENTS).parquet(f"{sf_dir}/documents.parquet"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_CONVERSATIONS).parquet(f"{sf_dir}/conversations.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def qa_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question/answer rows whose answers end in every kind of final answer the parser has to handle."""
    doc, chars = F.col("doc_id"), F.col("n_chars")
    kind = doc % 12
    thousands = F.concat(
        F.lit("$"), _text(1 + chars % 900), F.lit(","), F.lpad(_text(doc % 1000), 3, "0")
    )
    tail = (
        F.when(kind == 0, _text(chars))
        .when(kind == 1, thousands)
        .when(kind == 2, F.concat(F.lit("-"), _text(doc % 100)))
        .when(kind == 3, F.concat(_text(doc % 7 + 1), F.lit("/"), _text(doc % 9)))
        .when(kind == 4, F.concat(_text(doc % 101), F.lit("%")))
        .when(kind == 5, F.lit("Twelve."))
        .when(kind == 7, F.lit("no number here"))
        .when(kind == 8, F.concat(_text(doc % 50), F.lit(".50")))
        .when(kind == 9, F.lit("0"))
        .when(kind == 10, F.lit("1,024.75"))
        .otherwise(F.concat(F.lit("-$"), _text(doc % 30)))
    )
    marked = F.concat(F.col("text"), F.lit(f"\n{ANSWER_MARKER} "), tail)
    return documents(spark, sf_dir).select(
        doc.alias("src_id"),
        F.when(doc % 5 == 0, "test").otherwise("train").alias("split"),
        F.col("text").alias("question"),
        F.when(kind == 6, F.col("text")).otherwise(marked).alias("answer"),
    )


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four completions per document: right, nearly right, right without marker, plain text."""
    value = F.col("n_chars") % 900
    reference = _text(value)
    near = _text(value + F.col("doc_id") % 3)
    text, g = F.col("text"), F.col("gen_idx")
    completion = (
        F.when(g == 0, F.concat(text, F.lit(f"\n{ANSWER_MARKER} "), reference))
        .when(g == 1, F.concat(text, F.lit(f"\n{ANSWER_MARKER} "), near))
        .when(g == 2, F.concat(text, F.lit(" so the answer is "), reference, F.lit(".")))
        .otherwise(text)
    )
    generations = F.explode(F.array(*[F.lit(i) for i in range(GENERATIONS)]))
    return (
        documents(spark, sf_dir)
        .withColumn("gen_idx", generations)
        .select(
            F.col("doc_id").alias("prompt_id"),
            g,
            reference.alias("reference"),
            completion.alias("completion"),
        )
    )


def completion_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same completions in array layout, built per document without a shuffle."""
    value = F.col("n_chars") % 900
    reference, text = _text(value), F.col("text")
    near = _text(value + F.col("doc_id") % 3)
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("prompt_id"),
        reference.alias("reference"),
        F.array(
            F.concat(text, F.lit(f"\n{ANSWER_MARKER} "), reference),
            F.concat(text, F.lit(f"\n{ANSWER_MARKER} "), near),
            F.concat(text, F.lit(" so the answer is "), reference, F.lit(".")),
            text,
        ).alias("completions"),
    )


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reference answer per prompt."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("prompt_id"), _text(F.col("n_chars") % 900).alias("reference")
    )


def chat_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat-style completions: each conversation turn as a list of messages.

    Opening turns hold one message, later ones an empty opening message and their own; `system` turns carry no
    message at all.
    """
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    opening = F.struct(F.lit("user").alias("role"), F.lit("").alias("content"))
    return conversations(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "system", F.slice(F.array(message), 1, 0))
        .when(F.col("turn") == 0, F.array(message))
        .otherwise(F.array(opening, message))
        .alias("messages"),
    )


def candidate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as they may arrive from outside: each document once, most of them broken in one way."""
    doc, text = F.col("doc_id"), F.col("text")
    kind = doc % 10

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    good = F.array(message("system", F.lit("Be brief.")), message("user", text))
    nothing = F.lit(None)
    messages = (
        F.when(kind == 4, F.array(message("user", text)))
        .when(kind == 5, F.array(message("user", text), message("system", F.lit("Be brief."))))
        .when(kind == 6, F.array(message("system", F.lit("  ")), message("user", text)))
        .when(kind == 7, F.array(nothing.cast("struct<role:string,content:string>"), message("user", text)))
        .when(kind == 8, nothing)
        .otherwise(good)
    )
    return documents(spark, sf_dir).select(
        F.when(kind == 1, doc + 1).otherwise(doc).alias("idx"),
        doc.alias("expected_idx"),
        F.lit("train").alias("split"),
        F.when(kind == 2, F.lit(" \n")).otherwise(text).alias("question"),
        F.when(kind == 3, F.lit("n/a")).otherwise(_text(doc)).alias("reference_answer"),
        messages.alias("prompt_messages"),
        F.when(kind != 9, F.struct(doc.alias("original_idx"), F.lit("easy").alias("difficulty"))).alias("metadata"),
    )
