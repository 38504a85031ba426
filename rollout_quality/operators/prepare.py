"""Preparation jobs: raw question/answer rows to validated records, quarantine and views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollout_quality.config import COMPAT, DEFAULT_SYSTEM_PROMPT, BuildConfig
from rollout_quality.functions import records as R
from rollout_quality.functions.numeric import answer_type, normalise_numeric
from rollout_quality.functions.text import digest, question_fingerprint, strip
from rollout_quality.operators.indexing import ROWS_PER_BUCKET, with_position
from rollout_quality.schemas import ANALYSIS_FIELDS, MESSAGES, PUBLIC_FIELDS


def index_split(
    raw: DataFrame, key: str = "src_id", ties: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Raw rows with their position in the split; dropping rows later leaves gaps, as it must."""
    return with_position(raw, key, "idx", ties=ties, rows_per_bucket=rows_per_bucket)


def parse_solutions(raw: DataFrame, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Replace `answer` by reasoning, canonical answer, error and error_code."""
    carried = [F.col(c) for c in raw.columns if c != "answer"]
    parsed, error = F.col("__parsed"), F.col("__error")
    reasoning = strip(F.left(F.col("answer"), parsed["at"] - 1))
    return (
        raw.withColumn("__parsed", R.parse_solution(F.col("answer"), cfg.grammar))
        .withColumn("__error", R.parse_error(F.col("answer"), parsed))
        .select(
            *carried,
            F.when(error.isNull(), reasoning).alias("reference_solution"),
            F.when(error.isNull(), parsed["answer"]).alias("reference_answer"),
            error["text"].alias("error"),
            error["code"].alias("error_code"),
        )
    )


def normalise_answers(df: DataFrame, column: str, out: str = "normalised", grammar: str = COMPAT) -> DataFrame:
    return df.withColumn(out, normalise_numeric(F.col(column), grammar))


def check_rows(raw: DataFrame, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Parsed rows with every reason for quarantine decided (parse errors, then blank texts), and difficulty."""
    parsed = parse_solutions(raw, cfg).withColumn("__shape", R.shape_error(F.col("question"), cfg.system_prompt))
    checked = parsed.withColumns(
        {
            "error": F.coalesce("error", F.col("__shape.text")),
            "error_code": F.coalesce("error_code", F.col("__shape.code")),
        }
    ).drop("__shape")
    if not cfg.add_difficulty:
        return checked
    return checked.withColumn("difficulty", R.difficulty(F.col("reference_solution")))


def _prompt(cfg: BuildConfig) -> Column:
    return F.when(F.col("error").isNull(), R.build_prompt(F.col("question"), cfg.system_prompt))


def with_prompts(processed: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Processed rows that were stored without their prompts, which follow from the questions."""
    return processed.withColumn("prompt_messages", _prompt(cfg).cast(MESSAGES))


def process_split(
    raw: DataFrame,
    cfg: BuildConfig = BuildConfig(),
    key: str | None = "src_id",
    metrics: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Parse, index, shape and validate every row. `error` is NULL for a good row, else says what is wrong.

    Bad rows stay in the table with their record columns NULL, so good, quarantined and raw counts come from
    one DataFrame. Further input columns are carried along. All text work, including the optional report
    `metrics`, is done before rows are ranked: it runs in the scan tasks, and a later filter on `error` reads a
    finished column instead of parsing again. With `key=None` the input already has its `idx`.
    """
    checked = check_rows(raw, cfg)
    good, prompt = F.col("error").isNull(), _prompt(cfg)
    if metrics:
        checked = with_metrics(checked, prompt)
    indexed = checked if key is None else index_split(checked, key, rows_per_bucket=rows_per_bucket)
    metadata = [F.col("idx").alias("original_idx")]
    if cfg.add_difficulty:
        metadata.append(F.col("difficulty"))
    record = ("idx", "split", "question", "reference_answer", "reference_solution")
    others = [c for c in indexed.columns if c not in (*record, "difficulty", "error", "error_code")]
    return indexed.select(
        "idx",
        "split",
        "question",
        *[F.when(good, F.col(c)).alias(c) for c in ("reference_answer", "reference_solution")],
        prompt.alias("prompt_messages"),
        F.when(good, F.struct(*metadata)).alias("metadata"),
        "error",
        "error_code",
        *others,
    )


def with_metrics(rows: DataFrame, messages: Column | None = None) -> DataFrame:
    """Add the narrow columns all reports run on, so that they never read the texts again."""
    good = F.col("error").isNull()
    prompt = F.col("prompt_messages") if messages is None else messages
    return rows.withColumns(
        {
            "prompt_words": R.prompt_words(prompt),
            "answer_type": F.when(good, answer_type(F.col("reference_answer"))),
            "prompt_key": digest(R.prompt_fingerprint(prompt)),
            "question_key": F.when(good, digest(question_fingerprint(F.col("question")))),
        }
    )


def accepted(processed: DataFrame) -> DataFrame:
    return processed.where(F.col("error").isNull())


def quarantined(processed: DataFrame) -> DataFrame:
    return processed.where(F.col("error").isNotNull()).select("idx", "split", "question", "error", "error_code")


def trainer_view(processed: DataFrame) -> DataFrame:
    """The public record fields of the good rows."""
    return accepted(processed).select(*PUBLIC_FIELDS)


def analysis_view(processed: DataFrame) -> DataFrame:
    """The public record fields plus the reasoning text."""
    return accepted(processed).select(*ANALYSIS_FIELDS)


def rl_input_view(records: DataFrame) -> DataFrame:
    """Prompt and reference answer, named as a trainer expects them."""
    return records.select(F.col("prompt_messages").alias("prompt"), "reference_answer")


def filter_difficulty(records: DataFrame, difficulty: str) -> DataFrame:
    return records.where(F.col("metadata.difficulty") == difficulty)


def validate_records(
    records: DataFrame, expected_idx: str | None = None, grammar: str = COMPAT
) -> DataFrame:
    """Add `errors`: error codes joined by `;`, empty text for a valid record."""
    kinds = {f.name: f.dataType for f in records.schema.fields}
    expected = F.col(expected_idx) if expected_idx else None
    return records.withColumn("errors", F.array_join(R.validation_errors(kinds, expected, grammar), ";"))


def build_prompts(raw: DataFrame, system_prompt: str = DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    return raw.withColumn("prompt_messages", R.build_prompt(F.col("question"), system_prompt))


def fingerprint_questions(df: DataFrame) -> DataFrame:
    return df.withColumn("fingerprint", question_fingerprint(F.col("question")))


