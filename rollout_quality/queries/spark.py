"""One query per job, over the benchmark tables. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollout_quality.config import COMPAT, FULL, BuildConfig, EvalConfig, RewardWeights
from rollout_quality.functions import records as R, rewards as W
from rollout_quality.functions.numeric import answer_type, normalise_numeric
from rollout_quality.functions.text import strip
from rollout_quality.operators import batching, evaluation, groups, leakage, prepare, report, scoring
from rollout_quality.operators.gates import quality_gates
from rollout_quality.plans.build_dataset import build_dataset, manifest
from rollout_quality.plans.evaluate import eval_report, evaluate as run_evaluation, score_against
from rollout_quality.schemas import record_type
from rollout_quality.session import cut_lineage, new_folder, write_and_reread
from rollout_quality.sources import derived, sinks, tables
from rollout_quality.streaming import scoring as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CFG = BuildConfig()
BATCH = 32
SAMPLE = 100
CUSTOM_WEIGHTS = RewardWeights(exact_match=2.0, soft_numeric=0.5, format=0.25, length=0.25)


def query(fn: Query) -> Query:
    """Register under the function's name, without the underscore that avoids a clash with an import."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def r6(value: Column | str) -> Column:
    """Six decimals, never minus zero."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column, 6) + F.lit(0.0)


def big(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column.cast("bigint")


def member() -> list[Column]:
    return [F.col("prompt_id"), big("gen_idx").alias("gen_idx")]


# ---- inputs shared by the queries -----------------------------------------------------------------------


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.process_split(derived.qa_raw(spark, sf_dir), CFG)


def unindexed_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows where the position in the split does not matter: no ranking, no shuffle."""
    raw = derived.qa_raw(spark, sf_dir)
    return prepare.process_split(raw.withColumn("idx", F.col("src_id")), CFG, key=None)


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unindexed processed rows with the report columns."""
    raw = derived.qa_raw(spark, sf_dir)
    return prepare.process_split(raw.withColumn("idx", F.col("src_id")), CFG, key=None, metrics=True)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(derived.completions(spark, sf_dir))


def labelled_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prompt_id, reference, difficulty); quarantined rows have no difficulty."""
    rows = unindexed_processed(spark, sf_dir).select(
        F.col("src_id").alias("prompt_id"), F.col("metadata.difficulty").alias("difficulty")
    )
    return derived.references(spark, sf_dir).join(rows, "prompt_id", "left")


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = derived.completions(spark, sf_dir).drop("reference")
    return score_against(texts, labelled_targets(spark, sf_dir))


def record_columns(*extra: str, difficulty: bool = True) -> list[Column]:
    """Scalars of a record, for comparison."""
    label = [F.col("metadata.difficulty").alias("difficulty")] if difficulty else []
    return [
        F.col("idx"),
        F.col("split"),
        F.col("question"),
        F.col("reference_answer"),
        F.col("prompt_messages")[0]["role"].alias("role_0"),
        F.col("prompt_messages")[0]["content"].alias("content_0"),
        F.col("prompt_messages")[1]["role"].alias("role_1"),
        F.col("prompt_messages")[1]["content"].alias("content_1"),
        F.col("metadata.original_idx").alias("original_idx"),
        *label,
        *[F.col(c) for c in extra],
    ]


# ---- evaluation and scoring -----------------------------------------------------------------------------


@query
def evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, join with references and difficulty, rewards, metrics per difficulty and overall."""
    return eval_rollup(spark, sf_dir)


@query
def join_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = scoring.completion_features(derived.completions(spark, sf_dir).drop("reference"))
    joined = scoring.join_references(features, derived.references(spark, sf_dir))
    return joined.select(*member(), "reference", "predicted")


@query
def extract_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.completion_features(derived.completions(spark, sf_dir)).select(*member(), "predicted")


@query
def extract_answers_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = scoring.completion_features(derived.completions(spark, sf_dir), FULL)
    return features.select(*member(), "predicted")


@query
def exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(*member(), r6("exact_match").alias("exact_match"))


@query
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = evaluation.eval_summary(scored(spark, sf_dir))
    return summary.select("num_samples", *[r6(c).alias(c) for c in summary.columns[1:]])


@query
def soft_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(*member(), r6("soft_numeric").alias("soft_numeric"))


@query
def format_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(*member(), r6("format").alias("format"))


@query
def length_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(*member(), r6("length").alias("length"))


@query
def composite_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(*member(), r6("reward").alias("reward"))


@query
def selected_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    completions = derived.completions(spark, sf_dir)
    chosen = scoring.score_selected(completions, ("exact_match", "format"), CUSTOM_WEIGHTS)
    return chosen.select(*member(), r6("reward").alias("reward"))


@query
def reward_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = scoring.reward_matrix(derived.completions(spark, sf_dir))
    return matrix.select(*member(), *[r6(c).alias(c) for c in (*W.COMPONENTS, "reward_sum", "weighted_sum")])


@query
def group_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rewarded = scoring.group_rewards(derived.completion_arrays(spark, sf_dir))
    exploded = rewarded.select("prompt_id", F.posexplode_outer("rewards").alias("gen_idx", "reward"))
    return exploded.select(*member(), r6("reward").alias("reward"))


@query
def custom_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reward supplied by the user, as a Column expression."""

    def contains_reference(completion: Column, reference: Column) -> Column:
        brevity = F.lit(1.0) / (F.length(completion) + 1)
        return F.when(completion.contains(F.concat(F.lit("#### "), reference)), F.lit(1.0)).otherwise(brevity)

    rewarded = scoring.custom_rewards(derived.completions(spark, sf_dir), contains_reference)
    return rewarded.select(*member(), r6("reward").alias("reward"))


@query
def multi_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rewards side by side, library and user-supplied, with weights for their sum."""
    rewards = {
        "format": lambda completion, reference: W.format_reward(completion),
        "length": lambda completion, reference: W.length_reward(completion),
        "mentions": lambda completion, reference: completion.contains(reference).cast("double"),
    }
    scored = scoring.multi_rewards(derived.completions(spark, sf_dir), rewards, {"format": 0.5, "mentions": 2.0})
    return scored.select(*member(), *[r6(c).alias(c) for c in (*rewards, "reward_sum", "weighted_sum")])


@query
def group_advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rewards = scored(spark, sf_dir).select("prompt_id", "gen_idx", "reward")
    return groups.group_advantages(rewards).select(*member(), r6("advantage").alias("advantage"))


@query
def group_advantages_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for prompts with very many completions, asked for from three completions on."""
    rewards = scored(spark, sf_dir).select("prompt_id", "gen_idx", "reward")
    relative = groups.group_advantages(rewards, hot_rows=2)
    return relative.select(*member(), r6("advantage").alias("advantage"))


@query
def group_advantages_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advantages within sources instead of prompts: a few groups hold all rows, and positions repeat in them."""
    rewards = scored(spark, sf_dir).select("prompt_id", "gen_idx", "reward")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sources = documents.select(F.col("doc_id").alias("prompt_id"), "source")
    relative = groups.group_advantages(rewards.join(sources, "prompt_id"), key="source", hot_rows=100)
    return relative.select(*member(), "source", r6("advantage").alias("advantage"))


@query
def group_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = groups.group_step(derived.completions(spark, sf_dir))
    return steps.select(
        *member(),
        "reference",
        F.md5("completion").alias("completion_md5"),
        r6("reward").alias("reward"),
        r6("advantage").alias("advantage"),
    )


@query
def group_step_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group step on array layout: rewards and advantages per row, no shuffle."""
    rewarded = scoring.group_rewards(derived.completion_arrays(spark, sf_dir))
    relative = rewarded.select("prompt_id", "rewards", W.group_advantages(F.col("rewards")).alias("advantages"))
    pairs = F.posexplode_outer(F.arrays_zip("rewards", "advantages")).alias("gen_idx", "x")
    exploded = relative.select("prompt_id", pairs)
    return exploded.select(
        *member(), r6("x.rewards").alias("reward"), r6("x.advantages").alias("advantage")
    )


@query
def reward_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite rewards with the contract they were computed under."""
    rows = scoring.with_contract(scored(spark, sf_dir))
    contract = list(scoring.contract_columns())
    return rows.select(
        *member(),
        r6("reward").alias("reward"),
        *[big(c).alias(c) if c.endswith("_tokens") else F.col(c) for c in contract],
    )


@query
def completion_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = derived.chat_completions(spark, sf_dir)
    return chats.select("conv_id", "turn", W.completion_text(F.col("messages")).alias("completion"))


@query
def eval_by_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.eval_by_difficulty(labelled_scores(spark, sf_dir))
    return found.select("difficulty", "n", r6("accuracy").alias("accuracy"), r6("mean_reward").alias("mean_reward"))


@query
def eval_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.eval_rollup(labelled_scores(spark, sf_dir))
    return found.select("difficulty", "level", "n", *[r6(c).alias(c) for c in found.columns[3:]])


@query
def eval_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first records of the test split by index (the evaluation sample)."""
    records = prepare.trainer_view(processed(spark, sf_dir)).where(F.col("split") == "test")
    return evaluation.eval_sample(records, SAMPLE).select("idx", "split", "question", "reference_answer")


# ---- preparation ----------------------------------------------------------------------------------------


@query
def load_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "qa_raw")
    derived.qa_raw(spark, sf_dir).write.partitionBy("split").parquet(path)
    loaded = tables.load_qa(spark, path, CFG.splits)
    return loaded.select("src_id", "split", "question", "answer")


@query
def load_qa_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.split_sizes(tables.select_splits(derived.qa_raw(spark, sf_dir), CFG.splits))


@query
def index_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.index_split(derived.qa_raw(spark, sf_dir)).select("src_id", "split", "idx")


@query
def index_split_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for large splits, forced by small buckets."""
    rows = prepare.index_split(derived.qa_raw(spark, sf_dir), rows_per_bucket=50)
    return rows.select("src_id", "split", "idx")


@query
def index_split_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys with very many rows each, in an order of the caller's: positions from stored ranges."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digits = F.length(F.col("n_chars").cast("string")).cast("long")
    rows = documents.select("doc_id", F.col("lang").alias("split"), digits.alias("size_class"))
    placed = prepare.index_split(rows, "size_class", ties=["doc_id"], rows_per_bucket=200)
    return placed.select("doc_id", "split", "size_class", "idx")


@query
def parse_solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = prepare.parse_solutions(derived.qa_raw(spark, sf_dir))
    return parsed.select("src_id", "reference_solution", "reference_answer", "error", "error_code")


def _normalised(spark: SparkSession, sf_dir: str, grammar: str) -> DataFrame:
    answer = F.col("answer")
    tail = F.when(answer.contains("####"), F.substring_index(answer, "####", -1)).otherwise(answer)
    rows = derived.qa_raw(spark, sf_dir).select("src_id", "question", tail.alias("tail"))
    return rows.select(
        "src_id",
        normalise_numeric(F.col("tail"), grammar).alias("answer_number"),
        normalise_numeric(F.col("question"), grammar).alias("question_number"),
    )


@query
def normalise_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir, COMPAT)


@query
def normalise_answers_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir, FULL)


@query
def build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare.build_prompts(derived.qa_raw(spark, sf_dir))
    messages = F.col("prompt_messages")
    return rows.select(
        "src_id",
        big(F.size(messages)).alias("n_messages"),
        *[messages[i][f].alias(f"{f}_{i}") for i in (0, 1) for f in ("role", "content")],
    )


@query
def difficulty_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = prepare.parse_solutions(derived.qa_raw(spark, sf_dir))
    return parsed.select(
        "src_id",
        R.difficulty(F.col("reference_solution")).alias("difficulty"),
        R.difficulty(strip(F.col("question"))).alias("question_difficulty"),
    )


@query
def question_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.fingerprint_questions(derived.qa_raw(spark, sf_dir)).select("src_id", "fingerprint")


@query
def prompt_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare.build_prompts(derived.qa_raw(spark, sf_dir))
    return rows.select("src_id", big(R.prompt_words(F.col("prompt_messages"))).alias("words"))


@query
def answer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare.accepted(prepare.parse_solutions(derived.qa_raw(spark, sf_dir)))
    return rows.select("src_id", "reference_answer", answer_type(F.col("reference_answer")).alias("answer_type"))


@query
def process_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir).select(*record_columns("reference_solution", "error", "error_code"))


@query
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = prepare.validate_records(derived.candidate_records(spark, sf_dir), "expected_idx")
    return checked.select("expected_idx", "errors")


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.quarantined(processed(spark, sf_dir))


@query
def trainer_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.trainer_view(processed(spark, sf_dir)).select(*record_columns())


@query
def analysis_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.analysis_view(processed(spark, sf_dir)).select(*record_columns("reference_solution"))


@query
def rl_input_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = prepare.rl_input_view(prepare.trainer_view(processed(spark, sf_dir)))
    return view.select(
        F.col("prompt")[0]["content"].alias("system"), F.col("prompt")[1]["content"].alias("user"), "reference_answer"
    )


@query
def filter_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = prepare.trainer_view(processed(spark, sf_dir))
    return prepare.filter_difficulty(records, "medium").select(*record_columns())


@query
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.batch_plan(prepare.trainer_view(processed(spark, sf_dir)), BATCH)


@query
def batch_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for every seed: each record is in one batch, and only the last batch may be smaller."""
    records = prepare.trainer_view(processed(spark, sf_dir)).select("split", "idx")
    placed = batching.assign_batches(records, BATCH, seed=7)
    sizes = placed.groupBy("split", "batch_no").agg(F.count(F.lit(1)).alias("size"), F.sum("idx").alias("idx"))
    return sizes.groupBy("split").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("size").alias("n_rows"), F.max("size").alias("largest"),
        F.min("size").alias("smallest"), F.sum("idx").alias("sum_idx"),
    )


@query
def batch_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = prepare.trainer_view(unindexed_processed(spark, sf_dir))
    return batching.steps_per_epoch(records, BATCH)


@query
def render_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = prepare.trainer_view(processed(spark, sf_dir))
    return records.select("idx", "split", R.render_prompt(F.col("prompt_messages")).alias("prompt"))


# ---- reports --------------------------------------------------------------------------------------------


@query
def failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.failure_reasons(unindexed_processed(spark, sf_dir))


@query
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = report.split_counts(unindexed_processed(spark, sf_dir))
    return counted.select("split", "record_count", "failed_count", "raw_count", r6("error_rate").alias("error_rate"))


@query
def difficulty_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.difficulty_distribution(unindexed_processed(spark, sf_dir))


@query
def answer_type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.answer_type_distribution(measured(spark, sf_dir))


@query
def prompt_length_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(spark, sf_dir)
    found = report.prompt_length_summary(rows, CFG.splits, CFG.max_prompt_length)
    return found.select(
        "split",
        big("min_words").alias("min_words"),
        big("max_words").alias("max_words"),
        r6("avg_words").alias("avg_words"),
        "truncation_risk_count",
    )


@query
def duplicate_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.duplicate_prompts(measured(spark, sf_dir))


def _split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(spark, sf_dir)
    return report.split_report(rows, CFG.splits, CFG.max_prompt_length)


@query
def split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_report(spark, sf_dir).drop("ord")


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.accepted(unindexed_processed(spark, sf_dir)).select("split", "question")


@query
def within_split_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.within_split_duplicates(_questions(spark, sf_dir), CFG.splits)


@query
def cross_split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.cross_split_overlap(_questions(spark, sf_dir), CFG.splits)


@query
def overlap_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _questions(spark, sf_dir)
    counts = leakage.question_counts(questions, CFG.splits, starts=True)
    shown = leakage.overlap_examples(questions, counts, CFG.splits)
    return shown.select("pair", big("rank").alias("rank"), "question")


@query
def fingerprint_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.fingerprint_intersect(_questions(spark, sf_dir), *CFG.splits)


@query
def leakage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leakage.leakage_report(_questions(spark, sf_dir), CFG.splits)
    return found.select("kind", "scope", "duplicate_count", F.array_join("examples", "|").alias("examples"))


@query
def quality_gates_(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = leakage.question_counts(_questions(spark, sf_dir), CFG.splits)
    return quality_gates(_split_report(spark, sf_dir), leakage.leakage_counts(counts, CFG.splits), CFG)


@query
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.dataset_summary(write_and_reread(prepare.trainer_view(processed(spark, sf_dir)), "summary"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(spark, sf_dir)
    paths = sinks.artifact_paths("out", CFG)
    return manifest(_split_report(spark, sf_dir), report.failure_codes(rows), CFG, paths)


def _manifest_rows(built: DataFrame) -> DataFrame:
    """The parts of a manifest that do not depend on time and machine, one row per split."""
    rows = built.withColumn("entry", F.explode("splits"))
    return rows.select(
        "pipeline_contract_version",
        "reward_contract_version",
        F.array_join("public_sample_fields", ",").alias("public_fields"),
        F.col("config.system_prompt").alias("system_prompt"),
        F.col("entry.split").alias("split"),
        *[F.col(f"entry.{c}").alias(c) for c in ("record_count", "failed_count", "duplicate_prompt_count")],
        F.coalesce(F.col("entry.failure_codes.no_marker"), F.lit(0)).alias("no_marker"),
        F.coalesce(F.col("entry.failure_codes.unparseable_answer"), F.lit(0)).alias("unparseable"),
    )


@query
def manifest_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest_rows(_manifest(spark, sf_dir))


# ---- sources, sinks, end to end -------------------------------------------------------------------------


@query
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "jsonl")
    sinks.write_jsonl(cut_lineage(prepare.analysis_view(processed(spark, sf_dir))), path, CFG.splits)
    back = tables.read_jsonl(spark, f"{path}/*", record_type(analysis=True))
    return back.select(*record_columns("reference_solution"))


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "columnar")
    sinks.write_columnar(prepare.trainer_view(processed(spark, sf_dir)), path)
    both = [tables.read_split(spark, path, s) for s in CFG.splits]
    return both[0].unionByName(both[1]).select(*record_columns())


@query
def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation report written as nested JSON and read back, one row per difficulty."""
    stored = cut_lineage(labelled_scores(spark, sf_dir).select("difficulty", "exact_match", "reward", "format"))
    built = eval_report(
        evaluation.eval_summary(stored), evaluation.eval_by_difficulty(stored), EvalConfig(model_name="given")
    )
    path = new_folder(spark, "eval_results")
    sinks.write_report(built, path)
    return _eval_rows(spark.read.schema(built.schema).json(path))


@query
def evaluate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole evaluation plan over the test split; its written report read back, one row per difficulty."""
    rows = unindexed_processed(spark, sf_dir).select(F.col("src_id").alias("prompt_id"), "split", "metadata")
    records = derived.references(spark, sf_dir).join(rows, "prompt_id").select(
        "split", F.col("prompt_id").alias("idx"), F.col("reference").alias("reference_answer"), "metadata"
    )
    folder = new_folder(spark, "evaluation")
    texts = derived.completions(spark, sf_dir).drop("reference")
    done = run_evaluation(texts, records, EvalConfig(model_name="given", split="test"), folder)
    return _eval_rows(spark.read.schema(done.report.schema).json(f"{folder}/eval_results"))


def _eval_rows(saved: DataFrame) -> DataFrame:
    rows = saved.withColumn("entry", F.explode("by_difficulty"))
    return rows.select(
        "model_name",
        "split",
        "num_samples",
        r6("exact_match_accuracy").alias("exact_match_accuracy"),
        r6("mean_composite_reward").alias("mean_composite_reward"),
        r6("mean_format_reward").alias("mean_format_reward"),
        F.col("entry.difficulty").alias("difficulty"),
        F.col("entry.n").alias("n"),
        r6("entry.accuracy").alias("accuracy"),
        r6("entry.mean_reward").alias("mean_reward"),
    )


@query
def load_trainer_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "trainer")
    sinks.write_columnar(prepare.trainer_view(processed(spark, sf_dir)), path)
    return prepare.rl_input_view(tables.read_split(spark, path, "test")).select(
        F.col("prompt")[0]["content"].alias("system"), F.col("prompt")[1]["content"].alias("user"), "reference_answer"
    )


@query
def build_dataset_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole build with all artifacts; the trainer dataset read back from its columnar artifact."""
    raw = derived.qa_raw(spark, sf_dir)
    path = build_dataset(raw, new_folder(spark, "build"), CFG, enforce_gates=False).paths["trainer_parquet"]
    both = [tables.read_split(spark, path, s) for s in CFG.splits]
    return both[0].unionByName(both[1]).select(*record_columns())


@query
def build_no_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build without difficulty over an earlier build with it; the returned trainer rows read the new artifact."""
    raw, folder = derived.qa_raw(spark, sf_dir), new_folder(spark, "build")
    build_dataset(raw, folder, replace(CFG, save_columnar=False), enforce_gates=False)
    built = build_dataset(raw, folder, replace(CFG, add_difficulty=False, save_jsonl=False), enforce_gates=False)
    counts = built.summary.select("split", F.col("n_rows").alias("split_rows"))
    return built.trainer.join(F.broadcast(counts), "split").select(*record_columns("split_rows", difficulty=False))


# ---- streams --------------------------------------------------------------------------------------------


def _stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Write a table as many files and stream them in several triggers; groups may arrive split."""
    path = new_folder(spark, "arrivals")
    files = 3 * spark.sparkContext.defaultParallelism
    rows.repartition(files).write.parquet(path)
    return streams.completion_stream(spark, path, rows.schema, max_files_per_trigger=files // 2)


@query
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streams.stream_scores(_stream(spark, derived.completions(spark, sf_dir)))
    done = streams.drain_to_parquet(stream.select("prompt_id", "gen_idx", "reward"), "scores")
    return done.select(*member(), r6("reward").alias("reward"))


@query
def stream_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running metrics per difficulty; the labels are a stored side table joined to the stream."""
    arrivals = _stream(spark, derived.completions(spark, sf_dir).drop("reference"))
    targets = cut_lineage(labelled_targets(spark, sf_dir))
    done = streams.drain_latest(streams.running_metrics(score_against(arrivals, targets)), ["difficulty"], "metrics")
    return done.select("difficulty", "n", r6("accuracy").alias("accuracy"), r6("mean_reward").alias("mean_reward"))


@query
def stream_advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = streams.stream_scores(_stream(spark, derived.completions(spark, sf_dir)))
    done = streams.stream_advantages(rows, derived.GENERATIONS).emitted
    return done.select(*member(), r6("advantage").alias("advantage"))


@query
def stream_advantages_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with one to six completions, some of which arrive twice, after the end of the stream."""
    rows = derived.completions(spark, sf_dir)
    more = rows.where("gen_idx < 2").withColumn("gen_idx", F.col("gen_idx") + derived.GENERATIONS)
    members = rows.unionByName(more).where("gen_idx < 1 + prompt_id % 6")
    arrivals = members.unionByName(members.where("gen_idx = 0"))
    done = streams.stream_advantages(streams.stream_scores(_stream(spark, arrivals)), derived.GENERATIONS).closed
    return done.select(*member(), r6("advantage").alias("advantage"))
