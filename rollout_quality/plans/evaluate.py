"""End-to-end evaluation of a given completions table against prepared records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rollout_quality.config import EvalConfig, RewardWeights
from rollout_quality.functions import rewards as R
from rollout_quality.operators.evaluation import eval_by_difficulty, eval_sample, eval_summary
from rollout_quality.operators.scoring import completion_features, component_rewards, join_references
from rollout_quality.session import cut_lineage
from rollout_quality.sources.sinks import write_report


@dataclass(frozen=True)
class EvalResult:
    summary: DataFrame
    by_difficulty: DataFrame
    report: DataFrame


def score_against(
    completions: DataFrame,
    targets: DataFrame,
    weights: RewardWeights | None = None,
    grammar: str = "compat",
    how: str = "inner",
) -> DataFrame:
    """Score completions against `targets(prompt_id, reference, ...)`.

    Texts are reduced to three scalars before the join, so the shuffle carries keys and scalars only.
    """
    features = completion_features(completions, grammar)
    joined = join_references(features, targets, how=how)
    parts = {c: F.col(c) for c in R.COMPONENTS}
    return component_rewards(joined).withColumn("reward", R.combine(parts, weights))


def targets_of(records: DataFrame, key: str = "idx") -> DataFrame:
    """(prompt_id, reference, difficulty) of prepared records."""
    return records.select(
        F.col(key).alias("prompt_id"),
        F.col("reference_answer").alias("reference"),
        F.col("metadata.difficulty").alias("difficulty"),
    )


def evaluate(
    completions: DataFrame, records: DataFrame, cfg: EvalConfig = EvalConfig(), output_dir: str | None = None
) -> EvalResult:
    """Evaluate one split: select records, join, score, aggregate, and optionally write the report.

    `completions.prompt_id` refers to `records.idx` within the split.
    """
    chosen = records.where(F.col("split") == cfg.split)
    if cfg.num_samples is not None:
        chosen = eval_sample(chosen, cfg.num_samples)
    scored = score_against(completions, targets_of(chosen), grammar=cfg.grammar)
    # Four scalars per row; stored because two aggregates read them.
    stored = cut_lineage(scored.select("difficulty", "exact_match", "reward", "format"))
    summary, by_difficulty = eval_summary(stored), eval_by_difficulty(stored)
    report = eval_report(summary, by_difficulty, cfg)
    if output_dir is not None:
        write_report(report, f"{output_dir.rstrip('/')}/eval_results")
    return EvalResult(summary, by_difficulty, report)


def eval_report(summary: DataFrame, by_difficulty: DataFrame, cfg: EvalConfig) -> DataFrame:
    """One nested row with both metric levels."""
    total = summary.select(F.struct(*summary.columns).alias("total"))
    entries = by_difficulty.select(F.struct("difficulty", "n", "accuracy", "mean_reward").alias("entry"))
    both = total.unionByName(entries, allowMissingColumns=True).agg(
        F.first("total", ignorenulls=True).alias("total"),
        F.sort_array(F.collect_list("entry")).alias("by_difficulty"),
    )
    return both.select(
        F.lit(cfg.model_name).alias("model_name"),
        F.lit(cfg.split).alias("split"),
        "total.*",
        "by_difficulty",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"),
    )
