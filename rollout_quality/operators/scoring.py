"""Scoring jobs over a completions table (`prompt_id`, `gen_idx`, `completion`, optionally `reference`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rollout_quality.config import COMPAT, FULL, FULL_DIGITS_CONTRACT_VERSION, RewardConfig, RewardWeights
from rollout_quality.functions import rewards as R
from rollout_quality.operators.hot import HOT_ROWS, hot_keys, may_broadcast
from rollout_quality.session import cut_lineage

FEATURES = ("predicted", "format", "length")
# Keys of a prompt in a stream whose references are too large to broadcast.
STREAM_SALTS = 16


def as_text(completions: DataFrame, column: str = "completion") -> DataFrame:
    """Turn chat-style completions into plain text; plain text stays as it is."""
    kind = completions.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        return completions.withColumn(column, R.completion_text(F.col(column)))
    return completions.withColumn(column, F.coalesce(F.col(column), F.lit("")))


def completion_features(completions: DataFrame, grammar: str = COMPAT) -> DataFrame:
    """Replace the completion text by the three narrow columns scoring needs."""
    keep = [F.col(c) for c in completions.columns if c != "completion"]
    features = R.completion_features(F.col("completion"), grammar)
    return as_text(completions).select(*keep, *[c.alias(n) for n, c in features.items()])


def join_references(
    features: DataFrame,
    references: DataFrame,
    key: str = "prompt_id",
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pair completions (or their features) with the reference of their prompt.

    Drop or reduce the texts first (`completion_features`): then this shuffle moves a few scalars per row.
    Whether the reference side is broadcast is decided at run time from its measured size. Rows of hot prompts
    (counted, see `hot`) meet the few references of those prompts by broadcast, the others by the usual join. A
    stream cannot be counted: its references are broadcast if they are proven small, else every prompt is spread
    over `STREAM_SALTS` keys.
    """
    if how not in ("inner", "left"):
        return features.join(references, key, how)
    if features.isStreaming:
        return _join_stream(features, references, key, how)
    hot = hot_keys(features.where(F.col(key).isNotNull()), key, hot_rows)
    if hot is None:
        return features.join(references, key, how)
    keys = F.broadcast(hot.withColumnRenamed("__hot", key))
    few = references.join(keys, key, "left_semi")
    if not may_broadcast(few):  # many references for one prompt
        return features.join(references, key, how)
    stored = cut_lineage(features)
    large = stored.join(keys, key, "left_semi").join(F.broadcast(few), key, how)
    usual = stored.join(keys, key, "left_anti").join(references, key, how)
    return usual.unionByName(large)


def _join_stream(features: DataFrame, references: DataFrame, key: str, how: str) -> DataFrame:
    """Join a stream with stored references: by broadcast, or by (key, salt).

    The salt of a row follows from its values, so the rows of a hot prompt reach `STREAM_SALTS` tasks in every
    trigger, and a repeated trigger deals them out alike. Each reference is there once for each salt.
    """
    if may_broadcast(references):
        return features.join(F.broadcast(references), key, how)
    salt = "__salt"
    dealt = features.withColumn(salt, F.pmod(F.xxhash64(*features.columns), F.lit(STREAM_SALTS)).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1)))
    return dealt.join(references.withColumn(salt, copies), [key, salt], how).drop(salt)


def component_rewards(features: DataFrame, soft_k: float = 0.1) -> DataFrame:
    """Add the four component rewards next to the other columns; the features are consumed."""
    keep = [F.col(c) for c in features.columns if c not in FEATURES]
    reference = F.col("reference")
    both = features.withColumns(
        {f"__{n}": c for n, c in R.numbers(F.col("predicted"), reference).items()}
    )
    row = {f: F.col(f) for f in FEATURES} | {"p": F.col("__p"), "r": F.col("__r")}
    parts = R.components(row, reference, soft_k)
    return both.select(*keep, "predicted", *[c.alias(n) for n, c in parts.items()])


def score(
    completions: DataFrame,
    weights: RewardWeights | None = None,
    soft_k: float = 0.1,
    grammar: str = COMPAT,
) -> DataFrame:
    """Features, components and composite `reward` of completions that carry their reference."""
    parts = {c: F.col(c) for c in R.COMPONENTS}
    return component_rewards(completion_features(completions, grammar), soft_k).withColumn(
        "reward", R.combine(parts, weights)
    )


def score_selected(
    completions: DataFrame,
    selected: Sequence[str],
    weights: RewardWeights | None = None,
    soft_k: float = 0.1,
    grammar: str = COMPAT,
) -> DataFrame:
    """Reward from a subset of the components; work for the others is pruned from the plan."""
    parts = {c: F.col(c) for c in R.COMPONENTS}
    scored = component_rewards(completion_features(completions, grammar), soft_k)
    keep = [c for c in scored.columns if c not in R.COMPONENTS and c != "predicted"]
    return scored.select(*keep, R.combine_selected(parts, selected, weights).alias("reward"))


def reward_matrix(
    completions: DataFrame,
    weights: RewardWeights | None = None,
    soft_k: float = 0.1,
    grammar: str = COMPAT,
) -> DataFrame:
    """One column per component, their plain sum, and their weighted sum."""
    parts = {c: F.col(c) for c in R.COMPONENTS}
    scored = component_rewards(completion_features(completions, grammar), soft_k)
    return scored.withColumns(
        {"reward_sum": R.total(parts), "weighted_sum": R.total(parts, weights or RewardWeights())}
    )


def custom_rewards(completions: DataFrame, reward: R.Reward, out: str = "reward") -> DataFrame:
    """Score with a user's reward over (completion, reference): a Column expression or a pandas UDF."""
    scored = as_text(completions).withColumn(out, reward(F.col("completion"), F.col("reference")))
    return scored.drop("completion")


def multi_rewards(
    completions: DataFrame, rewards: dict[str, R.Reward], weights: dict[str, float] | None = None
) -> DataFrame:
    """One column per given reward, their plain sum, and their weighted sum (weight 1 where none is given)."""
    if not rewards:
        raise ValueError("give at least one reward")
    texts = as_text(completions)
    columns = {n: f(F.col("completion"), F.col("reference")) for n, f in rewards.items()}
    scored = texts.withColumns(columns).drop("completion")
    weighted = [F.lit(float((weights or {}).get(n, 1.0))) * F.col(n) for n in rewards]
    plain = [F.col(n) for n in rewards]
    return scored.withColumns(
        {"reward_sum": sum(plain[1:], plain[0]), "weighted_sum": sum(weighted[1:], weighted[0])}
    )


def reward_of(
    reward: R.Reward | None, weights: RewardWeights | None = None, soft_k: float = 0.1, grammar: str = COMPAT
) -> R.Reward:
    """A given reward, or the composite with these settings."""
    return reward or (lambda c, r: R.composite_reward(c, r, weights, soft_k, grammar))


def group_rewards(
    arrays: DataFrame,
    reward: R.Reward | None = None,
    weights: RewardWeights | None = None,
    soft_k: float = 0.1,
    grammar: str = COMPAT,
) -> DataFrame:
    """Add `rewards` to rows in array layout (`completions` array, `reference`); no shuffle."""
    fn = reward_of(reward, weights, soft_k, grammar)
    return arrays.withColumn("rewards", R.group_rewards(F.col("completions"), F.col("reference"), fn))


def contract_columns(config: RewardConfig | None = None, grammar: str = COMPAT) -> dict[str, Column]:
    """The reward contract as literals."""
    values = (config or RewardConfig()).to_dict()
    if grammar == FULL:
        values["contract_version"] = FULL_DIGITS_CONTRACT_VERSION
    return {name: F.lit(value) for name, value in values.items()}


def with_contract(scored: DataFrame, config: RewardConfig | None = None, grammar: str = COMPAT) -> DataFrame:
    """Attach the reward contract to scored rows."""
    return scored.withColumns(contract_columns(config, grammar))
