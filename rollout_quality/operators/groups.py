"""Group-relative advantages and the full group step, safe for prompts with very many completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollout_quality.config import COMPAT, RewardWeights
from rollout_quality.functions.rewards import Reward
from rollout_quality.operators.hot import HOT_ROWS, hot_keys
from rollout_quality.operators.scoring import as_text, reward_of
from rollout_quality.session import cut_lineage

EPSILON = 1e-8
_STATS = ("__mean", "__std")


def _relative(eps: float) -> Column:
    return (F.col("reward") - F.col("__mean")) / (F.col("__std") + F.lit(eps))


def _in_window(scored: DataFrame, key: str, eps: float) -> DataFrame:
    group = Window.partitionBy(key)
    stats = {"__mean": F.avg("reward").over(group), "__std": F.stddev_pop("reward").over(group)}
    return scored.withColumns(stats).withColumn("advantage", _relative(eps)).drop(*_STATS)


def group_advantages(
    scored: DataFrame, key: str = "prompt_id", eps: float = EPSILON, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add `advantage` = (reward - group mean) / (population deviation + eps); every row stays.

    Usual groups take one exchange and one window. The rows of hot prompts (counted, see `hot`) do not move at all:
    their statistics are combined in the tasks that hold them and come back as one broadcast row per prompt.
    Rows without a prompt are one group. Only the number of rows of a prompt matters, not its positions.
    """
    hot = hot_keys(scored, key, hot_rows)
    if hot is None:
        return _in_window(scored, key, eps)
    large, usual = _parted(cut_lineage(scored), key, hot)
    return _in_window(usual, key, eps).unionByName(_in_place(large, key, eps))


def _parted(rows: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of hot prompts, and the others; only keys are compared."""
    flagged = rows.join(F.broadcast(hot.withColumn("__is", F.lit(True))), F.col(key).eqNullSafe(F.col("__hot")), "left")
    large = flagged.where("__is").drop("__is", "__hot")
    return large, flagged.where(F.col("__is").isNull()).drop("__is", "__hot")


def _in_place(large: DataFrame, key: str, eps: float) -> DataFrame:
    """Advantages of hot prompts. Their statistics are a pass over (key, reward) of its own and are all that is stored;
    they come back to the rows as one broadcast row for each of fewer than 10,000 prompts."""
    stats = large.groupBy(F.col(key).alias("__key")).agg(
        F.avg("reward").alias("__mean"), F.stddev_pop("reward").alias("__std")
    )
    spread = large.join(F.broadcast(cut_lineage(stats)), F.col(key).eqNullSafe(F.col("__key")))
    return spread.withColumn("advantage", _relative(eps)).drop("__key", *_STATS)


def group_step(
    completions: DataFrame,
    reward: Reward | None = None,
    key: str = "prompt_id",
    eps: float = EPSILON,
    hot_rows: int = HOT_ROWS,
    weights: RewardWeights | None = None,
    soft_k: float = 0.1,
    grammar: str = COMPAT,
) -> DataFrame:
    """The completions with their reward and advantage: one row per completion, whatever the size of its group.

    `weights`, `soft_k` and `grammar` shape the composite reward; a `reward` of one's own replaces it. For rows
    that already hold a prompt's completions as an array, see `functions.rewards.group_advantages`. No text is
    stored: the completions of hot prompts are read and scored once more for their statistics, so a reward of one's own
    must give the same value again.
    """

    def scored(texts: DataFrame) -> DataFrame:
        fn = reward_of(reward, weights, soft_k, grammar)
        return texts.withColumn("reward", fn(F.col("completion"), F.col("reference")))

    texts = as_text(completions)
    hot = hot_keys(texts, key, hot_rows)
    if hot is None:
        return _in_window(scored(texts), key, eps)
    large, usual = _parted(texts, key, hot)
    return _in_window(scored(usual), key, eps).unionByName(_in_place(scored(large), key, eps))
