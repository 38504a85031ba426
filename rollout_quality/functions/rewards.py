"""Reward components and their combinations, as Column expressions.

Extraction, line and word counts depend on the completion alone. Jobs therefore compute
`completion_features` next to the scan and carry only those scalars through joins and windows; the long
completion text never enters a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from rollout_quality.config import ANSWER_MARKER, COMPAT, RewardWeights
from rollout_quality.functions.numeric import extract_final_answer, to_float
from rollout_quality.functions.text import has_lines, let, strip, word_count

Reward = Callable[[Column, Column], Column]

COMPONENTS = ("exact_match", "soft_numeric", "format", "length")
RELATIVE_TOLERANCE = 1e-6
# Shares of the format reward and the word limits of the length reward.
MARKER_SHARE = 0.4
LINES_SHARE = 0.3
NUMBER_SHARE = 0.3
MIN_LINES = 3
MIN_WORDS = 20
MAX_WORDS = 512


def completion_text(messages: Column) -> Column:
    """Text of a chat-style completion: content of its last message, empty if there is none."""
    return F.coalesce(F.try_element_at(messages, F.lit(-1))["content"], F.lit(""))


def format_reward(completion: Column) -> Column:
    """Marker present, at least three non-blank lines, a digit after the last marker. NULL is empty text."""
    completion = F.coalesce(completion, F.lit(""))
    numbered = F.substring_index(completion, ANSWER_MARKER, -1).rlike("[0-9]")
    lines = F.when(has_lines(completion, MIN_LINES), F.lit(LINES_SHARE)).otherwise(F.lit(0.0))
    number = F.when(numbered, F.lit(NUMBER_SHARE)).otherwise(F.lit(0.0))
    return F.when(completion.contains(ANSWER_MARKER), F.lit(MARKER_SHARE) + lines + number).otherwise(lines)


def length_reward(completion: Column, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS) -> Column:
    """1 inside the limits, falling towards 0 below and above them. NULL is empty text."""
    return let(
        word_count(F.coalesce(completion, F.lit(""))),
        lambda n: F.when(n < min_words, n / F.lit(float(min_words)))
        .when(n > max_words, F.lit(float(max_words)) / n)
        .otherwise(F.lit(1.0)),
    )


def completion_features(completion: Column, grammar: str = COMPAT) -> dict[str, Column]:
    """Everything scoring needs from a completion, as three narrow columns."""
    return {
        "predicted": extract_final_answer(completion, grammar),
        "format": format_reward(completion),
        "length": length_reward(completion),
    }


def numbers(predicted: Column, reference: Column) -> dict[str, Column]:
    """Both sides as doubles; NULL where a side is not a number. Only the reference may carry commas."""
    return {
        "p": predicted.try_cast("double"),
        "r": to_float(F.replace(reference, F.lit(","), F.lit(""))),
    }


def exact_match(predicted: Column, reference: Column, p: Column, r: Column) -> Column:
    """1 if both are numbers within relative tolerance, or the same text if either is not a number."""
    close = F.abs(p - r) <= F.lit(RELATIVE_TOLERANCE) * F.greatest(F.abs(p), F.abs(r))
    same_number = close & (F.abs(r) < float("inf"))
    same_text = (p.isNull() | r.isNull()) & (strip(predicted) == strip(reference))
    return F.when(same_number | same_text, F.lit(1.0)).otherwise(F.lit(0.0))


def soft_numeric(p: Column, r: Column, k: float = 0.1) -> Column:
    """exp(-k * relative error), 0 if either side is not a number."""
    return F.coalesce(F.exp(F.lit(-float(k)) * (F.abs(p - r) / (F.abs(r) + 1.0))), F.lit(0.0))


def components(row: dict[str, Column], reference: Column, k: float = 0.1) -> dict[str, Column]:
    """The four component rewards, given a completion's features and `numbers`."""
    return {
        "exact_match": exact_match(row["predicted"], reference, row["p"], row["r"]),
        "soft_numeric": soft_numeric(row["p"], row["r"], k),
        "format": row["format"],
        "length": row["length"],
    }


def _capped(value: Column) -> Column:
    # `least` would turn NaN into the cap.
    return let(value, lambda v: F.when(F.isnan(v), v).otherwise(F.least(v, F.lit(1.0))))


def combine(parts: dict[str, Column], weights: RewardWeights | None = None) -> Column:
    """Weighted mean of all four components, at most 1."""
    w = weights or RewardWeights()
    if w.total == 0:
        raise ValueError("reward weights must not sum to zero")
    return _capped(_weighted_sum(parts, w, COMPONENTS) / F.lit(w.total))


def combine_selected(
    parts: dict[str, Column], selected: Sequence[str], weights: RewardWeights | None = None
) -> Column:
    """Weighted mean of the selected components, at most 1; 0 if nothing with weight is selected."""
    w = weights or RewardWeights()
    unknown = set(selected) - set(COMPONENTS)
    if unknown:
        raise ValueError(f"unknown reward components: {sorted(unknown)}")
    chosen = [c for c in COMPONENTS if c in selected]
    total = sum(getattr(w, c) for c in chosen)
    if total <= 0:
        return F.lit(0.0)
    return _capped(_weighted_sum(parts, w, chosen) / F.lit(total))


def total(parts: dict[str, Column], weights: RewardWeights | None = None) -> Column:
    """Plain sum of the components, or their weighted sum, without a cap."""
    if weights is None:
        return sum((parts[c] for c in COMPONENTS[1:]), parts[COMPONENTS[0]])
    return _weighted_sum(parts, weights, COMPONENTS)


def _weighted_sum(parts: dict[str, Column], w: RewardWeights, chosen: Sequence[str]) -> Column:
    terms = [F.lit(float(getattr(w, c))) * parts[c] for c in chosen]
    return sum(terms[1:], terms[0])


def _with_components(
    completion: Column,
    reference: Column,
    k: float,
    grammar: str,
    combined: Callable[[dict[str, Column]], Column],
) -> Column:
    """Bind features, then numbers, then combine the components: the whole score as one expression."""

    def bind(values: dict[str, Column], body: Callable[[dict[str, Column]], Column]) -> Column:
        packed = F.struct(*[c.alias(n) for n, c in values.items()])
        return let(packed, lambda s: body({n: s[n] for n in values}))

    return bind(
        completion_features(completion, grammar),
        lambda f: bind(
            {**f, **numbers(f["predicted"], reference)}, lambda row: combined(components(row, reference, k))
        ),
    )


def exact_match_reward(completion: Column, reference: Column, grammar: str = COMPAT) -> Column:
    return _with_components(completion, reference, 0.1, grammar, lambda parts: parts["exact_match"])


def soft_numeric_reward(
    completion: Column, reference: Column, k: float = 0.1, grammar: str = COMPAT
) -> Column:
    return _with_components(completion, reference, k, grammar, lambda parts: parts["soft_numeric"])


def composite_reward(
    completion: Column,
    reference: Column,
    weights: RewardWeights | None = None,
    soft_k: float = 0.1,
    grammar: str = COMPAT,
) -> Column:
    """Composite reward of one completion, for use inside array functions and as a default reward."""
    return _with_components(completion, reference, soft_k, grammar, lambda parts: combine(parts, weights))


def create_reward(
    weights: RewardWeights | None = None,
    soft_k: float = 0.1,
    selected: Sequence[str] | None = None,
    grammar: str = COMPAT,
) -> Reward:
    """A reward function over (completion, reference): the composite, or only the `selected` components."""
    if selected is None:
        return lambda c, r: composite_reward(c, r, weights, soft_k, grammar)
    return lambda c, r: _with_components(
        c, r, soft_k, grammar, lambda parts: combine_selected(parts, selected, weights)
    )


def group_rewards(completions: Column, reference: Column, reward: Reward | None = None) -> Column:
    """Rewards of an array of completions of one prompt, in order; no shuffle."""
    score = reward or composite_reward
    return F.transform(completions, lambda c: score(c, reference))


def group_advantages(rewards: Column, eps: float = 1e-8) -> Column:
    """(reward - mean) / (population deviation + eps) over an array; empty for an empty array."""
    mean = F.aggregate(rewards, F.lit(0.0), lambda a, r: a + r) / F.size(rewards)

    def spread(m: Column) -> Column:
        squares = F.aggregate(rewards, F.lit(0.0), lambda a, r: a + (r - m) * (r - m))
        return F.struct(m.alias("mean"), (F.sqrt(squares / F.size(rewards)) + F.lit(eps)).alias("std"))

    filled = let(
        mean,
        lambda m: let(spread(m), lambda s: F.transform(rewards, lambda r: (r - s["mean"]) / s["std"])),
    )
    return F.when(F.size(rewards) > 0, filled).otherwise(rewards)
