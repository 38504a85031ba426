"""Preparation, quality reporting, reward scoring and evaluation of question/answer and completion tables."""

from rollout_quality.config import BuildConfig, EvalConfig, RewardConfig, RewardWeights
from rollout_quality.operators.gates import QualityGateError
from rollout_quality.plans.build_dataset import BuildResult, build_dataset
from rollout_quality.plans.evaluate import EvalResult, evaluate

__all__ = [
    "BuildConfig",
    "BuildResult",
    "EvalConfig",
    "EvalResult",
    "QualityGateError",
    "RewardConfig",
    "RewardWeights",
    "build_dataset",
    "evaluate",
]
