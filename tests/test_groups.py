import random
import statistics

import pytest
from pyspark.sql import functions as F

from rollout_quality.config import RewardWeights
from rollout_quality.operators import groups, hot, scoring

SCHEMA = "prompt_id long, gen_idx int, reward double"
COMPLETIONS = "prompt_id long, gen_idx int, completion string, reference string"


def scored(spark, sizes, seed=0):
    rng = random.Random(seed)
    rows = [(p, g, rng.random()) for p, n in sizes.items() for g in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute_force(rows):
    by_prompt = {}
    for p, g, r in rows:
        by_prompt.setdefault(p, []).append(r)
    out = {}
    for p, g, r in rows:
        rewards = by_prompt[p]
        out[p, g] = (r - statistics.mean(rewards)) / (statistics.pstdev(rewards) + 1e-8)
    return out


@pytest.mark.parametrize("hot_rows", [4_096, 100, 3])
def test_hot_prompt(spark, hot_rows):
    """One prompt holds far more than a third of all rows."""
    rows, df = scored(spark, {1: 900, 2: 4, 3: 1, **{i: 4 for i in range(10, 60)}})
    got = groups.group_advantages(df, hot_rows=hot_rows).collect()
    want = brute_force(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["advantage"] == pytest.approx(want[r["prompt_id"], r["gen_idx"]], abs=1e-6)


@pytest.mark.parametrize("hot_rows", [4_096, 1])
def test_rows_without_prompt_or_position_are_kept(spark, hot_rows):
    rows = [(None, 0, 1.0), (None, 1, 3.0), (1, None, 1.0), (1, 0, 2.0), (1, 3, 3.0)]
    got = groups.group_advantages(spark.createDataFrame(rows, SCHEMA), hot_rows=hot_rows).collect()
    assert len(got) == len(rows)
    assert {r["reward"]: round(r["advantage"], 3) for r in got if r["prompt_id"] is None} == {1.0: -1.0, 3.0: 1.0}
    assert {r["reward"]: round(r["advantage"], 3) for r in got if r["prompt_id"] == 1} == {1.0: -1.225, 2.0: 0.0, 3.0: 1.225}


def test_advantages_sum_to_zero_and_constant_groups(spark):
    df = spark.createDataFrame([(1, i, 0.5) for i in range(5)] + [(2, i, float(i)) for i in range(4)], SCHEMA)
    out = groups.group_advantages(df)
    assert all(abs(r["advantage"]) < 1e-2 for r in out.where("prompt_id = 1").collect())
    assert out.groupBy("prompt_id").agg(F.abs(F.sum("advantage")).alias("s")).where("s > 1e-6").count() == 0
    assert groups.group_advantages(df.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("hot_rows", [4_096, 3])
def test_group_step(spark, hot_rows):
    """One row per completion, whatever the size of the group."""
    rows = [(1, g, f"#### {g}", "1") for g in range(8)] + [(2, 0, "#### 5", "5"), (2, 1, None, "5")]
    df = spark.createDataFrame(rows, COMPLETIONS)
    steps = groups.group_step(df.repartition(4), hot_rows=hot_rows).orderBy("prompt_id", "gen_idx").collect()
    assert [(r["prompt_id"], r["gen_idx"], r["completion"]) for r in steps] == [(p, g, c or "") for p, g, c, _ in rows]
    rewards, advantages = ([r[c] for r in steps if r["prompt_id"] == 1] for c in ("reward", "advantage"))
    spread = statistics.pstdev(rewards) + 1e-8
    assert advantages == pytest.approx([(x - statistics.mean(rewards)) / spread for x in rewards], abs=1e-6)
    assert rewards[1] == max(rewards)


def test_group_step_with_own_reward_or_weights(spark):
    df = spark.createDataFrame([(1, 0, "#### 12", "7"), (1, 1, "#### 7", "7")], COMPLETIONS)
    own = groups.group_step(df, reward=lambda c, r: F.length(c).cast("double")).orderBy("gen_idx").collect()
    assert [r["reward"] for r in own] == [7.0, 6.0]
    exact = RewardWeights(exact_match=1.0, soft_numeric=0.0, format=0.0, length=0.0)
    weighted = groups.group_step(df, weights=exact).orderBy("gen_idx").collect()
    assert [r["reward"] for r in weighted] == [0.0, 1.0]


def test_null_completions_score_alike_in_both_layouts(spark):
    texts = ["#### 5", None, "So\n#### 6"]
    rows = spark.createDataFrame([(1, g, t, "5") for g, t in enumerate(texts)], COMPLETIONS)
    long = [r["reward"] for r in groups.group_step(rows, soft_k=0.5).orderBy("gen_idx").collect()]
    arrays = spark.createDataFrame([(texts, "5")], "completions array<string>, reference string")
    assert scoring.group_rewards(arrays, soft_k=0.5).first()["rewards"] == pytest.approx(long)


def test_hot_prompt_with_repeated_and_sparse_positions_leaves_the_window(spark):
    rows = [(1, g % 4, float(g)) for g in range(2_000)] + [(1, 39_000_000, 1.0)] + [(p, 0, 1.0) for p in range(2, 400)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r["__hot"] for r in hot.hot_keys(df, "prompt_id", 100).collect()] == [1]
    assert hot.hot_keys(df, "prompt_id", 5_000) is None
    got = groups.group_advantages(df, hot_rows=100)
    assert got.count() == len(rows)
    assert abs(got.where("prompt_id = 1").agg(F.sum("advantage")).first()[0]) < 1e-6


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [4_096, 10])
def test_join_of_hot_prompt(spark, how, hot_rows):
    rows = [(1, g, float(g)) for g in range(300)] + [(p, g, 0.0) for p in range(2, 40) for g in range(4)]
    features = spark.createDataFrame(rows, SCHEMA)
    references = spark.createDataFrame([(p, str(p)) for p in range(1, 30)], "prompt_id long, reference string")
    got = scoring.join_references(features, references, how=how, hot_rows=hot_rows).collect()
    want = sorted((p, g, str(p) if p < 30 else None) for p, g, _ in rows if how == "left" or p < 30)
    assert sorted((r["prompt_id"], r["gen_idx"], r["reference"]) for r in got) == want


@pytest.mark.parametrize("hot_rows", [4_096, 4])
def test_rows_with_negative_positions_are_kept(spark, hot_rows):
    rows = spark.createDataFrame([(1, i, float(i)) for i in range(-3, 7)], "prompt_id long, gen_idx int, reward double")
    got = groups.group_advantages(rows, hot_rows=hot_rows)
    assert sorted(r["gen_idx"] for r in got.collect()) == list(range(-3, 7))
