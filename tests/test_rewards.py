import math
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from rollout_quality.config import RewardConfig, RewardWeights
from rollout_quality.functions import rewards as R
from rollout_quality.operators import scoring

C, REF = "completion string, reference string", lambda fn: lambda: fn(F.col("completion"), F.col("reference"))
ONE = "completion string"
COMPLETIONS = "prompt_id long, gen_idx int, completion string, reference string"


def test_exact_match(values):
    cases = [
        (("blah #### 42", "42"), 1.0),
        (("blah #### 43", "42"), 0.0),
        (("#### 1000", "1,000"), 0.0),
        (("#### 1,000", "1,000"), 1.0),
        (("#### 0.5", "1/2"), 0.0),
        (("#### 1/3", "0.3333332"), 1.0),
        (("#### 1/3", "0.3334"), 0.0),
        (("#### 0", "0"), 1.0),
        (("#### 0.00001", "0"), 0.0),
        (("nothing", "42"), 0.0),
        (("#### 42", None), 0.0),
        (("#### 5", "five"), 0.0),
        (("#### 5", "inf"), 0.0),
        (("#### 5", "nan"), 0.0),
    ]
    got = values([c[0] for c in cases], C, REF(R.exact_match_reward))
    assert got == [c[1] for c in cases]


def test_soft_numeric(values):
    cases = [("#### 100", "100"), ("#### 90", "100"), ("#### -5", "0"), ("none", "1"), ("#### 1", "x")]
    got = values(cases, C, REF(R.soft_numeric_reward))
    want = [1.0, math.exp(-0.1 * 10 / 101), math.exp(-0.5), 0.0, 0.0]
    assert got == pytest.approx(want, abs=1e-12)
    steep = values(cases[1:2], C, REF(lambda c, r: R.soft_numeric_reward(c, r, k=2.0)))
    assert steep == pytest.approx([math.exp(-2.0 * 10 / 101)])


def test_format(values):
    texts = ["Step 1.\nStep 2.\nStep 3.\n#### 42", "a\nb\nc", "#### x", "#### 1", "5 #### 5 #### x", "", "a\n\n\nb #### 2"]
    got = values(texts, ONE, lambda: R.format_reward(F.col("completion")))
    assert got == pytest.approx([1.0, 0.3, 0.4, 0.7, 0.4, 0.0, 0.7])


def test_length(values):
    texts = ["w " * n for n in (0, 1, 19, 20, 21, 512, 513, 1024)]
    got = values(texts, ONE, lambda: R.length_reward(F.col("completion")))
    assert got == pytest.approx([0.0, 0.05, 0.95, 1.0, 1.0, 1.0, 512 / 513, 0.5])


def test_composite_orderings(values):
    work = "Seven boxes\nhold six pens\nor 42 pens\n#### "
    cases = [
        (work + "13", "42"),
        (work + "42", "42"),
        ("Of 42 pens sold, 9 are blue", "42"),
        ("Of 9 boxes sold, pens are 42", "42"),
    ]
    scores = values(cases, C, REF(R.composite_reward))
    assert scores[0] < scores[1] and scores[2] < scores[3]
    assert all(0.0 <= s <= 1.0 for s in scores)
    n = len((work + "42").split())
    assert scores[1] == pytest.approx((1.0 + 0.3 + 0.2 * 1.0 + 0.1 * n / 20) / 1.6)


def test_selection_and_weights(values):
    case = [("#### 42", "42")]

    def score(*selected):
        return values(case, C, REF(R.create_reward(selected=selected)))[0]

    assert score(*R.COMPONENTS) == pytest.approx((1.0 + 0.3 + 0.2 * 0.7 + 0.1 * 0.1) / 1.6)
    assert score() == 0.0
    assert score("format") == pytest.approx(0.7)
    assert score("length") == pytest.approx(0.1)
    with pytest.raises(ValueError):
        R.combine({}, RewardWeights(0, 0, 0, 0))
    with pytest.raises(ValueError):
        R.combine_selected({}, ["style"])
    assert R.COMPONENTS == ("exact_match", "soft_numeric", "format", "length")
    assert RewardWeights.from_config(RewardConfig(format_weight=0.5)).format == 0.5


def test_array_layout_matches_long_layout(spark):
    texts = ["#### 1", "#### 2", "no", "It is 1."]
    arrays = spark.createDataFrame([(1, "1", texts), (2, "2", [])], "prompt_id long, reference string, completions array<string>")
    got = {r["prompt_id"]: r["rewards"] for r in scoring.group_rewards(arrays).collect()}
    long = spark.createDataFrame([(i, t, "1") for i, t in enumerate(texts)], "i int, completion string, reference string")
    want = [r["reward"] for r in scoring.score(long).orderBy("i").collect()]
    assert got[1] == pytest.approx(want) and got[2] == []
    assert got[1][0] > got[1][1]


def test_array_advantages(values):
    rng = random.Random(4)
    groups = [[0.2, 0.5, 0.8, 1.0, 0.0], [0.5] * 5, [0.7], []] + [
        [rng.random() for _ in range(rng.randint(1, 9))] for _ in range(50)
    ]
    got = values([(g,) for g in groups], "r array<double>", lambda: R.group_advantages(F.col("r")))
    for rewards, advantages in zip(groups, got):
        want = []
        if rewards:
            mean, spread = statistics.mean(rewards), statistics.pstdev(rewards) + 1e-8
            want = [(r - mean) / spread for r in rewards]
        assert advantages == pytest.approx(want, abs=1e-6)


def test_chat_completions(spark):
    schema = "id int, completion array<struct<role:string,content:string>>"
    rows = [(1, [("user", "q"), ("assistant", "#### 3")]), (2, []), (3, None), (4, [("assistant", None)])]
    texts = scoring.as_text(spark.createDataFrame(rows, schema)).orderBy("id").collect()
    assert [r["completion"] for r in texts] == ["#### 3", "", "", ""]


def test_custom_reward_accepts_pandas_udf(spark):
    @pandas_udf("double")
    def same_length(completion: pd.Series, reference: pd.Series) -> pd.Series:
        return (completion.str.len() == reference.str.len()).astype("float64")

    rows = [(1, 0, "42", "42"), (1, 1, "4", "42")]
    df = spark.createDataFrame(rows, COMPLETIONS)
    got = scoring.custom_rewards(df, same_length).orderBy("gen_idx").collect()
    assert [r["reward"] for r in got] == [1.0, 0.0]


def test_contract(spark):
    row = scoring.with_contract(spark.range(1)).first().asDict()
    assert row["contract_version"] == "v1" and row["format_weight"] == 0.2
    assert row["answer_extraction_policy"] == "prefer_####_then_last_numeric"
    assert scoring.with_contract(spark.range(1), grammar="full").first()["contract_version"] == "v1-full-digits"


def test_reward_matrix_sums(spark):
    df = spark.createDataFrame([("#### 42", "42")], C)
    row = scoring.reward_matrix(df).first()
    assert row["reward_sum"] == pytest.approx(1.0 + 1.0 + 0.7 + 0.1)
    assert row["weighted_sum"] == pytest.approx(1.0 + 0.3 + 0.2 * 0.7 + 0.1 * 0.1)


def test_multi_rewards(spark):
    df = spark.createDataFrame([(1, 0, "#### 42", "42")], COMPLETIONS)
    rewards = {"a": R.exact_match_reward, "b": lambda c, r: F.lit(0.5)}
    row = scoring.multi_rewards(df, rewards, {"a": 3.0}).first()
    assert (row["a"], row["b"], row["reward_sum"], row["weighted_sum"]) == (1.0, 0.5, 1.5, 3.5)
    with pytest.raises(ValueError):
        scoring.multi_rewards(df, {})


def test_null_completion_scores_as_empty_text_in_both_layouts(spark):
    row = spark.sql("SELECT array(CAST(NULL AS STRING), '') AS c, CAST(NULL AS STRING) AS one, '4' AS r").select(
        R.group_rewards(F.col("c"), F.col("r")).alias("many"), R.composite_reward(F.col("one"), F.col("r")).alias("long")
    ).first()
    assert row["many"] == [0.0, 0.0] and row["long"] == 0.0
