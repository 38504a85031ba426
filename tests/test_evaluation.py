import pytest
from pyspark.sql import functions as F

from rollout_quality.config import EvalConfig
from rollout_quality.operators import evaluation, prepare
from rollout_quality.plans.evaluate import evaluate

SCORED = "difficulty string, exact_match double, reward double, format double"


def test_metrics(spark):
    df = spark.createDataFrame(
        [("easy", 1.0, 0.9, 1.0), ("easy", 0.0, 0.1, 0.3), (None, 1.0, 0.8, 0.7)], SCORED
    )
    row = evaluation.eval_summary(df).first()
    assert row["num_samples"] == 3
    assert row["exact_match_accuracy"] == pytest.approx(2 / 3)
    assert row["mean_composite_reward"] == pytest.approx(0.6)
    assert row["mean_format_reward"] == pytest.approx(2 / 3)
    by = {r["difficulty"]: r for r in evaluation.eval_by_difficulty(df).collect()}
    assert set(by) == {"easy", "unknown"} and by["easy"]["n"] == 2
    assert by["easy"]["mean_reward"] == pytest.approx(0.5)
    rolled = {(r["difficulty"], r["level"]): r["n"] for r in evaluation.eval_rollup(df).collect()}
    assert rolled == {("easy", 0): 2, ("unknown", 0): 1, ("all", 1): 3}


def test_empty(spark):
    df = spark.createDataFrame([], SCORED)
    assert tuple(evaluation.eval_summary(df).first()) == (0, 0.0, 0.0, 0.0)
    assert evaluation.eval_by_difficulty(df).count() == 0
    assert evaluation.eval_summary(df.drop("difficulty")).first()["num_samples"] == 0


def test_end_to_end(spark, tmp_path):
    raw = spark.createDataFrame(
        [(i, "test", f"Question {i}?", f"Because. #### {i}") for i in range(6)],
        "src_id long, split string, question string, answer string",
    )
    records = prepare.trainer_view(prepare.process_split(raw))
    completions = spark.createDataFrame(
        [(i, 0, f"So:\n\nit is\n#### {i if i % 2 else 99}") for i in range(6)],
        "prompt_id long, gen_idx int, completion string",
    )
    result = evaluate(completions, records, EvalConfig(model_name="m"), str(tmp_path))
    assert result.summary.first()["num_samples"] == 6
    assert result.summary.first()["exact_match_accuracy"] == pytest.approx(0.5)
    written = spark.read.json(f"{tmp_path}/eval_results").first()
    assert written["model_name"] == "m" and written["by_difficulty"][0]["n"] == 6
    few = evaluate(completions, records, EvalConfig(num_samples=3))
    assert few.summary.first()["num_samples"] == 3
    none = evaluate(completions, records, EvalConfig(split="train"))
    assert none.summary.first()["num_samples"] == 0
    with pytest.raises(ValueError):
        EvalConfig(num_samples=-1)
    with pytest.raises(ValueError):
        evaluation.eval_sample(records, -1)
    assert [r["idx"] for r in evaluation.eval_sample(records, 2).collect()] == [0, 1]
    assert records.where(F.col("idx") == 5).first()["reference_answer"] == "5"
