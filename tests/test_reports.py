import pytest
from pyspark.sql import functions as F

from rollout_quality.config import BuildConfig
from rollout_quality.operators import leakage, prepare, report
from rollout_quality.operators.gates import QualityGateError, enforce, quality_gates

RAW = "src_id long, split string, question string, answer string"


def measured(spark, rows, cfg=BuildConfig()):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], RAW)
    return prepare.with_metrics(prepare.process_split(df, cfg))


def questions(spark, **splits):
    rows = [(s, q) for s, qs in splits.items() for q in qs]
    return spark.createDataFrame(rows, "split string, question string")


def test_split_report(spark):
    rows = measured(
        spark,
        [
            ("train", "Same question", "A. #### 1"),
            ("train", " Same question\n", "A. B. C. D. E. #### -2"),
            ("train", "Same Question", "A. #### 0.5"),
            ("train", "Bad", "none"),
        ],
    )
    got = {r["split"]: r for r in report.split_report(rows, ("train", "test"), 20).collect()}
    train = got["train"]
    assert (train["record_count"], train["failed_count"], train["raw_count"]) == (3, 1, 4)
    assert train["duplicate_prompt_count"] == 1  # exact after stripping; the third differs in case
    assert (train["difficulty_easy"], train["difficulty_medium"]) == (2, 1)
    assert (train["answer_integer"], train["answer_negative_integer"], train["answer_decimal"]) == (1, 1, 1)
    assert train["min_words"] == train["max_words"] == train["avg_words"] > 20
    assert train["truncation_risk_count"] == 3
    empty = got["test"].asDict()
    assert {v for k, v in empty.items() if k not in ("ord", "split")} == {0}
    assert report.duplicate_prompts(rows).first()["duplicate_prompt_count"] == 1
    reasons = report.failure_reasons(rows).collect()
    assert [(r["error_code"], r["n"]) for r in reasons] == [("no_marker", 1)]


def test_report_without_difficulty(spark):
    cfg = BuildConfig(add_difficulty=False)
    rows = measured(spark, [("train", "Q", "A. #### 1")], cfg)
    assert report.split_report(rows, ("train",)).first()["difficulty_easy"] == 0


def test_leakage_clean_and_dirty(spark):
    splits = ("train", "test")
    clean = questions(spark, train=["What is 2+2?", "Solve for x."], test=["What is 3+3?", "Find area."])
    assert leakage.cross_split_overlap(clean, splits).collect() == [("train__test", 0)]
    dirty = questions(spark, train=["What is 2+2?", "Unique."], test=[" what IS  2+2?", "Different."])
    rows = {r["scope"]: r for r in leakage.leakage_report(dirty, splits).collect()}
    assert rows["train__test"]["duplicate_count"] == 1
    assert rows["train__test"]["examples"] == ["what is 2+2?"]
    assert rows["train"]["duplicate_count"] == rows["test"]["duplicate_count"] == 0


@pytest.mark.parametrize("broadcast_rows", [1_000, 0])
def test_three_splits_match_brute_force(spark, broadcast_rows):
    splits = ("a", "b", "c")
    data = {
        "a": [f"Question {i % 13}" for i in range(40)] + ["Hot one"] * 200,
        "b": [f"question  {i}" for i in range(0, 20, 2)] + ["hot ONE"] * 100,
        "c": ["QUESTION 4", "only here"],
    }
    df = questions(spark, **data)
    prints = {s: [" ".join(q.lower().split()) for q in qs] for s, qs in data.items()}
    counts = leakage.question_counts(df, splits)
    got = {r["scope"]: r["duplicate_count"] for r in leakage.leakage_counts(counts, splits).collect()}
    want = {s: len(p) - len(set(p)) for s, p in prints.items()}
    shared = {
        f"{a}__{b}": set(prints[a]) & set(prints[b]) for a, b in (("a", "b"), ("a", "c"), ("b", "c"))
    }
    assert got == want | {k: len(v) for k, v in shared.items()}
    texts = leakage.overlap_texts(df, counts, splits, broadcast_rows).collect()
    found = {k: sorted(r["question"] for r in texts if r["pair"] == k) for k in shared}
    assert found == {k: sorted(v) for k, v in shared.items()}
    shown = leakage.overlap_examples(df, counts, splits, 5).orderBy("pair", "rank").collect()
    assert [r["question"] for r in shown if r["pair"] == "a__b"] == sorted(shared["a__b"])[:5]
    assert {r["question"] for r in leakage.fingerprint_intersect(df, "a", "b").collect()} == shared["a__b"]


def test_missing_questions_are_no_duplicates(spark):
    df = questions(spark, train=[None, None, "x"], test=[None, "y"])
    counted = leakage.leakage_counts(leakage.question_counts(df, ("train", "test")), ("train", "test"))
    assert [r["duplicate_count"] for r in counted.orderBy("ord").collect()] == [0, 0, 0]


def test_single_split(spark):
    df = questions(spark, train=["x", "X "])
    off = leakage.within_split_duplicates(df, ("train",)).collect()
    on = leakage.within_split_duplicates(df, ("train",), check_single_split=True).collect()
    assert (off[0]["duplicate_count"], on[0]["duplicate_count"]) == (0, 1)
    assert leakage.leakage_report(df, ("train",)).collect()[0]["examples"] == []


def test_gate_messages(spark):
    cfg = BuildConfig(splits=("train", "test"), max_prompt_length=2)
    rows = measured(
        spark,
        [
            ("train", "Same", "A. #### 1"),
            ("train", "Same", "A. #### 1"),
            ("train", "Bad", "none"),
            ("test", "same", "A. #### 1"),
        ],
        cfg,
    )
    summary = report.split_report(rows, cfg.splits, cfg.max_prompt_length)
    counts = leakage.question_counts(prepare.accepted(rows), cfg.splits)
    found = quality_gates(summary, leakage.leakage_counts(counts, cfg.splits), cfg)
    assert [r["message"] for r in found.orderBy("seq").collect()] == [
        "train parse/drop rate 0.3333 exceeds max_parse_error_rate=0.0100",
        "train has 1 duplicate prompt(s)",
        "train truncation risk rate 1.0000 (2/2 prompts) exceeds max_truncation_risk_rate=0.0000",
        "test truncation risk rate 1.0000 (1/1 prompts) exceeds max_truncation_risk_rate=0.0000",
        "train has 1 duplicate question(s) within split",
        "cross-split leakage detected in train__test: 1 duplicate question(s)",
    ]
    with pytest.raises(QualityGateError, match=r"0\.0100 \| train has 1 duplicate prompt"):
        enforce(found)
    enforce(found.where(F.lit(False)))


def test_results_do_not_depend_on_partitioning(spark):
    rows = [("train" if i % 3 else "test", f"Question {i % 7}", f"A. #### {i % 4}") for i in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], RAW)
    seen = set()
    for n in (1, 5, 11):
        rows_n = prepare.with_metrics(prepare.process_split(df.repartition(n)))
        summary = report.split_report(rows_n, ("train", "test")).orderBy("ord").collect()
        leaks = leakage.leakage_report(prepare.accepted(rows_n), ("train", "test")).orderBy("ord").collect()
        seen.add((str(summary), str(leaks)))
    assert len(seen) == 1


def test_examples_with_equal_starts(spark):
    """Questions that share their first characters are ordered by what follows, copies shown once."""
    head = "word " * 30
    texts = [f"{head}{n}" for n in (5, 3, 9, 1, 7, 2, 8, 3, 3)]
    rows = [(i, s, t) for s in ("train", "test") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "idx long, split string, question string")
    counts = leakage.question_counts(df, ("train", "test"))
    shown = leakage.overlap_examples(df, counts, ("train", "test"), 3).orderBy("rank").collect()
    assert [r["question"][-1] for r in shown] == ["1", "2", "3"]
