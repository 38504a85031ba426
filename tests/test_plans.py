"""The physical plans keep the properties that make the jobs scale."""

import re

import pytest
from pyspark.sql import functions as F

from rollout_quality.operators import groups, prepare, report, scoring
from rollout_quality.plans.evaluate import score_against
from rollout_quality.queries import spark as q
from rollout_quality.sources import derived, tables

DIRECTORY = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return [line for line in text.splitlines() if re.search(r"Exchange (hash|range|Single|RoundRobin)", line)]


def shuffles(text):
    """Exchanges other than the spreading of a small input."""
    return [x for x in exchanges(text) if "REPARTITION_BY_NUM" not in x]


@pytest.mark.parametrize(
    "name",
    ["composite_reward", "reward_matrix", "process_split", "group_advantages", "evaluate", "split_report", "batch_plan"],
)
def test_no_python_and_no_single_partition_of_rows(spark, name):
    text = plan(q.QUERIES[name](spark, DIRECTORY))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    if name != "evaluate":  # its total is over a handful of per-difficulty sums
        assert "SinglePartition" not in text


def test_scoring_needs_no_shuffle(spark):
    assert shuffles(plan(q.QUERIES["composite_reward"](spark, DIRECTORY))) == []
    assert shuffles(plan(q.QUERIES["group_rewards"](spark, DIRECTORY))) == []


def test_advantages_take_one_exchange_and_one_window(spark, tmp_path):
    derived.completions(spark, DIRECTORY).write.parquet(f"{tmp_path}/c")
    stored = spark.read.parquet(f"{tmp_path}/c")
    rewards = scoring.score(stored).select("prompt_id", "gen_idx", "reward")
    text = plan(groups.group_advantages(rewards))
    assert len(exchanges(text)) == 1 and len(re.findall(r"\bWindow \[", text)) == 1


def test_size_check_reads_one_column(spark, tmp_path):
    derived.completions(spark, DIRECTORY).write.parquet(f"{tmp_path}/c")
    scored = scoring.score(spark.read.parquet(f"{tmp_path}/c"))
    text = plan(scored.groupBy("prompt_id").count())
    assert "ReadSchema: struct<prompt_id:bigint>" in text


def test_texts_stay_out_of_the_join(spark, tmp_path, capsys):
    derived.completions(spark, DIRECTORY).drop("reference").write.parquet(f"{tmp_path}/c")
    stored = spark.read.parquet(f"{tmp_path}/c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        score_against(stored, q.labelled_targets(spark, DIRECTORY)).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    features = [x for x in moved if "predicted" in x]
    assert features and not any("completion" in x for x in features)


def test_split_filter_and_columns_reach_the_scan(spark, tmp_path):
    derived.qa_raw(spark, DIRECTORY).write.parquet(f"{tmp_path}/q")
    text = plan(tables.load_qa(spark, f"{tmp_path}/q", ["test"]).select("src_id"))
    assert "In(split, [test])" in text or "EqualTo(split,test)" in text
    assert "ReadSchema: struct<src_id:bigint,split:string>" in text


def test_saved_split_is_pruned(spark, tmp_path):
    view = prepare.trainer_view(q.processed(spark, DIRECTORY))
    view.write.partitionBy("split").parquet(f"{tmp_path}/t")
    text = plan(tables.read_split(spark, f"{tmp_path}/t", "test").select("reference_answer"))
    assert "ReadSchema: struct<reference_answer:string>" in text
    assert re.search(r"PartitionFilters: \[.*split", text)


def test_good_rows_are_not_parsed_twice(spark):
    text = plan(q.QUERIES["trainer_view"](spark, DIRECTORY))
    filters = [x for x in text.splitlines() if re.search(r"Filter .*error", x)]
    assert filters and not any("regexp" in x or "locate" in x for x in filters)


def test_answer_is_extracted_once(spark):
    text = plan(q.QUERIES["reward_matrix"](spark, DIRECTORY))
    assert text.count("regexp_extract_all(completion") <= 3  # fraction, number and word scans, once each


def test_examples_use_a_per_partition_limit(spark):
    text = plan(q.QUERIES["overlap_examples"](spark, DIRECTORY))
    assert "WindowGroupLimit" in text


def test_hot_prompts_store_no_text(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(groups, "cut_lineage", lambda df: stored.append(df.columns) or df)
    texts = derived.completions(spark, DIRECTORY).withColumn("prompt_id", F.col("prompt_id") % 3)
    got = groups.group_step(texts, hot_rows=10)
    assert stored == [["__key", "__mean", "__std"]]
    want = groups.group_step(texts, hot_rows=10**9)
    columns = ("prompt_id", "gen_idx", "completion", "reward")
    assert got.columns == want.columns and got.select(*columns).exceptAll(want.select(*columns)).count() == 0
    gap = got.agg(F.avg(F.abs("advantage"))).first()[0] - want.agg(F.avg(F.abs("advantage"))).first()[0]
    assert abs(gap) < 1e-9


def test_the_summary_of_a_build_is_not_read_by_the_task_that_writes_it(spark):
    """The written report is one file: what it holds must reach its task by an exchange, not by a scan of all records."""
    records = prepare.trainer_view(prepare.process_split(derived.qa_raw(spark, DIRECTORY)))
    text = plan(report.dataset_summary(records).coalesce(1))
    assert "Coalesce 1" in text and "REPARTITION_BY_COL" in text
    assert text.index("REPARTITION_BY_COL") < text.index("Join")
