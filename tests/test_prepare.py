import random

import pytest
from pyspark.sql import functions as F

from rollout_quality.config import BuildConfig
from rollout_quality.functions import records as R
from rollout_quality.operators import batching, indexing, prepare
from rollout_quality.schemas import ANALYSIS_FIELDS, PUBLIC_FIELDS

RAW = "src_id long, split string, question string, answer string"


def raw(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], RAW)


def test_parse(spark):
    df = raw(
        spark,
        ("train", "q", "Work it out.\n#### 8"),
        ("train", "q", "No marker " + "x" * 100),
        ("train", "q", "First #### 1 then #### 2"),
        ("train", "q", "a #### none given "),
        ("train", "q", None),
        ("train", "q", "#### 5/0"),
    )
    got = {r["src_id"]: r for r in prepare.parse_solutions(df).collect()}
    assert (got[0]["reference_solution"], got[0]["reference_answer"]) == ("Work it out.", "8")
    assert got[1]["error"] == "parse_error:No '####' found in solution: " + ("No marker " + "x" * 100)[:80]
    assert (got[2]["reference_solution"], got[2]["reference_answer"]) == ("First", "1")
    assert got[3]["error"] == "parse_error:Cannot parse numeric answer from: 'none given'"
    assert [got[i]["error_code"] for i in range(6)] == [
        None,
        "no_marker",
        None,
        "unparseable_answer",
        "no_marker",
        "unparseable_answer",
    ]


def test_difficulty_edges(values):
    texts = [" ".join(f"S{i}." for i in range(n)) for n in (0, 1, 4, 5, 9, 10)] + ["Step one. Step two.", None]
    want = ["easy", "easy", "easy", "medium", "medium", "hard", "easy", None]
    assert values(texts, "t string", lambda: R.difficulty(F.col("t"))) == want


def test_prompt_render_and_fingerprint(spark):
    df = spark.createDataFrame([(' What "is" é?\n',)], "question string")
    row = prepare.build_prompts(df, "Be kind.").select(
        "prompt_messages",
        R.render_prompt(F.col("prompt_messages")).alias("text"),
        R.prompt_words(F.col("prompt_messages")).alias("words"),
        R.prompt_fingerprint(F.col("prompt_messages")).alias("key"),
    ).first()
    assert [m["role"] for m in row["prompt_messages"]] == ["system", "user"]
    assert row["prompt_messages"][1]["content"] == 'What "is" é?'
    assert row["text"] == '[SYSTEM]\nBe kind.\n\n[USER]\nWhat "is" é?\n\n[ASSISTANT]'
    assert row["words"] == 5
    assert row["key"] == (
        '[{"content":"Be kind.","role":"system"},{"content":"What \\"is\\" é?","role":"user"}]'
    )


def test_process_and_views(spark):
    df = raw(
        spark,
        ("train", " Q one? ", "Because. #### 4"),
        ("train", "Q two?", "bad"),
        ("test", "  ", "So. #### 5"),
        ("train", "Q three?", "Thus. #### 6"),
        ("test", None, "So. #### 7"),
    )
    processed = prepare.process_split(df)
    rows = {(r["split"], r["idx"]): r for r in processed.collect()}
    assert set(rows) == {("train", 0), ("train", 1), ("train", 2), ("test", 0), ("test", 1)}
    assert rows["test", 0]["error"] == "empty_question;empty_prompt_content:1"
    assert rows["test", 1]["error_code"] == "empty_question"
    good = rows["train", 2]
    assert good["metadata"].asDict() == {"original_idx": 2, "difficulty": "easy"}
    assert rows["train", 1]["metadata"] is None and rows["train", 1]["prompt_messages"] is None
    trainer, analysis = prepare.trainer_view(processed), prepare.analysis_view(processed)
    assert tuple(trainer.columns) == PUBLIC_FIELDS and tuple(analysis.columns) == ANALYSIS_FIELDS
    assert trainer.count() == 2 and prepare.quarantined(processed).count() == 3
    assert prepare.rl_input_view(trainer).columns == ["prompt", "reference_answer"]
    assert prepare.filter_difficulty(trainer, "hard").count() == 0
    # Produced records pass the general validator.
    assert [r["errors"] for r in prepare.validate_records(trainer, "idx").collect()] == ["", ""]


def test_no_difficulty_and_blank_system_prompt(spark):
    df = raw(spark, ("train", "Q?", "So. #### 5"))
    plain = prepare.process_split(df, BuildConfig(add_difficulty=False))
    assert plain.schema["metadata"].dataType.names == ["original_idx"]
    blank = prepare.process_split(df, BuildConfig(system_prompt="  ")).first()
    assert blank["error"] == "empty_prompt_content:0"


def test_validation_codes(spark):
    message = "array<struct<role:string,content:string>>"
    schema = (
        f"idx long, split string, question string, reference_answer string, prompt_messages {message}, "
        "metadata struct<original_idx:long>, want long"
    )
    ok = [("system", "s"), ("user", "u")]
    rows = [
        (0, "a", "q", "4", ok, (0,), 0),
        (1, "a", "q", "4", ok, (0,), 0),
        (0, "a", " ", "x", None, None, 0),
        (0, "a", "q", "4", [("user", "bad")], (0,), 0),
        (0, "a", "q", "4", [("user", "u"), ("system", " ")], (0,), 0),
        (0, "a", "q", "4", [None, ("user", None)], (0,), 0),
        (0, "a", None, None, ok, (0,), 0),
    ]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    assert [r["errors"] for r in prepare.validate_records(df, "want").collect()] == [
        "",
        "unstable_idx",
        "empty_question;invalid_reference_answer;invalid_metadata;invalid_prompt_messages",
        "invalid_prompt_messages",
        "invalid_prompt_roles;empty_prompt_content:1",
        "invalid_prompt_roles;prompt_message_not_dict:0;empty_prompt_content:1",
        "empty_question;invalid_reference_answer",
    ]
    missing = prepare.validate_records(df.drop("prompt_messages", "split")).first()["errors"]
    assert missing == "missing_fields:split,prompt_messages"
    wrong = df.withColumns({"question": F.lit(3), "metadata": F.lit("x"), "prompt_messages": F.lit("y")})
    assert prepare.validate_records(wrong).first()["errors"] == (
        "empty_question;invalid_metadata;invalid_prompt_messages"
    )


@pytest.mark.parametrize("rows_per_bucket", [1_000, 37, 3])
@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_match_brute_force(spark, rows_per_bucket, partitions):
    rng = random.Random(rows_per_bucket)
    # Keys crowd in one narrow range, and one split holds most rows.
    keys = rng.sample(range(1_000), 300) + rng.sample(range(10**9, 10**12), 60)
    rows = [(k, "train" if rng.random() < 0.8 else "test") for k in keys]
    df = spark.createDataFrame(rows, "src_id long, split string").repartition(partitions)
    got = {
        (r["split"], r["src_id"]): r["idx"]
        for r in prepare.index_split(df, rows_per_bucket=rows_per_bucket).collect()
    }
    want = {}
    for split in ("train", "test"):
        ordered = sorted(k for k, s in rows if s == split)
        want.update({(split, k): i for i, k in enumerate(ordered)})
    assert got == want


def test_equal_keys_are_kept(spark):
    df = spark.createDataFrame([(5, "a", i) for i in range(40)] + [(9, "a", 99)], "src_id long, split string, n int")
    out = prepare.index_split(df, ties=["n"], rows_per_bucket=4).orderBy("idx").collect()
    assert [r["n"] for r in out] == list(range(40)) + [99]
    assert [r["idx"] for r in out] == list(range(41))


@pytest.mark.parametrize("rows_per_bucket", [1_000, 5])
def test_missing_keys_and_splits_are_kept(spark, rows_per_bucket):
    rows = [(None, "a"), (None, "a"), (7, None)] + [(i, "a") for i in range(30)] + [(i, None) for i in range(20, 25)]
    df = spark.createDataFrame(rows, "src_id long, split string")
    out = prepare.index_split(df, rows_per_bucket=rows_per_bucket).collect()
    assert sorted(r["idx"] for r in out if r["split"] == "a") == list(range(32))
    assert {r["src_id"]: r["idx"] for r in out if r["split"] is None} == {7: 0, 20: 1, 21: 2, 22: 3, 23: 4, 24: 5}
    assert {r["idx"] for r in out if r["src_id"] is None} == {0, 1}
    with pytest.raises(TypeError):
        prepare.index_split(df, key="split")


@pytest.mark.parametrize("rows_per_bucket", [1_000, 10])
def test_equal_and_missing_keys_keep_their_position_under_any_partitioning(spark, rows_per_bucket):
    rows = [(7, "a", i) for i in range(150)] + [(None, "a", i) for i in range(150)] + [(i, "a", i) for i in range(20)]
    df = spark.createDataFrame(rows, "src_id long, split string, n int")
    runs = [
        sorted((r["idx"], r["src_id"], r["n"]) for r in prepare.index_split(part, rows_per_bucket=rows_per_bucket).collect())
        for part in (df.repartition(3), df.repartition(8, "n"))
    ]
    assert runs[0] == runs[1]
    assert [i for i, _, _ in runs[0]] == list(range(320))
    keys = [k for _, k, _ in runs[0]]
    assert keys[:150] == [None] * 150 and keys[150:] == sorted(keys[150:])


def _with_ties(spark, n=400):
    rng = random.Random(n)
    words = [None, "", "a", "ab", "é", *(f"w{i}" for i in range(40))]
    rows = [(7 if i % 3 else None, "a" if i % 2 else "b", rng.choice(words), i) for i in range(n)]
    rows += [(i, rng.choice(["a", "b", None]), rng.choice(words), i) for i in range(100)] + [(7, "a", "same", 5)] * 30
    return rows, spark.createDataFrame(rows, "src_id long, split string, word string, n int")


@pytest.mark.parametrize("rows_per_bucket", [1_000, 20, 3])
@pytest.mark.parametrize("partitions", [1, 6])
def test_hot_keys_follow_the_order_of_the_ties(spark, rows_per_bucket, partitions):
    rows, df = _with_ties(spark)
    placed = prepare.index_split(df.repartition(partitions), ties=["word", "n"], rows_per_bucket=rows_per_bucket).collect()
    for split in ("a", "b", None):
        # Null first, then by the bytes of the text.
        own = sorted(
            (r for r in rows if r[1] == split),
            key=lambda r: (r[0] is not None, r[0] or 0, r[2] is not None, (r[2] or "").encode(), r[3]),
        )
        got = sorted((r["idx"], r["src_id"], r["word"], r["n"]) for r in placed if r["split"] == split)
        assert got == [(i, r[0], r[2], r[3]) for i, r in enumerate(own)]


def test_missing_keys_alone_are_cut_too(spark):
    df = spark.range(300).select(
        F.when(F.col("id") >= 200, F.col("id")).alias("src_id"), F.lit("a").alias("split"), F.col("id").alias("n")
    )
    plan = prepare.index_split(df, ties=["n"], rows_per_bucket=20)
    assert [r["n"] for r in plan.orderBy("idx").collect()] == list(range(300))
    assert [r["idx"] for r in plan.orderBy("idx").collect()] == list(range(300))


def test_one_key_on_a_third_of_the_rows_fills_no_single_window(spark, monkeypatch):
    kept = {}
    store = indexing.write_and_reread
    monkeypatch.setattr(indexing, "write_and_reread", lambda df, name: kept.setdefault(name, store(df, name)))
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 10).cast("long").alias("src_id"),
        F.lit("a").alias("split"), (F.col("id") % 5).cast("string").alias("word"),
    )
    placed = indexing.with_position(df, "src_id", ties=["word"], rows_per_bucket=200)
    assert placed.agg(F.countDistinct("idx"), F.max("idx")).first()[:] == (9_000, 8_999)
    sizes = [r["count"] for r in kept["ranges"].groupBy("__part").count().collect()]
    assert sum(sizes) == 3_000 and max(sizes) <= 600


def test_empty_table(spark):
    df = spark.createDataFrame([], "src_id long, split string")
    assert indexing.with_position(df, "src_id").count() == 0


def test_batches(spark):
    message = [("system", "a b"), ("user", "c")]
    rows = [(i * 3, "train", message) for i in range(10)] + [(i, "test", message) for i in range(4)]
    df = spark.createDataFrame(rows, "idx long, split string, prompt_messages array<struct<role:string,content:string>>")
    plan = {(r["split"], r["batch_no"]): r for r in batching.batch_plan(df, 4).collect()}
    assert {k: v["batch_size"] for k, v in plan.items()} == {
        ("train", 0): 4,
        ("train", 1): 4,
        ("train", 2): 2,
        ("test", 0): 4,
    }
    assert plan["train", 1]["first_idx"] == 12 and plan["train", 1]["max_words"] == 3
    shuffled = batching.assign_batches(df, 4, seed=7, rows_per_bucket=3).where("split = 'train'").collect()
    again = batching.assign_batches(df.repartition(3), 4, seed=7).where("split = 'train'").collect()
    order = {r["idx"]: r["position"] for r in shuffled}
    assert order == {r["idx"]: r["position"] for r in again}
    assert sorted(order.values()) == list(range(10))
    assert [i for i, _ in sorted(order.items(), key=lambda x: x[1])] != sorted(order)
    steps = {r["split"]: r["steps"] for r in batching.steps_per_epoch(df, 4).collect()}
    assert steps == {"train": 3, "test": 1}
    with pytest.raises(ValueError):
        batching.assign_batches(df, 0)
