import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rollout_quality import BuildConfig, QualityGateError, build_dataset, session
from rollout_quality.plans import build_dataset as build, commit
from rollout_quality.schemas import PUBLIC_FIELDS, record_type
from rollout_quality.sources import sinks, tables

RAW = "src_id long, split string, question string, answer string"
ROWS = [
    (0, "train", "What is 2 + 2?", "Add them.\n#### 4"),
    (1, "train", "What is 10 / 2?", "Divide the number.\n#### 5"),
    (2, "test", "What is 3 + 3?", "Add them.\n#### 6"),
]


def table(spark, rows):
    return spark.createDataFrame(rows, RAW)


def lines(folder):
    return [json.loads(x) for f in sorted(Path(folder).glob("*.json")) for x in f.read_text().splitlines()]


def test_artifacts(spark, tmp_path):
    result = build_dataset(table(spark, ROWS), str(tmp_path))
    assert result.trainer.count() == 3 and set(result.trainer.columns) == set(PUBLIC_FIELDS)
    trainer, analysis = lines(tmp_path / "trainer/jsonl/train"), lines(tmp_path / "analysis/jsonl/train")
    assert set(trainer[0]) == set(PUBLIC_FIELDS)
    assert list(trainer[0]) == sorted(PUBLIC_FIELDS)
    assert list(trainer[0]["prompt_messages"][0]) == ["content", "role"]
    assert [r["idx"] for r in trainer] == [0, 1] and analysis[0]["reference_solution"] == "Add them."
    manifest = lines(tmp_path / "reports/manifest")[0]
    assert manifest["pipeline_contract_version"] == "v1"
    assert manifest["reward_contract"]["contract_version"] == "v1"
    assert [s["split"] for s in manifest["splits"]] == ["train", "test"]
    assert manifest["config"]["max_prompt_length"] == 512
    assert [r["record_count"] for r in lines(tmp_path / "reports/validation_summary")] == [2, 1]
    assert len(lines(tmp_path / "reports/leakage_report")) == 3
    assert lines(tmp_path / "reports/violations") == []
    saved = tables.read_split(spark, f"{tmp_path}/trainer/parquet", "test")
    assert saved.columns == list(PUBLIC_FIELDS) and saved.first()["reference_answer"] == "6"
    full = tables.read_split(spark, f"{tmp_path}/analysis/parquet", "train", analysis=True)
    assert "reference_solution" in full.columns and full.count() == 2


def test_sinks_can_be_switched_off(spark, tmp_path):
    build_dataset(table(spark, ROWS), str(tmp_path), BuildConfig(save_jsonl=False, save_columnar=False))
    assert not (tmp_path / "trainer").exists() and (tmp_path / "reports/manifest").exists()


@pytest.mark.parametrize(
    "rows, settings, message",
    [
        ([(i, s, "Same question?", "Work.\n#### 1") for i, s in enumerate(("train", "test"))], {}, "leakage"),
        ([(0, "train", "Broken", "No marker")], {"splits": ("train",), "max_parse_error_rate": 0.0}, "parse/drop"),
        (
            [(0, "train", "word " * 600, "Math.\n#### 1")],
            {"splits": ("train",), "max_prompt_length": 100},
            "truncation risk",
        ),
        ([(i, "train", "Same?", "Work.\n#### 1") for i in (0, 1)], {"splits": ("train",)}, "duplicate prompt"),
    ],
)
def test_gates_stop_before_writing(spark, tmp_path, rows, settings, message):
    with pytest.raises(QualityGateError, match=message):
        build_dataset(table(spark, rows), str(tmp_path / "out"), BuildConfig(**settings))
    assert not (tmp_path / "out").exists()


def test_violations_can_be_reported_instead(spark, tmp_path):
    result = build_dataset(
        table(spark, [(0, "train", "Broken", "No marker"), *ROWS[1:]]), str(tmp_path), enforce_gates=False
    )
    assert [r["rule"] for r in result.violations.collect()] == ["parse_error_rate"]
    reasons = lines(tmp_path / "reports/failure_reasons")
    assert reasons[0]["error"] == "parse_error:No '####' found in solution: No marker"


def test_deterministic(spark, tmp_path):
    seen = []
    for name, parts in (("one", 1), ("two", 3)):
        out = tmp_path / name
        build_dataset(table(spark, ROWS).repartition(parts), str(out))
        seen.append((lines(out / "trainer/jsonl/train"), lines(out / "reports/validation_summary")))
    assert seen[0] == seen[1]


def test_jsonl_keeps_nulls_text_and_blank_lines(spark, tmp_path):
    rows = [(0, "train", "Größe “x” ?", "1", None, (0, None))]
    df = spark.createDataFrame(rows, record_type())
    sinks.write_jsonl(df, str(tmp_path / "j"), ["train"])
    text = "".join(f.read_text() for f in (tmp_path / "j/train").glob("*.json"))
    assert "Größe" in text and '"prompt_messages":null' in text and '"difficulty":null' in text
    (tmp_path / "j/train/extra.json").write_text(f"\n\n{text}\n   \n")
    back = tables.read_jsonl(spark, f"{tmp_path}/j/train", record_type())
    assert back.count() == 2 and back.first()["question"] == rows[0][2]
    (tmp_path / "j/train/bad.json").write_text("{oops\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        tables.read_jsonl(spark, f"{tmp_path}/j/train", record_type()).collect()


def test_no_difficulty_key_when_off(spark, tmp_path):
    build_dataset(table(spark, ROWS), str(tmp_path), BuildConfig(add_difficulty=False))
    assert list(lines(tmp_path / "trainer/jsonl/train")[0]["metadata"]) == ["original_idx"]


def test_sources(spark, tmp_path):
    df = table(spark, ROWS)
    df.write.parquet(f"{tmp_path}/p")
    df.write.json(f"{tmp_path}/j")
    assert tables.load_qa(spark, f"{tmp_path}/p", ["train"]).count() == 2
    assert tables.load_qa(spark, f"{tmp_path}/j", None, "json").count() == 3
    sizes = {r["split"]: r["n_rows"] for r in tables.split_sizes(df).collect()}
    assert sizes == {"train": 2, "test": 1}
    with pytest.raises(FileNotFoundError, match="build it first"):
        tables.read_split(spark, f"{tmp_path}/nothing", "train")
    with pytest.raises(ValueError):
        tables.load_qa(spark, f"{tmp_path}/p", fmt="csv")


def test_config_checks():
    with pytest.raises(ValueError):
        BuildConfig(splits=())
    with pytest.raises(ValueError):
        BuildConfig(splits=("a", "a"))
    with pytest.raises(ValueError):
        BuildConfig(grammar="loose")


def test_three_splits(spark, tmp_path):
    rows = [*ROWS, (3, "dev", "What is 4 + 4?", "#### 8"), (4, "ignored", "x", "#### 1")]
    cfg = BuildConfig(splits=("train", "dev", "test"))
    result = build_dataset(table(spark, rows), str(tmp_path), cfg)
    assert result.trainer.count() == 4
    pairs = result.leakage_report.where(F.col("kind") == "pair").orderBy("ord").collect()
    assert [r["scope"] for r in pairs] == ["train__dev", "train__test", "dev__test"]


def test_jsonl_files_follow_in_index_order(spark, tmp_path):
    rows = [(i * 7 % 100, "train", f"q{i}", "1", None, (0, None)) for i in range(100)]
    df = spark.createDataFrame(rows, record_type()).repartition(5)
    sinks.write_jsonl(df, str(tmp_path / "j"), ["train"], max_records_per_file=9)
    assert [r["idx"] for r in lines(tmp_path / "j/train")] == list(range(100))


def test_summary_is_part_of_a_build(spark, tmp_path):
    result = build_dataset(table(spark, ROWS), str(tmp_path))
    assert {r["split"]: r["n_rows"] for r in result.summary.collect()} == {"train": 2, "test": 1}
    assert {r["first_answer"] for r in lines(tmp_path / "reports/dataset_summary")} == {"4", "6"}


def files_of(folder):
    return sorted(str(f.relative_to(folder)) for f in Path(folder).rglob("*") if f.is_file())


@pytest.fixture
def shared(spark):
    """The shared folder, and what was in it before."""
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(files_of(folder))
    return lambda: [f for f in files_of(folder) if f not in before]


def test_working_tables_go_when_a_build_ends(spark, tmp_path, shared):
    result = build_dataset(table(spark, ROWS), str(tmp_path / "out"))
    assert shared() == [] and not (tmp_path / "out/_staging").exists()
    # All that is returned can still be read.
    assert result.trainer.count() == result.analysis.count() == result.processed.count() == 3
    assert result.split_report.count() == result.manifest.select(F.explode("splits")).count() == 2
    assert result.leakage_report.count() == 3 and result.violations.count() == 0
    assert str(tmp_path) in result.trainer.inputFiles()[0] and result.trainer.columns == list(PUBLIC_FIELDS)
    with pytest.raises(QualityGateError):
        build_dataset(table(spark, ROWS * 2), str(tmp_path / "other"))
    assert shared() == [] and not (tmp_path / "other").exists()


def test_shuffle_files_go_with_their_query(spark):
    """Inside a run; other queries of the session keep their setting."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def shuffled():
        return {f for d in folders for f in Path(d).rglob("shuffle_*.data")}

    before, setting = shuffled(), spark.conf.get(name, None)
    with session.WorkFolder(spark, "run"):
        with session.WorkFolder(spark, "other"):
            pass
        kept = session.write_and_reread(spark.range(1000).repartition(3), "kept")
        assert kept.count() == 1000
        until = time.time() + 10  # files are removed in the background
        while shuffled() - before and time.time() < until:
            time.sleep(0.1)
        assert not shuffled() - before
    assert spark.conf.get(name, None) == setting


def test_prompts_are_not_stored_with_the_working_rows(spark, tmp_path, monkeypatch):
    stored, store = [], build.write_and_reread
    monkeypatch.setattr(
        build, "write_and_reread", lambda df, *by, **how: stored.append(df.columns) or store(df, *by, **how)
    )
    bad = [(3, "train", "Broken", "No marker"), (4, "test", None, "Work.\n#### 1"), (5, "test", " a ", "Work.\n#### 1")]
    build_dataset(table(spark, ROWS + bad), str(tmp_path), enforce_gates=False)
    assert len(stored) == 1 and "question" in stored[0] and "prompt_messages" not in stored[0]
    written = lines(tmp_path / "analysis/jsonl/train") + lines(tmp_path / "analysis/jsonl/test")
    users = {r["question"]: r["prompt_messages"][1]["content"] for r in written}
    assert users == {r[2]: r[2].strip() for r in [*ROWS, bad[2]]}


def test_working_rows_go_before_the_last_artifact(spark, tmp_path, shared, monkeypatch):
    beside, write = [], build.write_columnar
    monkeypatch.setattr(
        build, "write_columnar", lambda df, *at, **how: beside.append(shared() != []) or write(df, *at, **how)
    )
    rows = [*ROWS, (3, "train", "Broken", "No marker"), (4, "train", "What?", "So.\n#### 7")]
    build_dataset(table(spark, rows), str(tmp_path), enforce_gates=False)
    assert beside == [True, False]
    for split in ("train", "test"):
        for name, analysis in (("trainer", False), ("analysis", True)):
            saved = tables.read_split(spark, f"{tmp_path}/{name}/parquet", split, analysis)
            plain = tables.read_jsonl(spark, f"{tmp_path}/{name}/jsonl/{split}", saved.schema)
            assert saved.orderBy("idx").collect() == plain.orderBy("idx").collect() != []


def test_texts_of_columnar_artifacts_are_packed_densely(spark, tmp_path):
    build_dataset(table(spark, ROWS), str(tmp_path))
    names = [f for f in files_of(tmp_path) if f.endswith(".parquet")]
    assert names and all(f.endswith(".zstd.parquet") for f in names)


def test_jsonl_rows_are_in_order_before_they_are_shaped(spark, tmp_path):
    plans = []

    def shaped(rows):
        plans.append(rows._jdf.queryExecution().logical().toString())
        return rows.withColumn("prompt", F.concat("question", F.lit("!")))

    df = spark.createDataFrame([(i * 7 % 20, "train", f"q{i}") for i in range(20)], "idx long, split string, question string")
    sinks.write_jsonl(df.repartition(3), str(tmp_path / "j"), ["train"], shape=shaped)
    assert all("Sort" in p for p in plans) and len(plans) == 1
    written = lines(tmp_path / "j/train")
    assert [r["idx"] for r in written] == list(range(20)) and all(r["prompt"] == r["question"] + "!" for r in written)


@pytest.mark.parametrize("settings", [{"save_columnar": False}, {"save_columnar": False, "save_jsonl": False}])
def test_returned_rows_without_columnar_artifact(spark, tmp_path, settings):
    result = build_dataset(table(spark, ROWS), str(tmp_path / "out"), BuildConfig(**settings))
    assert sorted(r["question"] for r in result.trainer.collect()) == sorted(r[2] for r in ROWS)
    assert result.analysis.columns[-1] == "reference_solution" and result.analysis.count() == 3


def test_build_that_fails_publishes_nothing(spark, tmp_path, shared, monkeypatch):
    out = tmp_path / "out"
    build_dataset(table(spark, ROWS), str(out))
    before = {f: (out / f).read_bytes() for f in files_of(out)}

    def broken(df, path):
        raise OSError("no space")

    monkeypatch.setattr(build, "write_report", broken)
    with pytest.raises(OSError, match="no space"):
        build_dataset(table(spark, ROWS[:2]), str(out), BuildConfig(splits=("train",)))
    assert {f: (out / f).read_bytes() for f in files_of(out)} == before and shared() == []


def test_killed_build_leaves_no_partial_artifact(spark, tmp_path, monkeypatch):
    """Killed while it writes: what it staged is not an artifact, and the next build drops it."""
    out = tmp_path / "out"
    monkeypatch.setattr(build, "write_report", lambda df, path: exec("raise KeyboardInterrupt"))
    monkeypatch.setattr(commit.StagedOutput, "__exit__", lambda *args: None)
    with pytest.raises(KeyboardInterrupt):
        build_dataset(table(spark, ROWS), str(out))
    assert {f.split("/")[0] for f in files_of(out)} <= {"_staging"} and commit.committed(spark, str(out)) is None
    monkeypatch.undo()
    build_dataset(table(spark, ROWS), str(out))
    assert not (out / "_staging").exists() and lines(out / "reports/manifest")


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_build_killed_while_publishing_is_carried_through(spark, tmp_path, monkeypatch, moves):
    out, done = tmp_path / "out", []
    build_dataset(table(spark, ROWS), str(out))
    move = commit.Files.move

    def dies(self, source, target):
        # The marks are moved too; artifacts are folders.
        if not source.endswith(".part"):
            done.append(target)
            if len(done) > moves:
                raise KeyboardInterrupt
        move(self, source, target)

    monkeypatch.setattr(commit.Files, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        build_dataset(table(spark, ROWS[:2]), str(out), BuildConfig(splits=("train",), save_jsonl=False))
    monkeypatch.undo()
    assert commit.committed(spark, str(out)) is None
    commit.recover(spark, str(out))
    assert commit.committed(spark, str(out))["parts"] == ["reports", "trainer/parquet", "analysis/parquet"]
    assert [s["split"] for s in lines(out / "reports/manifest")[0]["splits"]] == ["train"]
    assert tables.read_split(spark, f"{out}/trainer/parquet", "test").count() == 0
    assert not (out / "trainer/jsonl").exists() and not (out / "_staging").exists()


def test_no_folder_is_an_error_in_the_library(spark, monkeypatch):
    class Bare:
        sparkContext = type("C", (), {"getCheckpointDir": lambda self: None, "master": "spark://host"})()
        conf = type("K", (), {"get": lambda self, key, other=None: other})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Bare())
    assert session.with_local_folder(Bare()) and Bare.sparkContext.getCheckpointDir() is None
