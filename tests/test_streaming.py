import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollout_quality.operators import evaluation, groups, scoring
from rollout_quality.streaming import scoring as streams

SCHEMA = "prompt_id long, gen_idx int, reference string, completion string"


@pytest.fixture
def arrivals(spark, tmp_path):
    """Four completions per prompt, spread over files so that no group arrives whole."""
    rows = [(p, g, str(p), f"So {g}\n#### {p + g % 2}") for p in range(30) for g in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    for g in range(4):
        df.where(F.col("gen_idx") == g).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return df, streams.completion_stream(spark, f"{tmp_path}/in", df.schema, max_files_per_trigger=1)


def rounded(df, *columns):
    return sorted(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect())


def test_scores(arrivals):
    batch, stream = arrivals
    done = streams.drain_to_parquet(streams.stream_scores(stream).select("prompt_id", "gen_idx", "reward"), "t")
    assert rounded(done, "prompt_id", "gen_idx", "reward") == rounded(
        scoring.score(batch), "prompt_id", "gen_idx", "reward"
    )


def test_running_metrics(arrivals):
    batch, stream = arrivals
    label = F.when(F.col("prompt_id") < 10, "easy")
    done = streams.drain_latest(
        streams.running_metrics(streams.stream_scores(stream).withColumn("difficulty", label)), ["difficulty"], "m"
    )
    want = evaluation.eval_by_difficulty(scoring.score(batch).withColumn("difficulty", label))
    columns = ("difficulty", "n", "accuracy", "mean_reward")
    assert rounded(done, *columns) == rounded(want, *columns)


def test_advantages_of_groups_split_over_files(arrivals):
    batch, stream = arrivals
    done = streams.stream_advantages(streams.stream_scores(stream), 4).emitted
    columns = ("prompt_id", "gen_idx", "advantage")
    assert rounded(done, *columns) == rounded(groups.group_advantages(scoring.score(batch)), *columns)


def test_uneven_groups_and_replays(spark, tmp_path):
    """Groups of three and five members, one of them replayed, over four triggers."""
    order = [[(1, 0), (2, 0), (2, 1)], [(1, 1), (2, 2), (1, 0), (3, 0)], [(2, 3), (1, 0)], [(2, 4), (1, 2)]]
    rows = lambda some: [(p, g, str(p), f"#### {p + g % 3}") for p, g in some]
    for part in order:
        spark.createDataFrame(rows(part), SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streams.completion_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema, 1)
    done = streams.stream_advantages(streams.stream_scores(stream), 4)
    columns = ("prompt_id", "gen_idx", "advantage")
    unique = spark.createDataFrame(rows(dict.fromkeys(x for part in order for x in part)), SCHEMA)
    assert rounded(done.closed, *columns) == rounded(groups.group_advantages(scoring.score(unique)), *columns)
    assert sorted((r["prompt_id"], r["gen_idx"]) for r in done.emitted.collect()) == [(2, g) for g in range(4)]


def test_empty_stream(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    df.write.parquet(f"{tmp_path}/in")
    stream = streams.completion_stream(spark, f"{tmp_path}/in", df.schema)
    done = streams.stream_advantages(streams.stream_scores(stream), 2)
    assert done.emitted.count() == done.closed.count() == 0
    with pytest.raises(ValueError):
        streams.stream_advantages(df, 0)


def test_a_trigger_reads_its_arrivals_and_their_open_groups(spark, tmp_path, monkeypatch):
    """Prompts come one after the other over many triggers; later triggers see no more rows than early ones."""
    rows = [(p, g, str(p), f"#### {p + g % 3}") for p in range(120) for g in range(4)]
    for at in range(0, len(rows), 24):  # a trigger fills five groups and begins others
        part = rows[at : at + 22] + rows[max(0, at - 2) : at]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    seen = []
    of = streams.group_advantages

    def counted(members, **settings):
        if not members.isStreaming and "passed" in members.inputFiles()[0]:
            seen.append(spark.read.parquet(members.inputFiles()[0].rsplit("/", 1)[0]).count())
        return of(members, **settings)

    monkeypatch.setattr(streams, "group_advantages", counted)
    stream = streams.completion_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema, 1)
    done = streams.stream_advantages(streams.stream_scores(stream), 4)
    columns = ("prompt_id", "gen_idx", "advantage")
    triggers = seen[:-1]  # the last is `closed`
    assert len(triggers) == 20 and max(triggers) <= 24 + 3 * 2
    unique = spark.createDataFrame(rows[: len(rows) - 2], SCHEMA)
    assert rounded(done.closed, *columns) == rounded(groups.group_advantages(scoring.score(unique)), *columns)
    assert done.emitted.groupBy("prompt_id").count().count() == 119


def test_hot_prompt_is_let_through(spark, tmp_path):
    """A prompt with most rows of every trigger, missing prompts, positions and rewards, and positions that repeat."""
    rows = [(7, g, float(g % 5)) for g in range(900)] + [(7, 3, -1.0), (None, 0, 1.0), (None, 1, 0.0), (None, None, 0.5), (8, None, None), (8, 1, 2.0)]
    schema = "prompt_id long, gen_idx int, reward double"
    for at in range(0, len(rows), 303):
        spark.createDataFrame(rows[at : at + 303], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streams.completion_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, 1)
    done = streams.stream_advantages(stream, 3)
    first = spark.createDataFrame([r for r in rows if r != (7, 3, -1.0)], schema)
    columns = ("prompt_id", "gen_idx", "reward", "advantage")
    key = lambda r: str(r)
    assert sorted(rounded_all(done.closed, columns), key=key) == sorted(rounded_all(groups.group_advantages(first), columns), key=key)
    sizes = {r["prompt_id"]: r["count"] for r in done.emitted.groupBy("prompt_id").count().collect()}
    assert sizes == {7: 303, None: 3}


def rounded_all(df, columns):
    return [tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()]


def test_state_settings_are_restored(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with streams.disk_state(spark):
        assert spark.conf.get(key).endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("how", ["inner", "left"])
def test_references_too_large_to_broadcast(spark, tmp_path, monkeypatch, how):
    """A stream with a hot prompt meets each part of the references by (prompt, salt), and equals the batch."""
    monkeypatch.setattr(scoring, "may_broadcast", lambda df: False)
    rows = [(p if g % 3 else 5, g, f"#### {p}") for p in range(40) for g in range(6)] + [(None, 0, "#### 1"), (99, 0, "#### 1")]
    df = spark.createDataFrame(rows, "prompt_id long, gen_idx int, completion string")
    references = spark.createDataFrame([(p, str(p)) for p in range(50)] + [(5, "again"), (None, "none")], "prompt_id long, reference string")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = streams.completion_stream(spark, f"{tmp_path}/in", df.schema)
    features = scoring.completion_features(stream)
    joined = scoring.join_references(features, references, how=how)
    columns = ("prompt_id", "gen_idx", "reference", "predicted")
    assert joined.columns == ["prompt_id", *[c for c in features.columns if c != "prompt_id"], "reference"]
    done = streams.drain_to_parquet(joined.select(*columns), "joined")
    want = scoring.completion_features(df).join(references, "prompt_id", how)
    assert sorted(map(str, rounded_all(done, columns))) == sorted(map(str, rounded_all(want, columns)))
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "__salt" in plan


class _State:
    """What a step sees of its state."""

    def __init__(self):
        self.get, self.exists = None, False

    def update(self, value):
        self.get, self.exists = value, True


def test_prompts_share_a_call():
    """One call settles all prompts of a state: groups that fill, stay open, were emitted, and replays."""
    step, state = streams._filling(3), _State()

    def trigger(*frames):
        columns = ["prompt_id", "gen_idx", "reward"]
        out = list(step((0,), iter([pd.DataFrame(f, columns=columns) for f in frames]), state))
        return {tuple(None if pd.isna(v) else v for v in r) for f in out for r in f.itertuples(index=False)}

    assert trigger([(1, 0, 0.5), (2, 0, 1.0), (1, 1, 0.25)], [(2, 0, 0.75)]) == {
        (1, 0, 0.5, True, False), (1, 1, 0.25, True, False), (2, 0, 0.75, True, False), (2, 0, 1.0, True, False)
    }
    assert trigger([(1, 0, 9.0), (1, 2, 0.1)], [(2, 1, 0.2), (1, 1, 9.0), (1, 3, 0.3)]) == {
        (1, 0, 0.5, False, True), (1, 0, 9.0, True, False), (1, 1, 0.25, False, True), (1, 1, 9.0, True, False),
        (1, 2, 0.1, True, True), (1, 3, 0.3, True, True), (2, 1, 0.2, True, False),
    }
    assert state.get == ([2, 2], [0, 1], [0.75, 0.2], [1])
    assert trigger([(1, 4, 0.4), (2, None, None)]) == {
        (1, 4, 0.4, True, False), (2, 0, 0.75, False, True), (2, 1, 0.2, False, True), (2, None, None, True, True)
    }
    assert state.get == ([], [], [], [1, 2])
