"""Incremental scoring: completions arrive as files and are scored as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rollout_quality.config import COMPAT, RewardWeights
from rollout_quality.files import Files
from rollout_quality.operators.evaluation import UNKNOWN
from rollout_quality.operators.groups import EPSILON, group_advantages
from rollout_quality.operators.scoring import score
from rollout_quality.schemas import COMPLETIONS
from rollout_quality.session import new_folder

ADVANTAGES = T.StructType(
    [
        T.StructField("prompt_id", T.LongType()),
        T.StructField("gen_idx", T.IntegerType()),
        T.StructField("reward", T.DoubleType()),
        T.StructField("advantage", T.DoubleType()),
    ]
)


def completion_stream(
    spark: SparkSession, path: str, schema: T.StructType = COMPLETIONS, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over a folder of Parquet files with completions."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_scores(
    completions: DataFrame,
    weights: RewardWeights | None = None,
    soft_k: float = 0.1,
    grammar: str = COMPAT,
) -> DataFrame:
    """Score a stream: the batch expressions, no state."""
    return score(completions, weights, soft_k, grammar)


def running_metrics(scored: DataFrame) -> DataFrame:
    """Running metrics per difficulty. State is one row of sums per label."""
    return scored.groupBy(F.coalesce(F.col("difficulty"), F.lit(UNKNOWN)).alias("difficulty")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("exact_match").alias("accuracy"),
        F.avg("reward").alias("mean_reward"),
    )


class StreamedAdvantages(NamedTuple):
    """emitted: groups as they filled up; closed: every group, after the end of the stream."""

    emitted: DataFrame
    closed: DataFrame


# Prompts whose ids differ in the last bits alone share a state and a call of Python: at most 64 of them, however many
# prompts there are. Ids that lie far apart have a state each.
_SHARED_BITS = 6
# What such a state holds: the members of open groups, and the prompts that were emitted.
_OPEN = "prompt_id array<long>, gen_idx array<int>, reward array<double>, emitted array<long>"
# `arrived`: the row came in this trigger. `out`: it belongs to a group that is emitted in this trigger.
_PASSED = T.StructType(
    [
        *ADVANTAGES.fields[:3],
        T.StructField("arrived", T.BooleanType()),
        T.StructField("out", T.BooleanType()),
    ]
)


def _filling(group_size: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Pass on what arrives of the prompts that share a state, and the members held for a prompt once its group is full.

    A full group lets all further rows of its trigger through, so no more than `group_size` members are held of a
    prompt, in memory or in the state, however many rows it has. Prompts, rewards and positions may be missing.
    """

    def known(values: pd.Series) -> list:
        return [None if v is None or v != v else v for v in values.tolist()]

    def rows(found: list[tuple]) -> Iterator[pd.DataFrame]:
        if found:
            prompts, indexes, rewards, arrived, out = zip(*found)
            yield pd.DataFrame(
                {
                    "prompt_id": pd.array(prompts, "Int64"),
                    "gen_idx": pd.array([None if g is None else int(g) for g in indexes], "Int32"),
                    "reward": pd.array(rewards, "object"),
                    "arrived": arrived,
                    "out": out,
                }
            )

    def step(key: tuple, arrivals: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        prompts, indexes, rewards, emitted = state.get if state.exists else ([], [], [], [])
        held: dict[int | None, dict] = {}
        for p, g, r in zip(prompts, indexes, rewards):
            held.setdefault(p, {})[g] = r
        before, full = set(emitted), set()
        fresh: dict[int | None, list[tuple]] = {}
        seen: dict[int | None, set] = {}
        for frame in arrivals:
            found = []
            for p, g, r in zip(known(frame["prompt_id"]), known(frame["gen_idx"]), known(frame["reward"])):
                if p in before:
                    found.append((p, g, r, True, False))
                elif p in full:
                    # A position that was held already is a replay: it arrived, but is not let out again.
                    found.append((p, g, r, True, g not in held.get(p, ())))
                else:
                    fresh.setdefault(p, []).append((g, r))
                    seen.setdefault(p, set(held.get(p, ()))).add(g)
                    if len(seen[p]) >= group_size:
                        full.add(p)
                        own = held.get(p, {})
                        found += [(p, g, r, False, True) for g, r in own.items()]
                        found += [(p, g, r, True, g not in own) for g, r in fresh.pop(p)]
            yield from rows(found)
        yield from rows([(p, g, r, True, False) for p, members in fresh.items() for g, r in members])
        for p, members in fresh.items():
            # Of equal positions the smallest reward comes first, a missing one last.
            for g, r in sorted(members, key=lambda m: (m[1] is None, m[1] or 0.0)):
                held.setdefault(p, {}).setdefault(g, r)
        kept = [(p, g, r) for p, own in held.items() if p not in full for g, r in own.items()]
        prompts, indexes, rewards = ([m[k] for m in kept] for k in range(3))
        state.update((prompts, [None if g is None else int(g) for g in indexes], rewards, [*emitted, *full]))

    return step


def stream_advantages(scored: DataFrame, group_size: int, eps: float = EPSILON) -> StreamedAdvantages:
    """Drain a stream of scored completions into group-relative advantages.

    A group is emitted in the trigger in which it has `group_size` members or more, with all that are there. At
    the end, `closed` holds the advantages of all groups over all their members: smaller groups, and groups that
    went on growing after they were emitted. It equals the batch result. A (prompt_id, gen_idx) that arrives again
    is a replay: the first arrival counts, and of several in one trigger that with the smallest reward.

    The members of open groups, and of every other prompt that it was emitted, are state on disk, by at most 64 prompts of
    adjacent ids, so a trigger reads its arrivals and the states they belong to, whatever came before. The rows that arrived and were
    emitted are tables with a folder for each trigger, which a repeated trigger writes anew.
    """
    if group_size < 1:
        raise ValueError("group_size must be positive")
    spark = scored.sparkSession
    out = new_folder(spark, "advantages")
    batched = [T.StructField("batch", T.LongType())]

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/passed/batch={batch_id}")
        passed = spark.read.schema(_PASSED).parquet(f"{out}/passed/batch={batch_id}")
        members = passed.where("out").groupBy("prompt_id", "gen_idx").agg(F.min("reward").alias("reward"))
        group_advantages(members, eps=eps).write.mode("overwrite").parquet(f"{out}/emitted/batch={batch_id}")

    narrow = scored.select("prompt_id", F.col("gen_idx").cast("int"), F.col("reward").cast("double"))
    shared = F.shiftright(F.col("prompt_id").cast("long"), _SHARED_BITS)
    filled = narrow.withColumn("__shared", shared).groupBy("__shared").applyInPandasWithState(
        _filling(group_size), _PASSED, _OPEN, "append", GroupStateTimeout.NoTimeout
    )
    with disk_state(spark):
        query = (
            filled.writeStream.foreachBatch(step)
            .option("checkpointLocation", f"{out}/checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        finish(query)

    def read(kind: str, schema: T.StructType) -> DataFrame:
        if not Files(spark, out).exists(f"{out}/{kind}"):  # no trigger ran
            return spark.createDataFrame([], T.StructType([*schema.fields, *batched]))
        return spark.read.schema(T.StructType([*schema.fields, *batched])).parquet(f"{out}/{kind}")

    first = F.min(F.struct("batch", F.col("reward").isNull().alias("none"), "reward"))["reward"].alias("reward")
    arrived = read("passed", _PASSED).where("arrived").groupBy("prompt_id", "gen_idx").agg(first)
    return StreamedAdvantages(read("emitted", ADVANTAGES).drop("batch"), group_advantages(arrived, eps=eps))


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on disk (RocksDB) and save only what changed in a trigger. The settings
    of the session are as before afterwards."""
    store = "spark.sql.streaming.stateStore"
    wanted = {
        f"{store}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        f"{store}.rocksdb.changelogCheckpointing.enabled": "true",
        # A state that is spread over many partitions must not reserve disk that it does not use.
        f"{store}.rocksdb.allowFAllocate": "false",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def drain_to_parquet(stream: DataFrame, name: str) -> DataFrame:
    """Process everything available into a Parquet table in the shared folder and read it back."""
    spark = stream.sparkSession
    out = new_folder(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    finish(query)
    return spark.read.schema(stream.schema).parquet(out)


def drain_latest(stream: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Process everything available of a running aggregation, and give the last state of every key.

    A trigger writes the keys it changed, as a folder of its own that a repeated trigger writes anew; nothing goes
    through the driver, and the number of keys is not bounded. The state is on disk.
    """
    spark = stream.sparkSession
    out = new_folder(spark, name)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/changes/batch={batch_id}")

    with disk_state(spark):
        query = (
            stream.writeStream.foreachBatch(step)
            .option("checkpointLocation", f"{out}/checkpoint")
            .outputMode("update")
            .trigger(availableNow=True)
            .start()
        )
        finish(query)
    if not Files(spark, out).exists(f"{out}/changes"):  # no trigger ran
        return spark.createDataFrame([], stream.schema)
    versions = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    changes = spark.read.schema(versions).parquet(f"{out}/changes")
    values = [c for c in stream.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"last.{c}").alias(c) for c in stream.columns])


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
