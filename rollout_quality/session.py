"""Session helpers: defaults for local work, the shared working folder, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollout_quality.files import Files

# A side is broadcast only if a count proves at most this many narrow rows (a key and a few scalars).
BROADCAST_ROWS = 1_000_000
# Stored texts take two thirds of the room that Spark's default codec needs.
TEXT_CODEC = "zstd"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", app: str = "rollout-quality", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir` of the session. There is no other choice: a folder of
    one machine would be lost on a cluster."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or current
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not current:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def with_local_folder(spark: SparkSession) -> SparkSession:
    """For checks on one machine: a session whose executors all live in this process gets a temporary folder, if it
    has none. Sessions on a cluster are left as they are."""
    local = spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")
    if local and not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollout-quality-"))
    return spark


# Sessions with open runs: how many, and their setting before the first.
_DROPPING: dict[SparkSession, tuple[int, str | None]] = {}
_LOCK = Lock()


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside the block, the shuffle files of a query go when the query ends, not when the driver happens to collect
    garbage. The setting is the session's, so runs that are open at the same time share it."""
    with _LOCK:
        runs, before = _DROPPING.get(spark) or (0, spark.conf.get(_SHUFFLE_CLEANUP, None))
        _DROPPING[spark] = runs + 1, before
        spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            runs, before = _DROPPING.pop(spark)
            if runs > 1:
                _DROPPING[spark] = runs - 1, before
            elif before is None:
                spark.conf.unset(_SHUFFLE_CLEANUP)
            else:
                spark.conf.set(_SHUFFLE_CLEANUP, before)


class WorkFolder:
    """The tables that one run works with. All that is stored inside the block lies in one folder of the shared folder,
    which goes at its end, also after an error, or with `clear`. Frames that read it must not leave the block. Shuffle
    files go with their queries."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, new_folder(spark, name)

    def __enter__(self) -> "WorkFolder":
        self._before = _RUN.set(self)
        self._shuffles = _shuffles_dropped(self.spark)
        self._shuffles.__enter__()
        return self

    def clear(self) -> None:
        """Drop all that is stored, once nothing reads it any more."""
        Files(self.spark, self.path).delete(self.path)

    def __exit__(self, kind, value, trace) -> None:
        _RUN.reset(self._before)
        self.clear()
        self._shuffles.__exit__(None, None, None)


_RUN: ContextVar[WorkFolder | None] = ContextVar("run", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path that no other run uses: in the folder of the run, or under the shared folder."""
    run = _RUN.get()
    above = run.path if run is not None else f"{shared_folder(spark)}/rollout_quality"
    return f"{above}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Rows that survive the loss of the executors that computed them: a table of the run that owns its working data,
    else a reliable checkpoint."""
    if _RUN.get() is not None:
        return write_and_reread(df, "cut")
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def write_and_reread(df: DataFrame, name: str, *partition_by: str, codec: str | None = None) -> DataFrame:
    """Cut lineage with a Parquet table, so that later readers pay only for the columns they use."""
    path = new_folder(df.sparkSession, name)
    writer = df.write.mode("error")
    if codec:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy text work all cores when a small input arrives in a few partitions.

    Only an input with at most half as many partitions as cores is redistributed; a table that already fills
    the cluster is read as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def run_together(spark: SparkSession, *actions: Callable[[], None]) -> None:
    """Submit independent Spark jobs at the same time, so that the last tasks of one leave no cores idle."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(copy_context().run, inherit(a)) for a in actions]:
            done.result()


def is_small(stored: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if a stored narrow table is proven small enough to broadcast."""
    return stored.agg(F.count(F.lit(1)).alias("n")).first()["n"] <= max_rows
