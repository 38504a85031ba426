"""Exact deduplication as a stateful stream.

Documents arrive as files. The state, kept on disk and never expired, holds per digest of the normalised text
the stable identifier of the row that stays, a locator of its content (file and row) and the number of rows.
On every hit the whole normalised text is compared with the text at the locator; a digest that two different
texts share is split by the texts themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rollout_quality.llm.common import ready, scratch, store

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A state that is spread over many partitions must not reserve disk that it does not use.
RESERVE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
# The bitmap that holds back contents which cannot be copies has a fixed size: one megabyte.
FILTER_BITS = 23
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; a null text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _rows(frame: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Identifier, content and locator. Rows without an identifier order last."""
    return (
        frame.select(
            "doc_id",
            normalised(F.col("text")).alias("content"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        )
        .withColumn("digest", digest(F.col("content")))
        .withColumn("me", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row"))
        .select("doc_id", "content", "digest", "me")
    )


def _first(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.min("me").alias("first"), F.count(F.lit(1)).alias("n"))


def stream_state(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    digest: Callable[[Column], Column] = sha256,
    files_per_trigger: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Drain the files at `path` through the keyed state: one row (digest, first, n) per digest.

    Every trigger writes the keys it changed into a folder named by its batch, so that a repeated trigger
    replaces its own output; the newest row of a digest is its state. A given `checkpoint` folder lets a later
    call go on where this one ended: only new files are read.
    """
    out = checkpoint or scratch(spark, "dedup-state")
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # Written as a pattern, the path may be one file as well as a folder.
    parent, _, name = path.rstrip("/").rpartition("/")
    state = _first(_rows(reader.parquet(f"{parent}/{{{name}}}"), digest), "digest")

    def changed(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/changed/batch={batch_id}")

    before = {k: spark.conf.get(k, None) for k in (STATE_STORE, CHANGELOG, RESERVE)}
    spark.conf.set(STATE_STORE, ROCKS)
    spark.conf.set(CHANGELOG, "true")
    spark.conf.set(RESERVE, "false")
    try:
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{out}/checkpoint")
            .foreachBatch(changed)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    kinds = T.StructType([*state.schema.fields, T.StructField("batch", T.LongType())])
    changes = spark.read.schema(kinds).parquet(f"{out}/changed")
    newest = changes.groupBy("digest").agg(F.max_by(F.struct("first", "n"), "batch").alias("s"))
    return newest.select("digest", "s.first", "s.n")


def _likely(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows whose digest may be that of a group: all that are, and by a bitmap of FILTER_BITS few that are not."""
    place = F.pmod(F.xxhash64("digest"), F.lit(1 << FILTER_BITS))
    found = groups.select(place.alias("at")).distinct().toPandas()["at"].to_numpy(np.int64)  # 2^FILTER_BITS at most
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[found] = True
    held = rows.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            yield batch.filter(pa.array((held.value[at >> 3] << (at & 7)).astype(np.uint8) >= 128)).drop_columns("at")

    return rows.withColumn("at", place).mapInArrow(keep, rows.schema)


def exact_duplicates(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    digest: Callable[[Column], Column] = sha256,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """One row per row of the Parquet documents at `path`: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the smallest doc_id stays. Rows repeated with the same doc_id: one of
    them stays (first file and row). Null doc_id: stays only if no equal text has one; keep_id is null then.
    Null text: empty. Empty table: no rows. Other columns are not read. `digest` decides what is looked up in the
    state; whatever it is, equal means equal bytes.
    """
    ready(spark)
    state = stream_state(spark, path, schema, digest, files_per_trigger)
    groups = store(state.filter("n > 1"), "dedup-groups")
    rows = _rows(spark.read.schema(schema).parquet(path), digest)
    # A hit is compared with the content at the locator that the state holds. Only contents of hits travel.
    hits = _likely(rows.select("digest", "content", "me"), groups).join(groups.hint("merge"), "digest")
    hits = store(hits.select("digest", "content", (F.col("me") == F.col("first")).alias("stays")), "dedup-hits")
    held = hits.filter("stays").select("digest", F.col("content").alias("held"))
    again = hits.filter("NOT stays").join(held.hint("merge"), "digest")
    differ = again.filter("content != held").select("digest").distinct()
    differ = store(differ, "dedup-collisions")
    sha = F.sha2(F.col("content").cast("binary"), 256).alias("text_sha256")
    split = None
    if not differ.isEmpty():
        mixed = rows.join(differ, "digest", "left_semi")
        split = mixed.join(_first(mixed, "content"), "content").select("doc_id", "me", "first", "n", sha)
        rows = rows.join(differ, "digest", "left_anti")
    narrow = rows.select("doc_id", "digest", "me", sha)
    joined = narrow.join(groups.hint("merge"), "digest", "left").select("doc_id", "me", "first", "n", "text_sha256")
    if split is not None:
        joined = joined.unionByName(split)
    return joined.select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("me") == F.col("first"), F.lit(True)).alias("kept"),
        "text_sha256",
    )
