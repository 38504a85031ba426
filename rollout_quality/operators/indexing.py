"""Stable contiguous 0-based positions within a split, without a one-task window.

Two passes over key columns only: bucket edges from a bounded sample of keys, then row counts per
(split, bucket). The ranking window then runs per (split, bucket), and the counts of the buckets before give
its offset. Bucket membership is a function of the key, so a recomputed task lands on the same positions.

Keys that hold more than a bucket and are ordered by further columns of the caller's (`ties`) are cut into ranges of
(key, ties, digest) instead. Ranges depend on a sample of the rows, so these rows are stored with their place in
their range, and the positions follow from the stored counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rollout_quality.session import write_and_reread

ROWS_PER_BUCKET = 20_000
MAX_BUCKETS = 100_000
_SAMPLE_PER_BUCKET = 20
_GROUP = "__group"
_BUCKET = "__bucket"
_PART = "__part"
_DIGEST = "__digest"
_FIRST = "__first"
_ORIGIN = "__origin"
_AT = "__at"
_SAMPLE_CONF = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
_IN_PARTITION = (1 << 33) - 1  # the bits of monotonically_increasing_id that count the rows of a partition
_EXACT = 2.0**53


def _edges(df: DataFrame, key: str, rows_per_bucket: int) -> tuple[list[float], list[float], bool]:
    """Inner bucket edges (empty if all rows fit one bucket; at most 2 * MAX_BUCKETS values), the keys among them
    that fill more than a bucket each, and whether rows without a key do."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("known")).first()
    rows, known = found["n"], found["known"]
    buckets = min(MAX_BUCKETS, -(-rows // rows_per_bucket))
    if buckets <= 1:
        return [], [], False
    keys = df.select(F.col(key).cast("double").alias("k"))
    fraction = min(1.0, buckets * _SAMPLE_PER_BUCKET / rows)
    if fraction < 1.0:
        keys = keys.sample(fraction, seed=17)
    shares = [i / buckets for i in range(1, buckets)]
    edges = sorted(keys.approxQuantile("k", shares, 0.1 / buckets))
    # Beyond 2^53 different keys may share a double; such a bucket is not one key.
    heavy = sorted({a for a, b in zip(edges, edges[1:]) if a == b and abs(a) < _EXACT})
    alone = [math.nextafter(v, math.inf) for v in heavy]
    return sorted({*edges, *alone}), heavy, rows - known > rows_per_bucket


def _with_bucket(df: DataFrame, key: str, edges: Sequence[float]) -> DataFrame:
    if not edges:
        return df.withColumn(_BUCKET, F.lit(0))
    numeric = "__key"
    bucketizer = Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol=numeric, outputCol=_BUCKET, handleInvalid="keep"
    )
    bucketed = bucketizer.transform(df.withColumn(numeric, F.col(key).cast("double"))).drop(numeric)
    return bucketed.withColumn(_BUCKET, F.coalesce(F.col(_BUCKET).cast("int"), F.lit(-1)))


def _in_ranges(rows: DataFrame, order: Sequence[str], rows_per_bucket: int) -> DataFrame:
    """A stored table of the rows with their range and their place there, in the order of (group, bucket, *order).

    Equal rows are told apart by the partition they come from: any order of theirs is right, and a range never has
    to hold all of them. The driver gets a sample of the order columns: 60 rows a range, 3,000,000 at most.
    """
    conf, by = rows.sparkSession.conf, [_GROUP, _BUCKET, *order, _DIGEST, _ORIGIN]
    ranges = max(1, min(MAX_BUCKETS, -(-rows.count() // rows_per_bucket)))
    sorted_rows = rows.withColumn(_ORIGIN, F.spark_partition_id()).repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))
    placed = sorted_rows.withColumns({_PART: F.spark_partition_id(), _AT: place})
    before = conf.get(_SAMPLE_CONF)
    conf.set(_SAMPLE_CONF, str(_SAMPLE_PER_BUCKET))
    try:
        return write_and_reread(placed.drop(_ORIGIN, _DIGEST), "ranges")
    finally:
        conf.set(_SAMPLE_CONF, before)


def with_position(
    df: DataFrame,
    key: str,
    out: str = "idx",
    split: str = "split",
    ties: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add `out`: position of each row within its split, in the order of the numeric column `key`, then `ties`,
    then a digest of the whole row, so that positions do not depend on how the rows are partitioned.

    Rows that are equal in every column are interchangeable. Rows without a key come first, and rows without a
    split form a split of their own; none is lost. Keys with more rows than a bucket (no key among them) are cut
    further: by the digest, or with `ties` into stored ranges of (key, ties, digest).
    """
    if not isinstance(df.schema[key].dataType, T.NumericType):
        raise TypeError(f"column {key!r} must be numeric to order rows")
    edges, heavy, unkeyed = _edges(df, key, rows_per_bucket)
    grouped = df.withColumn(_GROUP, F.coalesce(F.col(split).cast("string"), F.lit("\0")))
    digest = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    bucketed = _with_bucket(grouped, key, edges).withColumn(_PART, F.lit(0))
    crowded = F.col(key).cast("double").isin(heavy) if heavy else F.lit(False)
    crowded = F.when(F.col(key).isNull(), unkeyed).otherwise(crowded)
    ranged = None
    if (heavy or unkeyed) and ties:
        ranged = _in_ranges(bucketed.where(crowded).withColumn(_DIGEST, digest), (key, *ties), rows_per_bucket)
        bucketed = bucketed.where(~crowded)
    elif heavy or unkeyed:
        bucketed = bucketed.withColumn(_PART, F.when(crowded, F.shiftright(digest, 52).cast("int")).otherwise(0))
    bucket = (_GROUP, _BUCKET, _PART)
    order: list[Column] = [F.col(c) for c in (key, *ties)]
    placed = bucketed.withColumn(_DIGEST, digest)
    rank = F.row_number().over(Window.partitionBy(*bucket).orderBy(*order, _DIGEST)).cast("bigint") - 1
    ranked = placed.withColumn(out, rank).drop(_DIGEST)
    if not edges:
        return ranked.drop(*bucket)

    counts = bucketed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias(_AT))
    if ranged is not None:
        # A range may begin in the middle of a bucket and end in another.
        counts = counts.unionByName(ranged.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.min(_AT).alias(_AT)))
    before = Window.partitionBy(_GROUP).orderBy(_BUCKET, _PART).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*bucket, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col(_AT)).alias(_FIRST))
    if ranged is not None:
        ranked = ranked.unionByName(ranged.withColumn(out, F.col(_AT)).drop(_AT))
    # The ranked rows are already partitioned and sorted by bucket: this join moves only the counts.
    return (
        ranked.join(firsts, list(bucket))
        .withColumn(out, F.col(out) + F.col(_FIRST))
        .drop(*bucket, _FIRST)
    )
