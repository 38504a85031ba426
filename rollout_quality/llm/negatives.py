"""Hard negatives by a secondary sort.

Scores are computed in blocks of anchors against blocks of rows. What a block can contribute is known before anything
is shuffled: its best rows of the anchor's label and, once an anchor's positives are known, its best rows in each of
their windows; no other pair of the block can be in the result. These pairs are packed into keys (anchor, descending
score, id), dealt out by anchor and sorted within their partitions. A streaming iterator reads each anchor's pairs from
the best score down: a positive opens a window of scores, a negative is emitted for every open window that it falls
into. Only the windows of one anchor are held.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import Column, DataFrame, functions as F

from rollout_quality.llm.common import ready, store

POSITIVES = 5
NEGATIVES = 3
# The score of a negative is between these percentages of the score of its positive.
LOWEST, HIGHEST = 50, 95
SCALE = 256.0
BLOCK_ROWS = 4096
LARGEST = (1 << 63) - 1
# Products of vectors with smaller components than this are exact as doubles.
PLAIN = 2.0**20

PAIRS = "anchor long, anchor_id long, score long, id long, positive boolean"
MINED = (
    "anchor long, anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)
# anchor, score from the highest down, positives first, rows without an id last, id: bytes in the order of the values.
KEY = ">QQ??Q"


def window(score: int) -> tuple[int, int]:
    """Lowest and highest score of a positive's negatives; none fits if the positive's score is below zero."""
    return -(-LOWEST * score // 100), HIGHEST * score // 100


def whole(vectors: Iterable[np.ndarray]) -> np.ndarray:
    """floor(256 x) of all components as a matrix; shorter vectors end in zeros."""
    vectors = list(vectors)
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    with np.errstate(over="ignore"):
        return np.floor(np.clip(SCALE * out, -np.finfo(float).max, np.finfo(float).max))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers; those that need more bits are held at the largest of their sign."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    out = np.zeros((len(a), len(b)), np.int64)
    sides = [[np.flatnonzero(large == w) for w in (False, True)] for large in (np.abs(m).max(1, initial=0) >= PLAIN for m in (a, b))]
    for i in sides[0]:
        for j in sides[1]:
            x, y = a[i], b[j]
            bound = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * width
            if bound < 2.0**53:
                part = (x @ y.T).astype(np.int64)
            elif bound < 2.0**62:
                part = x.astype(np.int64) @ y.astype(np.int64).T
            else:
                exact = [np.array([[int(v) for v in row] for row in m], object).reshape(len(m), width) for m in (x, y)]
                part = np.clip(exact[0] @ exact[1].T, -LARGEST, LARGEST).astype(np.int64)
            out[np.ix_(i, j)] = part
    return out


def best(scores: np.ndarray, among: np.ndarray, count: int) -> np.ndarray:
    """Of the places `among` (ascending), the `count` with the highest scores; equal scores in order of place."""
    if len(among) > count:
        found = scores[among]
        last = np.partition(found, -count)[-count]
        above = among[found > last]
        among = np.concatenate([above, among[found == last][: count - len(above)]])
    return among


def _by_blocks(anchors: DataFrame, rows: DataFrame, chosen: Callable[..., np.ndarray]) -> DataFrame:
    """Pairs that `chosen` keeps of every block of anchors against every block of rows.

    Both sides are dealt out in blocks of bounded size, so a task holds two blocks, whatever the tables' size.
    """
    across, down = (max(1, math.ceil(t.count() / BLOCK_ROWS)) for t in (anchors, rows))

    def dealt(table: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int")
        # Both sides may read the same stored table; new names for its columns keep them apart.
        columns = [F.col(c).alias(c) for c in table.columns]
        return table.select(*columns, block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        # In order of id, rows without one last: equal scores are then taken in order of place.
        b = b.take(pc.sort_indices(b, [("id", "ascending"), ("rid", "ascending")], null_placement="at_end"))
        table = products(whole(a["vec"].to_pylist()), whole(b["vec"].to_pylist()))
        labels, rids = b["label"].to_numpy(), b["rid"].to_numpy()
        kept, counts = [np.zeros(0, np.int64)], []
        for scores, anchor in zip(table, a.drop_columns("vec").to_pylist()):
            same = labels == anchor["label"]
            kept.append(chosen(scores, same, rids != anchor["rid"], anchor))
            counts.append(len(kept[-1]))
        asked, places = np.repeat(np.arange(len(a)), counts), np.concatenate(kept)
        return pa.table(
            {
                "anchor": a["rid"].take(asked),
                "anchor_id": a["id"].take(asked),
                "score": table[asked, places],
                "id": b["id"].take(places),
                "positive": a["label"].to_numpy()[asked] == labels[places],
            }
        )

    left, right = dealt(anchors, "a", across, "b", down), dealt(rows, "b", down, "a", across)
    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(pair, PAIRS)


def _secondary_sort(pairs: DataFrame, partitions: int) -> RDD:
    """(packed key, anchor's id), the pairs of an anchor together and in order."""

    def keyed(row) -> tuple[bytes, int]:
        id_ = row["id"]
        return struct.pack(KEY, row["anchor"], LARGEST - row["score"], not row["positive"], id_ is None, (id_ or 0) + (1 << 63)), row["anchor_id"]

    return pairs.rdd.map(keyed).repartitionAndSortWithinPartitions(partitions, lambda key: zlib.crc32(key[:8]))


def _anchors(rows: Iterable[tuple[bytes, int]]) -> Iterator[tuple[int, int, Iterator[tuple]]]:
    """(anchor, its id, its (score, id, positive) one after the other)."""

    def unpacked(own):
        for key, _ in own:
            _, down, negative, unnamed, id_ = struct.unpack(KEY, key)
            yield LARGEST - down, None if unnamed else id_ - (1 << 63), not negative

    for anchor, own in groupby(((struct.unpack(KEY, k)[0], (k, i)) for k, i in rows), lambda x: x[0]):
        first = next(own)[1]
        yield anchor, first[1], unpacked(pair for part in ([first], (x[1] for x in own)) for pair in part)


def first_positives(rows: Iterable[tuple[bytes, int]], count: int = POSITIVES) -> Iterator[tuple]:
    for anchor, anchor_id, own in _anchors(rows):
        for n, (score, id_, _) in enumerate(own):
            if n < count:
                yield anchor, anchor_id, score, id_, True


def first_negatives(rows: Iterable[tuple[bytes, int]], count: int = NEGATIVES) -> Iterator[tuple]:
    for anchor, anchor_id, own in _anchors(rows):
        opened: list[list] = []
        for score, id_, positive in own:
            if positive:
                opened.append([id_, score, *window(score), 0])
                continue
            for w in opened:
                if w[4] < count and w[2] <= score <= w[3]:
                    w[4] += 1
                    yield anchor, anchor_id, w[0], w[4], id_, w[1], score


def usable(rows: DataFrame, anchors: Column, label: Column, id_: str, vector: str) -> DataFrame:
    """A stored table of the rows that take part: rid, id, label, vec, asks."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return store(
        rows.where(label.isNotNull() & F.coalesce(finite, F.lit(False))).select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(id_).cast("long").alias("id"),
            label.cast("long").alias("label"),
            F.col(vector).cast("array<double>").alias("vec"),
            F.coalesce(anchors, F.lit(False)).alias("asks"),
        ),
        "vectors",
    )


def mine(
    rows: DataFrame,
    anchors: Column,
    label: Column,
    id_: str = "vec_id",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """anchor (a number of its row), anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row where `anchors` holds and each of its first `positives` other rows of the same label, the first
    `negatives` rows of other labels with a score in the positive's window; by descending score, then ascending id. Rows
    without a label or vector, or with a component that is null or not finite, take no part. Rows without an id do,
    after all others of the same score. Rows that are repeated are rows of their own: one can be the other's positive.
    Shorter vectors end in zeros, a score beyond 64 bits is the largest of its sign, an empty vector scores 0. An empty
    table gives no rows; other columns are not read.
    """
    spark = ready(rows.sparkSession)
    taking = usable(rows, anchors, label, id_, vector)
    asking = taking.where("asks").drop("asks")
    taking = taking.drop("asks")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def nearest(scores: np.ndarray, same: np.ndarray, other: np.ndarray, anchor: dict) -> np.ndarray:
        return best(scores, np.flatnonzero(same & other), positives)

    def in_windows(scores: np.ndarray, same: np.ndarray, other: np.ndarray, anchor: dict) -> np.ndarray:
        kept = [np.zeros(0, np.int64)]
        for low, high in {window(int(s)) for s in anchor["positives"]}:
            if low <= high:
                kept.append(best(scores, np.flatnonzero(~same & (scores >= low) & (scores <= high)), negatives))
        return np.unique(np.concatenate(kept))

    near = _secondary_sort(_by_blocks(asking, taking, nearest), partitions).mapPartitions(lambda rows: first_positives(rows, positives))
    found = store(spark.createDataFrame(near, PAIRS), "positives")
    scored = found.groupBy("anchor").agg(F.collect_set("score").alias("positives"))
    known = asking.join(scored.withColumnRenamed("anchor", "rid"), "rid")
    pairs = _by_blocks(known, taking, in_windows).unionByName(found)
    mined = _secondary_sort(pairs, partitions).mapPartitions(lambda rows: first_negatives(rows, negatives))
    return spark.createDataFrame(mined, MINED)
