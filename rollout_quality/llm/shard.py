"""Sharding by a k-d tree over metadata, with DataFrame operations only.

A node that should hold k shards is split where the weight (bytes) of its left side is nearest to floor(k/2)/k of
its own, along the metadata dimension in which its rows spread widest. The split points of all nodes of a level
are found together: histograms of weight by key range are narrowed until a range holds one row or next to no
weight. A histogram has at most `shards` x `BUCKETS` rows whatever the input; rows never travel before the last
step, which numbers the rows of every shard.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollout_quality.llm.common import store

BUCKETS = 2048
TOLERANCE = 0.0005
SLOT_ROWS = 4096
OVERHEAD = 16
TIE_BITS = 32
COORDINATE = (1 << 30) - 1


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def label(value: Column) -> Column:
    """A coordinate for a label: equal labels are neighbours, no label is zero."""
    return F.coalesce(F.shiftrightunsigned(F.xxhash64(value.cast("string")), 34), F.lit(0)).cast("double")


def number(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


@dataclass
class Node:
    shards: int
    first: int
    tests: list[tuple[int, bool, int]] = field(default_factory=list)  # (dimension, at most the cut?, cut)


def _within(node: Node, keys: list[Column]) -> Column:
    test = F.lit(True)
    for dim, left, cut in node.tests:
        test = test & (keys[dim] <= cut if left else keys[dim] > cut)
    return test


def _number_of(nodes: list[Node], keys: list[Column]) -> Column:
    column = None
    for i, node in enumerate(nodes[:-1]):
        test = _within(node, keys)
        column = F.when(test, i) if column is None else column.when(test, i)
    last = F.lit(len(nodes) - 1)
    return (last if column is None else column.otherwise(last)).cast("int")


def _cuts(points: DataFrame, nodes: list[Node], keys: list[Column], leaf_bytes: float) -> dict[int, tuple[int, int]]:
    """For every node: the widest dimension and the key at which its left part ends."""
    at = points.withColumn("__node", _number_of(nodes, keys))
    spans = [f(k).alias(f"{n}{d}") for d, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]
    found: dict[int, tuple[int, int]] = {}
    seeking: dict[int, dict] = {}
    for r in at.groupBy("__node").agg(F.sum("bytes").alias("w"), *spans).collect():
        node = nodes[r["__node"]]
        if node.shards == 1:
            continue
        dim = max(range(len(keys)), key=lambda d: ((r[f"hi{d}"] >> TIE_BITS) - (r[f"lo{d}"] >> TIE_BITS), -d))
        want = r["w"] * (node.shards // 2) / node.shards
        seeking[r["__node"]] = {"dim": dim, "lo": r[f"lo{dim}"], "hi": r[f"hi{dim}"], "want": want}
    while seeking:
        for s in seeking.values():
            s["width"] = max(0, (s["hi"] - s["lo"] + 1).bit_length() - (BUCKETS.bit_length() - 1))
        rows = ", ".join(f"({i}, {s['dim']}, {s['lo']}L, {s['hi']}L, {s['width']})" for i, s in seeking.items())
        sought = points.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(__node, dim, lo, hi, width)")
        key = F.lit(None).cast("long")
        for d, k in enumerate(keys):
            key = F.when(F.col("dim") == d, k).otherwise(key)
        # One row per node that is split, so at most half as many as shards.
        inside = at.join(F.broadcast(sought), "__node").withColumn("key", key).filter("key BETWEEN lo AND hi")
        bucket = F.expr("shiftright(key - lo, width)")
        counted = inside.groupBy("__node", bucket.alias("bucket")).agg(
            F.sum("bytes").alias("w"), F.count(F.lit(1)).alias("n")
        )
        weights: dict[int, list] = {}
        for r in counted.collect():  # at most shards x BUCKETS rows
            weights.setdefault(r["__node"], []).append((r["bucket"], r["w"], r["n"]))
        for i, s in list(seeking.items()):
            before = 0
            for bucket, w, n in sorted(weights[i]):
                if before + w >= s["want"]:
                    break
                before += w
            start = s["lo"] + (bucket << s["width"])
            end = min(s["hi"], start + (1 << s["width"]) - 1)
            if n == 1 or s["width"] == 0 or w <= TOLERANCE * leaf_bytes:
                found[i] = (s["dim"], end if s["want"] - before > w / 2 else start - 1)
                del seeking[i]
            else:
                s["lo"], s["hi"], s["want"] = start, end, s["want"] - before
    return found


def kd_tree(points: DataFrame, dims: int, shards: int, *carried: str) -> DataFrame:
    """`points` (rid, bytes, d0, d1, ... and the `carried` columns) with the shard of every row."""
    spans = [f(f"d{d}").alias(f"{n}{d}") for d in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]
    whole = points.agg(F.sum("bytes").alias("w"), *spans).first()
    tie = F.xxhash64("rid").bitwiseAND(F.lit((1 << TIE_BITS) - 1).cast("long"))
    placed = []
    for d in range(dims):
        lo, hi = whole[f"lo{d}"] or 0.0, whole[f"hi{d}"] or 0.0
        place = (F.col(f"d{d}") - lo) / (hi - lo) * COORDINATE if hi > lo else F.lit(0)
        placed.append((F.shiftleft(place.cast("long"), TIE_BITS) + tie).alias(f"k{d}"))
    points = store(points.select(*carried, "rid", "bytes", *placed), "keys")
    keys = [F.col(f"k{d}") for d in range(dims)]
    nodes = [Node(shards, 0)]
    while whole["w"] is not None and any(n.shards > 1 for n in nodes):
        cuts = _cuts(points, nodes, keys, whole["w"] / shards)
        grown = []
        for i, n in enumerate(nodes):
            if n.shards == 1:
                grown.append(n)
                continue
            # A node without rows is still split, so that every shard has a place in the tree.
            dim, cut = cuts.get(i, (0, -1))
            half = n.shards // 2
            grown.append(Node(half, n.first, [*n.tests, (dim, True, cut)]))
            grown.append(Node(n.shards - half, n.first + half, [*n.tests, (dim, False, cut)]))
        nodes = grown
    return points.withColumn("shard", _number_of(nodes, keys)).drop(*[f"k{d}" for d in range(dims)])


def with_slots(rows: DataFrame, key: str) -> DataFrame:
    """Number the rows of every `key` from 0 without gaps: blocks are counted first, so that no task has to hold
    more than a block of about SLOT_ROWS rows, however large a key is."""
    blocks = max(1, math.ceil(rows.count() / SLOT_ROWS))
    rows = rows.withColumn("__block", F.pmod(F.xxhash64("rid", F.lit(7)), F.lit(blocks)))
    counts = rows.groupBy(key, "__block").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "__block", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(key, "__block").orderBy("rid")) - 1
    placed = rows.withColumn("__at", inside).join(starts, [key, "__block"])
    return placed.withColumn("slot", (F.col("__start") + F.col("__at")).cast("long")).drop("__block", "__at", "__start")


def shard_documents(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dims: dict[str, Column] | None = None
) -> DataFrame:
    """All rows with doc_id, size, text_crc32, shard and slot.

    Give the number of shards, or `target_bytes`: leaves are split until they hold about that much. The size of a
    row is the UTF-8 bytes of its text plus 16. `dims` are the metadata dimensions (default: source, lang, length
    of the text, doc_id). A null is the lowest value of its dimension, equal rows are told apart by their place in
    a stored copy of the narrow columns, so one label or text on a third of all rows is split like any other.
    Repeated rows each get a slot. Empty table: no rows.
    """
    if dims is None:
        dims = {
            "source": label(F.col("source")),
            "lang": label(F.col("lang")),
            "length": F.log2(F.lit(1.0) + utf8_bytes(F.col("text"))),
            "doc_id": number(F.col("doc_id")),
        }
    points = store(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            (utf8_bytes(F.col("text")) + OVERHEAD).alias("bytes"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            *[c.alias(f"d{i}") for i, c in enumerate(dims.values())],
        ),
        "points",
    )
    if shards is None:
        shards = max(1, math.ceil((points.agg(F.sum("bytes")).first()[0] or 0) / target_bytes))
    rows = kd_tree(points, len(dims), shards, "doc_id", "text_crc32").withColumnRenamed("bytes", "size")
    return with_slots(rows, "shard").drop("rid")
