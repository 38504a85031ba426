"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame operations only.

All words that the mix takes lie on one line: source after source, each with as many words as its target, in the
order of its shuffled documents, begun again when the source is used up. The line is cut into blocks of equally many
words. The points of the van der Corput sequence (the bits of the slot number reversed) fall on the line, which is
the cumulative scale of the targets: a slot gives to the source in which its point lies, so any run of slots holds
the sources close to their targets. Slots are ranked within their source, and the slot of rank r takes the source's
r-th block. A block on the border of two sources belongs to the one in which it begins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollout_quality.llm.common import ready, store

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_WORDS = 256
REPEATS = 3
# Rows that a window holds at most, about; sums of whole groups come first.
GROUP_BITS = 12
PLACE_BITS = 60


class Mixed(NamedTuple):
    """documents: rid, doc_id, source, size, source_size, target. pieces: slot, offset, rid, doc_id, source, turn,
    start, length: words `start` to `start + length` of a document stand at `offset` of a slot, for the `turn`-th time."""

    documents: DataFrame
    pieces: DataFrame


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running(rows: DataFrame, by: Sequence[str], group: str, order: Sequence[str], value: Column, out: str) -> DataFrame:
    """Add the sum of `value` over the rows before, by `group` and inside a group by `order`, among equal `by`."""
    valued = rows.withColumn("__value", value)
    sums = valued.groupBy(*by, group).agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*by).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by, group, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*by, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = valued.withColumn("__within", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    placed = within.join(starts, [*by, group])
    return placed.withColumn(out, (F.col("__start") + F.col("__within")).cast("long")).drop("__value", "__within", "__start")


def _weighted(sizes: DataFrame, weights: Sequence[float] | dict[str, float]) -> DataFrame:
    """Sources in order of their code points, null last, with their ordinal and weight."""
    ranged = sizes.repartitionByRange("key").withColumn("part", F.spark_partition_id())
    ranked = running(store(ranged, "mix-sources"), [], "part", ["key"], F.lit(1), "ordinal").drop("part")
    if isinstance(weights, dict):
        given = sizes.sparkSession.createDataFrame(list(weights.items()), "name string, weight double")
        named = given.select(F.concat(F.lit("s"), "name").alias("key"), "weight")
        return ranked.join(named, "key", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    turn = (F.col("ordinal") % len(weights) + 1).cast("int")
    return ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))


def targets(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Add `target`: shares of all sizes by weight, at most `repeats` times a source's size, the excess reshared.

    Every pass finds the sources that the level reaches from one row of sums, until it reaches no further one.
    """
    cap = F.col("source_size") * F.lit(repeats)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, reached = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        found = sources.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, cap)).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("open")
        ).first()
        if found["n"] == reached or not found["open"]:
            break
        reached, level = found["n"], (total - (found["held"] or 0)) / found["open"]
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(share >= cap, cap.cast("double")).otherwise(share))


def _slots(sources: DataFrame, blocks: int, block: int) -> DataFrame:
    """slot (from 0, in the order of the schedule) and the block it takes."""
    bits = max(1, (blocks - 1).bit_length())
    point = F.conv(F.reverse(F.lpad(F.bin("id"), bits, "0")), 2, 10).cast("long")
    points = sources.sparkSession.range(1 << bits).select("id", point.alias("at")).where(F.col("at") < blocks)
    points = points.select("id", "at", F.shiftright("at", GROUP_BITS).alias("bucket"), F.lit(True).alias("slot"))
    # Where the blocks of each source begin, once in every stretch of the line that they reach.
    first, last = (F.floor((F.col(c) + F.lit(block - 1)) / block).cast("long") for c in ("line", "end"))
    owned = sources.select("ordinal", first.alias("first"), last.alias("after")).where("first < after")
    reach = F.sequence(F.shiftright("first", GROUP_BITS), F.shiftright(F.col("after") - 1, GROUP_BITS))
    edges = owned.withColumn("bucket", F.explode(reach))
    edges = edges.select(F.greatest("first", F.shiftleft("bucket", GROUP_BITS)).alias("at"), "bucket", "ordinal", "first")
    before = Window.partitionBy("bucket").orderBy("at", F.col("slot").asc_nulls_first())
    both = points.unionByName(edges, allowMissingColumns=True)
    dealt = both.withColumns({c: F.last(c, ignorenulls=True).over(before) for c in ("ordinal", "first")}).where("slot")
    turns = dealt.select("id", "ordinal", "first", F.shiftright("id", GROUP_BITS).alias("stretch"))
    ranked = running(turns, ["ordinal"], "stretch", ["id"], F.lit(1), "rank")
    numbered = running(ranked, [], "stretch", ["id"], F.lit(1), "slot")
    return numbered.select("slot", (F.col("first") + F.col("rank")).alias("block"))


def mix(
    docs: DataFrame, weights: Sequence[float] | dict[str, float] = WEIGHTS, block: int = BLOCK_WORDS, repeats: int = REPEATS
) -> Mixed:
    """Take as many words as there are, from each source its target share, no document more than `repeats` times.

    `weights` are repeated over the sources in code point order, or given by source (others then weigh 0; a null
    source has no name and weighs 0 too). A null source is a source of its own and comes last. A null or empty text
    has size 0, is a document and gives no piece. A long text is cut into blocks like any other; nothing is dropped
    but what the target leaves out. Repeated rows are documents of their own; rows alike in id, text and size are
    interchangeable. The order of a source's documents follows from digests of id and text, so reruns agree. An
    empty table, or one without words, gives no pieces. Columns other than doc_id, source and text are not read.
    """
    spark = ready(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), F.md5(text)).cast("binary"))
    rows = store(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            "source",
            # Null sorts after every name.
            F.when(F.col("source").isNull(), "t").otherwise(F.concat(F.lit("s"), "source")).alias("key"),
            words(F.col("text")).alias("size"),
            F.conv(F.substring(digest, 1, PLACE_BITS // 4), 16, 10).cast("long").alias("place"),
        ),
        "mix-sizes",
    )
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    aimed = store(targets(_weighted(sizes, weights), repeats), "mix-targets")
    aimed = aimed.withColumns({"take": F.floor("target").cast("long"), "stretch": F.shiftright("ordinal", GROUP_BITS)})
    lined = running(aimed, [], "stretch", ["ordinal"], F.col("take"), "line").drop("stretch")
    sources = store(lined.withColumn("end", F.col("line") + F.col("take")), "mix-line")
    words_taken = sources.agg(F.sum("take")).first()[0] or 0

    groups = max(0, math.ceil(rows.count() / (1 << GROUP_BITS)) - 1).bit_length()
    grouped = rows.withColumn("group", F.shiftright("place", PLACE_BITS - groups))
    # A source's figures reach its documents by (source, group), so a large source is many keys.
    starts = grouped.groupBy("key", "group").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("key").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).drop("sum").join(sources, "key")
    inside = Window.partitionBy("key", "group").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = grouped.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["key", "group"])
    placed = placed.withColumn("from", F.col("before") + F.col("within"))
    found = store(placed.select("rid", "doc_id", "source", "size", "source_size", "target", "from", "take", "line"), "mix-placed")

    begin = F.expr("line + turn * source_size + from")
    pieces = (
        found.where("size > 0 AND from < take")
        .withColumn("turn", F.explode(F.expr("sequence(0, (take - 1 - from) div source_size)")))
        .withColumns({"begin": begin, "stop": F.least(begin + F.col("size"), F.col("line") + F.col("take"))})
        .withColumn("block", F.explode(F.expr(f"sequence(begin div {block}, (stop - 1) div {block})")))
        .withColumns({"low": F.greatest("begin", F.col("block") * block), "high": F.least("stop", (F.col("block") + 1) * block)})
        .select(
            "rid", "doc_id", "source", "turn", (F.col("low") - F.col("begin")).alias("start"),
            (F.col("high") - F.col("low")).alias("length"), "block", (F.col("low") % block).alias("offset"),
        )
    )
    slots = _slots(sources, -(-words_taken // block), block) if words_taken else spark.createDataFrame([], "slot long, block long")
    scheduled = pieces.join(slots, "block")
    return Mixed(
        found.select("rid", "doc_id", "source", "size", "source_size", "target"),
        scheduled.select("slot", "offset", "rid", "doc_id", "source", "turn", "start", "length"),
    )


def taken(mixed: Mixed) -> DataFrame:
    """The documents with `taken`, the words that the schedule takes of each, repeats counted."""
    sums = mixed.pieces.groupBy("rid").agg(F.sum("length").alias("taken"))
    return mixed.documents.join(sums, "rid", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")).drop("rid")
