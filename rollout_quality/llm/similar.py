"""Near duplicates by SimHash fingerprints and MinHash bands of word shingles: both propose pairs, shingle sets decide.

Texts with equal shingle sets are one node. Nodes whose fingerprints are linked by ball hashing (`simhash.near_links`)
are compared first. At similarity 0.8 fingerprints differ in up to 14 of 64 bits (README), which a ball cannot carry, so
bands propose the rest: sets whose similarity is s share one with probability 1 - (1 - s**ROWS)**BANDS, 0.9996 at 0.8.
All pairs of a band of at most SMALL nodes are compared; in larger bands every node is first compared with the band's
first and with the AHEAD nodes that follow it by size, which joins most of a family of copies. A second pass compares
all nodes of these bands that are not in one group by then, in blocks: the groups are as if all pairs of every band had
been compared, but what travels are the nodes of a band and never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from rollout_quality.llm.common import ready, store
from rollout_quality.llm.simhash import RADIUS, components, majority, near_links

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
SMALL, AHEAD = 8, 4
# A block of a band holds at most so many nodes, and so many shingles or one node.
BLOCK_NODES, BLOCK_ITEMS = 512, 1 << 20
SEED = 42
CHUNK = 1 << 12
_RNG = np.random.default_rng(SEED)
_TIMES = _RNG.integers(0, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, BANDS * ROWS).astype(np.uint32)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the word shingles; of all words if they are fewer; none without words."""
    parts = (text or "").encode().lower().split()
    width, digest = min(size, len(parts)), xxhash.xxh64_intdigest
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    pairs = zip(starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.unique(np.fromiter((digest(line[s:e], SEED) for s, e in pairs), np.uint64, len(parts) - width + 1))


def node(found: np.ndarray) -> int:
    """Digest of a shingle set, as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).astype(np.int64))


def bands(found: np.ndarray) -> list[int]:
    """A key for every band, as signed longs; empty sets meet in all."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    low = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(low), CHUNK):
        np.minimum(least, (_TIMES[:, None] * low[None, at : at + CHUNK] + _PLUS[:, None]).min(1), out=least)
    keys = [xxhash.xxh64_intdigest(part.tobytes(), b) for b, part in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets; two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _prints(docs: DataFrame, size: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t, size) for t in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"], "node": [node(s) for s in sets], "n": [len(s) for s in sets],
                    "fp": np.array([majority(s) for s in sets], np.uint64).view(np.int64), "keys": [bands(s) for s in sets],
                }
            )

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, node long, n long, fp long, keys array<long>")


def close_prints(nodes: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of nodes (node, n, fp) by SimHash: each node with the first of its fingerprint, and the firsts of
    fingerprints that ball hashing links, if their sizes allow the similarity."""
    firsts = store(nodes.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("head")), "fingerprints")
    of = lambda name: firsts.select(F.col("fp").alias(name), F.col("head").alias(f"{name}_head"))
    linked = near_links(firsts.select("fp"), radius).join(of("u"), "u").join(of("v"), "v").select("u_head", "v_head")
    same = nodes.join(firsts, "fp").select(F.struct("node", "n").alias("u_head"), F.col("head").alias("v_head"))
    a, b = F.col("u_head.node"), F.col("v_head.node")
    fits = F.least("u_head.n", "v_head.n") >= similarity * F.greatest("u_head.n", "v_head.n")
    return linked.unionByName(same).filter((a != b) & fits).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def candidates(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Distinct pairs (a, b) of nodes (node, n, keys) that meet in a band and whose sizes allow the similarity."""
    met = nodes.select("node", "n", F.explode("keys").alias("key"))
    # Every node is held against the few that stand ahead of it and the first of its band: no self-join.
    order = Window.partitionBy("key").orderBy("n", "node")
    ahead = met.select(
        "node", "n", F.count(F.lit(1)).over(Window.partitionBy("key")).alias("m"),
        F.first(F.struct("node", "n")).over(order).alias("head"),
        F.collect_list(F.struct("node", "n")).over(order.rowsBetween(1, SMALL - 1)).alias("next"),
    ).filter("m > 1")
    near = F.when(F.col("m") <= SMALL, F.col("next")).otherwise(F.slice("next", 1, AHEAD))
    pairs = ahead.select("node", "n", F.explode(F.concat(near, F.array("head"))).alias("o")).filter("node != o.node")
    fits = F.least("n", "o.n") >= similarity * F.greatest("n", "o.n")
    return pairs.filter(fits).select(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b")).distinct()


def apart(docs: DataFrame, nodes: DataFrame, roots: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """Links (u, v) that connect the nodes which meet in a band of more than SMALL nodes, have at least the similarity and
    are not in one group: all that `candidates` left out and that can still matter."""
    grouped = nodes.join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root"), "keys")
    met = grouped.select("node", "n", "root", F.explode("keys").alias("key"))
    held = met.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
    band = held.groupBy("key").agg(F.sum("m").alias("m"), F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("m", "root")).alias("main"))
    mixed = met.join(band.filter((F.col("m") > SMALL) & (F.col("roots") > 1)).select("key", "main"), "key")
    before = Window.partitionBy("key").orderBy("n", "node").rowsBetween(Window.unboundedPreceding, -1)
    rows, items = F.count(F.lit(1)).over(before), F.coalesce(F.sum("n").over(before), F.lit(0))
    block = F.floor(rows / BLOCK_NODES) + F.floor(items / BLOCK_ITEMS)
    # The nodes of a band's largest group are compared with those outside it only.
    placed = store(mixed.select("key", "node", "n", "root", (F.col("root") != F.col("main")).alias("outside"), block.alias("block")), "mixed-bands")
    blocks = placed.groupBy("key", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("outside").alias("outside"))
    x, y = blocks.filter("outside").alias("x"), blocks.alias("y")
    fits = (F.col("y.high") + 1 >= similarity * F.col("x.low")) & (F.col("x.high") + 1 >= similarity * F.col("y.low"))
    meet = x.join(y, F.col("x.key") == F.col("y.key")).filter(fits)
    meet = meet.select(F.col("x.key").alias("key"), F.col("x.block").alias("one"), F.col("y.block").alias("two"))
    sets = _items(docs, nodes, placed.select("node"), size)
    full = placed.join(sets, "node")
    left = full.filter("outside").join(meet.withColumn("block", F.col("one")), ["key", "block"])
    right = full.join(meet.withColumn("block", F.col("two")), ["key", "block"])
    by = ("key", "one", "two")
    own = [F.col(c).alias(c) for c in (*by, "node", "root", "items")]  # columns of their own: both sides come from one table

    def compare(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        return links_of_blocks(one, two, similarity)

    pairs = left.select(own).groupBy(*by).cogroup(right.select(own).groupBy(*by))
    return pairs.applyInPandas(compare, "u long, v long").distinct()


def links_of_blocks(one: pd.DataFrame, two: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links (u, v) that connect all nodes of `one` with those of `two` (node, root, items) that have at least the
    similarity and another root. At most one link joins two groups, so there are fewer links than nodes."""
    sets = [np.frombuffer(raw, np.uint64) for raw in two["items"]]
    ends = np.cumsum([0] + [len(s) for s in sets])
    known, ids = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
    nodes, group, sizes, found = two["node"].to_numpy(), two["root"].to_numpy().copy(), np.diff(ends), []
    asked = np.zeros(len(known), bool)
    alias: dict[int, int] = {}  # groups that a link has joined to another
    for u, root, raw in zip(one["node"].tolist(), one["root"].tolist(), one["items"]):
        while root in alias:
            root = alias[root]
        own = np.frombuffer(raw, np.uint64)
        _, at, _ = np.intersect1d(known, own, assume_unique=True, return_indices=True)
        asked[at] = True
        hits = np.concatenate(([0], np.cumsum(asked[ids])))
        asked[at] = False
        both = hits[ends[1:]] - hits[ends[:-1]]
        union = len(own) + sizes - both
        near = np.flatnonzero((group != root) & (both / np.maximum(union, 1) >= similarity))
        others, first = np.unique(group[near], return_index=True)
        for other, k in zip(others.tolist(), near[first].tolist()):
            found.append((u, int(nodes[k])))
            group[group == other] = root
            alias[other] = root
    return pd.DataFrame(found, columns=["u", "v"], dtype="int64")


def similar_links(docs: DataFrame, prints: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """Links (u, v) between nodes whose shingle sets have at least the similarity: enough of them to connect all nodes
    that a chain of such pairs connects."""
    firsts = [F.first(c).alias(c) for c in ("n", "fp", "keys")]
    nodes = store(prints.groupBy("node").agg(F.min("doc_id").alias("first"), *firsts), "shingle-sets")
    pairs = close_prints(nodes, similarity).unionByName(candidates(nodes, similarity)).distinct()
    links = store(_verified(docs, nodes, pairs, similarity, size), "similar")
    return links.unionByName(apart(docs, nodes, components(links), similarity, size))


def _items(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """A stored table (node, items) of the shingle sets of the wanted nodes."""
    asked = wanted.select("node").distinct().join(nodes.select("node", "first"), "node")

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [shingles(t, size) for t in frame["text"]]
            # A doc_id can stand for other texts, too.
            own = [k for k, (s, n) in enumerate(zip(found, frame["node"])) if node(s) == n]
            yield pd.DataFrame({"node": frame["node"].iloc[own], "items": [found[k].tobytes() for k in own]})

    texts = docs.select(F.col("doc_id").alias("first"), "text").join(asked, "first").select("node", "text")
    return store(texts.mapInPandas(sets, "node long, items binary").dropDuplicates(["node"]), "shingle-items")


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, similarity: float, size: int) -> DataFrame:
    """Of the pairs (a, b) those whose shingle sets have at least the similarity, as links (u, v)."""
    pairs = store(pairs, "candidates")
    items = _items(docs, nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")), size)
    both = pairs.join(items.select(F.col("node").alias("a"), F.col("items").alias("left")), "a").join(
        items.select(F.col("node").alias("b"), F.col("items").alias("right")), "b"
    )

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            near = [
                jaccard(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= similarity
                for a, b in zip(frame["left"], frame["right"])
            ]
            yield pd.DataFrame({"u": frame["a"], "v": frame["b"]})[np.array(near, bool)]

    return both.mapInPandas(verify, "u long, v long")


def keep_first(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """The rows of `docs` with one document of each group of similar ones: the one whose doc_id is the smallest.

    Groups are connected by pairs of at least the similarity. Texts without words are equal. Repeated rows of one
    doc_id are one document and all stay or go. Rows without a doc_id stay and link no others.
    """
    ready(docs.sparkSession)
    prints = store(_prints(docs.filter("doc_id IS NOT NULL"), size), "minhash")
    roots = components(similar_links(docs, prints, similarity, size))
    classes = prints.select("doc_id", "node").join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    firsts = classes.groupBy("root").agg(F.min("doc_id").alias("first"))
    goes = classes.join(firsts, "root").filter("doc_id != first").select("doc_id").distinct()
    return docs.join(goes, "doc_id", "left_anti").select(docs.columns)
