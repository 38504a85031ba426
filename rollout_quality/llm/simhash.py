"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance 4 or less have a common variant: a value within 2 bits of both. Every distinct
fingerprint emits all its variants within 2 bits, variants are shuffled, and fingerprints that meet at a variant
are linked to the smallest of them (they are at distance 2 + 2 at most, which is verified all the same). What
crosses the network is not the 2,081 variants but their leading bits: a fingerprint goes once to every block of
leading bits in which it has variants, and the block's task writes them out. Blocks that hold much more than the
mean are cut by further bits. A block returns a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from rollout_quality.llm.common import ready, store

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCK_ROWS = 4000
HEAVY = 3
SPLIT_BITS = 6
CHUNK = 1 << 15
_LIGHT = np.int64(1) << np.int64(40)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half the XXH64 hashes of the word shingles; zero without words."""
    parts = (text or "").encode().lower().split()  # bytes.lower() folds A-Z only, split() cuts at ASCII spaces
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(parts))
    digest, count = xxhash.xxh64_intdigest, len(parts) - width + 1
    pairs = zip(starts[:count].tolist(), ends[width - 1 :].tolist())
    return majority(np.fromiter((digest(line[s:e], SEED) for s, e in pairs), np.uint64, count))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; zero if there are none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint as a signed long, for every row."""
    ready(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = np.array([fingerprint(t, shingle) for t in frame["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fp": values.view(np.int64)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fp long")


def _masks(bits: int, radius: int) -> list[np.ndarray]:
    """By number of flipped bits: all masks of that many among `bits`."""
    return [
        np.array([sum(1 << i for i in c) for c in combinations(range(bits), k)], np.uint64)
        for k in range(radius + 1)
    ]


def _deal(fps: np.ndarray, bits: int, half: int, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, fingerprint) for all blocks of `bits` leading bits that hold variants; heavy blocks are cut further."""
    low, sub = np.uint64(64 - bits), np.uint64(64 - bits - SPLIT_BITS)
    blocks, owners = [], []
    for flips, masks in enumerate(_masks(bits, half)):
        top = ((fps >> low)[:, None] ^ masks[None, :]).ravel()
        owner = np.repeat(fps, len(masks))
        cut = np.isin(top, heavy)
        blocks.append(top[~cut].astype(np.int64))
        owners.append(owner[~cut])
        if cut.any():
            top, owner = top[cut], owner[cut]
            below = (owner >> sub) & np.uint64((1 << SPLIT_BITS) - 1)
            for more in _masks(SPLIT_BITS, half - flips):
                inner = (top << np.uint64(SPLIT_BITS))[:, None] | (below[:, None] ^ more[None, :])
                blocks.append(inner.ravel().astype(np.int64) + _LIGHT)
                owners.append(np.repeat(owner, len(more)))
    return np.concatenate(blocks), np.concatenate(owners)


def _variants(fps: np.ndarray, block: int, bits: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """All variants of the fingerprints that lie in the block, and whose they are (positions in `fps`)."""
    if block >= _LIGHT:
        block, bits = block - int(_LIGHT), bits + SPLIT_BITS
    low = np.uint64(64 - bits)
    flips = np.bitwise_count((fps >> low) ^ np.uint64(block))
    values, owners = [], []
    for k in range(half + 1):
        at = np.flatnonzero(flips == k)
        inside = (fps[at] & ((np.uint64(1) << low) - np.uint64(1))) | (np.uint64(block) << low)
        for masks in _masks(64 - bits, half - k):
            values.append((inside[:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(at, len(masks)))
    return np.concatenate(values), np.concatenate(owners)


def _forest(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """For 0 .. count-1: the smallest number reachable over the links a-b."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        grown = root.copy()
        np.minimum.at(grown, a, low)
        np.minimum.at(grown, b, low)
        np.minimum.at(grown, root[a], low)
        np.minimum.at(grown, root[b], low)
        grown = grown[grown]
        if np.array_equal(grown, root):
            return root
        root = grown


def links_of_block(fps: np.ndarray, block: int, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) that connect all fingerprints meeting at a variant of the block."""
    fps = np.unique(fps)
    values, owners = _variants(fps, block, bits, radius // 2)
    order = np.argsort(values)
    values, owners = values[order], owners[order]
    fresh = np.concatenate(([True], values[1:] != values[:-1]))
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, len(values)))
    met = np.repeat(sizes > 1, sizes)
    if not met.any():
        return fps[:0], fps[:0]
    head = np.repeat(owners[heads], sizes)[met]
    other = owners[met]
    near = np.bitwise_count(fps[head] ^ fps[other]) <= radius
    root = _forest(head[near], other[near], len(fps))
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return fps[linked], fps[root[linked]]


def near_links(distinct: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that give the same components as all pairs within
    `radius` bits (an even number)."""
    if radius % 2:
        raise ValueError("the radius must be even: both sides cover half of it")
    half, rows = radius // 2, distinct.count()
    bits = 4
    while bits < 24 and rows * sum(math.comb(bits, k) for k in range(half + 1)) > block_rows << bits:
        bits += 1
    mean = max(1.0, rows * sum(math.comb(bits, k) for k in range(half + 1)) / (1 << bits))
    none = np.array([], np.uint64)

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << bits, np.int64)
        for frame in frames:
            blocks, _ = _deal(frame["fp"].to_numpy().view(np.uint64), bits, half, none)
            total += np.bincount(blocks, minlength=1 << bits)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"block": found, "n": total[found]})

    counts = distinct.mapInPandas(tally, "block long, n long").groupBy("block").agg(F.sum("n").alias("n"))
    # At most a HEAVY-th of all blocks can be that far above the mean.
    full = counts.filter(F.col("n") > HEAVY * mean).select("block").collect()
    heavy = np.array([r["block"] for r in full], np.uint64)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            blocks, owners = _deal(frame["fp"].to_numpy().view(np.uint64), bits, half, heavy)
            for at in range(0, len(blocks), 1 << 17):
                part = slice(at, at + (1 << 17))
                yield pd.DataFrame({"block": blocks[part], "fp": owners[part].view(np.int64)})

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        fps = frame["fp"].to_numpy().view(np.uint64)
        u, v = links_of_block(fps, int(frame["block"].iloc[0]), bits, radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    dealt = distinct.mapInPandas(deal, "block long, fp long")
    return dealt.groupBy("block").applyInPandas(meet, "u long, v long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link table (u, v): the root is the smallest node reachable.

    Alternates two steps until the links no longer change: every node hands its larger neighbours to its smallest
    one, then its smaller ones. Each round is a stored table.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m"))

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = store(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        own = smallest(large)
        small = large.join(own, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = store(small.unionByName(own.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) for every row.

    Texts without words, null texts among them, have fingerprint zero and are linked like any other. Repeated rows
    stay repeated. A row without a doc_id is linked, but its component is named by the others; a component of such
    rows only has a null id. Empty table: no rows.
    """
    prints = store(with_fingerprints(docs, shingle), "fingerprints")
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(near_links(distinct.select("fp"), radius))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs` with one document of each group: the one whose doc_id is the smallest.

    Repeated rows of one doc_id are one document and all stay or go. Rows without a doc_id stay: they cannot be
    told apart from the document that represents them.
    """
    stays = near_duplicates(docs, radius, shingle).filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(stays, "doc_id", "left_anti").select(docs.columns)
