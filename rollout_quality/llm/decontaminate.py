"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over the words of every text.

Words of the benchmark get numbers; a window of words is a polynomial hash of numbers, computed for all windows
of a text at once. Hash hits are verified by comparing the numbers of all their words. A benchmark larger than
BLOCK_BYTES is scanned in blocks of that size, so what is broadcast never grows beyond it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rollout_quality.llm.common import ready, store

N = 10
BLOCK_BYTES = 64_000_000
MAX_HIT_SHARE = 0.0
NOT_WORD = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in NOT_WORD else c for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of a-z, 0-9 and characters beyond ASCII."""
    return (text or "").encode().translate(_FOLD).split()


class NGramSet:
    """Windows of benchmark items: `n` consecutive words, or all words of a shorter item."""

    def __init__(self, items: list[tuple], n: int = N):
        self.number: dict[bytes, int] = {}
        self.items: list = []
        self.windows: dict[int, dict[tuple, list[int]]] = {}
        for item_id, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            if not ids:
                continue
            here, size = len(self.items), min(n, len(ids))
            self.items.append(item_id)
            group = self.windows.setdefault(size, {})
            for i in range(len(ids) - size + 1):
                owners = group.setdefault(tuple(ids[i : i + size]), [])
                if not owners or owners[-1] != here:
                    owners.append(here)
        self.hashes = {
            size: np.unique(self._hash(np.array(list(group), np.uint64).T)) for size, group in self.windows.items()
        }

    @staticmethod
    def _hash(columns) -> np.ndarray:
        out = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            out = out * _BASE + column
        return out

    def find(self, text_words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the items that occur."""
        count = len(text_words)
        hit, items = np.zeros(count, bool), set()
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in text_words), np.uint64, count)
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        for size, group in self.windows.items():
            if count < size:
                continue
            starts = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(starts):
                continue
            hashed, known = self._hash([ids[starts + j] for j in range(size)]), self.hashes[size]
            place = np.searchsorted(known, hashed)
            for i in starts[known[np.minimum(place, len(known) - 1)] == hashed]:
                owners = group.get(tuple(ids[i : i + size].tolist()))
                if owners:
                    hit[i : i + size] = True
                    items.update(owners)
        return hit, items


def _ranges(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs of hit words, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist()


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[list[tuple]]:
    """The benchmark in parts of about `block_bytes`; one part is in driver memory at a time while it is cut."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    total = benchmark.agg(F.sum(size).alias("b")).first()["b"] or 0
    count = max(1, math.ceil(total / block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for b in range(count):
        yield [tuple(r) for r in benchmark.filter(part == b).select("item_id", "text").collect()]


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows and columns of `docs`, plus __n_words, __ranges (starts and ends of hit word runs) and __items
    (ids, as strings, of the items with an occurring window).

    Null texts have no words. Items without words have no window; repeated items are reported once by id, an item
    without id as the empty string. Empty benchmark: nothing is hit. Empty table: no rows.
    """
    spark = ready(docs.sparkSession)
    out = docs.withColumns(
        {
            "__n_words": F.lit(0).cast("long"),
            "__ranges": F.array().cast("array<int>"),
            "__items": F.array().cast("array<string>"),
        }
    )
    for number, block in enumerate(_blocks(benchmark, block_bytes)):
        if number and number % 4 == 0:
            out = store(out, "scanned")  # bounds the workers that one task runs side by side
        grams = spark.sparkContext.broadcast(NGramSet(block, n))

        def find(frames: Iterator[pd.DataFrame], grams=grams) -> Iterator[pd.DataFrame]:
            known = grams.value
            for frame in frames:
                counts, ranges, items = [], [], []
                for text, before, names in zip(frame["text"], frame["__ranges"], frame["__items"]):
                    here = words(text)
                    hit, found = known.find(here)
                    for start, end in zip(before[::2], before[1::2]):
                        hit[start:end] = True
                    counts.append(len(here))
                    ranges.append(_ranges(hit))
                    found = {"" if known.items[i] is None else str(known.items[i]) for i in found}
                    items.append(sorted(found | set(names)))
                yield frame.assign(__n_words=counts, __ranges=ranges, __items=items)

        out = out.mapInPandas(find, out.schema)
    return out


def hit_words() -> Column:
    ends = F.filter("__ranges", lambda _, i: i % 2 == 1)
    starts = F.filter("__ranges", lambda _, i: i % 2 == 0)
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    return total(ends) - total(starts)


def cut_spans(text: str | None, ranges: list[int]) -> str | None:
    """The text without its hit runs of words (from the first character of a run to the last)."""
    if text is None or not len(ranges):
        return text
    spans = [m.span() for m in _WORD.finditer(text.translate(_UPPER))]
    kept, at = [], 0
    for start, end in zip(ranges[::2], ranges[1::2]):
        kept.append(text[at : spans[start][0]])
        at = spans[end - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    max_hit_share: float = MAX_HIT_SHARE,
    n: int = N,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`docs` without benchmark text, same columns.

    remove="documents": rows go if more than `max_hit_share` of their words are hit. remove="spans": hit runs of
    words are cut out of the texts, and rows go only if more than `max_hit_share` of their words are hit (give 1.0
    to keep all). Rows without a hit stay as they are, null and empty texts too.
    """
    found = scan(docs, benchmark, n, block_bytes)
    clean = found.filter((F.size("__ranges") == 0) | (hit_words() <= max_hit_share * F.col("__n_words")))
    if remove == "documents":
        return clean.select(docs.columns)
    schema = docs.schema

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [cut_spans(t, r) for t, r in zip(frame["text"], frame["__ranges"])]
            yield frame.assign(text=texts)[schema.names]

    return clean.mapInPandas(cut, schema)
