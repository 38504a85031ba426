"""Phrase collocations by dynamic itemset counting.

The corpus is coded once into shards. Shards are scanned in a cycle; words are counted from the first scan on, a longer
phrase from the scan after both its parts (all but its last word, all but its first) have reached the threshold, while
shorter ones are still being counted. Every phrase is counted until it has seen each shard once, so a phrase that
starts late ends late, and lengths interleave instead of taking a pass each.

Counts of the cycle are kept in counters that phrases share by hash, a fixed fraction of the corpus' words, spread over
segments. A counter is never below the count of any phrase in it, so no frequent phrase is lost; at the end the phrases
whose counter reached the threshold are counted by their words, which makes all results exact. Which phrases are active
follows from the counters alone: phrases are active in a scan if their parts had reached the threshold before it, and
done if that was so a whole cycle earlier.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollout_quality.llm.common import ready, scratch, store

THRESHOLD = 30
LONGEST = 4
SHARDS = 4
TOP = 2000
PARTS = 16
NAMED_SPLITS = 4
NO_LANG = "und"
# Words of a coded row, rows of a file, and places collected before they are summed: bounds of a task's memory.
ROW_WORDS = 1 << 20
FILE_ROWS = 8
CHUNK_CHARS = 1 << 22
HELD_PLACES = 1 << 22
WORDS_PER_COUNTER = 8
SEGMENT_BITS = 18
# Bits of the filter of one scan; with more counters a shard is scanned once for every such slice of them.
FILTER_BITS = 28

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAKS = ".,;:!?\x0b\x0c\r"
CODED = "lang string, shard int, words array<string>, codes binary, n long"
FOUND = "length int, segment long, n long, steps binary, counts binary"
STATE = "length int, segment long, counts binary, reached binary, n_reached long"


# ---- Coding --------------------------------------------------------------------------------------------------------


def prepared(text: Column) -> Column:
    """A-Z in lower case, pieces apart by line feeds, words by spaces."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER + BREAKS + "\t", UPPER.lower() + "\n" * len(BREAKS) + " ")


def _chunks(text: str) -> Iterator[str]:
    """A long text in parts that end with a piece."""
    at = 0
    while len(text) - at > CHUNK_CHARS:
        end = text.find("\n", at + CHUNK_CHARS)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


class _Book:
    """Words of a language in the order of their first use, and texts as their numbers; 0 ends a piece."""

    def __init__(self):
        self.numbers = defaultdict(count(1).__next__, {"\n": 0, "": -1})
        self.codes: list[np.ndarray] = []

    def add(self, text: str) -> int:
        tokens = text.replace("\n", " \n ").split(" ")
        codes = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
        codes = np.append(codes[codes >= 0], np.int32(0))
        self.codes.append(codes)
        return len(codes)

    def row(self, lang: str, shard: int) -> dict:
        words = [w for w, i in self.numbers.items() if i > 0]
        codes = np.concatenate(self.codes)
        return {"lang": lang, "shard": shard, "words": words, "codes": codes.tobytes(), "n": int((codes > 0).sum())}


def coded(docs: DataFrame, shards: int) -> DataFrame:
    """A stored table of coded texts, one folder for each shard."""
    spark = ready(docs.sparkSession)
    row_words = ROW_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[str, _Book] = defaultdict(_Book)
        held, shard = 0, TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            rows = [book.row(lang, shard % shards) for lang, book in books.items()]
            books.clear()
            kinds = [pa.string(), pa.int32(), pa.list_(pa.string()), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(rows[0], kinds)], names=list(rows[0]))

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                for chunk in _chunks(text.as_py()):
                    held += books[lang].add(chunk)
                    if held >= row_words:
                        yield flush()
                        held, shard = 0, shard + 1
        if books:
            yield flush()

    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), prepared(F.col("text")).alias("text"))
    path = scratch(spark, "phrases")
    rows = texts.mapInArrow(run, CODED)
    rows.write.option("maxRecordsPerFile", FILE_ROWS).option("compression", "zstd").partitionBy("shard").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, as they travel and are stored."""
    return pa.Codec("zstd").compress(np.ascontiguousarray(values).tobytes(), asbytes=True)


def unsqueezed(raw: bytes, kind: type, size: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(raw, size * np.dtype(kind).itemsize, asbytes=True), kind)


# ---- Phrases of a coded row ----------------------------------------------------------------------------------------


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    """A number for each (not empty) word of a language, from its bytes by place. Words that share one share counters."""
    words = pa.concat_arrays([words.cast(pa.large_string())])
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    letters = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    starts, sizes = ends[:-1] - ends[0], np.diff(ends)
    powers = np.cumprod(np.full(sizes.max(), 0xC2B2AE3D27D4EB4F, np.uint64))
    letters *= powers[np.arange(len(letters)) - np.repeat(starts, sizes)]
    return mixed(np.add.reduceat(letters, starts) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))


class _Row:
    """Hashes of the phrases that begin at each place; `runs[n]` marks the places with n words in one piece."""

    def __init__(self, words: pa.Array, lang: str, codes: bytes, longest: int = LONGEST):
        self.codes = np.frombuffer(codes, np.int32)
        inside = self.codes > 0
        one = np.concatenate([np.zeros(1, np.uint64), word_hashes(words, lang)])[self.codes]
        self.hashes, self.runs = {1: one}, {1: inside}
        for n in range(2, longest + 1):
            self.hashes[n] = mixed(mixed(self.hashes[n - 1][:-1]) + one[n - 1 :])
            self.runs[n] = self.runs[n - 1][:-1] & inside[n - 1 :]

    def counters(self, n: int, bits: int) -> np.ndarray:
        return (self.hashes[n] >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Reached:
    """The counters of a slice that have reached the threshold, by phrase length, one bit each."""

    bits: dict[int, np.ndarray]
    first: int
    size: int

    def packed(self) -> tuple:
        """What travels to the tasks: mostly zeros, and each executor keeps it on its disk."""
        return {n: (len(b), squeezed(b)) for n, b in self.bits.items()}, self.first, self.size

    @classmethod
    def unpacked(cls, packed: tuple) -> "Reached":
        return cls({n: unsqueezed(raw, np.uint8, size) for n, (size, raw) in packed[0].items()}, *packed[1:])

    def mine(self, counters: np.ndarray) -> np.ndarray:
        return (counters >= self.first) & (counters < self.first + self.size)

    def holds(self, length: int, counters: np.ndarray) -> np.ndarray:
        """Of counters in the slice."""
        own = self.bits.get(length)
        if own is None:
            return np.zeros(len(counters), bool)
        at = counters - self.first
        return (own[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

    def parts(self, row: _Row, n: int, bits: int, among: np.ndarray) -> np.ndarray:
        """Of the places `among`, those where both parts of the phrase of n words have reached the threshold.

        The slice of a phrase is that of its first part. A second part in another slice counts as reached: its phrase
        is then counted although it need not be.
        """
        before = row.counters(n - 1, bits)
        among = among[self.mine(before[among])]
        among = among[self.holds(n - 1, before[among])]
        after = before[among + 1]
        known = self.mine(after)
        kept = ~known
        kept[known] = self.holds(n - 1, after[known])
        return among[kept]


def _active(row: _Row, n: int, bits: int, now: Reached, past: Reached | None) -> np.ndarray:
    """Places of the phrases of n words that are counted in this scan: activated by now, and not a cycle ago."""
    places = np.flatnonzero(row.runs[n])
    if n == 1:
        return places[now.mine(row.counters(1, bits)[places])] if past is None else places[:0]
    places = now.parts(row, n, bits, places)
    return places if past is None else np.setdiff1d(places, past.parts(row, n, bits, places), assume_unique=True)


# ---- Counting ------------------------------------------------------------------------------------------------------


class _Counters:
    """Stored counters by length and version: version t holds what the first t scans counted."""

    def __init__(self, corpus: DataFrame, threshold: int):
        self.spark, self.threshold = corpus.sparkSession, threshold
        words = corpus.agg(F.sum("n")).first()[0] or 0
        self.segment_bits = SEGMENT_BITS
        self.bits = max(SEGMENT_BITS, math.ceil(words / WORDS_PER_COUNTER).bit_length())
        self.slices = 1 << max(0, self.bits - FILTER_BITS)
        nothing = self.spark.createDataFrame([], STATE)
        self.versions: list[dict[int, DataFrame]] = [{n: nothing for n in range(1, LONGEST + 1)}]
        self.sizes: list[dict[int, int]] = [{n: 0 for n in range(1, LONGEST + 1)}]

    def reached(self, version: int, slice_: int) -> Reached:
        """One slice of the filter: at most 2^FILTER_BITS bits a length."""
        size = (1 << self.bits) // self.slices
        first, wide = slice_ * size, 1 << self.segment_bits
        out = Reached({}, first, size)
        for length, table in self.versions[version].items():
            if not self.sizes[version][length]:
                continue
            own = out.bits[length] = np.zeros(max(size, wide) // 8, np.uint8)
            rows = table.where((F.col("length") == length) & F.col("segment").between(first // wide, (first + size - 1) // wide))
            for r in rows.where("n_reached > 0").select("segment", "reached").collect():
                at = (r["segment"] * wide - first) // 8
                own[at : at + wide // 8] = unsqueezed(r["reached"], np.uint8, wide // 8)
        return out

    def add(self, found: DataFrame, lengths: list[int]) -> None:
        """A new version: the last one and what a scan found of some lengths."""
        limit, kind, wide = self.threshold, np.min_scalar_type(self.threshold), 1 << self.segment_bits

        def merge(key: tuple, state: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
            totals = np.zeros(wide, np.int64)
            for raw in state["counts"]:
                totals += unsqueezed(raw, kind, wide)
            for n, steps, counts in zip(new["n"], new["steps"], new["counts"]):
                totals[np.cumsum(unsqueezed(steps, np.uint32, n))] += unsqueezed(counts, np.uint32, n)
            reached = totals >= limit
            row = [key[0], key[1], squeezed(np.minimum(totals, limit).astype(kind)), squeezed(np.packbits(reached)), int(reached.sum())]
            return pd.DataFrame([row], columns=["length", "segment", "counts", "reached", "n_reached"])

        by = ("length", "segment")
        last = _all(self.versions[-1][n].where(F.col("length") == n).select(*by, "counts") for n in lengths)
        merged = store(last.groupBy(*by).cogroup(found.groupBy(*by)).applyInPandas(merge, STATE), "phrase-counters")
        sums = {r["length"]: r["n"] for r in merged.groupBy("length").agg(F.sum("n_reached").alias("n")).collect()}
        self.versions.append(self.versions[-1] | {n: merged for n in lengths})
        self.sizes.append(self.sizes[-1] | sums)

    def open(self, cycle: int) -> list[int]:
        """Lengths of which phrases are still being counted: some were activated within the last cycle."""
        if len(self.sizes) <= cycle:
            return list(range(1, LONGEST + 1))
        now, before = self.sizes[-1], self.sizes[-1 - cycle]
        return [n for n in range(2, LONGEST + 1) if now[n - 1] != before[n - 1]]


def _summed(places: dict[int, list[np.ndarray]], segment_bits: int) -> Iterator[pa.RecordBatch]:
    """Collected counters by length and segment: how many, the steps from one place in it to the next, their counts."""
    rows: list[tuple] = []
    for n, found in places.items():
        if not found:
            continue
        own, counts = np.unique(np.concatenate(found), return_counts=True)
        segments, starts = np.unique(own >> segment_bits, return_index=True)
        for s, low, high in zip(segments, starts, [*starts[1:], len(own)]):
            steps = np.diff(own[low:high] & ((1 << segment_bits) - 1), prepend=0).astype(np.uint32)
            rows.append((n, int(s), int(high - low), squeezed(steps), squeezed(counts[low:high].astype(np.uint32))))
    if rows:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["length", "segment", "n", "steps", "counts"])


def _scan(shard: DataFrame, counters: _Counters, lengths: list[int], cycle: int, slice_: int) -> DataFrame:
    """What one scan of a shard counts with the filter of one slice."""
    version = len(counters.versions) - 1
    bits, segment_bits = counters.bits, counters.segment_bits
    versions = [version, version - cycle] if version >= cycle else [version]
    sent = shard.sparkSession.sparkContext.broadcast([counters.reached(v, slice_).packed() for v in versions])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = [*map(Reached.unpacked, sent.value), None][:2]
        places: dict[int, list[np.ndarray]] = {n: [] for n in lengths}
        held = 0
        for batch in batches:
            for words, lang, codes in zip(batch["words"], batch["lang"], batch["codes"]):
                row = _Row(words.values, lang.as_py(), codes.as_buffer(), max(lengths))
                for n, found in places.items():
                    at = _active(row, n, bits, now, before)
                    found.append(row.counters(n, bits)[at])
                    held += len(at)
                if held > HELD_PLACES:
                    yield from _summed(places, segment_bits)
                    places, held = {n: [] for n in places}, 0
        yield from _summed(places, segment_bits)

    return shard.select("lang", "words", "codes").mapInArrow(run, FOUND)


def _named(corpus: DataFrame, counters: _Counters, slice_: int, lengths: tuple[int, ...]) -> DataFrame:
    """Phrases by their words: those of a slice whose counter has reached the threshold, counted in every coded row."""
    bits = counters.bits
    sent = corpus.sparkSession.sparkContext.broadcast(counters.reached(len(counters.versions) - 1, slice_).packed())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = Reached.unpacked(sent.value)
        for batch in batches:
            for i in range(batch.num_rows):
                words, lang = batch["words"][i].values, batch["lang"][i].as_py()
                row = _Row(words, lang, batch["codes"][i].as_buffer(), max(lengths))
                for n in lengths:
                    own, at = row.counters(n, bits), np.flatnonzero(row.runs[n])
                    at = at[reached.mine(own[at])]
                    at = at[reached.holds(n, own[at])]
                    if not len(at):
                        continue
                    key = row.codes[at].astype(np.int64)
                    for j in range(1, n):
                        # Numbers of the phrases so far, then of those with one more word: no hash decides here.
                        key = np.unique(key, return_inverse=True)[1] * (len(words) + 1) + row.codes[at + j]
                    _, first, counts = np.unique(key, return_index=True, return_counts=True)
                    parts = [words.take(pa.array(row.codes[at[first] + j] - 1)) for j in range(n)]
                    phrases = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
                    columns = [pa.array([lang] * len(first)), pa.array(np.full(len(first), n, np.int32)), phrases, pa.array(counts.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "length", "phrase", "f"])

    return corpus.select("lang", "words", "codes").mapInArrow(run, "lang string, length int, phrase string, f long")


def _words_of(phrases: DataFrame, counters: _Counters) -> DataFrame:
    """The counters of the words of given phrases, in the form of what a scan finds."""
    bits, segment_bits = counters.bits, counters.segment_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, set[str]] = defaultdict(set)
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist()):
                words[lang].update(phrase.split(" "))
            hashes = [word_hashes(pa.array(sorted(own)), lang) for lang, own in words.items()]
            yield from _summed({1: [(h >> np.uint64(64 - bits)).astype(np.int64) for h in hashes]}, segment_bits)

    return phrases.select("lang", "phrase").mapInArrow(run, FOUND)


def _all(parts: Iterator[DataFrame]) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def frequent(corpus: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS) -> DataFrame:
    """lang, length, phrase and f of all phrases of two to four words with f of `threshold` or more, and of their words."""
    counters = _Counters(corpus, threshold)
    while lengths := counters.open(shards):
        shard = corpus.where(F.col("shard") == (len(counters.versions) - 1) % shards)
        counters.add(_all(_scan(shard, counters, lengths, shards, s) for s in range(counters.slices)), lengths)

    # A task of several splits sends a phrase on once instead of once for each.
    splits = corpus.rdd.getNumPartitions()
    wide = corpus.coalesce(max(corpus.sparkSession.sparkContext.defaultParallelism, splits // NAMED_SPLITS))

    def named(these: _Counters, *lengths: int) -> DataFrame:
        found = _all(_named(wide, these, s, lengths) for s in range(these.slices))
        sums = found.groupBy("lang", "length", "phrase").agg(F.sum("f").alias("f"))
        return store(sums.where(F.col("f") >= threshold), "phrases")

    phrases = named(counters, *range(2, LONGEST + 1))
    needed = _Counters(corpus, 1)
    needed.add(_words_of(phrases, needed), [1])
    return phrases.unionByName(named(needed, 1))


# ---- Scores --------------------------------------------------------------------------------------------------------


def _words(column: str, first: Column, number: Column) -> Column:
    return F.array_join(F.slice(column, first, number), " ")


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS, top: int | None = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first `top` phrases of two to four words (None: all).

    Texts are taken whole, a null text is empty, a null language is `und`, repeated rows count again. Phrases do not cross
    sentence marks or line ends. A phrase that is cut in two parts scores floor(2,000,000 a / (l + r)); its lowest cut
    counts, of equal ones that with the shortest first part. Phrases inside a longer one that holds 80 % of their
    occurrences go. Equal scores and counts are in the order of the phrases' bytes. A table without rows or words gives
    none. Columns other than lang and text are not read. Products are decimals of 38 digits.
    """
    corpus = coded(docs, shards)
    found = frequent(corpus, threshold, shards)
    split = found.withColumn("w", F.split("phrase", " "))
    longer = split.where("length > 1")

    cuts = longer.select("lang", "phrase", "w", F.col("length").alias("size"), F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", _words("w", F.lit(1), F.col("k")).alias("left"), _words("w", F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(found.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr("CAST(2000000 * CAST(a AS DECIMAL(20, 0)) div (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # (first word, number of words) of every shorter phrase of two words or more inside a phrase.
    spans = [(n, i, m) for n in range(3, LONGEST + 1) for m in range(2, n) for i in range(1, n - m + 2)]
    inside = F.filter(
        F.array(*[F.when(F.col("length") == n, _words("w", F.lit(i), F.lit(m))) for n, i, m in spans]), lambda p: p.isNotNull()
    )
    holders = longer.where("length > 2").select("lang", F.explode(inside).alias("phrase"), F.col("f").alias("holder"))
    holders = holders.groupBy("lang", "phrase").agg(F.max("holder").alias("holder"))
    kept = scored.join(holders, ["lang", "phrase"], "left").where("holder IS NULL OR 5 * CAST(holder AS DECIMAL(20, 0)) < 4 * CAST(a AS DECIMAL(20, 0))")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    if top is not None:
        # The first of each part of a language hold the first of all, so that one task ranks PARTS * top rows at most.
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
        ranked = ranked.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    sizes = corpus.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = ranked.withColumn("rank", F.col("rank").cast("long")).join(sizes, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
