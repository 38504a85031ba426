"""Repeated questions within a split and shared questions across splits.

Whole texts are compared through a 32-byte digest of their fingerprint. One aggregation by digest, with
map-side counting, gives all within-split and pairwise figures. Examples are chosen by the first characters of
shared questions; whole texts are fetched for those few only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollout_quality.functions.text import digest, question_fingerprint
from rollout_quality.session import BROADCAST_ROWS, cut_lineage, is_small

KEY = "question_key"
EXAMPLES = 5
# First characters by which examples are chosen before their whole texts are fetched.
START_CHARS = 64
_START = "start"


def split_pairs(splits: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(splits, 2))


def pair_name(a: str, b: str) -> str:
    return f"{a}__{b}"


def with_question_key(records: DataFrame) -> DataFrame:
    if KEY in records.columns:
        return records
    return records.withColumn(KEY, digest(question_fingerprint(F.col("question"))))


def question_counts(records: DataFrame, splits: Sequence[str], starts: bool = False) -> DataFrame:
    """One row per distinct question: its number of copies in each split (`n_0`, `n_1`, ... in split order).

    Rows without a question count nowhere. `starts` adds the first characters of the question (`start`).
    """
    known = F.col(KEY).isNotNull()
    copies = [F.count_if((F.col("split") == s) & known).alias(f"n_{i}") for i, s in enumerate(splits)]
    if starts:
        start = F.left(question_fingerprint(F.col("question")), F.lit(START_CHARS))
        copies.append(F.min(start).alias(_START))
    return with_question_key(records).groupBy(KEY).agg(*copies)


def _in_both(splits: Sequence[str], a: str, b: str) -> Column:
    return (F.col(f"n_{splits.index(a)}") > 0) & (F.col(f"n_{splits.index(b)}") > 0)


def leakage_counts(counts: DataFrame, splits: Sequence[str], check_single_split: bool = False) -> DataFrame:
    """(ord, kind, scope, duplicate_count): surplus copies per split, then shared questions per split pair.

    With one split the within-split figure is 0 unless `check_single_split` asks for it.
    """
    pairs = split_pairs(splits)
    within = [
        F.coalesce(F.sum(F.greatest(F.col(f"n_{i}") - 1, F.lit(0))), F.lit(0)).alias(f"w_{i}")
        for i in range(len(splits))
    ]
    shared = [F.count_if(_in_both(splits, a, b)).alias(f"p_{i}") for i, (a, b) in enumerate(pairs)]
    totals = counts.agg(*within, *shared)
    skip = len(splits) == 1 and not check_single_split

    def line(kind: str, scope: str, count: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(scope).alias("scope"), count.cast("bigint").alias("duplicate_count")
        )

    lines = [
        line("within_split", s, F.lit(0) if skip else F.col(f"w_{i}")) for i, s in enumerate(splits)
    ] + [line("pair", pair_name(a, b), F.col(f"p_{i}")) for i, (a, b) in enumerate(pairs)]
    return totals.select(F.posexplode(F.array(*lines)).alias("ord", "line")).select("ord", "line.*")


def within_split_duplicates(
    records: DataFrame, splits: Sequence[str], check_single_split: bool = False
) -> DataFrame:
    counted = leakage_counts(question_counts(records, splits), splits, check_single_split)
    return counted.where(F.col("kind") == "within_split").select(F.col("scope").alias("split"), "duplicate_count")


def cross_split_overlap(records: DataFrame, splits: Sequence[str]) -> DataFrame:
    """Number of shared questions of every split pair, 0 included."""
    counted = leakage_counts(question_counts(records, splits), splits)
    return counted.where(F.col("kind") == "pair").select(F.col("scope").alias("pair"), "duplicate_count")


def _shared_keys(counts: DataFrame, splits: Sequence[str]) -> DataFrame:
    """(split, pair, question_key) of every shared question, and its start if the counts have it; `split` is the
    first of the pair."""
    carried = [c for c in (KEY, _START) if c in counts.columns]
    hits = [
        F.when(
            _in_both(splits, a, b), F.struct(F.lit(a).alias("split"), F.lit(pair_name(a, b)).alias("pair"))
        )
        for a, b in split_pairs(splits)
    ]
    if not hits:
        none = F.struct(F.lit("").alias("split"), F.lit("").alias("pair"))
        return counts.where(F.lit(False)).select(*carried, none.alias("hit")).select("hit.*", *carried)
    found = F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull()))
    return counts.select(*carried, found.alias("hit")).select("hit.*", *carried)


def overlap_texts(
    records: DataFrame, counts: DataFrame, splits: Sequence[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(pair, question) for every shared question, as its fingerprint text, once per pair.

    The shared keys are stored and counted first. If they are few, they are sent to the scan of the texts. If
    they are many, copies are dropped before and during the shuffle by key, so that a question that fills a
    large part of the table arrives once.
    """
    return _texts(records, _shared_keys(counts, splits).select("split", "pair", KEY), broadcast_rows)


def _texts(records: DataFrame, wanted: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(pair, question) of the `wanted` (split, pair, question_key)."""
    shared = cut_lineage(wanted)
    texts = with_question_key(records).select("split", KEY, "question")
    if is_small(shared, broadcast_rows):
        once = texts.join(F.broadcast(shared), ["split", KEY]).dropDuplicates(["pair", KEY])
    else:
        once = texts.dropDuplicates(["split", KEY]).join(shared, ["split", KEY])
    return once.select("pair", question_fingerprint(F.col("question")).alias("question"))


def overlap_examples(
    records: DataFrame, counts: DataFrame, splits: Sequence[str], limit: int = EXAMPLES
) -> DataFrame:
    """The first shared questions of every pair in text order (`rank` from 1).

    A question with `limit` or more smaller starts cannot be among them. What is left, ties at the cut included,
    is ordered by whole texts.
    """
    if _START not in counts.columns:
        counts = question_counts(records, splits, starts=True)
    place = F.rank().over(Window.partitionBy("pair").orderBy(_START))
    first = _shared_keys(counts, splits).withColumn("place", place).where(F.col("place") <= limit)
    texts = _texts(records, first.select("split", "pair", KEY))
    rank = F.row_number().over(Window.partitionBy("pair").orderBy("question"))
    return texts.withColumn("rank", rank).where(F.col("rank") <= limit).select("pair", "rank", "question")


def fingerprint_intersect(records: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct question fingerprints present in both splits."""
    both = records.where(F.col("split").isin(a, b))
    return overlap_texts(both, question_counts(both, (a, b)), (a, b)).select("question")


def leakage_report(
    records: DataFrame, splits: Sequence[str], check_single_split: bool = False, limit: int = EXAMPLES
) -> DataFrame:
    """(ord, kind, scope, duplicate_count, examples): within-split rows, then pair rows with examples."""
    if len(splits) < 2:
        counts = question_counts(records, splits)
        listed = leakage_counts(counts, splits, check_single_split)
        return listed.withColumn("examples", F.array().cast("array<string>"))
    counts = cut_lineage(question_counts(records, splits, starts=True))  # narrow, and read twice: for the figures and for the shared keys
    listed = leakage_counts(counts, splits, check_single_split)
    shown = overlap_examples(records, counts, splits, limit)
    # At most `limit` texts per pair.
    examples = shown.groupBy("pair").agg(F.sort_array(F.collect_list("question")).alias("examples"))
    joined = listed.join(examples, (F.col("kind") == "pair") & (F.col("scope") == F.col("pair")), "left")
    return joined.select(
        "ord",
        "kind",
        "scope",
        "duplicate_count",
        F.coalesce("examples", F.array().cast("array<string>")).alias("examples"),
    )
