"""Toxicity: gradient-boosted trees over dense features of whole texts, calibrated by isotonic regression.

Features: densities of a fixed and of a learned lexicon, nearness of their hits to second-person words, capitals,
punctuation, obfuscation. The learned lexicon holds stems (beginnings of words) that labelled toxic documents use
far more often than others. Lexicon, trees and calibration are fitted on a bounded sample of labelled rows
(MAX_ROWS, chosen by a hash of the identifier): stems learned on one half describe the other half, and the
calibration sees only predictions for rows that the trees were not grown on.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rollout_quality.llm.common import ready, store

MAX_ROWS = 10_000
MAX_STEMS = 5_000
THRESHOLD = 0.7
STEM = (3, 8)
MIN_STRENGTH = 3.0
MIN_SHARE = 0.6
NEAR = 5
CACHE_WORDS = 300_000
TREES, DEPTH, RATE, BINS, LEAST, PENALTY = 60, 3, 0.2, 32, 5, 1.0

# Common insults, and second-person words of several languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb fool fools loser losers scum trash garbage worthless pathetic disgusting clown clowns"
    " ugly filthy vermin parasite bastard bastards bitch jerk imbecile cretin retard freak pig swine hate die kill dummkopf arschloch"
    " schwein trottel abschaum hurensohn idioten connard salaud abruti ordure merde batard idiota estupido imbecil basura cabron puta".split()
)
SECOND = frozenset(
    "you your yours yourself youre ur u du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre vos"
    " usted ustedes vosotros ti tus vuestro".split()
)
LEET = str.maketrans("0134578@$!|", "oleastbasii")
NAMES = (
    "fixed_rate", "fixed_count", "stem_rate", "stem_count", "stem_max", "stem_sum", "stem_kinds", "near_second",
    "second_rate", "capital_rate", "shout_rate", "mark_rate", "punctuation_rate", "obfuscated_rate", "stretched_rate", "words",
)
_LETTERS = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"[^\W\d_][0-9@$!*#+.|]+[^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_FIXED, _SECOND, _OBFUSCATED, _SHOUT, _MARK, _LONG = (1 << k for k in range(8, 14))


def _forms(word: str) -> set[str]:
    """A word in plain letters, also with look-alike signs read as letters."""
    plain = "".join(_LETTERS.findall(word.lower()))
    hidden = "".join(_LETTERS.findall(word.lower().translate(LEET))) if _HIDDEN.search(word) else plain
    return {f for f in (plain, hidden) if f}


def stems(word: str) -> set[str]:
    """Beginnings of a word, and the whole word (marked with $) if it is short."""
    found = set()
    for form in _forms(word):
        found.update(form[:k] for k in range(STEM[0], min(STEM[1], len(form)) + 1))
        if STEM[0] <= len(form) <= 2 * STEM[1]:
            found.add(form + "$")
    return found


class _Words(dict):
    """Word -> what is known of it, as bits; the low 8 are the strength of its strongest stem in sixteenths."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon
        self.begin = {s[: STEM[0]] for s in lexicon}

    def __missing__(self, word: str) -> int:
        low = word.lower().strip(string.punctuation)
        plain = low.isalpha()
        forms = (low,) if plain else _forms(word)
        strength, get = 0.0, self.lexicon.get
        for form in forms:
            if form[: STEM[0]] in self.begin:
                strength = max([strength, *(get(s, 0.0) for s in stems(form))])
        code = min(255, int(16 * strength))
        if not plain and _HIDDEN.search(word):
            code |= _OBFUSCATED
        for form in forms:
            code |= _FIXED * (form in INSULTS) | _SECOND * (form in SECOND)
        code |= _LONG * bool(_STRETCHED.search(low))
        code |= _SHOUT * (word.isupper() and len(word) > 1) | _MARK * ("!" in word or "?" in word)
        if len(word) <= 64:
            self[word] = code
        return code


def describe(text: str | None, known: _Words) -> np.ndarray:
    """The features of NAMES; all zero for an empty or null text."""
    parts = (text or "").split()
    out = np.zeros(len(NAMES))
    if not parts:
        return out
    codes = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
    n, strength = len(parts), (codes & 255) / 16.0
    stem, fixed = strength > 0, (codes & _FIXED) > 0
    second, hits = np.flatnonzero(codes & _SECOND), np.flatnonzero(stem | fixed)
    near = 0
    if len(second) and len(hits):
        after = np.searchsorted(second, hits)
        gap = np.minimum(
            np.abs(hits - second[np.maximum(after - 1, 0)]), np.abs(second[np.minimum(after, len(second) - 1)] - hits)
        )
        near = int((gap <= NEAR).sum())
    letters = sum(map(len, parts))
    flag = lambda bit: np.count_nonzero(codes & bit) / n
    out[:] = (
        fixed.mean(), fixed.sum(), stem.mean(), stem.sum(), strength.max(), strength.sum(),
        len({parts[i] for i in np.flatnonzero(stem).tolist()}), near, len(second) / n,
        len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text)) / letters, flag(_SHOUT), flag(_MARK),
        len(re.findall(r"[^\w\s]", text)) / letters, flag(_OBFUSCATED), flag(_LONG), np.log1p(n),
    )
    return out


@dataclass
class Forest:
    """Boosted regression trees on binned features. A tree is (feature, cut, low, high) or a leaf value."""

    base: float = 0.0
    trees: list = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += _apply(tree, x)
        return out


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    out, low = np.empty(len(x)), x[:, tree[0]] <= tree[1]
    out[low], out[~low] = _apply(tree[2], x[low]), _apply(tree[3], x[~low])
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray) -> Forest:
    """Newton boosting of the logistic loss with histogram splits."""
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    forest = Forest(float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    # Rare features are zero up to their last quantile: cut what lies above as well.
    cuts = [np.unique(np.append(c, np.quantile(v[v > 0], np.linspace(0, 0.9, 8))) if (v > 0).any() else c) for c, v in zip(cuts, x.T)]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    margin = np.full(len(y), forest.base)

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None, None)
        if depth and len(rows) >= 2 * LEAST:
            for f, edges in enumerate(cuts):
                b = binned[rows, f]
                left_g = np.cumsum(np.bincount(b, g[rows], len(edges) + 1))[:-1]
                left_h = np.cumsum(np.bincount(b, h[rows], len(edges) + 1))[:-1]
                left_n = np.cumsum(np.bincount(b, minlength=len(edges) + 1))[:-1]
                gain = left_g**2 / (left_h + PENALTY) + (total_g - left_g) ** 2 / (total_h - left_h + PENALTY)
                gain = np.where((left_n >= LEAST) & (len(rows) - left_n >= LEAST), gain, -np.inf)
                gain -= total_g**2 / (total_h + PENALTY)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
        if best[1] is None:
            return float(-RATE * total_g / (total_h + PENALTY))
        low = binned[rows, best[1]] <= best[2]
        return (
            best[1], float(cuts[best[1]][best[2]]), split(rows[low], g, h, depth - 1), split(rows[~low], g, h, depth - 1)
        )

    for _ in range(TREES):
        p = _sigmoid(margin)
        tree = split(np.arange(len(y)), p - y, p * (1 - p), DEPTH)
        forest.trees.append(tree)
        margin += _apply(tree, x)
    return forest


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: places and non-decreasing shares, to be interpolated. Equal scores are pooled."""
    places, at = np.unique(score, return_inverse=True)
    weight, ones = np.bincount(at).astype(float), np.bincount(at, y)
    pools: list[list[float]] = []  # ones, weight, first, last
    for place, w, o in zip(places, weight, ones):
        pools.append([o, w, place, place])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            o, w, _, last = pools.pop()
            pools[-1][0] += o
            pools[-1][1] += w
            pools[-1][3] = last
    xs = [x for _, _, first, last in pools for x in (first, last)]
    ys = [o / w for o, w, *_ in pools for _ in range(2)]
    return np.array(xs), np.array(ys)


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    forest: Forest | None = None
    places: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    shares: np.ndarray = field(default_factory=lambda: np.array([0.0]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.forest is None:
            return np.full(len(x), self.shares[0])
        return np.clip(np.interp(self.forest.margin(x), self.places, self.shares), 0.0, 1.0)


def _sample(docs: DataFrame, labels: DataFrame, train: Column, max_rows: int) -> DataFrame:
    """At most `max_rows` labelled documents, by a hash of the identifier: doc_id, text, toxic, half."""
    chosen = labels.filter(train & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.filter("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int")
    chosen = store(chosen.select("doc_id", F.col("toxic").cast("int").alias("toxic"), half.alias("half")), "labels")
    # Broadcast: at most max_rows rows of three numbers.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return store(found.groupBy("doc_id", "toxic", "half").agg(F.max("text").alias("text")), "labelled")


def _lexicons(sample: DataFrame, sizes: dict[tuple[int, int], int]) -> list[dict[str, float]]:
    """Stems of half 0, of half 1 and of both, with the logarithm of how much likelier toxic documents use them."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen: dict[tuple, Counter] = {}
            for text, toxic, half in zip(frame["text"], frame["toxic"], frame["half"]):
                found = set().union(*map(stems, set((text or "").split())))
                seen.setdefault((half, toxic), Counter()).update(found)
            for (half, toxic), counts in seen.items():
                yield pd.DataFrame({"stem": list(counts), "slot": 2 * half + toxic, "n": list(counts.values())})

    counts = sample.mapInPandas(count, "stem string, slot int, n long")
    table = counts.groupBy("stem").agg(*[F.sum(F.when(F.col("slot") == s, F.col("n")).otherwise(0)).alias(f"n{s}") for s in range(4)])
    lexicons = []
    # n1 and n3 count toxic documents. Rarer stems say little; the most frequent ones are kept.
    table = store(table.filter("n1 + n3 >= 3"), "stems")
    for halves in ((0,), (1,), (0, 1)):
        toxic, clean = (sum((F.col(f"n{2 * h + t}") for h in halves), F.lit(0)) for t in (1, 0))
        total = [sum(sizes.get((h, t), 0) for h in halves) for t in (0, 1)]
        strength = F.log((toxic + 0.5) / (total[1] + 1.0)) - F.log((clean + 0.5) / (total[0] + 1.0))
        rows = (
            table.select("stem", strength.alias("s"), toxic.alias("t"), clean.alias("c"))
            .filter((F.col("s") >= MIN_STRENGTH) & (F.col("t") >= 3) & (F.col("t") >= MIN_SHARE * (F.col("t") + F.col("c"))))
            .orderBy(F.desc("t"), "stem")
            .limit(MAX_STEMS)
        )
        lexicons.append({r["stem"]: r["s"] for r in rows.collect()})
    return lexicons


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, max_rows: int = MAX_ROWS) -> Model:
    """Learn from `labels` (doc_id, toxic) for which `train` holds, and the texts of `docs`.

    Labels that are null, or of unknown or null documents, are left out; a document labelled twice is toxic if one
    label says so. With one class only, or no labels, every score is the share of toxic labels (none: zero).
    """
    ready(docs.sparkSession)
    sample = _sample(docs, labels, F.lit(True) if train is None else train, max_rows)
    sizes = {(r["half"], r["toxic"]): r["n"] for r in sample.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, ones = sum(sizes.values()), sum(n for (_, t), n in sizes.items() if t == 1)
    if not 0 < ones < rows:
        return Model(shares=np.array([ones / rows if rows else 0.0]))
    lexicons = _lexicons(sample, sizes)
    width = len(NAMES)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Each half is described by the stems of the other.
        known = [_Words(lexicons[1]), _Words(lexicons[0])]
        for frame in frames:
            x = [describe(t, known[h]).tolist() for t, h in zip(frame["text"], frame["half"])]
            yield pd.DataFrame({"half": frame["half"], "toxic": frame["toxic"], "x": x})

    found = sample.mapInPandas(run, "half int, toxic int, x array<double>").toPandas()  # max_rows rows of `width` numbers
    x, y, half = np.array(found["x"].tolist()).reshape(-1, width), found["toxic"].to_numpy(float), found["half"].to_numpy()
    margin = np.empty(len(y))
    for h in (0, 1):
        learn, judge = half != h, half == h
        if judge.any():
            margin[judge] = boost(x[learn] if learn.any() else x, y[learn] if learn.any() else y).margin(x[judge])
    return Model(lexicons[2], boost(x, y), *isotonic(margin, y))


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """`docs` (all rows and columns) with the calibrated probability in `out`; an input column of that name is
    replaced. Null and empty texts are scored as texts without words."""
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast(model)
    kept = docs.select(*[c for c in docs.columns if c != out])
    schema = kept.withColumn(out, F.lit(0.0)).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held.value
        known = _Words(own.lexicon)
        for frame in frames:
            if len(known) > CACHE_WORDS:
                known.clear()
            x = np.array([describe(t, known) for t in frame["text"]]).reshape(-1, len(NAMES))
            yield frame.assign(**{out: own.predict(x)})

    return kept.mapInPandas(run, schema)


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below the threshold, same columns."""
    return score(docs, model, "__score").filter(F.col("__score") < threshold).drop("__score")
