"""Language-model scoring with a causal self-attention model, trained here in numpy on subword ids.

What is counted covers all training documents: words (for the unigram base), ids, and transitions between units
(frequent ids, and bins of the others). The transitions give the model its output bias: how likely a class of
units is after the last two units. Attention over the last ids of the text corrects that bias per class; its
weights are trained on all windows of every training document, in parallel, and averaged. A text is scored in
overlapping windows: every id is a target once, and sees at least CONTEXT ids before it (padding at the start).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rollout_quality.llm.common import ready, store
from rollout_quality.llm.tokens import WORD_BPE, encode

IDS = 49_408
BEGIN, END = 49_406, 49_407
UNITS, CLASSES, COARSE = 1024, 64, 32
CONTEXT, TARGETS, WIDTH = 16, 32, 16
SPAN = CONTEXT + TARGETS + 1
HEAD_WORDS, HEAD_BYTES = 200_000, 32
ROUNDS, BATCH, RATE = 2, 64, 0.004
BACKOFF = 20.0
CHUNK = 4_000_000
LOG10 = np.log(10.0)
# Sums of exponentials stay finite in 32 bits without looking for the largest first.
LARGEST = np.float32(60.0)


# ---- words: the unigram base ------------------------------------------------------------------------------


def split_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; bytes.lower() and bytes.split() know ASCII only, as wanted."""
    return (text or "").encode().lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts; counted per batch before the shuffle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, counts = 0, Counter()
        for frame in frames:
            for text in frame["text"]:
                counts.update(split_words(text))
            if len(counts) > 200_000:
                yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})
                counts = Counter()
        yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})

    return docs.select("text").mapInPandas(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def prepared(docs: DataFrame, train: Column, head: dict[bytes, int], file: str) -> DataFrame:
    """A stored table with the words and ids of every text: rid, doc_id, train, n_words, head_known, head_sum
    (logarithms of the counts plus one of frequent words), tail (all other words, each once), times (how often), ids."""
    spark = ready(docs.sparkSession)
    known = spark.sparkContext.broadcast({w: float(np.log10(c + 1)) for w, c in head.items()})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = known.value.get
        for frame in frames:
            rows = []
            for text, ids in zip(frame["text"], encode(list(frame["text"]), file)):
                words = split_words(text)
                logs = list(map(get, words))
                tail = Counter([w for w, v in zip(words, logs) if v is None])
                known_words = len(words) - sum(tail.values())
                rows.append(
                    (len(words), known_words, sum(filter(None, logs)), list(tail), list(tail.values()), ids.astype("<u2").tobytes())
                )
            part = pd.DataFrame(rows, columns=["n_words", "head_known", "head_sum", "tail", "times", "ids"])
            yield pd.concat([frame[["rid", "doc_id", "train"]].reset_index(drop=True), part], axis=1)

    schema = (
        "rid long, doc_id long, train boolean, n_words long, head_known long, head_sum double, "
        "tail array<binary>, times array<long>, ids binary"
    )
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", train.alias("train"), "text")
    return store(rows.mapInPandas(run, schema), "lm-texts")


# ---- the model --------------------------------------------------------------------------------------------


@dataclass
class Model:
    """unit: of every id; rare: log share of an id in its unit; group, coarse: class of every unit; bias: log share
    of a class after (coarse class of the last but one unit, last unit); inside: log share of a unit in its class,
    after the last unit; weights: the attention."""

    unit: np.ndarray
    rare: np.ndarray
    group: np.ndarray
    coarse: np.ndarray
    bias: np.ndarray
    inside: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)


def units_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frequent ids are units of their own; the rest is dealt into 24 bins of about equal mass."""
    bins = 24
    order = np.lexsort((np.arange(IDS), -counts))
    must = np.array([BEGIN, END])
    order = np.concatenate([must, order[~np.isin(order, must)]])
    unit = np.empty(IDS, np.int32)
    unit[order[: UNITS - bins]] = np.arange(UNITS - bins)
    rest = order[UNITS - bins :]
    mass = np.cumsum(counts[rest] + 0.5)
    unit[rest] = UNITS - bins + np.minimum((mass / mass[-1] * bins).astype(int), bins - 1)
    total = np.bincount(unit, counts + 0.5, UNITS)
    return unit, np.log((counts + 0.5) / total[unit]).astype(np.float32)


def _group(profile: np.ndarray, weight: np.ndarray, count: int) -> np.ndarray:
    """k-means on leading directions of the units' profiles, started at the most frequent units."""
    centred = (profile - profile.mean(0)) * np.sqrt(weight)[:, None]
    _, _, axes = np.linalg.svd(centred.T @ centred)
    points = (profile - profile.mean(0)) @ axes[:24].T
    centres = points[np.argsort(-weight, kind="stable")[:count]].copy()
    for _ in range(15):
        near = ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
        mass = np.bincount(near, weight, count)
        for c in np.flatnonzero(mass > 0):
            centres[c] = (points[near == c] * weight[near == c, None]).sum(0) / mass[c]
    return near


def _counted(texts: DataFrame, keys) -> np.ndarray:
    """Sum of `keys` (ids of a batch of texts -> array of keys below `size`) over all training texts."""
    count, size = keys

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, waiting, held = np.zeros(size, np.int64), [], 0
        for frame in frames:
            waiting.append(count([np.frombuffer(raw, "<u2") for raw in frame["ids"]]))
            held += len(waiting[-1])
            if held > CHUNK:
                total += np.bincount(np.concatenate(waiting), minlength=size)
                waiting, held = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=size)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"k": found, "n": total[found]})

    rows = texts.filter("train").select("ids").mapInPandas(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    found, out = rows.toPandas(), np.zeros(size)  # at most `size` rows, whatever the corpus
    out[found["k"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    return out


def _joined(ids: list[np.ndarray], pad: int = 1) -> np.ndarray:
    """The texts one after the other: `pad` begin ids, the ids, the end id."""
    begin, end = np.full(pad, BEGIN, np.int64), np.array([END], np.int64)
    return np.concatenate([x for one in ids for x in (begin, one.astype(np.int64), end)])


def statistics(texts: DataFrame) -> Model:
    """Units, classes and bias from all training texts."""
    counts = _counted(texts, (lambda ids: _joined(ids), IDS))
    counts[BEGIN] = 0
    unit, rare = units_of(counts)

    def pairs(ids: list[np.ndarray]) -> np.ndarray:
        u = unit[_joined(ids)].astype(np.int64)
        return (u[:-1] * UNITS + u[1:])[u[1:] != unit[BEGIN]]

    two = _counted(texts, (pairs, UNITS * UNITS)).reshape(UNITS, UNITS)
    seen = two.sum(0) + 0.5
    seen[unit[BEGIN]] = 1e-9
    share = seen / seen.sum()
    after = (two + BACKOFF * share) / (two.sum(1, keepdims=True) + BACKOFF)
    # What comes before a unit says which units follow alike contexts; what follows it, which precede alike.
    root = np.sqrt(after)
    group = _group(np.sqrt(two.T / (two.sum(0)[:, None] + 1.0) + 1e-9), seen, CLASSES)
    coarse = _group(root, two.sum(1) + 0.5, COARSE)
    by_class = np.zeros((UNITS, CLASSES))
    np.add.at(by_class.T, group, after.T)

    def triples(ids: list[np.ndarray]) -> np.ndarray:
        u = unit[_joined(ids, 2)]
        key = (coarse[u[:-2]].astype(np.int64) * UNITS + u[1:-1]) * CLASSES + group[u[2:]]
        return key[u[2:] != unit[BEGIN]]

    three = _counted(texts, (triples, COARSE * UNITS * CLASSES)).reshape(COARSE, UNITS, CLASSES)
    three = (three + BACKOFF * by_class) / (three.sum(2, keepdims=True) + BACKOFF)
    return Model(
        unit, rare, group.astype(np.int32), coarse.astype(np.int32), np.log(three + 1e-30).astype(np.float32).reshape(-1, CLASSES),
        (np.log(after) - np.log(by_class[:, group])).astype(np.float32),
    )


def fresh_weights() -> dict[str, np.ndarray]:
    """The output starts at zero: an untrained model is its bias."""
    rng = np.random.default_rng(7)
    small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    square = lambda: small(WIDTH, WIDTH)
    return {
        "embed": small(UNITS, WIDTH), "place": small(SPAN - 1, WIDTH), "q": square(), "k": square(), "v": square(),
        "o": square(), "own": square(), "out": np.zeros((WIDTH, CLASSES), np.float32),
    }


# Which of the TARGETS last positions each of them does not see yet; all see the context before them.
_FUTURE = np.concatenate([np.zeros((TARGETS, CONTEXT)), np.where(np.tri(TARGETS, dtype=bool), 0, -1e9)], axis=1).astype(np.float32)
_SCALE = np.float32(WIDTH**-0.5)


def _flat(m: np.ndarray) -> np.ndarray:
    return m.reshape(-1, m.shape[-1])


def _crossed(m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """m' d of two tall arrays, in blocks that stay in the cache."""
    blocks = lambda one: one.reshape(-1, 4 * TARGETS if len(one) % (4 * TARGETS) == 0 else TARGETS, one.shape[1])
    return (blocks(m).transpose(0, 2, 1) @ blocks(d)).sum(0)


def _folded(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Queries against keys, last Wq (x Wk)' = last (Wq Wk') x', and values into the output, a (x Wv) Wo = (a x) (Wv Wo):
    the products of weights save the products of places."""
    return w["q"] @ w["k"].T * _SCALE, w["v"] @ w["o"]


def forward(w: dict[str, np.ndarray], units: np.ndarray) -> tuple:
    """Class corrections for the TARGETS last positions of windows of SPAN - 1 units, and what backward() needs."""
    meet, join = _folded(w)
    x = np.take(w["embed"], units, axis=0)
    x += w["place"]
    last = _flat(x[:, CONTEXT:])
    q = (last @ meet).reshape(-1, TARGETS, WIDTH)
    a = q @ x.transpose(0, 2, 1)
    a += _FUTURE
    np.exp(np.clip(a, -np.inf, LARGEST, out=a), out=a)
    share = np.repeat(1 / (_flat(a) @ np.ones(SPAN - 1, np.float32)), WIDTH).reshape(-1, WIDTH)
    mixed = _flat(a @ x)
    mixed *= share
    h = mixed @ join
    h += last @ w["own"]
    h /= np.abs(h) + np.float32(1)
    return (h @ w["out"]).reshape(-1, TARGETS, CLASSES), (x, last, q, a, share, mixed, h, meet, join)


def backward(w: dict[str, np.ndarray], units: np.ndarray, kept: tuple, d_out: np.ndarray, scale: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients, where d_out times scale (one per row) is that of the class corrections."""
    x, last, q, a, share, mixed, h, meet, join = kept
    many = len(units)
    g = {"out": _crossed(h * scale, d_out)}
    pre = d_out @ w["out"].T
    pre *= (1 - np.abs(h)) ** 2 * scale
    g["own"], g_join = _crossed(last, pre), _crossed(mixed, pre)
    g["v"], g["o"] = g_join @ w["o"].T, w["v"].T @ g_join
    d_mixed = pre @ join.T
    d_mixed *= share
    # A row of attention times its gradient adds up to the mixed values times theirs: one more column takes that off.
    left = np.empty((many, TARGETS, WIDTH + 1), x.dtype)
    left[:, :, :WIDTH] = d_mixed.reshape(many, TARGETS, WIDTH)
    np.negative(np.einsum("ij,ij->i", d_mixed, mixed).reshape(many, TARGETS), out=left[:, :, WIDTH])
    right = np.empty((many, SPAN - 1, WIDTH + 1), x.dtype)
    right[:, :, :WIDTH], right[:, :, WIDTH] = x, 1
    d_s = left @ right.transpose(0, 2, 1)
    d_s *= a
    d_q = _flat(d_s @ x)
    d_x = a.transpose(0, 2, 1) @ d_mixed.reshape(many, TARGETS, WIDTH)
    d_x += d_s.transpose(0, 2, 1) @ q
    d_last = pre @ w["own"].T
    d_last += d_q @ meet.T
    d_x[:, CONTEXT:] += d_last.reshape(many, TARGETS, WIDTH)
    g_meet = _crossed(last, d_q) * _SCALE
    g["q"], g["k"] = g_meet @ w["k"], g_meet.T @ w["q"]
    g["place"], g["embed"] = d_x.sum(0), np.zeros_like(w["embed"])
    # Units fit 16 bits, which sort fast; pairs of numbers are added as one complex number.
    unit = units.astype(np.uint16).ravel()
    order = np.argsort(unit, kind="stable")
    unit = unit[order]
    first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    pairs = np.take(_flat(d_x), order, axis=0).view(np.result_type(d_x, np.complex64))
    g["embed"][unit[first]] = np.add.reduceat(pairs, first).view(d_x.dtype)
    return g


def _biased(model: Model, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bias of the classes of the targets of windows of SPAN units, and those classes."""
    last, second = units[:, CONTEXT:-1], units[:, CONTEXT - 1 : -2]
    return np.take(model.bias, model.coarse[second] * UNITS + last, axis=0), model.group[units[:, CONTEXT + 1 :]]


def loss(model: Model, w: dict[str, np.ndarray], units: np.ndarray, valid: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy of the classes of valid targets, and its gradient."""
    bias, group = _biased(model, units)
    out, kept = forward(w, units[:, :-1])
    z = _flat(out)
    z += _flat(bias)
    del bias
    target = np.arange(0, z.size, CLASSES) + group.ravel()
    # A plain float: a 64-bit scalar of numpy would turn the whole backward pass into 64 bits.
    weight = valid.ravel().astype(np.float32) / float(max(1, valid.sum()))
    own = np.take(z, target)
    d = np.exp(np.clip(z, -LARGEST, LARGEST, out=z), out=z)
    total = d @ np.ones(CLASSES, np.float32)
    d.ravel()[target] -= total
    value = float(((np.log(total) - own) * weight).sum())
    return value, backward(w, units[:, :-1], kept, d, (weight / total)[:, None])


def windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of texts: (windows, SPAN) ids, which targets count, and the text of every window."""
    runs, owner, counts = [], [], []
    for t, one in enumerate(ids):
        n = len(one) + 1
        many = -(-n // TARGETS)
        run = np.full(CONTEXT + 1 + many * TARGETS, BEGIN, np.int64)
        run[CONTEXT + 1 : CONTEXT + n] = one
        run[CONTEXT + n] = END
        runs.append(run)
        owner.append(np.full(many, t))
        left = np.full(many, TARGETS)
        left[-1] = n - (many - 1) * TARGETS
        counts.append(left)
    flat, owner, counts = np.concatenate(runs), np.concatenate(owner), np.concatenate(counts)
    begins = np.cumsum([0] + [len(r) for r in runs[:-1]])
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    starts = begins[owner] + number * TARGETS
    return flat[starts[:, None] + np.arange(SPAN)], np.arange(TARGETS) < counts[:, None], owner


def batches(frames: Iterator[pd.DataFrame], number: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every window of every text (column ids) once, BATCH at a time, and which of its targets count. The windows of
    a frame are mixed, in another order each round."""
    for frame in frames:
        ids = [np.frombuffer(raw, "<u2") for raw in frame["ids"]]
        if not ids:
            continue
        tokens, valid, _ = windows(ids)
        order = np.random.default_rng([number, zlib.crc32(frame["ids"].iloc[0])]).permutation(len(tokens))
        for b in range(0, len(order), BATCH):
            yield tokens[order[b : b + BATCH]], valid[order[b : b + BATCH]]


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The weights that `flat` holds one after the other."""
    ends = np.cumsum([v.size for v in like.values()])
    return {k: part.reshape(v.shape) for (k, v), part in zip(like.items(), np.split(flat, ends[:-1]))}


def train(texts: DataFrame, model: Model) -> Model:
    """Fit the attention: every task makes one pass of Adam over all windows of its training texts, the tasks'
    weights are averaged by how many windows they saw, ROUNDS times."""
    spark = texts.sparkSession
    w = fresh_weights()
    for number in range(ROUNDS):
        held = spark.sparkContext.broadcast((model, w))

        def run(frames: Iterator[pd.DataFrame], number=number, held=held) -> Iterator[pd.DataFrame]:
            own, start = held.value
            flat = np.concatenate([v.ravel() for v in start.values()])
            w = _views(flat, start)
            m, s = np.zeros_like(flat), np.zeros_like(flat)
            step, seen = 0, 0
            for tokens, valid in batches(frames, number):
                units = own.unit[tokens]
                _, g = loss(own, w, units, valid)
                step, seen = step + 1, seen + len(units)
                d = np.concatenate([g[k].ravel() for k in w])
                m *= 0.9
                m += 0.1 * d
                s *= 0.99
                s += 0.01 * d**2
                move = np.sqrt(s / (1 - 0.99**step))
                move += 1e-6
                np.divide(m, move, out=move)
                move *= RATE / (1 + number) / (1 - 0.9**step)
                flat -= move
            if seen:
                yield pd.DataFrame({"pos": np.arange(len(flat)), "v": flat * float(seen), "n": float(seen)})

        rows = texts.filter("train").select("ids").mapInPandas(run, "pos long, v double, n double")
        mean = rows.groupBy("pos").agg((F.sum("v") / F.sum("n")).alias("v")).toPandas()  # one row per weight
        if not len(mean):
            break
        w = _views(mean.sort_values("pos")["v"].to_numpy(np.float32), w)
    model.weights = w
    return model


def log10_probability(model: Model, ids: list[np.ndarray], batch: int = 256) -> np.ndarray:
    """log10 of the model's probability of every text (its ids and the end)."""
    if not ids:
        return np.zeros(0)
    tokens, valid, owner = windows(ids)
    out = np.zeros(len(tokens))
    for at in range(0, len(tokens), batch):
        here = tokens[at : at + batch]
        units = model.unit[here]
        bias, group = _biased(model, units)
        z, _ = forward(model.weights, units[:, :-1])
        z += bias
        np.clip(z, -np.inf, LARGEST, out=z)
        top = np.take(z, np.arange(0, z.size, CLASSES) + group.ravel()).reshape(group.shape)
        np.exp(z, out=z)
        picked = top - np.log(z @ np.ones(CLASSES, np.float32))
        target, last = units[:, CONTEXT + 1 :], units[:, CONTEXT:-1]
        picked = picked + model.inside[last, target] + model.rare[here[:, CONTEXT + 1 :]]
        out[at : at + batch] = (picked * valid[at : at + batch]).sum(1, dtype=np.float64)
    return np.bincount(owner, out, len(ids)) / LOG10


# ---- the operator -----------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, train_if: Column, file: str = WORD_BPE) -> DataFrame:
    """One row per row of `docs`: doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows for which `train_if` is true (null: not). Null and empty texts are texts of the end alone.
    Repeated rows count as often as they occur. Without training rows every word is unknown, and the model is
    uniform within what an empty count gives. Empty table: no rows.
    """
    ready(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.coalesce(train_if, F.lit(False)).alias("__train"))
    counts = store(word_counts(rows.filter("__train")), "words")
    ends = rows.filter("__train").count()
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = (total["n"] or 0) + ends, total["v"] + (1 if ends else 0)
    short = counts.filter(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("c"), "word").limit(HEAD_WORDS)
    head = {bytes(r["word"]): r["c"] for r in short.toLocalIterator()}  # HEAD_WORDS words of HEAD_BYTES at most
    texts = prepared(rows, F.col("__train"), head, file)
    model = docs.sparkSession.sparkContext.broadcast(train(texts, statistics(texts)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids = [np.frombuffer(raw, "<u2") for raw in frame["ids"]]
            yield frame.drop(columns="ids").assign(score=log10_probability(model.value, ids))

    narrow = texts.select("rid", "doc_id", "train", "n_words", "head_known", "head_sum", "ids")
    schema = "rid long, doc_id long, train boolean, n_words long, head_known long, head_sum double, score double"
    scored = narrow.mapInPandas(run, schema)
    # Frequent words are settled where the text is read; only rare ones travel, once for each text.
    tail = texts.select("rid", F.explode(F.arrays_zip("tail", "times")).alias("own"))
    tail = tail.select("rid", F.col("own.tail").alias("word"), F.col("own.times").alias("m"))
    tail = tail.join(counts, "word").groupBy("rid").agg(
        F.sum("m").alias("tail_known"), F.sum(F.col("m") * F.log10(F.col("c") + 1)).alias("tail_sum")
    )
    end_log = float(np.log10(ends + 1))
    return scored.join(tail, "rid", "left").select(
        "doc_id",
        "train",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) + end_log
         - (F.col("n_words") + 1) * float(np.log10(n + v + 1))).alias("base_score"),
        "score",
    )
