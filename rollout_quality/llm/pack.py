"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of its documents' tokens. A window of `length` tokens is filled in rounds: each queue is
owed its target share of the window, takes whole tokens and carries the fraction it is still owed (its deficit,
an exact remainder) into the next window. Because remainders are exact integers, what a queue has given before
any window has a closed form, so every partition starts with the deficits that the windows before it left and
places its own documents without waiting for others. When a queue runs dry, its share goes to the others.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rollout_quality.llm.common import ready, store
from rollout_quality.llm.tokens import WORD_BPE, encode
from rollout_quality.session import is_small

LENGTH = 4096
END = 2
# Starts of (part, source) that are broadcast, at most; beyond, the tokens are shuffled to meet them.
BROADCAST_STARTS = 100_000


@dataclass
class Phase:
    """A run of windows in which the same queues give, or one window with explicit takes."""

    first: int
    given: list[int]  # by each queue before the phase
    upto: list[int]  # running sums of the queues' weights; or, in a single window, of their takes
    single: bool
    length: int

    def edge(self, queue: int, k: int) -> int:
        """What the queues before `queue` give in the first `k` windows of the phase."""
        if not queue:
            return 0
        return self.upto[queue - 1] * k if self.single else self.upto[queue - 1] * k * self.length // self.upto[-1]


@dataclass
class Schedule:
    phases: list[Phase] = field(default_factory=list)
    starts: list[list[int]] = field(default_factory=list)  # by queue: what it has given before each phase

    def pieces(self, queue: int, at: int, count: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the document, length, sequence, offset there) for `count` tokens at place `at` of a queue."""
        end, pos, starts = at + count, at, self.starts[queue]
        while pos < end:
            p = bisect_right(starts, pos) - 1
            phase = self.phases[p]
            stop = starts[p + 1] if p + 1 < len(starts) else None
            width = phase.edge(queue + 1, 1) - phase.edge(queue, 1) if phase.single else None
            k = 0
            if width is None:
                weight = phase.upto[queue] - (phase.upto[queue - 1] if queue else 0)
                k = max(0, (pos - phase.given[queue]) * phase.upto[-1] // (weight * phase.length) - 2)
            low, high = phase.edge(queue, k), phase.edge(queue + 1, k)
            while pos < end and (stop is None or pos < stop):
                low1, high1 = phase.edge(queue, k + 1), phase.edge(queue + 1, k + 1)
                begin, until = phase.given[queue] + high - low, phase.given[queue] + high1 - low1
                if pos < until:
                    take = min(end, until) - pos
                    yield pos - at, take, phase.first + k, low1 - low + pos - begin
                    pos += take
                low, high, k = low1, high1, k + 1


def plan(tokens: list[int], weights: list[int], length: int = LENGTH) -> Schedule:
    """Windows for queues of so many tokens. A queue's share of a full window must be one token at least."""
    left, given, made, first = list(tokens), [0] * len(tokens), Schedule(), 0
    while any(left):
        active = [w if n else 0 for w, n in zip(weights, left)]
        total = sum(active)
        runs = min(n * total // (length * w) for w, n in zip(active, left) if w)
        upto = np.cumsum(np.array(active, object)).tolist()
        phase = Phase(first, list(given), upto, False, length)
        # Rounding may ask a queue for one token more than its share.
        ends = lambda q: phase.edge(q + 1, runs) - phase.edge(q, runs)
        while runs and any(ends(q) > n for q, n in enumerate(left)):
            runs -= 1
        if runs:
            takes = [ends(q) for q in range(len(left))]
        else:
            takes, room, runs = [0] * len(left), min(length, sum(left)), 1
            while room:
                open_ = [q for q, n in enumerate(left) if n > takes[q]]
                share = sum(active[q] for q in open_)
                before = room
                for q in open_:
                    more = min(left[q] - takes[q], before * active[q] // share)
                    takes[q], room = takes[q] + more, room - more
                if room == before:
                    for q in sorted(open_, key=lambda q: -active[q])[:room]:
                        takes[q], room = takes[q] + 1, room - 1
            phase = Phase(first, list(given), np.cumsum(np.array(takes, object)).tolist(), True, length)
        made.phases.append(phase)
        given = [g + t for g, t in zip(given, takes)]
        left = [n - t for n, t in zip(left, takes)]
        first += runs
    made.starts = [[p.given[q] for p in made.phases] for q in range(len(tokens))]
    return made


def tokenized(docs: DataFrame, file: str = WORD_BPE, end: int = END) -> DataFrame:
    """A stored table: doc_id (as text: beside nulls pandas would round it), source, part, start (tokens of the same
    source and part before it), n, ids."""
    ready(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId(), {}
        for frame in frames:
            starts, counts, coded = [], [], []
            for source, ids in zip(frame["source"], encode(list(frame["text"]), file)):
                ids = np.append(ids, end)
                source = None if source is None or source != source else source
                starts.append(seen.get(source, 0))
                seen[source] = starts[-1] + len(ids)
                counts.append(len(ids))
                coded.append((ids.astype("<u2") if not len(ids) or ids.max() < 1 << 16 else ids.astype("<u4")).tobytes())
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "source": frame["source"], "part": part, "start": starts, "n": counts, "ids": coded}
            )

    schema = "doc_id string, source string, part long, start long, n long, ids binary"
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "source", "text")
    return store(named.mapInPandas(run, schema), "tokens")


def _queues(sums: DataFrame, length: int, weights: dict | None) -> tuple[list, list[int], list[int]]:
    """Sources with a queue of their own, and the tokens and weights of all queues; a last one holds the rest.

    At most `length` sources can be owed a token a window, so the list is bounded; smaller ones share a queue.
    """
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    total = by_source.agg(F.sum("n").alias("t")).first()["t"] or 0
    large = by_source.filter(F.col("n") * length >= total).orderBy(F.desc("n"), "source").collect()
    own = [(r["source"], r["n"]) for r in large]
    rest = total - sum(n for _, n in own)
    while own and 0 < rest * length < total:
        rest += own.pop()[1]
    names, tokens = [s for s, _ in own], [n for _, n in own] + ([rest] if rest else [])
    if weights is None:
        return names, tokens, tokens
    asked = [weights.get(s, 0.0) for s in names] + ([weights.get("*", 0.0)] if rest else [])
    # Every queue is owed a token a window at least, or its documents would wait for ever.
    scale = (sum(asked) or 1.0) / (length - len(asked))
    return names, tokens, [max(1, round((a + scale) / scale * 1_000_000)) for a in asked]


def pack(
    docs: DataFrame, length: int = LENGTH, weights: dict | None = None, file: str = WORD_BPE, end: int = END
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    Every token is in exactly one piece, all sequences but the last are full. `weights` gives target shares by
    source ("*": the shared queue of small sources); by default the shares of the corpus, so that all queues end
    together. A null source is a source of its own, a null text is empty and still has its end token, repeated rows
    and rows without a doc_id are documents like any other. Empty table: no rows.
    """
    coded = tokenized(docs, file, end)
    sums = coded.groupBy("part", "source").agg(F.sum("n").alias("n"))
    sums = store(sums, "queue-sums")
    names, tokens, shares = _queues(sums, length, weights)
    # At most `length` rows; sources without one share the last queue.
    queue_of = docs.sparkSession.createDataFrame([(n, q) for q, n in enumerate(names)], "own string, queue long")
    queued = sums.join(F.broadcast(queue_of), F.col("source").eqNullSafe(F.col("own")), "left").drop("own")
    queued = queued.fillna(len(names), ["queue"])
    return _place(coded, sums, queued, plan(tokens, shares, length))


def _place(coded: DataFrame, sums: DataFrame, queued: DataFrame, schedule: Schedule) -> DataFrame:
    """Where every (part, source) begins in its queue, then the pieces of every document. The tokens stay where they
    are while the starts are few."""
    inside = Window.partitionBy("queue", "part").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = queued.groupBy("queue", "part").agg(F.sum("n").alias("all"))
    parts = parts.select("queue", "part", F.coalesce(F.sum("all").over(across), F.lit(0)).alias("before"))
    starts = queued.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, ["queue", "part"])
    starts = starts.select(
        F.col("part").alias("p"), F.col("source").alias("s"), "queue", (F.col("before") + F.col("within")).alias("base")
    )
    if is_small(sums, BROADCAST_STARTS):  # a row for each of its rows
        starts = F.broadcast(starts)
    found = coded.join(starts, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    found = found.select("doc_id", "queue", (F.col("base") + F.col("start")).alias("at"), "n", "ids")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            ids_of = frame["doc_id"]
            for i, (queue, at, n, raw) in enumerate(zip(frame["queue"], frame["at"], frame["n"], frame["ids"])):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4").tobytes()
                for start, count, sequence, offset in schedule.pieces(queue, at, n):
                    rows.append((i, start, count, ids[4 * start : 4 * (start + count)], n, sequence, offset))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            out["doc_id"] = ids_of.take(out["doc_id"]).to_numpy() if len(out) else []
            yield out

    schema = "doc_id string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return found.mapInPandas(cut, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
