"""Mixing sources to target weights."""

import hashlib
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollout_quality.llm import mix

from .conftest import ODD

BLOCK = 16


def _targets(sizes, weights, repeats=3):
    """Share by weight; hold what is above its cap there and share the rest again."""
    held, total = {}, sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in held]
        rest, weight = total - sum(held.values()), sum(weights[s] for s in free)
        above = [s for s in free if weight and rest / weight * weights[s] > repeats * sizes[s]]
        if not above:
            return {s: held.get(s, rest / weight * weights[s] if weight else 0) for s in sizes}
        held |= {s: repeats * sizes[s] for s in above}


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _plain(rows, cycle=(5, 2, 1)):
    """(doc_id, size, source_size, target, taken) by walking each source's shuffled documents word by word."""
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(_size(r[1]) for r in rows if r[2] == s) for s in names}
    want = _targets(sizes, {s: cycle[i % len(cycle)] for i, s in enumerate(names)})

    def place(r):
        inner = hashlib.md5((r[1] or "").encode()).hexdigest()
        return hashlib.md5(f"{'' if r[0] is None else r[0]}/{inner}".encode()).hexdigest()[:15]

    out = []
    for s in names:
        own = sorted((r for r in rows if r[2] == s), key=place)
        left, taken = int(want[s]), [0] * len(own)
        while left:
            for i, r in enumerate(own):
                step = min(left, _size(r[1]))
                taken[i], left = taken[i] + step, left - step
        out += [(r[0], _size(r[1]), sizes[s], round(want[s], 6), t) for r, t in zip(own, taken)]
    return sorted(out, key=str)


def _rows(mixed):
    got = mix.taken(mixed).select("doc_id", "size", "source_size", "target", "taken").collect()
    return sorted(((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got), key=str)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, block string, rid long")


@pytest.fixture(scope="module")
def rows():
    """A source with a third of all words, small ones that reach their cap, one without words, and no source."""
    out = [(i, f"w{i} " * (i * 37 % 90), "hot" if i % 3 else f"s{i % 7}") for i in range(400)]
    out += [(1000, "few words here", "a"), (1001, None, "empty"), (1002, "no source " * 40, None), (1002, "no source " * 40, None)]
    return [(*r, "x", "y", 1) for r in out]


@pytest.mark.parametrize("groups", [12, 2])
def test_equals_walk_through_sources(spark, rows, groups, monkeypatch):
    monkeypatch.setattr(mix, "GROUP_BITS", groups)
    assert _rows(mix.mix(_frame(spark, rows), block=BLOCK)) == _plain([r[:3] for r in rows])


def test_schedule(spark, rows):
    """Slots are gapless and full, pieces follow each other, and every run of slots holds the mixture."""
    mixed = mix.mix(_frame(spark, rows), block=BLOCK)
    got = mixed.pieces.toPandas().sort_values(["slot", "offset"])
    assert (got["offset"] == got.groupby("slot")["length"].cumsum() - got["length"]).all()
    full = got.groupby("slot")["length"].sum()
    assert list(full.index) == list(range(len(full))) and sorted(full)[1] == BLOCK
    share = got.assign(hot=(got["source"] == "hot") * got["length"]).groupby("slot")["hot"].sum() / full
    for at in range(0, len(share) - 64, 64):
        assert abs(share[at : at + 64].mean() - share.mean()) < 0.06
    firsts = got[(got["source"] == "hot")].groupby("turn")["slot"]
    assert firsts.max().loc[0] <= firsts.min().get(1, 10**9) + 1
    words = {r[0]: (r[1] or "").split() for r in rows}
    for (doc, turn), own in got[got["doc_id"] < 1000].groupby(["doc_id", "turn"]):
        own = own.sort_values("start")
        assert own["start"].iloc[0] == 0 and (own["start"] + own["length"]).iloc[-1] <= len(words[doc])
        assert (own["start"].iloc[1:].to_numpy() == (own["start"] + own["length"]).iloc[:-1].to_numpy()).all()


def test_reruns_agree(spark, rows):
    df = _frame(spark, rows)
    one, two = (mix.mix(d, block=BLOCK).pieces.drop("rid").toPandas() for d in (df, df.repartition(7)))
    keys = ["slot", "offset", "doc_id", "source", "turn", "start", "length"]
    pd.testing.assert_frame_equal(*(x.sort_values(keys).reset_index(drop=True)[keys] for x in (one, two)))


def test_weights_by_name(spark, rows):
    got = mix.taken(mix.mix(_frame(spark, rows), weights={"hot": 1.0}, block=BLOCK))
    sums = {r["source"]: r["t"] for r in got.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert sums["hot"] == sum(_size(r[1]) for r in rows) and not any(v for k, v in sums.items() if k != "hot")


def test_odd_rows(odd, empty):
    got = _rows(mix.mix(odd))
    assert len(got) == len(ODD) and got == _plain([(r[0], r[1], r[3]) for r in ODD])
    none = mix.mix(empty)
    assert none.pieces.count() == 0 and mix.taken(none).count() == 0


def test_main_path_has_no_python(spark, sf_dir):
    mixed = mix.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = mix.taken(mixed)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
