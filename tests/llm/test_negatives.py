"""Hard negatives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollout_quality.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, anchor string"


def _plain(rows):
    """All pairs of every anchor, sorted whole."""
    taking = []
    for vec_id, vec, label, *_ in rows:
        if label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        taking.append((vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in vec], label))
    out = []
    for i, (a, va, la) in enumerate(taking):
        if a is None or a % 50:
            continue
        others = [(sum(x * y for x, y in zip(va, v)), b, l) for j, (b, v, l) in enumerate(taking) if j != i]
        others.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for ps, p, _ in [r for r in others if r[2] == la][:5]:
            fits = [r for r in others if r[2] != la and 50 * ps <= 100 * r[0] <= 95 * ps][:3]
            out += [(a, p, rank, n, ps, ns) for rank, (ns, n, _) in enumerate(fits, 1)]
    return sorted(out, key=str)


def _mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(df, F.col("vec_id") % 50 == 0, label)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


@pytest.mark.parametrize("block", [4096, 37])
def test_equals_all_pairs(spark, block, monkeypatch):
    """Random vectors, a vector on a third of the rows, ties, null and non-finite parts, odd ids and labels."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(4, 8))
    rows = []
    for i in range(300):
        vec = centres[0] if i % 3 == 0 else centres[i % 4] + rng.normal(size=8) * 0.6
        rows.append((i, [float(x) for x in np.round(vec, 1 if i % 2 else 3)], int(i % 4 if i % 5 else rng.integers(10)), "x", "y"))
    rows += [(50, rows[50][1], 2, "x", "y"), (50, rows[50][1], 2, "x", "y"), (None, rows[0][1], 0, "x", "y"), (-100, rows[3][1], 1, "x", "y")]
    rows += [(400, None, 1, "", ""), (401, rows[1][1], None, "", ""), (450, [0.1, None], 1, "", ""), (500, [float("nan"), 1.0], 1, "", "")]
    rows += [(550, [float("inf")], 1, "", ""), (600, [0.0] * 8, 1, "", ""), (650, [], 2, "", ""), (700, [1.5], 3, "", "")]
    assert _mined(spark.createDataFrame(rows, SCHEMA).repartition(5)) == _plain(rows)


def test_given_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert _mined(df) == _plain([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])


def test_empty(spark):
    assert _mined(spark.createDataFrame([], SCHEMA)) == []
    assert _mined(spark.createDataFrame([(50, [1.0], 1, "", "")], SCHEMA)) == []


def test_products_are_exact():
    rng = np.random.default_rng(0)
    sizes = [1.0, 2.0**19, 2.0**24, 2.0**40, 1e300]
    a, b = (np.floor(rng.normal(size=(10, 6)) * np.repeat(sizes, 2)[:, None]) for _ in range(2))
    want = [[max(-negatives.LARGEST, min(negatives.LARGEST, sum(int(x) * int(y) for x, y in zip(r, s)))) for s in b] for r in a]
    assert negatives.products(a, b).tolist() == want
    assert negatives.products(np.zeros((2, 0)), b).tolist() == [[0] * 10] * 2


def test_window_bounds():
    for score in range(-300, 300):
        low, high = negatives.window(score)
        assert [n for n in range(-400, 400) if low <= n <= high] == [n for n in range(-400, 400) if 50 * score <= 100 * n <= 95 * score]
