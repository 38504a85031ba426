"""What the language model learns from."""

import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rollout_quality.llm import lm
from rollout_quality.llm.common import ready


def test_every_id_is_a_training_target_once():
    texts = [np.arange(n).astype("<u2") + 1000 * n for n in (0, 1, 31, 32, 33, 60)] + [np.arange(5000).astype("<u2")]
    frame = pd.DataFrame({"ids": [t.tobytes() for t in texts]})
    for number in range(lm.ROUNDS):
        got = list(lm.batches(iter([frame, frame.iloc[:0]]), number))
        targets = np.concatenate([tokens[:, lm.CONTEXT + 1 :][valid] for tokens, valid in got])
        assert sorted(targets.tolist()) == sorted([i for t in texts for i in t.tolist()] + [lm.END] * len(texts))
        assert all(len(tokens) <= lm.BATCH for tokens, _ in got)


def _batch(seed: int):
    rng = np.random.default_rng(seed)
    share = rng.random((lm.COARSE * lm.UNITS, lm.CLASSES))
    bias = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    group, coarse = rng.integers(0, lm.CLASSES, lm.UNITS), rng.integers(0, lm.COARSE, lm.UNITS)
    nothing = np.zeros(0, np.float32)
    model = lm.Model(rng.integers(0, lm.UNITS, lm.IDS).astype(np.int32), nothing, group, coarse, bias, nothing)
    w = lm.fresh_weights()
    w["out"] = rng.normal(0, 0.3, w["out"].shape).astype(np.float32)
    units = rng.integers(0, lm.UNITS, (lm.BATCH, lm.SPAN)).astype(np.int32)
    return model, w, units, rng.random((lm.BATCH, lm.TARGETS)) < 0.9


def test_corrections_are_those_of_plain_attention():
    _, w, units, _ = _batch(1)
    got, _ = lm.forward(w, units[:, :-1])
    w = {k: v.astype(float) for k, v in w.items()}
    for b in (0, 17):
        x = w["embed"][units[b, :-1]] + w["place"]
        for t in range(lm.TARGETS):
            own = lm.CONTEXT + t
            a = np.exp(x[own] @ w["q"] @ (x[: own + 1] @ w["k"]).T / np.sqrt(lm.WIDTH))
            h = a @ (x[: own + 1] @ w["v"]) / a.sum() @ w["o"] + x[own] @ w["own"]
            assert np.allclose(got[b, t], h / (1 + np.abs(h)) @ w["out"], atol=1e-4)


def test_a_step_holds_few_copies_of_its_scores():
    model, w, units, valid = _batch(2)
    lm.loss(model, w, units, valid)
    tracemalloc.start()
    lm.loss(model, w, units, valid)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Scores of classes and of attention, in 32 bits.
    scores = 4 * lm.BATCH * lm.TARGETS * (lm.CLASSES + lm.SPAN - 1)
    assert most < 5 * scores


def test_rare_words_are_stored_once_a_text(spark):
    docs = ready(spark).createDataFrame([(1, "rare often RARE thing"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.prepared(docs, F.lit(True), {b"often": 3}, lm.WORD_BPE).collect()}
    assert dict(zip(map(bytes, got[1]["tail"]), got[1]["times"])) == {b"rare": 2, b"thing": 1} and len(got[1]["tail"]) == 2
    assert (got[1]["n_words"], got[1]["head_known"], got[2]["n_words"], got[2]["tail"]) == (4, 1, 0, [])
