"""Near duplicates of the pipeline: five-word shingles, similarity 0.8."""

import random
from itertools import combinations

from pyspark.sql import functions as F

import corpus_pipeline
from rollout_quality.llm import similar

from .conftest import ODD


def _set(text):
    parts = (text or "").encode().lower().split()
    return {b" ".join(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))} if parts else set()


def _first_of_groups(rows):
    """Smallest doc_id of every group, by comparing all pairs."""
    sets, root = [_set(r["text"]) for r in rows], list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        union = len(sets[i] | sets[j])
        if not union or len(sets[i] & sets[j]) >= 0.8 * union:
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for r, g in zip(rows, root):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    return sorted(least.values())


def test_stage_equals_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in got.collect()) == _first_of_groups(docs.collect())


def test_large_group_and_odd_rows(spark, odd, empty):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[: i % 190] + [f"x{i}"] + words[i % 190 + 1 :])) for i in range(60)]
    docs = spark.createDataFrame(rows + [(99, "other words that stand alone in this place")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in similar.keep_first(docs).collect()) == [0, 99]
    kept = similar.keep_first(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 1, 3, 6, 7, 8] and ids.count(None) == 1 and len(ODD) == 10
    assert similar.keep_first(empty).count() == 0


def test_family_that_nearly_meets_the_bar(spark):
    """Hundreds of related texts in one band, some pairs of which are similar: every group is found."""
    rng = random.Random(11)
    base, rows = [f"w{i}" for i in range(300)], []
    centres = [rng.sample(range(300), 4) for _ in range(45)]
    for i in range(270):
        words, own = list(base), i % 45
        for at in centres[own]:
            words[at] = f"c{own}-{at}"
        for at in rng.sample(range(300), rng.choice([1, 2, 3, 4, 5, 7])):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = similar._prints(docs, 5)
    largest = prints.select(F.explode("keys").alias("k")).groupBy("k").count().agg(F.max("count")).first()[0]
    want = _first_of_groups([{"doc_id": i, "text": t} for i, t in rows])
    assert largest > 50 and 30 < len(want) < 200, (largest, len(want))
    assert sorted(r["doc_id"] for r in similar.keep_first(docs).collect()) == want


def test_fingerprints_propose_pairs(spark):
    """Near texts within four bits are proposed by SimHash, also without any band; other sizes are not."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:-1]), " ".join(words[:200]), "other words that stand alone in this place", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = similar._prints(docs, 5)
    nodes = prints.withColumnRenamed("doc_id", "first")
    ids = {r["node"]: r["doc_id"] for r in prints.collect()}
    pairs = [tuple(sorted((ids[r["a"]], ids[r["b"]]))) for r in similar.close_prints(nodes).collect()]
    assert pairs == [(0, 1)]
    bandless = nodes.withColumn("keys", F.array(F.col("first")))
    links = similar._verified(docs, bandless, similar.close_prints(bandless), 0.8, 5)
    assert [tuple(sorted((ids[r["u"]], ids[r["v"]]))) for r in links.collect()] == [(0, 1)]


def test_large_bands_are_compared_in_blocks(spark, monkeypatch):
    """Nodes of a band that are in different groups meet in blocks; what comes back are fewer links than nodes."""
    monkeypatch.setattr(similar, "BLOCK_NODES", 7)
    monkeypatch.setattr(similar, "BLOCK_ITEMS", 3000)
    rng, base = random.Random(5), [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = base[: 150 - i % 9 * 8]
        for at in rng.sample(range(len(words)), rng.choice([1, 2, 3, 6])):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # One band for all, and no group yet.
    nodes = similar._prints(docs, 5).withColumnRenamed("doc_id", "first").withColumn("keys", F.array(F.lit(1).cast("long")))
    none = nodes.select("node", F.col("node").alias("root")).limit(0)
    links = similar.apart(docs, nodes, none).collect()
    ids = {r["node"]: r["first"] for r in nodes.collect()}
    root = list(range(60))
    for u, v in ((ids[r["u"]], ids[r["v"]]) for r in links):
        assert len(_set(rows[u][1]) & _set(rows[v][1])) >= 0.8 * len(_set(rows[u][1]) | _set(rows[v][1]))
        a, b = root[u], root[v]
        root = [min(a, b) if r in (a, b) else r for r in root]
    want = _first_of_groups([{"doc_id": i, "text": t} for i, t in rows])
    assert sorted(set(root)) == want and 1 < len(want) < 60
