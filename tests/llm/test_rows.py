"""Operators on whole rows: sharding, packing, line and exact deduplication, decontamination."""

import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollout_quality.llm import decontaminate, exact, lines, pack, shard, tokens
from rollout_quality.llm.common import DOCUMENTS
from rollout_quality.llm.tokens import encode, tokenizer

from .conftest import ODD


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_partition_all_rows(odd, shards):
    got = shard.shard_documents(odd, shards=shards).toPandas()
    assert len(got) == len(ODD) and got["shard"].between(0, shards - 1).all()
    assert sorted(got["size"]) == sorted(16 + len((r[1] or "").encode()) for r in ODD)
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))


def test_shards_are_near_equal(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.lit("x" * 500).alias("text"), "lang", "source")
    got = shard.shard_documents(docs.union(docs.withColumn("source", F.lit("hot"))), shards=7).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 7 and sizes.max() - sizes.min() <= 4 * 516


def test_shards_by_target_bytes(odd, empty):
    assert shard.shard_documents(odd, target_bytes=100_000).agg(F.max("shard")).first()[0] == 1
    assert shard.shard_documents(empty, shards=5).count() == 0


def _check_packed(got: pd.DataFrame, length: int):
    got = got.sort_values(["sequence_id", "offset"])
    grouped = got.groupby("sequence_id")["length"]
    assert (got["offset"] == grouped.cumsum() - got["length"]).all()
    filled = grouped.sum()
    assert (filled[:-1] == length).all() and list(filled.index) == list(range(len(filled)))


def test_packing_odd_rows(odd, empty):
    got = pack.pack(odd, length=64).toPandas()
    _check_packed(got, 64)
    want = sorted(np.append(ids, 2).tolist() for ids in encode([r[1] for r in ODD]))
    ids = [i for raw in got["ids"] for i in np.frombuffer(raw, "<u4").tolist()]
    assert sorted(ids) == sorted(i for one in want for i in one)
    assert pack.pack(empty).count() == 0


@pytest.mark.parametrize("sources", [1_500, 10_000])
def test_packing_many_sources(spark, sources):
    docs = spark.range(2 * sources).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % sources).alias("source"), F.lit("a bee").alias("text")
    )
    got = pack.pack(docs, weights={"s0": 0.5}).toPandas()
    _check_packed(got, 4096)
    assert got.groupby("doc_id")["length"].sum().eq(got.groupby("doc_id")["doc_tokens"].first()).all()
    assert got["doc_id"].nunique() == 2 * sources


def test_packing_keeps_ids_beside_nulls(spark):
    ids = [2**60 + 1, None, -(2**60) - 1]
    docs = spark.createDataFrame([(i, "a b", "s") for i in ids], "doc_id long, text string, source string").coalesce(1)
    got = [r["doc_id"] for r in pack.pack(docs).collect()]
    assert sorted(got, key=str) == sorted(ids, key=str)


def test_packing_leaves_tokens_where_they_are(spark, odd, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = pack.pack(odd, length=64)
        assert "hashpartitioning(part#" not in few._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(pack, "BROADCAST_STARTS", 0)
        many = pack.pack(odd, length=64)
        assert "hashpartitioning(part#" in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 100)
    monkeypatch.setattr(tokens, "_known", {})
    text = " ".join(w for i in range(1000) for w in (f"w{i}", f"Ab{chr(97 + i % 26)}é,", "the"))
    got = [encode([text, "the w1"]), encode(["the Abaé, w999"])]
    known = tokens._known[tokens.WORD_BPE]
    assert len(known) + len(known.before) <= 100
    coder = tokenizer(tokens.WORD_BPE)
    want = [coder.encode(t, add_special_tokens=False).ids for t in (text, "the w1", "the Abaé, w999")]
    assert [ids.tolist() for one in got for ids in one] == want


def test_forms_of_a_word_are_looked_up_once(monkeypatch):
    """Case and signs behind a word made forms of their own, each encoded and remembered."""
    monkeypatch.setattr(tokens, "_known", {})
    words = [f"{chr(97 + i)}ondé" for i in range(26)]
    texts = [f"{w} {w.title()} {w.upper()} {w}, {w}. {w.title()}! ({w}) {w}\n{w}" for w in words]
    got = encode(texts)
    assert [ids.tolist() for ids in got] == [tokenizer(tokens.WORD_BPE).encode(t, add_special_tokens=False).ids for t in texts]
    assert len(tokens._known[tokens.WORD_BPE]) <= len(words) + 2 * len(words)  # "(word", ")" and the like beside them


def test_texts_that_go_together_equal_the_tokenizer(monkeypatch):
    coder, rng = tokenizer(tokens.WORD_BPE), np.random.default_rng(5)
    plain = [c for c in map(chr, range(0x2100)) if tokens._PLAIN.fullmatch(c)]
    odd = ["<|endoftext|>", "<|ENDOFTEXT|>", "J\u030c", "e\u0301", "ª", "º", "µ", "İst", "ŉ", "ΣΑΣ", "\u00a0", "\u2028", "×", "日本", "'s", "'S", "l'M", "²"]
    texts = [f"A{c}B {c}x x{c}, ({c}{c}) 1{c}2'{c}s" for c in plain + odd]
    texts += ["".join(rng.choice(plain + [" "] * 300, 200)) for _ in range(50)] + ["", None, " ", "\n\t \r", "x", "."]
    texts += ["".join(rng.choice(plain + odd + [" "] * 300, 200)) for _ in range(50)]
    texts = [texts[i] for i in rng.permutation(len(texts))]
    want = [coder.encode(t or "", add_special_tokens=False).ids for t in texts]
    for most in (0, 50, 1 << 19):  # no text, some texts, all texts but the odd ones in groups
        monkeypatch.setattr(tokens, "GROUP_CHARS", most)
        monkeypatch.setattr(tokens, "_known", {})
        got = encode(texts)
        assert [(t, ids.tolist()) for t, ids in zip(texts, got)] == list(zip(texts, want))
        assert all(ids.dtype == np.dtype("<u4") for ids in got)


@pytest.mark.parametrize("seed", range(10))
def test_plan_equals_plain_round_robin(seed):
    """Window after window: what a queue and those before it are owed grows by their share of a window, whole tokens
    are taken, and the fraction is carried."""
    rng = np.random.default_rng(seed)
    tokens = [int(t) for t in rng.integers(1_000, 9_000, rng.integers(2, 7))]
    length, total = 100, sum(tokens)
    owed, windows = [Fraction(0)] * len(tokens), []
    for _ in range(total // length):
        upto = []
        for q in range(len(tokens)):
            owed[q] += Fraction(sum(tokens[: q + 1]) * length, total)
            upto.append(int(owed[q]))
            owed[q] -= upto[-1]
        windows.append(np.diff([0, *upto]))
    made, got = pack.plan(tokens, tokens, length), np.zeros((total // length + 3, len(tokens)), int)
    for q, count in enumerate(tokens):
        for _, n, window, _ in made.pieces(q, 0, count):
            got[window, q] += n
    full = made.phases[1].first if len(made.phases) > 1 else len(windows)
    assert full >= len(windows) - 2 and (got[:full] == np.array(windows[:full])).all()
    assert got.sum(0).tolist() == tokens


@pytest.mark.parametrize("seed", range(40))
def test_plan_gives_every_token_a_place(seed):
    rng = np.random.default_rng(seed)
    tokens = (rng.integers(1, 3000, rng.integers(1, 6)) + 200).tolist()
    weights = tokens if seed % 2 else rng.integers(30, 200, len(tokens)).tolist()
    if seed % 2:
        weights = tokens = [max(t, sum(tokens) // 32) for t in tokens]
    made, rows = pack.plan(tokens, weights, 64), []
    for queue, count in enumerate(tokens):
        at = 0
        while at < count:
            step = int(min(count - at, rng.integers(1, 150)))
            rows += [(queue, p[1], p[2], p[3]) for p in made.pieces(queue, at, step)]
            at += step
    got = pd.DataFrame(rows, columns=["queue", "length", "sequence_id", "offset"])
    assert got.groupby("queue")["length"].sum().tolist() == tokens
    _check_packed(got, 64)


def test_windows_keep_the_mixture():
    tokens = [100_000, 50_000, 7_000]
    made, got = pack.plan(tokens, tokens, 1000), []
    for queue, count in enumerate(tokens):
        got += [(queue, p[1], p[2]) for p in made.pieces(queue, 0, count)]
    by = pd.DataFrame(got, columns=["q", "n", "w"]).pivot_table(index="w", columns="q", values="n", aggfunc="sum")
    ideal = np.array(tokens) * 1000 / sum(tokens)
    assert (abs(by.iloc[:-1] - ideal) < 2).all().all()
    assert (abs(by.iloc[:-1].cumsum() - np.outer(np.arange(1, len(by)), ideal)) < 2).all().all()


def test_word_cache_equals_the_tokenizer():
    odd = ["Heed's don't 'S x<|startoftext|>, ΣΑΣ İst é́ café!", "a\xa0b c\x1cd", "...!!?? x_y ½ １２", "日本語、です", " \n\t "]
    for text, got in zip(odd, encode(odd)):
        assert got.tolist() == tokenizer("word_bpe_49k.json").encode(text, add_special_tokens=False).ids


def test_lines(spark, odd, empty):
    got = lines.drop_boilerplate(odd, max_ratio=0.3, min_pages=2).toPandas()
    assert len(got) == len(ODD) and list(got.columns) == [*odd.columns, "__n_lines", "__n_dropped"]
    ones = got[got["doc_id"] == 1]
    assert ones["text"].tolist() == ["", ""] and ones["__n_dropped"].tolist() == [2, 2]
    assert got[got["doc_id"] == 3]["text"].isna().all() and (got[got["doc_id"] == 8]["__n_dropped"] == 0).all()
    assert lines.drop_boilerplate(empty).count() == 0


NAMES = ["__drop", "__host", "__kept", "__h", "__k", "__hot", "__salt", "__N_dropped"]


def test_lines_with_clashing_names(odd):
    plain = lines.drop_boilerplate(odd, max_ratio=0.3, min_pages=2).select("doc_id", "text", "__n_lines", "__n_dropped")
    named = lines.drop_boilerplate(odd.withColumns({n: F.lit("mine") for n in NAMES}), max_ratio=0.3, min_pages=2)
    assert named.columns == [*odd.columns, *NAMES[:-1], "__n_lines", "__n_dropped"]
    assert all(r[:] == ("mine",) * 7 for r in named.select(*NAMES[:-1]).collect())
    assert sorted(map(str, named.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_lines_whose_lists_are_too_large_to_broadcast(spark, sf_dir, monkeypatch, hot_rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("__salt", F.lit(1))
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("source")))
    want = lines.drop_boilerplate(docs, max_ratio=0.02, min_pages=2)
    plan = want._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    wanted = sorted(map(str, want.collect()))
    monkeypatch.setattr(lines, "may_broadcast", lambda df: False)
    monkeypatch.setattr(lines._with_lists, "__defaults__", (hot_rows,))
    assert sorted(map(str, lines.drop_boilerplate(docs, max_ratio=0.02, min_pages=2).collect())) == wanted
    assert any("__n_dropped=0" not in r for r in wanted)


def test_hot_hosts_are_dealt_over_salts(spark):
    pages = spark.range(20_000).select(F.lit("hot").alias("source"), F.lit("a").alias("text"), F.lit(1).alias("__salt"))
    drop = spark.createDataFrame([("hot", ["x"])], "own string, listed array<string>").hint("merge")
    joined = lines._with_lists(pages, "source", drop, "own", 100)
    assert joined.count() == 20_000 and joined.columns == ["source", "text", "__salt", "listed"]
    assert joined.filter("listed[0] = 'x'").count() == 20_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in plan


def _exact(spark, frame, tmp_path, **options):
    path = str(tmp_path / "docs")
    frame.repartition(3).write.parquet(path)
    return exact.exact_duplicates(spark, path, frame.schema, **options).toPandas()


# A digest that sends different texts to one state must not change the result.
@pytest.mark.parametrize("digest", [exact.sha256, lambda c: F.unhex(F.hex(F.length(c) % 3))])
def test_exact(spark, odd, tmp_path, digest):
    got = _exact(spark, odd, tmp_path, digest=digest, files_per_trigger=1)
    assert len(got) == len(ODD) and got["kept"].sum() == 5
    same = got[got["group_size"] == 4]
    assert set(same["keep_id"]) == {1} and same["kept"].sum() == 1 and same["doc_id"].isna().sum() == 1
    blank = got[got["doc_id"].isin([3, 4, 5])]
    assert set(blank["keep_id"]) == {3} and blank[blank["kept"]]["doc_id"].tolist() == [3]


def test_exact_empty(spark, empty, tmp_path):
    assert len(_exact(spark, empty, tmp_path)) == 0


ITEMS = [("a", "Two three FOUR five six seven eight nine ten eleven twelve"), ("b", "tis"), (None, None), ("c", ""), ("c", "12")]


@pytest.mark.parametrize("block_bytes", [50, 10**6])
def test_decontamination(spark, odd, empty, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    found = decontaminate.scan(odd, items, block_bytes=block_bytes).withColumn("hit", decontaminate.hit_words()).toPandas()
    by = {i: (h, list(n)) for i, h, n in zip(found["doc_id"], found["hit"], found["__items"])}
    assert by[8] == (10, ["a"]) and by[7] == (2, ["b", "c"]) and by[6] == (0, [])
    left = decontaminate.decontaminate(odd, items)
    assert left.columns == odd.columns and left.count() == len(ODD) - 2
    cut = decontaminate.decontaminate(odd, items, remove="spans", max_hit_share=1.0).toPandas()
    texts = dict(zip(cut["doc_id"], cut["text"]))
    assert texts[8] == "one " and texts[7] == "Ünï çödé ß ' <|endoftext|> x_y "
    assert decontaminate.scan(empty, items).count() == 0
    assert decontaminate.decontaminate(odd, items.limit(0)).count() == len(ODD)
