"""SimHash, language model, toxicity, pages, archives, pipeline."""

import random
import re
import zlib
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from check_queries import compare
from rollout_quality.llm import html, lm, pack, simhash, toxicity, warc
from rollout_quality.llm.common import DOCUMENTS
from rollout_quality.llm.decontaminate import NGramSet, words

from .conftest import ODD
from .test_similar import _first_of_groups as first_of_groups


def _plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(parts[i : i + 4]) for i in range(max(1, len(parts) - 3))] if parts else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(count, links):
    root = list(range(count))
    for a, b in links:
        a, b = root[a], root[b]
        root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("heavy", [False, True])
def test_links_of_blocks_equal_brute_force(heavy):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    fps = np.unique(np.concatenate([base] + [base ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in rng.integers(0, 63, (4, 2))]))
    bits = 6
    full = np.arange(1 << bits, dtype=np.uint64) if heavy else np.array([], np.uint64)
    blocks, owners = simhash._deal(fps, bits, 2, full)
    found = [simhash.links_of_block(owners[blocks == b], int(b), bits, 4) for b in np.unique(blocks)]
    place = {int(f): i for i, f in enumerate(fps)}
    links = [(place[int(u)], place[int(v)]) for us, vs in found for u, v in zip(us, vs)]
    want = [(i, j) for i, j in combinations(range(len(fps)), 2) if int(fps[i] ^ fps[j]).bit_count() <= 4]
    assert _roots(len(fps), links) == _roots(len(fps), want)


def test_simhash_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd).toPandas()
    assert len(got) == len(ODD)
    want = sorted(f"{_plain_fingerprint(r[1]):016x}" for r in ODD)
    assert sorted(got["fingerprint"]) == want
    assert set(got[got["doc_id"].isin([1, 2])]["component_id"]) == {1} and set(got[got["doc_id"].isin([3, 4, 5])]["component_id"]) == {3}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and 2 not in [r["doc_id"] for r in kept.collect()]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "u long, v long")
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def _model():
    rng = np.random.default_rng(0)
    unit, rare = lm.units_of(rng.integers(0, 1000, lm.IDS).astype(float))
    group, coarse = rng.integers(0, lm.CLASSES, lm.UNITS), rng.integers(0, lm.COARSE, lm.UNITS)
    share = rng.random((lm.COARSE * lm.UNITS, lm.CLASSES))
    inside = rng.random((lm.UNITS, lm.UNITS))
    total = np.zeros((lm.UNITS, lm.CLASSES))
    np.add.at(total.T, group, inside.T)
    bias = np.log(share / share.sum(1, keepdims=True))
    return lm.Model(unit, rare, group, coarse, bias, np.log(inside / total[:, group]))


def test_gradient():
    model, rng = _model(), np.random.default_rng(1)
    w = {k: v.astype(float) for k, v in lm.fresh_weights().items()}
    w["out"] = rng.normal(0, 0.3, w["out"].shape)
    tokens, valid, _ = lm.windows([rng.integers(0, 49000, n).astype("<u2") for n in (0, 5, 80)])
    units = model.unit[tokens]
    _, gradient = lm.loss(model, w, units, valid)
    for k in w:
        at = (units[1, 20], 3) if k == "embed" else (1,) * w[k].ndim
        w[k][at] += 1e-5
        high = lm.loss(model, w, units, valid)[0]
        w[k][at] -= 2e-5
        low = lm.loss(model, w, units, valid)[0]
        w[k][at] += 1e-5
        assert abs((high - low) / 2e-5 - gradient[k][at]) < 1e-6


def test_next_id_probabilities_sum_to_one_and_are_causal():
    model = _model()
    model.weights = lm.fresh_weights()
    model.weights["out"] = np.random.default_rng(2).normal(0, 0.5, model.weights["out"].shape).astype(np.float32)
    text = np.arange(500, 540).astype("<u2")
    log10 = lambda ids: lm.log10_probability(model, ids)
    # The probabilities of all one-id continuations (their prefix's end left out) add up to the prefix's.
    tokens, valid, _ = lm.windows([np.append(text, i).astype("<u2") for i in range(0, lm.IDS, 1)][:1])
    many = np.repeat(tokens[-1:], lm.IDS, 0)
    last = lm.CONTEXT + int(valid[-1].sum()) - 1
    many[:, last] = np.arange(lm.IDS)
    units, total = model.unit[many], 0.0
    place = last - lm.CONTEXT - 1
    for at in range(0, lm.IDS, 4096):
        u = units[at : at + 4096]
        bias, group = lm._biased(model, u)
        z, _ = lm.forward(model.weights, u[:, :-1])
        z = z[:, place] + bias[:, place]
        lse = np.log(np.exp(z.astype(float)).sum(1))
        p = z[np.arange(len(u)), group[:, place]] - lse + model.inside[u[:, last - 1], u[:, last]] + model.rare[many[at : at + 4096, last]]
        total += np.exp(p).sum()
    # The begin id is never a target; its share is what is missing.
    assert abs(total - 1) < 2e-3
    assert (log10([text, text[:5], text[:0]]) < 0).all()


def test_lm_scores(spark, odd, empty):
    got = lm.score_texts(odd, F.col("doc_id") != 8).toPandas()
    train = [r for r in ODD if r[0] not in (8, None)]
    counts = pd.Series([w for r in train for w in lm.split_words(r[1])]).value_counts().to_dict()
    n, v, ends = sum(counts.values()) + len(train), len(counts) + 1, len(train)
    by = got.groupby("doc_id").first()
    for r in ODD:
        if r[0] is not None:
            own = [counts.get(w, 0) for w in lm.split_words(r[1])] + [ends]
            assert by.loc[r[0], "base_score"] == pytest.approx(sum(np.log10((c + 1) / (n + v + 1)) for c in own))
            assert by.loc[r[0], "n_known"] == sum(c > 0 for c in own) and by.loc[r[0], "n_tokens"] == len(own)
    assert (got["train_tokens"] == n).all() and np.isfinite(got["score"]).all() and (got["score"] <= 0).all()
    assert lm.score_texts(empty, F.lit(True)).count() == 0


def test_isotonic_is_monotone_and_calibrated():
    x, y = np.array([1.0, 2, 2, 3, 4, 5]), np.array([0.0, 1, 0, 0, 1, 1])
    places, shares = toxicity.isotonic(x, y)
    assert (np.diff(shares) >= 0).all() and np.interp(1, places, shares) == 0 and np.interp(5, places, shares) == 1


def test_toxicity_learns_stems(spark, empty):
    rng = random.Random(5)
    rows = [
        (i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(40)) + (" zorkelig" + "abcdef"[i % 6] if i % 5 == 0 else ""), "xx", "s", 1)
        for i in range(600)
    ] + [(1000, None, None, None, None), (None, "alpha", None, None, None), (1001, "", None, None, None)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)] + [(1000, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 1)
    got = toxicity.score(docs, model).toPandas()
    assert len(got) == 603 and got["score"].between(0, 1).all()
    held = got[got["doc_id"] % 3 == 1]
    held = held[held["doc_id"] < 600]
    assert ((held["score"] >= 0.7) == (held["doc_id"] % 5 == 0)).mean() > 0.97
    assert toxicity.fit(docs, labels.limit(0)).predict(np.zeros((2, len(toxicity.NAMES)))).tolist() == [0, 0]
    assert toxicity.score(empty, model).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = entry_points.queries()["op6_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    held = got.filter("held_out").toPandas()
    right = ((held["predicted"] == 1) & (held["toxic"] == 1)).sum()
    assert right / held["predicted"].sum() > 0.95 and right / held["toxic"].sum() > 0.85


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page"><header><h1>Site</h1></header>
<nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies</p></div><main><article class="post">
<header><h1>Title here</h1></header><p>Short.<p>A &amp; longer <b>bold</b>ly&nbsp;told <a href="x>y">tale</a> &lt;so&#8217;s&gt; on.
<script>if (a<b) document.write("<p>x</p>")</script><aside>Related: <a>foo</a></aside><ul><li>one item</li></ul>
<form><label>Mail</label><button>Go</button></form></article><section id="comments"><article><p>Nice words, reader here.</p></article>
</section></main><!-- <p>gone</p> --><footer>c 2020</footer>"""


def test_pages(spark):
    assert html.main_texts([PAGE]) == ["Title here Short. A & longer boldly told tale <so’s> on. one item"]
    assert html.main_texts([None, "", "<p>", "<br>"]) == [""] * 4
    pages = spark.createDataFrame([(1, None, PAGE, "x"), (1, "u", None, None), (None, "u", "", "y")], "page_id long, url string, html string, text string")
    got = html.extract(pages).toPandas()
    assert list(got.columns) == ["page_id", "url", "text"] and sorted(got["text"])[:2] == ["", ""] and len(got) == 3
    assert html.extract(pages.limit(0)).count() == 0


def test_page_articles_of_the_test_tables(spark, sf_dir):
    for r in entry_points.queries()["op7_html_extraction"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id", "url"]).collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)>", " ", article))
        assert r["text"] == " ".join(html.html.unescape(plain).split())


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    parts = []
    for i in range(20):
        data = warc.record("response", i, "http://a b/\r\n", warc._sha1(b"x" * 9 * i), 9 * i, b"x" * 9 * i)
        parts.append(warc.member(data) if packed else data)
    whole, rng = b"".join(parts), random.Random(1)
    assert [f.kind for f in warc.salvage(whole)] == ["response"] * 20 and not list(warc.salvage(b""))
    ends = np.cumsum([len(p) for p in parts])
    for _ in range(150):
        at = rng.randrange(len(whole))
        hurt = int(np.searchsorted(ends, at, side="right"))
        for bad in (whole[:at] + bytes([whole[at] ^ 0x55]) + whole[at + 1 :], whole[:at] + whole[at + 3 :], whole[:at] + b"junk" + whole[at:]):
            found = list(warc.salvage(bad))
            ids = {f.headers.get("warc-record-id") for f in found if f.kind == "response"}
            # At a border, two records can suffer; nothing further away may be lost.
            assert {warc._uri(i) for i in range(20) if abs(i - hurt) > 1} <= ids
            # Outside a gzip member nothing protects the value of a header.
            assert not packed or len(ids) == 20 or any(f.kind == "gap" for f in found)


def test_archives_of_odd_pages(spark):
    big = "é" * 600
    rows = [(1, "http://a", big), (5, None, big), (5, "http://b", big), (None, "u", big), (2, "u", None), (3, "u", "x"), (4, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = warc.round_trip(pages).toPandas()
    assert len(got) == 7 and set(got["kind"]) == {"response", "revisit"}
    revisits = got[got["kind"] == "revisit"]
    assert set(revisits["refers_to"]) == {5} and len(revisits) == 2 and (revisits["bytes"] == 1200).all()
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_pipeline_equals_brute_force(spark, sf_dir):
    """Each stage on the rows that the stage before it kept, against plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    out = stages["toxicity"](spark, docs, sf_dir)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, corpus_pipeline.toxicity_model(spark, docs, sf_dir)).collect()}
    rows = [r for r in rows if scores[r[0]] < toxicity.THRESHOLD]
    assert sorted(tuple(r) for r in out.collect()) == sorted(rows)

    out = stages["line_dedup"](spark, out, sf_dir)
    pages, counts = {}, {}
    for r in rows:
        pages[r[3]] = pages.get(r[3], 0) + 1
        for line in {x.strip(" \t\n\v\f\r") for x in r[1].split("\n")} - {""}:
            counts[r[3], line] = counts.get((r[3], line), 0) + 1
    bad = {k for k, n in counts.items() if n >= 5 and n > 0.05 * pages[k[0]]}
    cleaned = []
    for r in rows:
        kept = [x for x in r[1].split("\n") if (r[3], x.strip(" \t\n\v\f\r")) not in bad]
        text = "\n".join(kept)
        cleaned.append((r[0], text, r[2], r[3], r[4] if len(kept) == len(r[1].split("\n")) else len(text)))
    rows = cleaned
    assert sorted(tuple(r) for r in out.collect()) == sorted(rows)

    out = stages["near_dedup"](spark, out, sf_dir)
    firsts = set(first_of_groups([{"doc_id": r[0], "text": r[1]} for r in rows]))
    rows = [r for r in rows if r[0] in firsts]
    assert sorted(tuple(r) for r in out.collect()) == sorted(rows)

    out = stages["benchmark_decontamination"](spark, out, sf_dir)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {tuple(words(t)[i : i + 10]) for _, t in items for i in range(max(1, len(words(t)) - 9)) if words(t)}
    sizes = {len(g) for g in grams}
    hit = lambda t: any(tuple(words(t)[i : i + n]) in grams for n in sizes for i in range(len(words(t)) - n + 1))
    rows = [r for r in rows if not hit(r[1])]
    assert sorted(tuple(r) for r in out.collect()) == sorted(rows)

    got = stages["packing"](spark, out, sf_dir).toPandas()
    ids = {r[0]: np.append(x, 2).astype("<u4") for r, x in zip(rows, pack.encode([r[1] for r in rows]))}
    assert got.groupby("doc_id")["length"].sum().to_dict() == {d: len(x) for d, x in ids.items()}
    for r in got.itertuples():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    whole = corpus_pipeline.run(spark, sf_dir).toPandas()
    key = list(got.columns)
    assert whole.groupby("doc_id")["length"].sum().equals(got.groupby("doc_id")["length"].sum()) and list(whole.columns) == key


def test_queries_with_sql(spark, sf_dir):
    import duckdb
    from pathlib import Path

    from rollout_quality.llm.oracle import ORACLES

    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    for name in ORACLES:
        ok, note = compare(spark, con, name, sf_dir)
        assert ok, (name, note)
