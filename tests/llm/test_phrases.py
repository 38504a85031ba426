"""Phrase collocations."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollout_quality.llm import phrases

from .conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _plain(rows, threshold, top=2000):
    """All phrases counted at once."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    kept = {p: a for p, a in f.items() if len(p) > 2 and a >= threshold}
    gone = set()
    for p, a in kept.items():
        inner = {(p[0], *p[i : i + m]) for m in range(2, len(p) - 1) for i in range(1, len(p) - m + 1)}
        gone |= {q for q in inner if 100 * a >= 80 * kept[q]}
    out = []
    for p, a in kept.items():
        if p not in gone:
            cuts = [(2_000_000 * a // (f[p[: k + 1]] + f[p[:1] + p[k + 1 :]]), k, f[p[: k + 1]], f[p[:1] + p[k + 1 :]]) for k in range(1, len(p) - 1)]
            score, _, l, r = min(cuts)
            out.append((p[0], -score, -a, " ".join(p[1:]).encode(), l, r))
    out, ranks, got = sorted(out), Counter(), []
    for lang, score, a, phrase, l, r in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            got.append((lang, ranks[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return got


def _mined(df, threshold, **settings):
    got = phrases.collocations(df, threshold, **settings)
    return sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.fixture
def rows():
    """Text in which words become frequent late, a phrase on a third of the rows, and the same words in two languages."""
    rng, out = random.Random(5), []
    for i in range(300):
        words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            words += ["All", "Rights", "reserved", "here"]
        if i > 200:
            words += ["late", "comers", "meet", "again"] * 2
        marks = [rng.choice(["", "", "", ",", ".", "\n", "\t", " ", "!?", "\r\n"]) for _ in words]
        out.append((" ".join(w + m for w, m in zip(words, marks)), ("en", "fr", None)[i % 7 % 3], "x", 1))
    return [*out, (None, "en", "y", 2), ("", "de", "y", 2), ("a b c d " * 200, "xx", None, None)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, phrase string, shard int")


@pytest.mark.parametrize("shards, row_words", [(4, 1 << 19), (4, 200), (1, 100), (3, 50)])
def test_equals_counting_all_phrases(spark, rows, shards, row_words, monkeypatch):
    monkeypatch.setattr(phrases, "ROW_WORDS", row_words)
    assert _mined(_frame(spark, rows).repartition(3), 5, shards=shards) == _plain([r[:2] for r in rows], 5)


def test_slices_and_shared_counters(spark, rows, monkeypatch):
    """Few counters, so that many phrases share one, and filters of a quarter of them."""
    monkeypatch.setattr(phrases, "SEGMENT_BITS", 6)
    monkeypatch.setattr(phrases, "FILTER_BITS", 8)
    monkeypatch.setattr(phrases, "WORDS_PER_COUNTER", 16)
    monkeypatch.setattr(phrases, "ROW_WORDS", 300)
    assert _mined(_frame(spark, rows), 5, top=7) == _plain([r[:2] for r in rows], 5, 7)


def test_lengths_interleave(spark, rows, monkeypatch):
    """Longer phrases are counted before shorter ones have seen every shard."""
    monkeypatch.setattr(phrases, "ROW_WORDS", 100)
    corpus = phrases.coded(_frame(spark, rows), 4)
    counters = phrases._Counters(corpus, 5)
    for version in range(3):
        lengths = counters.open(4)
        counters.add(phrases._scan(corpus.where(F.col("shard") == version), counters, lengths, 4, 0), lengths)
    reached = [[n for n, size in sizes.items() if size] for sizes in counters.sizes]
    assert reached[1] == [1] and reached[2] == [1, 2] and reached[3][:3] == [1, 2, 3]


def test_long_text_is_coded_in_parts(monkeypatch):
    text = "ab cd\nef gh ij\n\nkl mn\nop"
    whole = phrases._Book()
    whole.add(text)
    monkeypatch.setattr(phrases, "CHUNK_CHARS", 5)
    parts = phrases._Book()
    for chunk in phrases._chunks(text):
        parts.add(chunk)
    assert "".join(phrases._chunks(text)) == text and len(list(phrases._chunks(text))) > 2
    assert parts.numbers == whole.numbers and [c for p in parts.codes for c in p if c] == [c for c in whole.codes[0] if c]


def test_odd_rows(odd, empty):
    assert _mined(odd, 3) == _plain([(r[1], r[2]) for r in ODD], 3)
    assert _mined(empty, 1) == []
