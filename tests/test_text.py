import random

from pyspark.sql import functions as F

from rollout_quality.functions import text as T

SPACES = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x3000)]


def random_texts(seed=5, n=400):
    rng = random.Random(seed)
    pieces = SPACES + ["a", "Zé", "word.", "x!", "?", "…", "1", "​"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_whitespace_set_is_pythons():
    assert set(T.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_words_blank(values):
    texts = random_texts()
    assert values(texts, "t string", lambda: T.strip(F.col("t"))) == [t.strip() for t in texts]
    assert values(texts, "t string", lambda: T.word_count(F.col("t"))) == [len(t.split()) for t in texts]
    assert values(texts, "t string", lambda: T.is_blank(F.col("t"))) == [not t.strip() for t in texts]
    assert values([None], "t string", lambda: T.is_blank(F.col("t"))) == [True]


def test_has_lines(values):
    texts = random_texts(6) + ["a\nb\nc", "a\n\n b \r\nc", "a b", "a\x0bb\x1cc", "\n\n\n", "a b c"]
    expected = [len([x for x in t.splitlines() if x.strip()]) >= 3 for t in texts]
    assert values(texts, "t string", lambda: T.has_lines(F.col("t"), 3)) == expected
    assert any(expected) and not all(expected)


def test_sentences(values):
    texts = ["", "One", "One. Two", "One. Two? Three!", "3.5 is. ok", "a...  b", "a.\n\nb.", "a .b", "a!? b"]
    assert values(texts, "t string", lambda: T.sentence_count(F.col("t"))) == [0, 1, 2, 3, 2, 2, 2, 1, 2]


def test_fingerprint_and_digest(values):
    pairs = [" What IS\t2 +\n2? ", "what is 2 + 2?"]
    prints = values(pairs, "t string", lambda: T.question_fingerprint(F.col("t")))
    assert prints == ["what is 2 + 2?"] * 2
    keys = values(prints + ["other"], "t string", lambda: T.digest(F.col("t")))
    assert keys[0] == keys[1] != keys[2] and len(keys[0]) == 32


def test_python_rounding(values):
    rng = random.Random(1)
    numbers = [0.0, 2.675, 2.665, 0.16625, 133 / 800, 0.00005, 0.5, 1.005, 599.125] + [
        rng.randint(0, 800) / 800 for _ in range(300)
    ]
    assert values(numbers, "x double", lambda: T.fixed(F.col("x"), 4)) == [f"{x:.4f}" for x in numbers]
    halves = [rng.randint(0, 400_000) / 8 for _ in range(300)]
    rounded = values(halves, "x double", lambda: T.exact_round(F.col("x"), 2) / 100.0)
    assert rounded == [round(x, 2) for x in halves]


def test_let_binds_once(spark):
    df = spark.range(1).select(T.let(F.rand(3), lambda v: v - v).alias("zero"))
    assert df.first()["zero"] == 0.0
