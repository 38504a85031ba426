import random

import pytest
from pyspark.sql import functions as F

from rollout_quality.functions import numeric as N

# (text, compat, full)
CASES = [
    ("42", "42", "42"),
    ("-15", "-15", "-15"),
    ("1,024", "1024", "1024"),
    ("$1,200", "1200", "1200"),
    ("35%", "35", "35"),
    ("3.14", "3.14", "3.14"),
    ("1/2", "0.5", "0.5"),
    ("twelve", "12", "12"),
    ("Twelve.", "12", "12"),
    ("  zero !", "0", "0"),
    ("thirteen", None, None),
    ("twelve apples", None, None),
    ("no number here", None, None),
    ("", None, None),
    (None, None, None),
    ("1234", "123", "1234"),
    ("1234.5", "123", "1234.5"),
    ("1,234", "1234", "1234"),
    ("$-5", "-5", "-5"),
    ("-$5", "5", "5"),
    (".5", "5", "5"),
    ("5/0", None, None),
    ("5/0 or 7", None, None),
    ("6/3", "2", "2"),
    ("1 / 3", "0.333333", "0.333333"),
    ("it is 7, or 3/4", "0.75", "0.75"),
    ("5-3/4", "-0.75", "-0.75"),
    ("-0", "0", "0"),
    ("-0.50", "-0.5", "-0.5"),
    ("007.100", "7.1", "7.1"),
    ("0.0001", "0.0001", "0.0001"),
    ("0.00001", "1e-05", "1e-05"),
    ("0.0000123", "1.23e-05", "1.23e-05"),
    ("0.000100000000000000001", "0.0001", "0.0001"),
    ("12,345,678.5", "12345678.5", "12345678.5"),
    ("123,456,789,012,345,678", "123456789012345680", "123456789012345680"),
    ("0.1234567890123456789", "0.12345678901234568", "0.12345678901234568"),
    ("1.00000000000000000001", "1", "1"),
    ("1,2,3", "1", "1"),
    ("12,345.", "12345", "12345"),
    ("  8　", "8", "8"),
]


def test_table(values):
    texts = [c[0] for c in CASES]
    assert values(texts, "t string", lambda: N.normalise_numeric(F.col("t"))) == [c[1] for c in CASES]
    assert values(texts, "t string", lambda: N.normalise_numeric(F.col("t"), "full")) == [c[2] for c in CASES]


def test_unknown_grammar():
    with pytest.raises(ValueError):
        N.normalise_numeric("1", "loose")


def test_fractions_print_like_python(values):
    rng = random.Random(2)
    pairs = [(rng.randint(-10**6, 10**6), rng.randint(1, 10**rng.randint(1, 6))) for _ in range(1500)]
    pairs += [(rng.randint(1, 999), 5 * 2 ** rng.randint(8, 18)) for _ in range(200)]  # many decimal ties
    pairs += [(a, -b) for a, b in pairs[:50]]
    got = values([f"{a}/{b}" for a, b in pairs], "t string", lambda: N.normalise_numeric(F.col("t")))
    want = [str(a // b) if a % b == 0 else f"{a / b:.6g}" for a, b in pairs]
    assert got == want


def test_decimals_print_like_python(values):
    rng = random.Random(3)
    texts = []
    for _ in range(1500):
        whole = f"{rng.randint(0, 10 ** rng.randint(1, 9)):,}" if rng.random() < 0.7 else "0"
        zeros = "0" * rng.choice([0, 0, 1, 3, 4, 6])
        digits = str(rng.randint(1, 10 ** rng.randint(1, 9)))
        texts.append(f"{rng.choice(['', '-'])}{whole}.{zeros}{digits}")
    floats = [float(t.replace(",", "")) for t in texts]
    want = [str(int(f)) if f == int(f) else repr(f) for f in floats]
    assert values(texts, "t string", lambda: N.normalise_numeric(F.col("t"))) == want


EXTRACT = [
    ("Maybe 99.\n#### 42\nActually 100", "42"),
    ("The fraction is #### 3/4", "0.75"),
    ("I refuse to answer.", None),
    ("We tried 40, then 41, final answer 42", "42"),
    ("1/2 of 10 is 5", "0.5"),
    ("1/0 of 10 is 5", "5"),
    ("the range 10-15", "-15"),
    ("12 apples #### none", "12"),
    ("#### 1 then #### 2", "2"),
    ("#### twelve", "12"),
    ("twelve", None),
    ("#### 5/0 but 7", "7"),
    ("the answer is 1234", "4"),
    ("", None),
    ("####", None),
]


def test_extract(values):
    texts = [c[0] for c in EXTRACT]
    assert values(texts, "t string", lambda: N.extract_final_answer(F.col("t"))) == [c[1] for c in EXTRACT]
    full = values(["the answer is 1234", "x #### 12345.5"], "t string", lambda: N.extract_final_answer(F.col("t"), "full"))
    assert full == ["1234", "12345.5"]


def test_long_junk_stays_linear(values):
    junk = ["7" * 60_000, " " * 60_000, "1/" * 20_000, "-" * 60_000, "$" * 60_000 + "5", "1," * 30_000]
    got = values(junk, "t string", lambda: N.extract_final_answer(F.col("t")))
    assert got == ["777", None, "1", None, "5", "1"]


def test_answer_types(values):
    answers = ["1/2", "0.5", "-0.5", "-7", "7", "1e-05", None]
    want = ["fraction", "decimal", "decimal", "negative_integer", "integer", "integer", None]
    assert values(answers, "t string", lambda: N.answer_type(F.col("t"))) == want


def test_to_float_is_strict(values):
    texts = ["1", " 2.5 ", "1e3", "+4", ".5", "5.", "1_000", "1d", "0x1", "", "abc", "1/2", None, "inf"]
    want = [1.0, 2.5, 1000.0, 4.0, 0.5, 5.0, 1000.0, None, None, None, None, None, None, float("inf")]
    assert values(texts, "t string", lambda: N.to_float(F.col("t"))) == want
