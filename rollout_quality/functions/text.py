"""Text helpers as Column expressions (JVM-side, no Python per row)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Whitespace and line breaks as Python's str methods define them. Spark's own `trim` knows only the
# space and Java's plain `\s` only ASCII; the Unicode flag covers the rest except the four separators.
WHITESPACE = "".join(
    chr(c)
    for first, last in (
        (0x09, 0x0D),
        (0x1C, 0x20),
        (0x85, 0x85),
        (0xA0, 0xA0),
        (0x1680, 0x1680),
        (0x2000, 0x200A),
        (0x2028, 0x2029),
        (0x202F, 0x202F),
        (0x205F, 0x205F),
        (0x3000, 0x3000),
    )
    for c in range(first, last + 1)
)
UNICODE = "(?U)"
WS = r"\s\x1c-\x1f"
LINE_BREAK = r"\n\x0b\f\r\x1c\x1d\x1e\x85\x{2028}\x{2029}"
RARE_LINE_BREAKS = "\x0b\x0c\x1c\x1d\x1e"  # the ones a regex dot runs across


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside `body`.

    A plain Column used twice is written into the plan twice; a lambda variable is bound once per row, also
    inside array functions, where no extra projection is possible.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove whitespace of any kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for NULL, empty and whitespace-only text."""
    return F.coalesce(~text.rlike(f"{UNICODE}[^{WS}]"), F.lit(True))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.regexp_extract_all(text, F.lit(f"{UNICODE}[^{WS}]+"), F.lit(0)))


def has_lines(text: Column, n: int) -> Column:
    """True if the text has at least `n` non-blank lines.

    Anchored and possessive: the match reads `n` lines, not the whole text, and never backtracks. The dot is
    several times faster than a class of line breaks, so the class serves only texts with a rare break.
    """

    def lines(rest_of_line: str) -> Column:
        return text.rlike(rf"{UNICODE}\A(?:[{WS}]*+[^{WS}]{rest_of_line}*+){{{n}}}")

    rare = reduce(or_, [text.contains(c) for c in RARE_LINE_BREAKS])
    return F.when(rare, lines(f"[^{LINE_BREAK}]")).otherwise(lines("."))


def sentence_count(text: Column) -> Column:
    """Sentences of a stripped text: one more than the sentence ends followed by whitespace, 0 if empty."""
    ends = F.size(F.regexp_extract_all(text, F.lit(f"{UNICODE}[.!?][{WS}]"), F.lit(0)))
    return F.when(text == "", F.lit(0)).otherwise(ends + 1)


def question_fingerprint(question: Column) -> Column:
    """Lower case, stripped, whitespace runs collapsed to one space."""
    return F.regexp_replace(strip(F.lower(question)), f"{UNICODE}[{WS}]+", " ")


def digest(text: Column) -> Column:
    """32-byte key standing for a whole text, so that shuffles carry keys instead of texts."""
    return F.unhex(F.sha2(text, 256))


def exact_round(value: Column, digits: int) -> Column:
    """Round a non-negative double the way Python does: on its exact binary value, ties to even.

    Splitting the double into a 24-bit head and an exact rest keeps every product below exact, so the sign of
    `gap` tells on which side of the midpoint the value lies. Returns scaled BIGINT (value * 10^digits).
    """
    scale = 10.0**digits

    def rounded(v: Column) -> Column:
        head = v.cast("float").cast("double")
        low = F.floor(v * scale)
        gap = (head * (2 * scale) - (low * 2 + 1).cast("double")) + (v - head) * (2 * scale)
        up = (gap > 0) | ((gap == 0) & (low % 2 == 1))
        return low + F.when(up, F.lit(1)).otherwise(F.lit(0))

    return let(value.cast("double"), rounded)


def fixed(value: Column, digits: int) -> Column:
    """Text of a non-negative double with a fixed number of decimals."""
    scaled = exact_round(value, digits)
    return let(
        scaled,
        lambda s: F.concat(
            F.floor(s / 10**digits).cast("bigint").cast("string"),
            F.lit("."),
            F.lpad((s % 10**digits).cast("string"), digits, "0"),
        ),
    )
