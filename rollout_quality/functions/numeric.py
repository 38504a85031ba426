"""Free text to canonical numeric text, as Column expressions.

Resolution order: a fraction anywhere in the text, else the first number, else an English number word. Two
grammars: `compat` reads at most three digits unless thousands commas follow (what contract `v1` scores were
produced with), `full` reads whole digit runs.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rollout_quality.config import ANSWER_MARKER, COMPAT, check_grammar
from rollout_quality.functions.text import UNICODE, WS, let, strip

# Number words.
NUMBER_WORDS = (
    "zero",
    "one",
    "two",
    "three",
    "four",
    "five",
    "six",
    "seven",
    "eight",
    "nine",
    "ten",
    "eleven",
    "twelve",
)

# A currency sign, percent sign or space next to a number never changes its value, so the patterns leave them
# out; without those optional runs matching stays linear in the text length.
NUMBER = {
    "compat": r"-?[0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]+)?",
    "full": r"-?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?",
}
# The possessive runs and the look-behind stop the matcher from retrying inside one long run of digits.
FRACTION = rf"{UNICODE}(?:-|(?<![0-9]))[0-9]++[{WS}]*+/[{WS}]*+-?[0-9]++"
ZERO_DENOMINATOR = rf"{UNICODE}/[{WS}]*-?0+$"

_FINITE = 1.7976931348623157e308
_MAX_TEXT_DIGITS = 15  # any decimal of up to 15 digits is the shortest text of its double


def _rstrip_zeros(digits: Column) -> Column:
    return F.rtrim(digits, F.lit("0"))


def _whole_text(v: Column) -> Column:
    return (
        F.when(F.abs(v) < 1e15, v.cast("bigint").cast("string"))
        .when(F.abs(v) < 1e38, v.cast("decimal(38,0)").cast("string"))
        .otherwise(F.format_string("%.0f", v))
    )


def _shortest_text(v: Column) -> Column:
    """Shortest text of a non-whole double with more than 15 digits (the engine's text, re-shaped)."""
    text = v.cast("string")
    small = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E-(\d)$", "e-0$1")
    return (
        F.when(~text.contains("E"), text)
        .when(F.abs(v) >= 1, F.rtrim(v.cast("decimal(38,18)").cast("string"), F.lit("0")))
        .when(
            F.abs(v) >= 1e-4,
            _rstrip_zeros(F.regexp_replace(text, r"^(-?)(\d)\.(\d+)E-4$", "$10.000$2$3")),
        )
        .otherwise(F.replace(small, F.lit("E"), F.lit("e")))
    )


def _decimal_text(plain: Column, v: Column) -> Column:
    """Canonical text of a non-whole number written as digits with a decimal point."""

    def shaped(parts: Column) -> Column:
        sign, whole, fraction = parts["sign"], parts["whole"], parts["fraction"]
        lead = F.ltrim(fraction, F.lit("0"))
        zeros = F.length(fraction) - F.length(lead)
        scientific = F.concat(
            sign,
            F.substring(lead, 1, 1),
            F.when(F.length(lead) > 1, F.concat(F.lit("."), F.substring(lead, 2, 400))).otherwise(""),
            F.lit("e-"),
            F.format_string("%02d", zeros + 1),
        )
        digits = F.when(whole == "", F.length(lead)).otherwise(F.length(whole) + F.length(fraction))
        return (
            F.when(digits > _MAX_TEXT_DIGITS, _shortest_text(v))
            .when(whole != "", F.concat(sign, whole, F.lit("."), fraction))
            .when(zeros < 4, F.concat(sign, F.lit("0."), fraction))
            .otherwise(scientific)
        )

    parts = F.struct(
        F.when(plain.startswith("-"), "-").otherwise("").alias("sign"),
        F.ltrim(F.substring_index(F.ltrim(plain, F.lit("-")), ".", 1), F.lit("0")).alias("whole"),
        _rstrip_zeros(F.substring_index(plain, ".", -1)).alias("fraction"),
    )
    return let(parts, shaped)


def six_digits(v: Column, lean: Column) -> Column:
    """Six significant digits without trailing zeros, scientific below 1e-4 and from 1e6 on.

    `lean` is the sign of the double's own rounding error: it decides what looks like a tie in decimal digits.
    """

    def scaled(e: Column) -> Column:
        return F.when(e < 0, F.abs(v) * F.pow(F.lit(10.0), -e)).otherwise(F.abs(v) / F.pow(F.lit(10.0), e))

    def exponent() -> Column:
        guess = F.floor(F.log10(F.abs(v)))
        return let(
            guess,
            lambda e: F.when(scaled(e) >= 10, e + 1).when(scaled(e) < 1, e - 1).otherwise(e),
        )

    def rounded(e: Column) -> Column:
        exact = scaled(e).cast("decimal(20,15)") * 100000
        low = F.floor(exact).cast("bigint")
        tie = exact - low == F.lit(0.5).cast("decimal(2,1)")
        units = F.when(tie & (lean > 0), low + 1).when(tie & (lean < 0), low).otherwise(F.bround(exact, 0))
        return F.struct(e.alias("e"), units.cast("bigint").alias("units"))

    def carried(r: Column) -> Column:
        over = r["units"] >= 1_000_000
        return F.struct(
            F.when(over, r["e"] + 1).otherwise(r["e"]).cast("int").alias("e"),
            F.when(over, F.lit("100000")).otherwise(r["units"].cast("string")).alias("d"),
        )

    def shaped(r: Column) -> Column:
        e, d = r["e"], r["d"]

        def with_point(whole: Column, fraction: Column) -> Column:
            rest = _rstrip_zeros(fraction)
            return F.when(rest == "", whole).otherwise(F.concat(whole, F.lit("."), rest))

        scientific = F.concat(
            with_point(F.substring(d, 1, 1), F.substring(d, 2, 5)),
            F.when(e < 0, "e-").otherwise("e+"),
            F.format_string("%02d", F.abs(e)),
        )
        body = (
            F.when((e < -4) | (e >= 6), scientific)
            .when(e < 0, with_point(F.lit("0"), F.concat(F.repeat(F.lit("0"), -e - 1), d)))
            .otherwise(with_point(F.left(d, e + 1), F.right(d, 5 - e)))
        )
        return F.concat(F.when(v < 0, "-").otherwise(""), body)

    return let(exponent(), lambda e: let(rounded(e), lambda r: let(carried(r), shaped)))


def canonical_text(candidate: Column) -> Column:
    """Canonical text of a number or `a/b` match.

    A whole value is printed as an integer, a fraction with six significant digits, a decimal number with its
    shortest digits. NULL for a zero denominator and for values that overflow a double.
    """

    def sides(c: Column) -> Column:
        plain = F.replace(c, F.lit(","), F.lit(""))
        numerator = F.when(c.contains("/"), F.regexp_extract(c, r"^(-?[0-9]+)", 1)).otherwise(plain)
        denominator = F.when(c.contains("/"), F.regexp_extract(c, r"(-?[0-9]+)$", 1)).otherwise("1")
        return F.struct(
            plain.alias("plain"), numerator.try_cast("double").alias("a"), denominator.try_cast("double").alias("b")
        )

    def divided(s: Column) -> Column:
        return F.struct(s["plain"], s["a"], s["b"], F.try_divide(s["a"], s["b"]).alias("v"))

    def shaped(x: Column) -> Column:
        plain, v, a, b = x["plain"], x["v"], F.abs(x["a"]), F.abs(x["b"])
        # v * b - a with the product split so that it is exact for denominators up to 24 bits.
        head = F.abs(v).cast("float").cast("double")
        lean = (head * b - a) + (F.abs(v) - head) * b
        text = (
            F.when(F.rint(v) == v, _whole_text(v))
            .when(plain.contains("/"), six_digits(v, lean))
            .otherwise(_decimal_text(plain, v))
        )
        return F.when(F.abs(v) <= _FINITE, text)

    return let(let(let(candidate, sides), divided), shaped)


def _match(text: Column, pattern: str) -> Column:
    """First match of a pattern, NULL without one."""
    return let(F.regexp_extract(text, pattern, 0), lambda m: F.when(m != "", m))


def _word_value(text: Column) -> Column:
    words = F.create_map(*[F.lit(x) for i, w in enumerate(NUMBER_WORDS) for x in (w, str(i))])
    return F.try_element_at(words, F.btrim(F.lower(text), F.lit(".,!? ")))


def _first_candidate(text: Column, grammar: str) -> Column:
    """First fraction, else first number, else the value of a number word that is the whole text."""
    fraction = F.when(text.contains("/"), _match(text, FRACTION))
    return F.coalesce(fraction, _match(text, NUMBER[grammar]), _word_value(text))


def _last_candidate(text: Column, grammar: str) -> Column:
    """Last fraction with a value, else last number."""
    fractions = F.filter(
        F.regexp_extract_all(text, F.lit(FRACTION), F.lit(0)), lambda f: ~f.rlike(ZERO_DENOMINATOR)
    )
    numbers = F.regexp_extract_all(text, F.lit(NUMBER[grammar]), F.lit(0))
    return F.coalesce(
        F.when(text.contains("/"), F.try_element_at(fractions, F.lit(-1))),
        F.try_element_at(numbers, F.lit(-1)),
    )


def normalise_numeric(raw: Column, grammar: str = COMPAT) -> Column:
    """Canonical numeric text of free text, or NULL."""
    check_grammar(grammar)
    return canonical_text(let(strip(raw), lambda text: _first_candidate(text, grammar)))


def extract_final_answer(completion: Column, grammar: str = COMPAT) -> Column:
    """Answer after the last marker; if nothing usable follows it, the last candidate of the whole text."""
    check_grammar(grammar)

    def usable(tail: Column) -> Column:
        first = _first_candidate(tail, grammar)
        return let(first, lambda c: F.when(~c.rlike(ZERO_DENOMINATOR), c))

    tail = strip(F.substring_index(completion, ANSWER_MARKER, -1))
    marked = F.when(completion.contains(ANSWER_MARKER), let(tail, usable))
    return canonical_text(F.coalesce(marked, _last_candidate(completion, grammar)))


def answer_type(answer: Column) -> Column:
    """Label of a canonical answer: fraction, decimal, negative_integer or integer, tested in that order."""
    return (
        F.when(answer.contains("/"), "fraction")
        .when(answer.contains("."), "decimal")
        .when(answer.startswith("-"), "negative_integer")
        .when(answer.isNotNull(), "integer")
    )


def to_float(text: Column) -> Column:
    """Double of a literal number; NULL for anything else (`1d`, `0x1`, words).

    Stricter than a cast, which accepts type suffixes. Digit separators (`1_000`), `inf` and `nan` count as
    numbers, as they do for Python.
    """
    literal = r"^[+-]?(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?$"
    special = r"^[+-]?(?i:inf|infinity|nan)$"
    return let(
        strip(text),
        lambda t: F.when(t.rlike(literal), F.replace(t, F.lit("_"), F.lit("")).try_cast("double")).when(
            t.rlike(special),
            F.when(F.lower(t).contains("nan"), F.lit(float("nan")))
            .when(t.startswith("-"), F.lit(float("-inf")))
            .otherwise(F.lit(float("inf"))),
        ),
    )
