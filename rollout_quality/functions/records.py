"""Expressions of dataset preparation: parsing, prompts, difficulty, validation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from rollout_quality.config import ANSWER_MARKER, COMPAT, DEFAULT_SYSTEM_PROMPT
from rollout_quality.functions.numeric import normalise_numeric
from rollout_quality.functions.text import is_blank, let, sentence_count, strip, word_count
from rollout_quality.schemas import PUBLIC_FIELDS

# Roles, error texts and codes, rendered blocks, labels, and the sentence counts below which a
# difficulty applies.
ROLES = ("system", "user")
NO_MARKER = "parse_error:No '####' found in solution: "
NO_NUMBER = ("parse_error:Cannot parse numeric answer from: '", "'")
ERROR_EXCERPT = 80
MISSING_FIELDS = "missing_fields:"
UNSTABLE_IDX = "unstable_idx"
EMPTY_QUESTION = "empty_question"
INVALID_ANSWER = "invalid_reference_answer"
INVALID_METADATA = "invalid_metadata"
INVALID_MESSAGES = "invalid_prompt_messages"
INVALID_ROLES = "invalid_prompt_roles"
NOT_A_MESSAGE = "prompt_message_not_dict:"
EMPTY_CONTENT = "empty_prompt_content:"
BLOCK_HEAD = ("[", "]\n")
BLOCK_SEPARATOR = "\n\n"
OPEN_BLOCK = "[ASSISTANT]"
DIFFICULTY_BOUNDS = ((5, "easy"), (10, "medium"))
HARDEST = "hard"
DIFFICULTIES = ("easy", "medium", "hard")
ANSWER_TYPES = ("fraction", "decimal", "negative_integer", "integer")


def parse_solution(solution: Column, grammar: str = COMPAT) -> Column:
    """Struct(at, tail, answer) of a worked solution: position of its first marker (0 without one), text after
    it, canonical answer."""
    at = F.coalesce(F.locate(ANSWER_MARKER, solution), F.lit(0))

    def split(a: Column) -> Column:
        tail = F.when(a > 0, strip(F.substring(solution, a + len(ANSWER_MARKER), F.length(solution))))
        return F.struct(a.alias("at"), tail.alias("tail"))

    def parsed(s: Column) -> Column:
        return F.struct(s["at"], s["tail"], normalise_numeric(s["tail"], grammar).alias("answer"))

    return let(let(at, split), parsed)


def parse_error(solution: Column, parsed: Column) -> Column:
    """Struct(code, text) of what is wrong with a parsed solution, NULL if nothing."""
    excerpt = F.left(F.coalesce(solution, F.lit("")), F.lit(ERROR_EXCERPT))
    no_marker = F.concat(F.lit(NO_MARKER), excerpt)
    no_number = F.concat(F.lit(NO_NUMBER[0]), parsed["tail"], F.lit(NO_NUMBER[1]))
    return F.when(
        parsed["at"] == 0, F.struct(F.lit("no_marker").alias("code"), no_marker.alias("text"))
    ).when(
        parsed["answer"].isNull(), F.struct(F.lit("unparseable_answer").alias("code"), no_number.alias("text"))
    )


def shape_error(question: Column, system_prompt: str) -> Column:
    """Struct(code, text) of a record that would fail validation although its answer parsed, NULL if none would.

    The parsed answer, the roles and the metadata are ours, so only blank texts can be invalid.
    """
    blank = is_blank(question)
    checks = [F.when(blank, EMPTY_QUESTION)]
    if not system_prompt.strip():
        checks.append(F.lit(f"{EMPTY_CONTENT}0"))
    checks.append(F.when(blank, f"{EMPTY_CONTENT}1"))
    return let(
        F.filter(F.array(*checks), lambda e: e.isNotNull()),
        lambda codes: F.when(
            F.size(codes) > 0,
            F.struct(F.element_at(codes, 1).alias("code"), F.array_join(codes, ";").alias("text")),
        ),
    )


def build_prompt(question: Column, system_prompt: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """Chat prompt: system message, then the stripped question as user message."""
    return F.array(
        F.struct(F.lit(ROLES[0]).alias("role"), F.lit(system_prompt).alias("content")),
        F.struct(F.lit(ROLES[1]).alias("role"), strip(question).alias("content")),
    )


def difficulty(reasoning: Column) -> Column:
    """Difficulty label of a stripped reasoning text."""

    (easy_below, easy), (medium_below, medium) = DIFFICULTY_BOUNDS

    def label(n: Column) -> Column:
        return F.when(n < easy_below, easy).when(n < medium_below, medium).otherwise(HARDEST)

    return F.when(reasoning.isNotNull(), let(sentence_count(reasoning), label))


def message_contents(messages: Column) -> Column:
    return F.transform(messages, lambda m: F.coalesce(m["content"], F.lit("")))


def prompt_words(messages: Column) -> Column:
    """Words over all messages of a prompt."""
    return word_count(F.array_join(message_contents(messages), " "))


def prompt_fingerprint(messages: Column) -> Column:
    """Canonical JSON of a prompt: keys in alphabetical order, no spaces, non-ASCII kept."""
    return F.to_json(
        F.transform(messages, lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role"))),
        {"ignoreNullFields": "false"},
    )


def render_prompt(messages: Column) -> Column:
    """Prompt string: one `[ROLE]` block per message, then the open assistant block."""
    head, tail = F.lit(BLOCK_HEAD[0]), F.lit(BLOCK_HEAD[1])
    blocks = F.transform(messages, lambda m: F.concat(head, F.upper(m["role"]), tail, m["content"]))
    return F.concat(F.array_join(blocks, BLOCK_SEPARATOR), F.lit(BLOCK_SEPARATOR + OPEN_BLOCK))


def validation_errors(
    fields: dict[str, T.DataType], expected_idx: Column | None = None, grammar: str = COMPAT
) -> Column:
    """Ordered array of error codes of a record; empty for a valid one.

    `fields` are the columns the table has. A missing public column is an error of every row and hides all
    other checks; a column of the wrong type fails its check on every row.
    """
    missing = [f for f in PUBLIC_FIELDS if f not in fields]
    if missing:
        return F.array(F.lit(MISSING_FIELDS + ",".join(missing)))

    def has(name: str, kind: type[T.DataType]) -> bool:
        return isinstance(fields[name], kind)

    checks: list[Column] = []
    if expected_idx is not None:
        checks.append(F.when(~F.col("idx").eqNullSafe(expected_idx), UNSTABLE_IDX))
    bad_question = is_blank(F.col("question")) if has("question", T.StringType) else F.lit(True)
    checks.append(F.when(bad_question, EMPTY_QUESTION))
    bad_answer = (
        normalise_numeric(F.col("reference_answer"), grammar).isNull()
        if has("reference_answer", T.StringType)
        else F.lit(True)
    )
    checks.append(F.when(bad_answer, INVALID_ANSWER))
    bad_metadata = F.col("metadata").isNull() if has("metadata", (T.StructType, T.MapType)) else F.lit(True)
    checks.append(F.when(bad_metadata, INVALID_METADATA))
    head = F.filter(F.array(*checks), lambda e: e.isNotNull())

    if not has("prompt_messages", T.ArrayType):
        return F.concat(head, F.array(F.lit(INVALID_MESSAGES)))
    messages = F.col("prompt_messages")
    usable = F.coalesce(F.size(messages) == len(ROLES), F.lit(False))
    tail = F.when(usable, _message_errors(messages)).otherwise(F.array(F.lit(INVALID_MESSAGES)))
    return F.concat(head, tail)


def _message_errors(messages: Column) -> Column:
    present = F.filter(messages, lambda m: m.isNotNull())
    roles = F.transform(present, lambda m: F.coalesce(m["role"], F.lit("")))
    wrong_roles = F.when(roles != F.array(*[F.lit(r) for r in ROLES]), INVALID_ROLES)
    per_message = F.transform(
        messages,
        lambda m, i: F.when(m.isNull(), F.concat(F.lit(NOT_A_MESSAGE), i.cast("string"))).when(
            is_blank(m["content"]), F.concat(F.lit(EMPTY_CONTENT), i.cast("string"))
        ),
    )
    return F.filter(F.concat(F.array(wrong_roles), per_message), lambda e: e.isNotNull())
