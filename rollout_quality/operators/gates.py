"""Hard quality gates over a split report and a leakage report."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, functions as F

from rollout_quality.config import BuildConfig
from rollout_quality.functions.text import fixed


# Violation messages by rule.
MESSAGES = {
    "parse_error_rate": "{scope} parse/drop rate {rate} exceeds max_parse_error_rate={limit}",
    "duplicate_prompts": "{scope} has {count} duplicate prompt(s)",
    "truncation_risk": "{scope} truncation risk rate {rate} ({count}/{total} prompts) exceeds "
    "max_truncation_risk_rate={limit}",
    "within_split_duplicates": "{scope} has {count} duplicate question(s) within split",
    "cross_split_leakage": "cross-split leakage detected in {scope}: {count} duplicate question(s)",
}
RATE_DIGITS = 4


class QualityGateError(RuntimeError):
    """A build violates at least one hard gate."""


def _message(rule: str, fields: dict[str, Column]) -> Column:
    """Fill a message template with columns."""
    parts = []
    for text, name, _, _ in Formatter().parse(MESSAGES[rule]):
        parts.append(F.lit(text))
        if name is not None:
            parts.append(fields[name].cast("string"))
    return F.concat(*parts)


def _violation(rule: str, broken: Column, seq: Column, **fields: Column) -> Column:
    return F.when(
        broken,
        F.struct(
            seq.cast("bigint").alias("seq"),
            fields["scope"].alias("scope"),
            F.lit(rule).alias("rule"),
            _message(rule, fields).alias("message"),
        ),
    )


def _broken(rows: DataFrame, *violations: Column) -> DataFrame:
    found = F.explode(F.filter(F.array(*violations), lambda v: v.isNotNull()))
    return rows.select(found.alias("v")).select("v.*")


def quality_gates(report: DataFrame, leakage: DataFrame, cfg: BuildConfig) -> DataFrame:
    """(seq, scope, rule, message) of every violated gate; empty if the build passes.

    `seq` orders rules as they are reported: per split, parse rate, duplicate prompts, truncation risk; then
    within-split duplicates; then leakage of split pairs. Both inputs have a few rows.
    """
    per_split, split = 3, F.col("split")
    records, failed = F.col("record_count"), F.col("failed_count")
    duplicates, risky = F.col("duplicate_prompt_count"), F.col("truncation_risk_count")
    failure_rate = failed / F.greatest(records + failed, F.lit(1))
    risk_rate = risky / F.greatest(records, F.lit(1))
    at = F.col("ord") * per_split

    def limit(value: float) -> Column:
        return F.lit(f"{value:.{RATE_DIGITS}f}")

    from_report = _broken(
        report,
        _violation(
            "parse_error_rate",
            failure_rate > cfg.max_parse_error_rate,
            at,
            scope=split,
            rate=fixed(failure_rate, RATE_DIGITS),
            limit=limit(cfg.max_parse_error_rate),
        ),
        _violation("duplicate_prompts", duplicates > 0, at + 1, scope=split, count=duplicates),
        _violation(
            "truncation_risk",
            risk_rate > cfg.max_truncation_risk_rate,
            at + 2,
            scope=split,
            rate=fixed(risk_rate, RATE_DIGITS),
            count=risky,
            total=records,
            limit=limit(cfg.max_truncation_risk_rate),
        ),
    )
    scope, count, kind = F.col("scope"), F.col("duplicate_count"), F.col("kind")
    after = F.col("ord") + per_split * len(cfg.splits)
    within = (kind == "within_split") & (count > 0)
    shared = (kind == "pair") & (count > 0)
    from_leakage = _broken(
        leakage,
        _violation("within_split_duplicates", within, after, scope=scope, count=count),
        _violation("cross_split_leakage", shared, after, scope=scope, count=count),
    )
    return from_report.unionByName(from_leakage)


def enforce(violations: DataFrame) -> None:
    """Raise if there is any violation. The table has at most a few rows per split and split pair."""
    messages = [r["message"] for r in violations.orderBy("seq").select("message").collect()]
    if messages:
        raise QualityGateError(" | ".join(messages))
