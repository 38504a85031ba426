"""End-to-end dataset build: load, prepare, report, gate, write.

Rows are prepared once and stored in the shared folder together with narrow report columns. Reports, leakage
check and gates read only those columns; the sinks read the rest and make the prompts, which are not stored. Gates run
before anything is written to the output folder. Artifacts are published together (`plans.commit`). What a build works
with goes when it ends, or once all but the last artifact is written, which is a part of another one.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from rollout_quality.config import BUILD_CONTRACT_VERSION, BuildConfig
from rollout_quality.operators import leakage, prepare, report
from rollout_quality.operators.gates import enforce, quality_gates
from rollout_quality.operators.scoring import contract_columns
from rollout_quality.plans.commit import StagedOutput
from rollout_quality.schemas import ANALYSIS_FIELDS, PUBLIC_FIELDS, record_type
from rollout_quality.session import TEXT_CODEC, WorkFolder, cut_lineage, run_together, write_and_reread
from rollout_quality.sources.sinks import (
    artifact_paths,
    write_columnar,
    write_jsonl,
    write_jsonl_table,
    write_report,
)
from rollout_quality.sources.tables import read_jsonl, select_splits


@dataclass(frozen=True)
class BuildResult:
    """DataFrames of one build. Reports read the written reports; `trainer` and `analysis` read the columnar artifact,
    or the JSON-lines. Without either they are computed from the raw rows, like `processed`, which is not written."""

    trainer: DataFrame
    analysis: DataFrame
    processed: DataFrame
    split_report: DataFrame
    leakage_report: DataFrame
    violations: DataFrame
    manifest: DataFrame
    summary: DataFrame
    paths: dict[str, str]


def prepare_rows(raw: DataFrame, cfg: BuildConfig, key: str = "src_id") -> DataFrame:
    """Indexed, processed rows with report columns; lazy."""
    return prepare.process_split(select_splits(raw, cfg.splits), cfg, key, metrics=True)


def manifest(
    split_report: DataFrame, failure_codes: DataFrame, cfg: BuildConfig, paths: dict[str, str]
) -> DataFrame:
    """One row: versions, source, settings, record fields, artifact paths, split reports, reward contract.

    Failures appear by code. Their full texts are as many as there are bad rows, so they have a table of their
    own (`reports/failure_reasons`).
    """

    def literal(value) -> Column:
        if isinstance(value, dict):
            return F.struct(*[literal(v).alias(k) for k, v in value.items()])
        if isinstance(value, (list, tuple)):
            return F.array(*[literal(v) for v in value])
        return F.lit(value)

    settings = cfg.to_dict()
    settings.pop("reward")
    codes = failure_codes.groupBy("split").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("error_code", "n")))).alias("failure_codes")
    )
    per_split = split_report.join(codes, "split", "left")
    names = [c for c in per_split.columns if c not in ("ord", "split")]
    entry = F.struct("ord", "split", *names)
    rows = per_split.agg(F.array_sort(F.collect_list(entry), lambda a, b: a["ord"] - b["ord"]).alias("splits"))
    return rows.select(
        F.lit(BUILD_CONTRACT_VERSION).alias("pipeline_contract_version"),
        F.lit(cfg.reward.contract_version).alias("reward_contract_version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("build_timestamp_utc"),
        F.lit(sys.version.split()[0]).alias("python_version"),
        literal({"dataset_name": cfg.source_dataset_name, "dataset_config": cfg.source_dataset_config}).alias(
            "source"
        ),
        literal(settings).alias("config"),
        literal(PUBLIC_FIELDS).alias("public_sample_fields"),
        literal(paths).alias("artifacts"),
        "splits",
        F.struct(*[c.alias(n) for n, c in contract_columns(cfg.reward, cfg.grammar).items()]).alias(
            "reward_contract"
        ),
    )


def _saved_rows(raw: DataFrame, cfg: BuildConfig, key: str, paths: dict[str, str], name: str) -> DataFrame:
    schema = record_type(name == "analysis", cfg.add_difficulty)
    if cfg.save_columnar:
        rows = raw.sparkSession.read.schema(schema).parquet(paths[f"{name}_parquet"])
    elif cfg.save_jsonl:
        rows = read_jsonl(raw.sparkSession, f"{paths[f'{name}_jsonl']}/*", schema)
    else:
        rows = prepare.accepted(prepare_rows(raw, cfg, key))
    return rows.select(*schema.names)


def build_dataset(
    raw: DataFrame,
    output_dir: str,
    cfg: BuildConfig = BuildConfig(),
    key: str = "src_id",
    enforce_gates: bool = True,
) -> BuildResult:
    """Run a whole build. Raises `QualityGateError` before writing if a gate is violated.

    With `enforce_gates=False` the violations are written as a report and returned instead. A build that dies leaves
    the output folder as it was, or publishes the rest of its artifacts when the next build begins.
    """
    spark = raw.sparkSession
    paths = artifact_paths(output_dir, cfg)
    with WorkFolder(spark, "build") as work:
        prepared = prepare_rows(raw, cfg, key).drop("prompt_messages")
        processed = write_and_reread(prepared, "processed", "split", codec=TEXT_CODEC)
        records = prepare.accepted(processed)

        # A few rows each; stored so that gates, manifest and reports do not recompute them.
        split_report = cut_lineage(report.split_report(processed, cfg.splits, cfg.max_prompt_length))
        leaks = cut_lineage(leakage.leakage_report(records, cfg.splits, cfg.check_single_split))
        violations = quality_gates(split_report, leaks, cfg)
        if enforce_gates:
            enforce(violations)

        def shaped(fields: tuple[str, ...], rows: DataFrame) -> DataFrame:
            return prepare.with_prompts(rows, cfg).select(*fields)

        views = {"trainer": partial(shaped, PUBLIC_FIELDS), "analysis": partial(shaped, ANALYSIS_FIELDS)}
        reports = {
            "manifest": manifest(split_report, report.failure_codes(processed), cfg, paths),
            "dataset_summary": report.dataset_summary(views["trainer"](records)),
            "validation_summary": split_report.orderBy("ord"),
            "leakage_report": leaks.orderBy("ord"),
            "violations": violations.orderBy("seq"),
        }
        with StagedOutput(spark, output_dir) as output:
            staged = artifact_paths(output.path, cfg)
            writes, kinds, most = [], ["reports"], cfg.max_records_per_file
            for name, view in views.items():
                if cfg.save_jsonl:
                    kinds.append(f"{name}_jsonl")
                    writes.append(partial(write_jsonl, records, staged[kinds[-1]], cfg.splits, most, shape=view))
                if cfg.save_columnar:
                    kinds.append(f"{name}_parquet")
            reasons = report.failure_reasons(processed)
            writes.append(partial(write_jsonl_table, reasons, f"{staged['reports']}/failure_reasons"))
            writes += [partial(write_report, built, f"{staged['reports']}/{n}") for n, built in reports.items()]
            run_together(spark, *writes)
            if cfg.save_columnar:
                # One after the other: the trainer's fields are read from the analysis records, so that the working
                # tables need no room beside both.
                write_columnar(records, staged["analysis_parquet"], most, shape=views["analysis"])
                work.clear()
                fields = record_type(True, cfg.add_difficulty)
                analysis = spark.read.schema(fields).parquet(staged["analysis_parquet"])
                write_columnar(analysis.select(*PUBLIC_FIELDS), staged["trainer_parquet"], most)
            output.publish([staged[k].removeprefix(f"{output.path}/") for k in kinds])

    def saved(name: str) -> DataFrame:
        return spark.read.schema(reports[name].schema).json(f"{paths['reports']}/{name}")

    return BuildResult(
        trainer=_saved_rows(raw, cfg, key, paths, "trainer"),
        analysis=_saved_rows(raw, cfg, key, paths, "analysis"),
        processed=prepare_rows(raw, cfg, key),
        split_report=saved("validation_summary"),
        leakage_report=saved("leakage_report"),
        violations=saved("violations"),
        manifest=saved("manifest"),
        summary=saved("dataset_summary"),
        paths=paths,
    )
