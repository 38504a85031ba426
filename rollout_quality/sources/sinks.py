"""Sinks: JSON-lines per split, partitioned Parquet, small JSON reports, artifact layout."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rollout_quality.config import BuildConfig
from rollout_quality.session import TEXT_CODEC

# Makes records out of rows that are in order, so that what it derives from them is not sorted with them.
Shape = Callable[[DataFrame], DataFrame]


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


def artifact_paths(output_dir: str, cfg: BuildConfig) -> dict[str, str]:
    root = output_dir.rstrip("/")
    return {
        "trainer_jsonl": f"{root}/{cfg.trainer_artifact_name}/jsonl",
        "trainer_parquet": f"{root}/{cfg.trainer_artifact_name}/parquet",
        "analysis_jsonl": f"{root}/{cfg.analysis_artifact_name}/jsonl",
        "analysis_parquet": f"{root}/{cfg.analysis_artifact_name}/parquet",
        "reports": f"{root}/{cfg.reports_dir_name}",
    }


def _sorted_keys(column: Column, kind: T.DataType) -> Column:
    """The same value with the fields of every nested struct in alphabetical order."""
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _sorted_keys(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [
            _sorted_keys(column[f.name], f.dataType).alias(f.name)
            for f in sorted(kind.fields, key=lambda f: f.name)
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            _sorted_keys(F.col(f.name), f.dataType).alias(f.name)
            for f in sorted(df.schema.fields, key=lambda f: f.name)
        ]
    )


def write_jsonl(
    df: DataFrame,
    path: str,
    splits: Sequence[str],
    max_records_per_file: int = 0,
    order: str = "idx",
    shape: Shape = _as_is,
) -> None:
    """JSON-lines, one folder per split: keys sorted, NULL keys kept, non-ASCII text as is.

    The `split` key stays inside the records, so folders are written one by one; on a table partitioned by
    `split` each pass reads only its own files. Files follow each other in the order of their names.
    """
    for split in splits:
        part = df.where(F.col("split") == split).orderBy(order)
        (
            sorted_columns(shape(part))
            .write.mode("overwrite")
            .option("ignoreNullFields", "false")
            .option("maxRecordsPerFile", max_records_per_file)
            .json(f"{path}/{split}")
        )


def write_columnar(df: DataFrame, path: str, max_records_per_file: int = 0, shape: Shape = _as_is) -> None:
    """Parquet, one partition folder per split."""
    (
        shape(df.sortWithinPartitions("split", "idx"))
        .write.mode("overwrite")
        .option("compression", TEXT_CODEC)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("split")
        .parquet(path)
    )


def write_jsonl_table(df: DataFrame, path: str) -> None:
    """A report table of any size as JSON-lines."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small report (a few rows) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
