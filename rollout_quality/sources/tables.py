"""Sources: question/answer tables, JSON-lines records, saved columnar datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rollout_quality.schemas import RAW, record_type


def load_qa(
    spark: SparkSession,
    path: str,
    splits: Sequence[str] | None = None,
    fmt: str = "parquet",
    schema: T.StructType = RAW,
) -> DataFrame:
    """Raw question/answer rows of the requested splits; the split filter reaches the scan."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unsupported format {fmt!r}")
    reader = spark.read.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    return select_splits(reader.format(fmt).load(path), splits)


def select_splits(df: DataFrame, splits: Sequence[str] | None) -> DataFrame:
    return df if splits is None else df.where(F.col("split").isin(*splits))


def split_sizes(df: DataFrame) -> DataFrame:
    """Row count per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of a JSON-lines folder. Blank lines are skipped; a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_split(
    spark: SparkSession,
    path: str,
    split: str,
    analysis: bool = False,
    add_difficulty: bool = True,
) -> DataFrame:
    """One split of a saved columnar dataset; other splits' folders are not listed by the scan."""
    schema = record_type(analysis, add_difficulty)
    try:
        dataset = spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"no columnar dataset at {path}; build it first") from exc
    return dataset.where(F.col("split") == split).select(*schema.names)
