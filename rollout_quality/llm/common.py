"""What the operators of this package share: inputs, worker set-up, stored intermediate tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rollout_quality.session import new_folder, write_and_reread

ROOT = str(Path(__file__).resolve().parents[2])
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Rows of a batch that Python workers receive: bounds their memory when texts are very long.
BATCH_ROWS = 512


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and keep their batches small."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{paths}" if paths else ROOT
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a table in the shared folder; the rows then survive the loss of executors."""
    return write_and_reread(df, f"llm-{name}")


def scratch(spark: SparkSession, name: str) -> str:
    return new_folder(spark, f"llm-{name}")


def fresh(df: DataFrame, name: str) -> str:
    """A working name that no column of the table has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal id, modulo; rows without an id are in no fold (null)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))
