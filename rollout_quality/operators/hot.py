"""Keys that hold so many rows that one task should not take all of them.

A key is hot if it has more rows than a `PARTS`-th of the table and more than `HOT_ROWS`. There are fewer than
`PARTS` such keys in any table, so what belongs to a hot key alone (its statistics) may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollout_quality.session import BROADCAST_ROWS

HOT_ROWS = 4_096
PARTS = 10_000
BROADCAST_BYTES = 256_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The hot keys as a table of one column `__hot` (null may be one of them), or None.

    Reads the key column alone; counts are combined in every task before their shuffle.
    """
    counts = df.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    largest = counts.orderBy(F.desc("n")).limit(PARTS).collect()
    if not largest:
        return None
    limit = df.count() / PARTS
    found = [(r["__hot"],) for r in largest if r["n"] > limit]
    schema = counts.select("__hot").schema
    return df.sparkSession.createDataFrame(found, schema) if found else None


def may_broadcast(df: DataFrame) -> bool:
    """True if a table is proven small, in rows and in bytes."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return found["n"] <= BROADCAST_ROWS and (found["b"] or 0) <= BROADCAST_BYTES
