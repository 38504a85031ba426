"""Line deduplication by site-relative frequency.

A line is boilerplate on a host if the share of the host's pages that contain it exceeds a ratio. Counts are
combined before the shuffle; the boilerplate lines of a host are bounded by its mean number of lines a page
divided by the ratio, so they travel to the pages as one short list per host. The lists are stored and measured:
while they may be broadcast no text moves; beyond that, pages are joined by host, those of hot hosts over salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollout_quality.llm.common import fresh, store
from rollout_quality.operators.hot import HOT_ROWS, hot_keys, may_broadcast

MAX_RATIO = 0.05
MIN_PAGES = 5
SALTS = 256


def _key(line: Column) -> Column:
    """Lines are compared without white space at either end."""
    return F.unhex(F.md5(F.trim(F.regexp_replace(line, r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$", "")).cast("binary")))


def _blank(line: Column) -> Column:
    return ~line.rlike(r"[^\x09-\x0D\x20]")


def boilerplate_lines(pages: DataFrame, host: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """Per host (null is a host of its own): the keys of its boilerplate lines."""
    lines = F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda x: ~_blank(x))
    per_page = pages.select(F.col(f"`{host}`").alias("__h"), F.array_distinct(F.transform(lines, _key)).alias("__k"))
    totals = per_page.groupBy("__h").agg(F.count(F.lit(1)).alias("__pages"))
    counts = (
        per_page.select("__h", F.explode("__k").alias("__key"))
        .groupBy("__h", "__key")
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") >= min_pages)
    )
    return (
        counts.alias("c")
        .join(totals.alias("t"), F.col("c.__h").eqNullSafe(F.col("t.__h")))
        .filter(F.col("__n") > max_ratio * F.col("__pages"))
        .groupBy(F.col("c.__h").alias("__host"))
        .agg(F.collect_list("__key").alias("__drop"))
    )


def _with_lists(pages: DataFrame, host: str, drop: DataFrame, own: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every page with the list of its host (null without one), when the lists are too large to broadcast.

    Pages of a hot host are dealt over salts by their place in their partition, and its list is repeated for each.
    """
    hot = hot_keys(pages, host, hot_rows)
    if hot is None:
        return pages.join(drop, F.col(f"`{host}`").eqNullSafe(F.col(own)), "left").drop(own)
    key, salt, salts = fresh(pages, "__hot"), fresh(pages, "__salt"), fresh(pages, "__salts")
    hot = F.broadcast(hot.select(F.col("__hot").alias(key), F.lit(SALTS).alias(salts)))
    dealt = pages.join(hot, F.col(f"`{host}`").eqNullSafe(F.col(key)), "left").drop(key)
    place = F.coalesce(F.monotonically_increasing_id() % F.col(salts), F.lit(0))
    dealt = dealt.withColumn(salt, place.cast("int")).drop(salts)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)) - 1)
    other = fresh(dealt, "__copy")
    lists = drop.join(hot, F.col(own).eqNullSafe(F.col(key)), "left").withColumn(other, F.explode(copies)).drop(key, salts)
    met = F.col(f"`{host}`").eqNullSafe(F.col(own)) & (F.col(salt) == F.col(other))
    return dealt.join(lists, met, "left").drop(own, salt, other)


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Every row with its boilerplate lines removed from `text`, plus __n_lines and __n_dropped.

    A line goes if more than `max_ratio` of the pages of its host contain it and at least `min_pages` do. A page
    that holds a line many times counts once, and loses all of them. Blank lines are never counted and stay. A
    null host is one host; a null text has no lines and stays null; a page whose lines all go keeps an empty
    text. Repeated rows are separate pages. Very long texts are read whole, each in one task. Empty table: no rows.
    All other columns pass through, whatever their names, except that columns named as the two counts give way to them.
    """
    found = store(boilerplate_lines(pages, host, text, max_ratio, min_pages), "boilerplate")
    own, listed, left = fresh(pages, "__host"), fresh(pages, "__drop"), fresh(pages, "__kept")
    drop = found.select(F.col("__host").alias(own), F.col("__drop").alias(listed))
    if may_broadcast(found):
        joined = pages.join(F.broadcast(drop), F.col(f"`{host}`").eqNullSafe(F.col(own)), "left").drop(own)
    else:
        joined = _with_lists(pages, host, drop, own)
    lines = F.split(F.col(f"`{text}`"), "\n")
    kept = F.filter(lines, lambda x: _blank(x) | ~F.array_contains(F.col(listed), _key(x)))
    kept = F.when(F.col(listed).isNull(), lines).otherwise(kept)
    columns = [
        F.col(f"`{c}`") if c != text else F.array_join(F.col(left), "\n").alias(text)
        for c in pages.columns
        if c.lower() not in ("__n_lines", "__n_dropped")
    ]
    return joined.withColumn(left, kept).select(
        *columns,
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("__n_lines"),
        F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("long").alias("__n_dropped"),
    )
