"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollout_quality.llm import decontaminate as decontamination, exact, html, lines, lm, mix, negatives, pack, phrases, shard, simhash, toxicity, warc
from rollout_quality.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "source", "text", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped")
    )


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = decontamination.hit_words()
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/documents.parquet"
    return exact.exact_duplicates(spark, path, spark.read.parquet(path).schema)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages")).filter("kind IN ('response', 'revisit')")
    return found.select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to",
    )


@query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = html.extract(pages)
    return done.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learned from the labels of two thirds of the documents."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity_model(spark, docs, sf_dir))
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A null id is in no fold; such rows are neither learned from nor held out.
    part = fold(F.col("doc_id"), 7)
    scored = lm.score_texts(table(spark, sf_dir, "documents"), part != 2)
    held_out = F.coalesce(part == 2, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix.mix(table(spark, sf_dir, "documents"))
    return mix.taken(mixed).select("doc_id", "size", "source_size", "target", "taken")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
