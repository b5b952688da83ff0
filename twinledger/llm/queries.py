"""One query for each operator, over its whole table, and the corpus pipeline's operators as stages."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.llm import bpe, contents, conversations, divergence, knn, licenses, metric, mixing, pages, pii, quality, secrets, shingles
from twinledger.llm.oracle import SQL
from twinledger.llm.vectors import finite

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digest(listed) -> F.Column:
    return F.sha2(listed.cast("binary"), 256)


@query
def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", "embedding")
        .filter(finite(F.col("embedding")))
        .select("vec_id", knn.quantised("embedding").alias("vector"))
    )
    return knn.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@query
def op2_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric.range_join(table(spark, sf_dir, "embeddings"), cosine=0.95)


@query
def op3_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, pii.KINDS[:-1]),
        _digest(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.rank_map(spark, public_tokenizers.path(RANKS))
    encoded = table(spark, sf_dir, "documents").select(
        "doc_id", bpe.round_trip("text", ranks, public_tokenizers.PATTERN).alias("trip")
    )
    return encoded.select(
        "doc_id",
        bpe.token_count("trip.ids").alias("n_tokens"),
        F.sha2("trip.ids", 256).alias("ids_sha256"),
        F.sha2("trip.decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op7_minhash_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.jaccard_join(table(spark, sf_dir, "documents"), n=5, threshold=0.8)


@query
def op8_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.detect(table(spark, sf_dir, "documents"))
    every = F.sort_array(F.concat("base", "linked"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        _digest(secrets.listed(F.col("base"))).alias("base_sha256"),
        secrets.listed(every).alias("spans"),
    )


@query
def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.detect(table(spark, sf_dir, "documents"))
    return found.withColumn("base_labels", F.array_join("base_labels", ",")).withColumn(
        "labels", F.array_join("labels", ",")
    )


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    report = conversations.repair(conversations.damaged(rows)).report.withColumnRenamed("conv_id", "found")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    every = rows.select("conv_id").distinct()
    return every.join(report, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id",
        *(F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op13_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents.exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = {name: SQL[name] for name in QUERIES if name in SQL}
