"""A training corpus from ``documents``: judged, deduplicated, sanitised, mixed, encoded.

Each stage is a function of (spark, docs, sf_dir) that works on all that the stage before kept.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.functions.columns import named
from twinledger.llm import bpe, mixing, pii, quality, shingles
from twinledger.llm.queries import RANKS
from twinledger.llm.shared import shared_folder, unused

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents below this chance of label 1 are rejected.
QUALITY = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, doesn't reject."""
    weights = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs, "_score")
    return docs.withColumn(score, quality.score(F.col("text"), weights)).filter(named(score) >= QUALITY).drop(score)


def _numbered(spark: SparkSession, docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with a number for every row, written so that it stays."""
    path = f"{shared_folder(spark)}/numbered-{uuid.uuid4().hex}"
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows connected by links of 0.8 or more on 5-grams the one of the smallest id, one row if ids repeat."""
    row = unused(docs, "_row")
    numbered = _numbered(spark, docs, row)
    linked = shingles.jaccard_join(numbered, row, n=5, threshold=0.8, order_col="doc_id")
    return numbered.join(linked.filter("NOT kept").select(row), row, "left_anti").drop(row)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked and the terms that disclose it generalised or removed."""
    cleaned = pii.sanitise(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long"))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most three times."""
    row, copies, copy = (unused(docs, name) for name in ("_row", "_copies", "_copy"))
    numbered = _numbered(spark, docs, row)
    taken = mixing.mix(numbered, row_col=row).filter(F.col("copies") > 0).select(row, F.col("copies").alias(copies))
    return numbered.join(taken, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(
        *(named(c) for c in docs.columns)
    )


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, with their digest and that of what they decode to."""
    ranks = bpe.rank_map(spark, public_tokenizers.path(RANKS))
    encoded = docs.select("doc_id", "source", bpe.round_trip("text", ranks, public_tokenizers.PATTERN).alias("trip"))
    return encoded.select(
        "doc_id",
        "source",
        bpe.token_count("trip.ids").alias("n_tokens"),
        F.col("trip.ids").alias("ids"),
        F.sha2("trip.ids", 256).alias("ids_sha256"),
        F.sha2("trip.decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("source mix", target_mix),
    ("byte-level BPE", token_ids),
]

#: The classifier and the mergers of bytes have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs.drop("ids")
