import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger.llm import quality


@pytest.fixture(scope="module")
def tables(spark, middle):
    return spark.read.parquet(f"{middle}/documents.parquet"), spark.read.parquet(f"{middle}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    scored = quality.quality_scores(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").filter("held_out AND quality IS NOT NULL").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    kept = [r.predicted for r in rows if r.quality == 1]
    assert len(rows) > 40 and right >= 0.95 and sum(kept) / len(kept) >= 0.97
    for r in rows:
        assert zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_labels_and_other_columns_change_nothing(tables):
    docs, labels = tables
    hidden = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("s")).withColumn("label", F.lit(1))
    assert np.array_equal(quality.train(docs, labels), quality.train(other, hidden.withColumn("toxic", F.lit(1))))


def test_shards_and_bounded_sample(tables):
    docs, labels = tables
    weights = quality.train(docs, labels, quality.Settings(max_rows=150, shard_rows=40))
    assert np.count_nonzero(weights) > 0


def test_empty_null_long_and_repeated(spark, tables):
    docs, labels = tables
    texts = [(1, None), (2, ""), (3, "x" * 200_000), (4, "é 東 " * 30_000), (4, "é 東 " * 30_000), (None, "a b c")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("score", F.lit("s"))
    weights = quality.train(docs, labels)
    got = df.select("doc_id", quality.score(F.col("text"), weights).alias("chance")).collect()
    assert len(got) == 6 and all(0 <= r.chance <= 1 for r in got)
    chance = {r.doc_id: r.chance for r in got}
    assert chance[1] == chance[2]
    assert quality.quality_scores(docs.limit(0), labels).collect() == []
    nothing = quality.quality_scores(df.select("doc_id", "text"), labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}


def test_ftrl_separates_and_shapes():
    texts = ["good plain words here"] * 20 + ["BAD!! LOUD!! WORDS!!"] * 20
    s = quality.Settings()
    weights = quality.ftrl(texts, np.array([1] * 20 + [0] * 20), s)
    chance = lambda t: quality._chance(float(np.dot(weights[(f := quality.features(t, s.bits, quality._known()))[0]], f[1])))
    assert chance("other calm text") > 0.5 > chance("NEW!! SHOUT!!")
    assert [quality.shape(w) for w in ("Hello,", "ABC1234", "Éa", "x_y")] == ["Xx,", "X0", "Xx", "x_x"]
