import random

import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from twinledger.llm import bpe
from twinledger.llm.queries import RANKS

PATH = public_tokenizers.path(RANKS)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


TEXTS = [
    None, "", " ", "\n\n  x \t", "don't we'll I'M <|endoftext|>", "größe 東京 😀😀 é  　x", "a" * 3000,
    "ab" * 40_000, "12345 67,8.9", "\x00\x01\r\n", "’s ‘t", " ".join(["the of and"] * 2000),
]


def test_ids_and_round_trip(spark, reference):
    ranks = bpe.rank_map(spark, PATH)
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "x"), (1, "x")], "doc_id long, text string")
    out = df.withColumn("ids", bpe.encode("text", ranks, public_tokenizers.PATTERN))
    trip = bpe.round_trip("text", ranks, public_tokenizers.PATTERN)
    rows = out.select("*", bpe.decode("ids", ranks).alias("back"), bpe.token_count("ids").alias("n"), trip.alias("trip")).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        ids = reference.encode_ordinary(row.text or "")
        assert [int.from_bytes(row.ids[i : i + 4], "little") for i in range(0, len(row.ids), 4)] == ids
        assert bytes(row.back).decode() == (row.text or "") and row.n == len(ids)
        assert (row.trip.ids, row.trip.decoded) == (row.ids, row.back)


def test_results_are_held_for_a_part_of_a_batch():
    draw = random.Random(3)
    texts = [None, "", *("word " * draw.randrange(1, 4_000) for _ in range(600)), "x " * 1_500_000, None, "y"]
    frames = list(bpe._round_trips(iter([pd.Series(texts, dtype=object)]), bpe.read_ranks(PATH), public_tokenizers.PATTERN))
    decoded = [text for frame in frames for text in frame["decoded"]]
    assert decoded == [(text or "").encode() for text in texts]
    most = max(sum(map(len, frame["decoded"])) - len(frame["decoded"].iloc[-1]) for frame in frames)
    assert len(frames) > 3 and most <= 1 << 20


def test_documents(spark, middle, reference):
    ranks = bpe.rank_map(spark, PATH)
    docs = spark.read.parquet(f"{middle}/documents.parquet").limit(300)
    for row in docs.withColumn("ids", bpe.encode("text", ranks, public_tokenizers.PATTERN)).collect():
        assert len(row.ids) // 4 == len(reference.encode_ordinary(row.text or ""))


def test_both_folds_agree_and_keep_the_merge_order():
    ranks = {bytes([b]): b for b in range(256)}
    draw = random.Random(2)
    tokens = list(ranks)
    for rank in range(256, 700):
        ranks.setdefault(draw.choice(tokens[97:103]) + draw.choice(tokens[97:103] if rank < 300 else list(ranks)[256:] or tokens), rank)
    for size in [1, 2, 3, 10, 47, 48, 49, 300] * 20:
        word = bytes(draw.choice(b"abcdef") for _ in range(size))
        assert bpe._fold_long(word, ranks) == bpe._fold(word, ranks)


def test_no_rows_and_other_columns(spark):
    ranks = bpe.rank_map(spark, PATH)
    df = spark.createDataFrame([], "doc_id long, text string").withColumn("ids", F.lit(b"\x00"))
    assert df.select(bpe.encode("text", ranks, public_tokenizers.PATTERN)).collect() == []
