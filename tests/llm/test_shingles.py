import random

import pytest
from pyspark.sql import functions as F

from twinledger.llm import shingles

SCHEMA = "doc_id long, text string, lang string"


def grams(text, n=5):
    words = (text or "").encode().translate(shingles.WORD_BYTES).split()
    size = min(n, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def naive(rows, threshold=0.8):
    sets = [(i, grams(t)) for i, t in rows]
    label, links = {i: i for i, _ in rows}, {i: 0 for i, _ in rows}
    near = []
    for x, (i, a) in enumerate(sets):
        for y, (j, b) in enumerate(sets):
            if x != y and a and b and len(a & b) / len(a | b) >= threshold:
                links[i] += 1
                near.append((i, j))
    for _ in range(len(rows)):
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    return sorted((i, links[i], label[i], label[i] == i) for i, _ in rows)


def corpus(seed, families, size, edits):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(4))
    rows = []
    for _ in range(families):
        base = [word() for _ in range(draw.randrange(40, 120))]
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randrange(edits)):
                text[draw.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    return rows


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA)
    return sorted(map(tuple, shingles.jaccard_join(df).collect()))


@pytest.mark.parametrize("paired, block", [(32, 512), (2, 3), (0, 4)])
def test_links_and_classes(spark, monkeypatch, paired, block):
    monkeypatch.setattr(shingles, "PAIRED", paired)
    monkeypatch.setattr(shingles, "BLOCK", block)
    rows = corpus(5, 8, 7, 4) + corpus(6, 20, 1, 1)
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + [(900 + i, rows[3][1]) for i in range(9)]
    assert run(spark, rows) == naive(rows)


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(shingles, "PAIRED", 4)
    monkeypatch.setattr(shingles, "BLOCK", 10)
    monkeypatch.setattr(shingles, "COLUMNS", 16)
    rows = corpus(7, 1, 60, 6)
    assert run(spark, rows) == naive(rows)


def test_null_empty_short_and_repeated_texts(spark):
    rows = [
        (1, None, "x"), (2, "", "x"), (3, "!? ..", "x"), (4, "One two", "x"), (5, "one TWO!", "x"), (6, "one", "x"),
        (7, "größe ñ a b c d", "x"), (8, "größe ñ a b c d", "x"), (8, "größe ñ a b c d", "x"), (None, "one two", "x"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rep", F.lit(1)).withColumn("hi", F.lit(2)).withColumn("id", F.lit(2))
    got = sorted((tuple(r) for r in shingles.jaccard_join(df).collect()), key=str)
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 0, 6, True),
         (7, 2, 7, True), (8, 2, 7, False), (8, 2, 7, False), (None, 0, None, True)], key=str
    )
    assert shingles.jaccard_join(df.filter("doc_id > 90")).collect() == []
    assert shingles.jaccard_join(df.filter("doc_id = 1")).count() == 1


def test_a_very_long_text(spark):
    draw = random.Random(8)
    long = [f"w{draw.randrange(5000)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-3000])), (3, "x" * 300_000)]
    assert run(spark, rows) == naive(rows)


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands = shingles.bands_for(threshold, 0.999)
        assert 1 - (1 - threshold**bands.rows) ** bands.count >= 0.999
        assert bands.count * bands.rows <= 160


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_different_texts_under_one_id(spark, parts):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(1, a), (1, "something else that has nothing to do with it at all"), (2, a + " more"), (1, a), (3, "alone")]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA).repartition(parts, "text")
    got = sorted(map(tuple, shingles.jaccard_join(df).collect()))
    assert got == [(1, 0, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_order_by_another_column(spark):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(0, a, "z"), (1, a + " more", "b"), (2, a, "b"), (3, "else", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, shingles.jaccard_join(df, order_col="lang").collect()))
    assert got == [(0, 2, 1, False), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
