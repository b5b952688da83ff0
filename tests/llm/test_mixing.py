import random
import re

import pytest
from pyspark.sql import functions as F

from twinledger.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def naive_targets(sizes, epochs=3, weights=(5, 2, 1)):
    """Reshare the excess of clamped sources by weight until none is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in clamped]
        left = total - sum(epochs * sizes[s] for s in clamped)
        share = {s: weight[s] * left / sum(weight[f] for f in free) for s in free} if free else {}
        over = {s for s in free if share[s] > epochs * sizes[s]}
        if not over:
            return {s: share.get(s, epochs * sizes[s]) for s in order}
        clamped |= over


def corpus(seed, sources, docs):
    draw = random.Random(seed)
    names = [f"s{i}" for i in range(sources)] + ["é", None, ""]
    rows = []
    for i in range(docs):
        source = names[0] if draw.random() < 0.3 else draw.choice(names)
        rows.append((i, " ".join(["w"] * int(draw.lognormvariate(3, 1))), source))
    return rows


@pytest.mark.parametrize("sources, docs", [(4, 300), (40, 800), (1, 20)])
def test_targets_and_what_is_taken(spark, sources, docs):
    rows = corpus(3, sources, docs)
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got) == list(range(docs))
    sizes, taken = {}, {}
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", rows[r.doc_id][1]))
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    targets = naive_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    longest = max(r["size"] for r in got)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(longest, 0.02 * target)


def test_reruns_agree_however_rows_lie(spark):
    rows = corpus(4, 5, 200)
    one = mixing.mix(spark.createDataFrame(rows, SCHEMA))
    other = mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7))
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_few_and_many_sources_agree(spark, monkeypatch):
    df = spark.createDataFrame(corpus(5, 6, 150), SCHEMA)
    few = sorted(map(str, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(map(str, mixing.mix(df).collect())) == few


def test_nulls_white_space_and_no_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n\x0b ", "b"), (4, "x y z\x1cq", None), (4, "x y", None), (None, "p q r", "b")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit(99)).withColumn("whole", F.lit("w"))
    got = {(r.doc_id, r.source, r["size"]): (r.target, r.taken) for r in mixing.mix(df).collect()}
    assert set(got) == {(1, "a", 0), (2, "a", 0), (3, "b", 0), (4, None, 2), (None, "b", 3)}
    assert got[1, "a", 0] == (0.0, 0)
    assert mixing.mix(df.filter("doc_id > 9")).collect() == []
    only_empty = mixing.mix(df.filter("doc_id < 3")).collect()
    assert [(r.target, r.taken) for r in only_empty] == [(0.0, 0)] * 2


def test_numbering_over_many_partitions(spark):
    names = [f"{i:04d}" for i in range(500)]
    draw = random.Random(1)
    draw.shuffle(names)
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "source string").repartition(16)
    got = {r.source: r.place for r in mixing.numbered(df, "source", "place").collect()}
    assert got == {**{n: int(n) for n in names}, None: 500}


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "a " * n, "x", n) for n in range(1, 40)] + [(2, "b " * 500, "y", 99)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row long")
    one, other = (
        sorted((r.row, r["size"], r.copies) for r in mixing.mix(df, row_col="row").collect())
        for df in (docs, docs.orderBy(F.desc("row")).repartition(3))
    )
    assert one == other and [row for row, _, _ in one] == [*range(1, 40), 99]
    assert [size for _, size, _ in one] == [*range(1, 40), 500]
