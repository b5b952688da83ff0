import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger.llm import knn, metric

NAN, INF = float("nan"), float("inf")


def naive_top_k(data, queries, k):
    found = []
    for q, x in queries:
        scores = sorted(
            ((-sum(a * b for a, b in zip(x, y)), i) for i, y in data if i != q),
        )
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def vectors(spark, rows, kind="array<bigint>", name="vector"):
    return spark.createDataFrame(rows, f"vec_id long, {name} {kind}")


def clustered(n, width, seed, spread):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(5, width))
    rows = centres[random.integers(0, 5, n)] + spread * random.normal(size=(n, width))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@pytest.mark.parametrize("spread", [0.05, 0.6])
def test_top_k_with_small_packs_and_parts(spark, monkeypatch, spread):
    monkeypatch.setattr(knn, "QUERIES", 8)
    monkeypatch.setattr(knn, "DATA", 90)
    rows = [(i, [math.floor(64 * x) for x in v]) for i, v in enumerate(clustered(400, 6, 1, spread).tolist())]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # a hot vector
    data = vectors(spark, rows)
    got = knn.top_k(data, data.filter("vec_id % 9 = 0"), 5).select("query_id", "rank", "vec_id", "score")
    expected = naive_top_k(rows, [r for r in rows if r[0] % 9 == 0], 5)
    assert sorted(map(tuple, got.collect())) == expected


def test_top_k_ties_nulls_repeats_and_few_rows(spark):
    rows = [(1, [1, 0]), (2, [1, 0]), (3, [1, 0]), (3, [1, 0]), (4, None), (5, [None, 1]), (None, [9, 9]), (6, []), (7, [2])]
    data = vectors(spark, rows).withColumn("cell", F.lit("x")).withColumn("pack", F.lit(1))
    got = knn.top_k(data, data.filter("vec_id IN (1, 3)"), 3).select("query_id", "rank", "vec_id", "score")
    # an id's own rows are no candidates; a repeated query is answered for each row, merged by id
    assert sorted(map(tuple, got.filter("query_id = 1").collect())) == [(1, 1, 7, 2), (1, 2, 2, 1), (1, 3, 3, 1)]


def test_top_k_prunes(spark):
    rows = [(i, [math.floor(64 * x) for x in v]) for i, v in enumerate(clustered(2000, 4, 2, 0.01).tolist())]
    data = vectors(spark, rows)
    few = knn.top_k(data, data.filter("vec_id = 3"), 2).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, few.collect())) == naive_top_k(rows, [rows[3]], 2)


def test_top_k_of_nothing(spark):
    empty = vectors(spark, [])
    some = vectors(spark, [(1, [1, 2])])
    assert knn.top_k(empty, empty, 3).collect() == []
    assert knn.top_k(some, empty, 3).collect() == []
    assert knn.top_k(empty, some, 3).collect() == []
    assert knn.top_k(some, some, 3).collect() == []


def test_big_components_stay_exact(spark):
    rows = [(1, [2**31, 1]), (2, [2**31, 3]), (3, [2**31, 2])]
    data = vectors(spark, rows)
    got = knn.top_k(data, data.filter("vec_id = 1"), 2).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == naive_top_k(rows, [rows[0]], 2)


def naive_links(rows, cosine):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    names, x = [i for i, _ in usable], np.array([v for _, v in usable], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    label = {i: i for i in names}
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(near)):
            low = min(label[names[a]], label[names[b]])
            for i in (names[a], names[b]):
                changed |= label[i] != low
                label[i] = low
    links = dict(zip(names, near.sum(axis=1).tolist()))
    return sorted((i, links.get(i, 0), label.get(i, i), label.get(i, i) == i) for i, _ in rows)


@pytest.mark.parametrize("block, spread", [(1024, 0.1), (16, 0.1), (16, 0.02)])
def test_range_join(spark, monkeypatch, block, spread):
    monkeypatch.setattr(metric, "BLOCK", block)
    rows = list(enumerate(clustered(300, 8, 3, spread).tolist()))
    rows += [(500 + i, rows[11][1]) for i in range(40)]
    got = metric.range_join(vectors(spark, rows, "array<double>", "embedding"), 0.95)
    assert sorted(map(tuple, got.collect())) == naive_links(rows, 0.95)


def test_range_join_follows_chains(spark):
    rows = [(i, [math.cos(0.3 * i), math.sin(0.3 * i)]) for i in range(10)]
    got = metric.range_join(vectors(spark, rows, "array<double>", "embedding"), 0.95)
    assert [tuple(r) for r in got.orderBy("vec_id").collect()] == naive_links(rows, 0.95)
    assert got.filter("component_id = 0").count() == 10


def test_range_join_leaves_unusable_vectors_alone(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [NAN, 1.0]), (6, [INF, 0.0]), (7, [None, 1.0]), (8, []), (9, [1.0])]
    df = vectors(spark, rows, "array<double>", "embedding").withColumn("rep", F.lit("r")).withColumn("home", F.lit(0))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in metric.range_join(df).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 9: (2, 1, False), **{i: (0, i, True) for i in range(3, 9)}}
    assert metric.range_join(df.filter("vec_id > 90")).collect() == []
    assert metric.range_join(df.filter("vec_id = 3")).count() == 1


def test_range_join_counts_repeated_rows(spark):
    rows = [(1, [1.0, 0.0])] * 3 + [(2, [1.0, 0.01])]
    got = metric.range_join(vectors(spark, rows, "array<double>", "embedding"))
    assert sorted(map(tuple, got.collect())) == [(1, 3, 1, True)] * 3 + [(2, 3, 1, False)]


def test_components_of_random_links(spark):
    from twinledger.llm.components import components

    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {i: i for pair in links for i in pair if i is not None}
    for _ in range(len(label)):
        for a, b in links:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    linked = {i for a, b in links if a is not None and b is not None and a != b for i in (a, b)}
    assert got == {i: label[i] for i in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("parts", [1, 4])
def test_different_vectors_under_one_id(spark, parts):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.01]), (2, [1.0, 0.02]), (1, [0.0, 1.0]), (1, [1.0, 0.0])]
    df = vectors(spark, rows, "array<double>", "embedding").repartition(parts, "embedding")
    got = sorted(map(tuple, metric.range_join(df).collect()))
    assert got == [(1, 0, 1, True), (1, 3, 1, True), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False)]
