"""Exact top-k by inner product: a Voronoi kNN join.

Inner products become distances: with M the largest norm, a vector v is
lifted to (v, sqrt(M^2 - |v|^2)) and a query q to (q, 0), and then
|q - v|^2 = |q|^2 + M^2 - 2 q.v, so the nearest have the highest scores.

Pivots part both sides into cells. From the summary of each data cell (its k
smallest distances from the pivot) every query cell gets a distance that its kth
neighbour can't exceed. A data vector goes to a query cell only if the triangle
inequality lets it lie within that distance of some query there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from twinledger.llm.shared import checkpointed
from twinledger.llm.vectors import distances, matrix

#: Queries that share a task, and data vectors that a task holds on average.
QUERIES, DATA = 2048, 8192
#: Most pivots; bounds are a matrix of that many by that many.
MOST_PIVOTS = 512
#: Rows of the score matrix made at a time.
ROWS = 256
#: Integers up to here are exact in a double.
EXACT = float(1 << 53)


def quantised(vector: str, factor: int = 64):
    """Each component x as floor(factor * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double")))


def top_k(data: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """Each query's ``k`` highest inner products: ``query_id``, ``rank``, ``id_col``, ``score``.

    Both frames have ``id_col`` and ``vector_col`` (array of bigint). A query's own id is
    no candidate; equal scores go to the smaller id. NULL, empty and NULL-holding
    vectors and NULL ids take no part, shorter vectors count as ended with
    zeros. Rows that repeat an id are candidates each. Fewer candidates give fewer rows.

    A query cell with more queries than a task takes is split, small ones that
    lie together are packed; the data that a pack needs is dealt into parts of
    bounded size, whose top k are merged. So copies of one vector, in one cell, are
    spread like others.
    """
    usable = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<bigint>").alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", F.isnull)
    )
    data, queries = usable(data), usable(queries)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    shape = data.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vector")).alias("width"), F.max(square).alias("square")).first()
    width = max(shape["width"] or 1, queries.agg(F.max(F.size("vector"))).first()[0] or 1)
    top = shape["square"] or 0.0

    def lifted(vectors: pd.Series, query: bool) -> np.ndarray:
        rows = matrix(vectors, width)
        height = np.zeros(len(rows)) if query else np.sqrt(np.maximum(0, top - (rows**2).sum(1)))
        return np.column_stack([rows, height])

    count = int(min(MOST_PIVOTS, max(1, np.sqrt(shape["rows"]) / 2)))
    picked = data.orderBy(F.xxhash64("id", F.lit(17)), "id").limit(count).toPandas()
    pivots = lifted(picked["vector"], False) if len(picked) else np.zeros((1, width + 1))

    def assign(query: bool):
        def assigned(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                away = distances(lifted(batch["vector"], query), pivots)
                cell = away.argmin(axis=1)
                yield batch.assign(cell=cell, away=away[np.arange(len(batch)), cell])

        return assigned

    kind = "id long, vector array<bigint>, cell int, away double"
    data = checkpointed(data.mapInPandas(assign(False), kind))
    queries = checkpointed(queries.mapInPandas(assign(True), kind))
    packs, reach = _bounds(data, queries, pivots, k)
    if not packs:
        return _ranked(data.limit(0).select(F.col("id").alias("query_id"), "id", F.lit(0).cast("long").alias("score")), k, id_col)

    def needed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                part = batch.iloc[start : start + ROWS]
                within = part["away"].to_numpy()[:, None] >= reach[:, part["cell"].to_numpy()].T
                row, pack = np.nonzero(within)
                yield pd.DataFrame({"pack": pack, "id": part["id"].to_numpy()[row], "vector": part["vector"].to_numpy()[row]})

    replicas = data.mapInPandas(needed, "pack int, id long, vector array<bigint>")
    pack_of, splits = F.create_map(*(F.lit(x) for cell, (pack, _) in packs.items() for x in (cell, pack))), {}
    for pack, parts in packs.values():
        splits[pack] = max(parts, splits.get(pack, 1))
    split_of = F.create_map(*(F.lit(x) for item in splits.items() for x in item))
    # one row a pack, of which there are no more than pivots
    held = {row["pack"]: row["count"] for row in replicas.groupBy("pack").count().collect()}
    parts_of = F.create_map(*(F.lit(x) for pack in splits for x in (pack, max(1, -(-held.get(pack, 0) // DATA)))))
    parts = parts_of[F.col("pack")]
    split = F.pmod(F.xxhash64("id"), split_of[F.col("pack")])
    left = (
        queries.withColumn("pack", pack_of[F.col("cell")])
        .withColumn("split", split)
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("pack", "split", "part", "id", "vector")
    )
    right = (
        replicas.withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), parts).cast("int"))
        .withColumn("split", F.explode(F.sequence(F.lit(0).cast("bigint"), split_of[F.col("pack")].cast("bigint") - 1)))
        .select("pack", "split", "part", "id", "vector")
    )

    def solve(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        return _best(ours, theirs, width, k)

    key = ["pack", "split", "part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(solve, "query_id long, id long, score long")
    return _ranked(found, k, id_col)


def _bounds(data: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int):
    """Each query cell's pack and number of splits, and what distance from its pivot a data vector
    of a cell must have to be needed by a pack. The summaries are bounded by the pivots."""
    near = Window.partitionBy("cell").orderBy("away")
    low = (
        data.select("cell", "away").withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1).toPandas()
    )
    cells = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("away")).toPandas()
    if low.empty or cells.empty:
        return {}, None
    between = distances(pivots, pivots)
    ids, radius = cells["cell"].to_numpy(), cells["away"].to_numpy()
    bound = radius[:, None] + between[ids][:, low["cell"].to_numpy()] + low["away"].to_numpy()[None, :]
    kth = np.sort(bound, axis=1)[:, k] if len(low) > k else np.full(len(ids), np.inf)
    slack = 1e-6 * (1 + np.abs(between).max() + radius.max())
    needs = between[ids] - (radius + kth)[:, None] - slack
    packs, reach, held, at = {}, [], QUERIES, int(ids[0])
    waiting = dict(zip(ids.tolist(), zip(cells["n"].tolist(), needs)))
    while waiting:
        at = min(waiting, key=lambda c: (between[at, c], c))
        n, need = waiting.pop(at)
        if held + n > QUERIES:
            reach.append(need.copy())
            held = 0
        reach[-1] = np.minimum(reach[-1], need)
        held += n
        packs[at] = (len(reach) - 1, max(1, -(-n // QUERIES)))
    return packs, np.array(reach)


def _best(ours: pd.DataFrame, theirs: pd.DataFrame, width: int, k: int) -> pd.DataFrame:
    """The k best of a part for each query of a task."""
    theirs = theirs.sort_values("id", ignore_index=True)
    names = theirs["id"].to_numpy()
    out = []
    if len(ours) and len(theirs):
        points = matrix(theirs["vector"], width)
        queries = matrix(ours["vector"], width)
        exact = np.abs(points).max() * np.abs(queries).max() * width < EXACT
        if not exact:
            points, queries = (np.array([list(v) + [0] * (width - len(v)) for v in x["vector"]], np.int64) for x in (theirs, ours))
        for start in range(0, len(ours), ROWS):
            scores = queries[start : start + ROWS] @ points.T
            for i, row in enumerate(scores):
                own = ours["id"].iat[start + i]
                most = min(k + int((names == own).sum()), len(row))
                line = np.partition(row, len(row) - most)[len(row) - most]
                at = np.flatnonzero(row >= line)
                at = at[names[at] != own]
                at = at[np.argsort(-row[at], kind="stable")[:k]]
                out.append((np.full(len(at), own), names[at], row[at].astype(np.int64)))
    if not out:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "id", "score")})
    return pd.DataFrame(dict(zip(("query_id", "id", "score"), map(np.concatenate, zip(*out)))))


def _ranked(found: DataFrame, k: int, id_col: str) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(by))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    )
