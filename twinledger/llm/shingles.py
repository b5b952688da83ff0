"""Documents that share most of their word n-grams: MinHash bands, then exact sets.

Words are the runs of letters and digits of the text after A-Z are lower-cased;
every character above ASCII counts as a letter. A text's n-grams are the sets of
``n`` consecutive words; a text of fewer words has one n-gram, all its words; a
text without words has none and links with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from twinledger.functions.columns import named
from twinledger.llm.components import components
from twinledger.llm.shared import Recent, bounded_batches, checkpointed

#: Bytes that end a word become blanks, A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Distinct words that a worker takes for recent.
KEPT_WORDS = 100_000
#: Buckets up to this size give pairs, larger ones blocks of this many documents.
PAIRED, BLOCK = 32, 512
#: Columns of the incidence matrix that a block fills at a time.
COLUMNS = 4096


class Bands(NamedTuple):
    count: int
    rows: int


def bands_for(threshold: float, recall: float, hashes: int = 160) -> Bands:
    """The most selective banding that reaches ``recall`` at ``threshold``.

    A pair of similarity s meets in one of b bands of r rows with the chance
    1 - (1 - s^r)^b. The largest r is taken whose b fits into ``hashes``.
    """
    best = None
    for rows in range(1, hashes + 1):
        count = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))) if threshold < 1 else 1
        if count * rows <= hashes:
            best = Bands(max(1, count), rows)
    if best is None:
        raise ValueError("no banding reaches that recall with so few hashes")
    return best


def _words() -> Recent:
    return Recent(xxhash.xxh64_intdigest, KEPT_WORDS)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str | None, n: int, words: dict) -> np.ndarray:
    """The distinct 64-bit hashes of a text's word n-grams, sorted."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
    hashes = np.array([words[w] for w in found], dtype=np.uint64)
    size = min(n, len(hashes))
    total = np.full(max(0, len(hashes) - size + 1) if size else 0, size, dtype=np.uint64)
    for i in range(size):
        total = _mixed(total + hashes[i : len(hashes) - size + 1 + i])
    return np.unique(total)


def _seeds(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    draw = lambda: random.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(), draw()


def band_hashes(shingles: np.ndarray, bands: Bands, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One signed 64-bit hash a band; the band's number is part of it."""
    lows = np.array([(shingles * a + b).min() for a, b in zip(*seeds)], dtype=np.uint64)
    lows = lows.reshape(bands.count, bands.rows)
    total = np.arange(1, bands.count + 1, dtype=np.uint64)
    for row in range(bands.rows):
        total = _mixed(total + lows[:, row])
    return total.view(np.int64)


def signatures(
    docs: DataFrame, id_col: str, text_col: str, n: int, bands: Bands, seed: int, order_col: str | None = None
) -> DataFrame:
    """``id``, ``place`` (of its order), the text's hash, a 128-bit ``hi``/``lo`` of the n-gram set, its size, and the bands."""
    seeds = _seeds(bands.count * bands.rows, seed)

    @F.pandas_udf("hi long, lo long, size long, bands array<long>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _words()
        for batch in batches:
            rows = []
            for text in batch:
                grams = shingle_hashes(text, n, words)
                hi, lo = np.frombuffer(xxhash.xxh128_digest(grams.tobytes()), dtype=np.int64)
                rows.append((hi, lo, len(grams), band_hashes(grams, bands, seeds) if len(grams) else None))
            yield pd.DataFrame(rows, columns=["hi", "lo", "size", "bands"])

    return _source(docs, id_col, text_col, order_col).select("place.id", "place", "hash", sign("text").alias("sign")).select(
        "id", "place", "hash", "sign.*"
    )


def _source(docs: DataFrame, id_col: str, text_col: str, order_col: str | None = None) -> DataFrame:
    """``place`` (what rows are ordered by), ``text``, ``hash`` of the text."""
    order = F.lit(0) if order_col is None else named(order_col)
    text = named(text_col)
    place = F.struct(order.alias("order"), named(id_col).cast("long").alias("id"))
    return docs.select(place.alias("place"), text.alias("text"), F.xxhash64(text).alias("hash"))


def _shingle_sets(source: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``node`` and its n-gram hashes as one binary, for the rows (``place``, ``hash``) in ``wanted``."""

    @F.pandas_udf("binary")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _words()
        for batch in batches:
            yield pd.Series([shingle_hashes(text, n, words).tobytes() for text in batch], dtype=object)

    # a row of that place and text, and copies of it
    met = source.join(wanted, ["place", "hash"]).dropDuplicates(["place", "hash"])
    return met.select("node", cut("text").alias("grams"))


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.99999,
    seed: int = 7,
    order_col: str | None = None,
) -> DataFrame:
    """Every document with its links of Jaccard similarity >= ``threshold``.

    Returns ``id_col``, ``n_links`` (other rows it links with directly),
    ``class_id`` (the smallest id it reaches by links; with ``order_col`` the one of the
    smallest value there, then id) and ``kept`` (it is that id), one row per row of ``docs``.

    Rows with the same n-gram set form one class, so copies are counted and
    never paired. Classes are numbered in the order of their smallest rows. The classes are banded; members of a
    small bucket are paired, a large bucket (near copies of one text) is cut
    into blocks and every two blocks are compared in a task of their own, which
    returns counts and a spanning forest instead of pairs. Either way two
    classes link if their full n-gram sets do.

    NULL and empty texts and texts without words have no links and are their
    own class. A row with a NULL id takes part under no id: it gets no links.
    Rows that repeat an id are rows of their own: equal ones are copies, different ones have
    their own links, and each counts for the rows that it links with.
    """
    bounded_batches(docs.sparkSession)
    bands = bands_for(threshold, recall)
    signed = checkpointed(signatures(docs, id_col, text_col, n, bands, seed, order_col))
    usable = signed.filter("size > 0 AND id IS NOT NULL")
    classes = checkpointed(
        usable.groupBy("hi", "lo")
        .agg(
            F.min(F.struct("place", "hash")).alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("size").alias("size"),
            F.first("bands").alias("bands"),
        )
        .orderBy("rep", "hi", "lo")
        .withColumn("node", F.monotonically_increasing_id())
    )
    candidates = checkpointed(_candidates(classes))
    met = classes.join(candidates.select("node").distinct(), "node", "left_semi")
    sets = checkpointed(_shingle_sets(_source(docs, id_col, text_col, order_col), met.select("rep.*", "node"), n))
    linked = checkpointed(
        _paired(candidates, sets, threshold).unionByName(_blocked(candidates, sets, threshold))
    )
    labels = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    names = classes.select(F.col("node").alias("component"), F.col("rep.place.id").alias("class_id"))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    resolved = (
        classes.select("hi", "lo", "node", "copies", F.col("rep.place.id").alias("own"))
        .join(links, "node", "left")
        .join(labels.join(names, "component"), "node", "left")
        .select(
            "hi",
            "lo",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("class_id", "own").alias("class_id"),
        )
    )
    empty = F.col("id").isNull() | (F.col("size") == 0)
    alone = signed.filter(empty).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("class_id"))
    return (
        usable.select("id", "hi", "lo")
        .join(resolved, ["hi", "lo"])
        .select("id", "n_links", "class_id")
        .unionByName(alone)
        .select(F.col("id").alias(id_col), "n_links", "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))
    )


def _candidates(classes: DataFrame) -> DataFrame:
    """Class members of every bucket of two or more: ``band, node, copies, size, total``."""
    members = classes.select(F.explode("bands").alias("band"), "node", "copies", "size")
    totals = members.groupBy("band").agg(F.count(F.lit(1)).alias("total")).filter("total > 1")
    return members.join(totals, "band")


def _large_buckets(candidates: DataFrame) -> DataFrame:
    """The large buckets of each class, at most one a band."""
    return (
        candidates.filter(F.col("total") > PAIRED).groupBy("node").agg(F.collect_list("band").alias("large"))
    )


def _paired(candidates: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links found through small buckets, once a pair: ``node, links, root``."""
    small = candidates.filter(F.col("total") <= PAIRED)
    one, other = (
        small.select("band", *(F.col(c).alias(c + end) for c in ("node", "copies", "size"))) for end in ("_a", "_b")
    )
    close = F.least("size_a", "size_b") >= F.lit(threshold - 1e-9) * F.greatest("size_a", "size_b")
    pairs = (
        one.join(other, "band")
        .filter((F.col("node_a") < F.col("node_b")) & close)
        .select("node_a", "node_b", "copies_a", "copies_b")
        .distinct()
    )
    large = _large_buckets(candidates)
    for end in ("_a", "_b"):
        pairs = pairs.join(large.select(F.col("node").alias("node" + end), F.col("large").alias("large" + end)), "node" + end, "left")
    met = F.coalesce(F.arrays_overlap("large_a", "large_b"), F.lit(False))
    pairs = pairs.filter(~met).drop("large_a", "large_b")
    for end in ("_a", "_b"):
        pairs = pairs.join(sets.select(F.col("node").alias("node" + end), F.col("grams").alias("grams" + end)), "node" + end)

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_jaccard(x, y) >= threshold for x, y in zip(a, b)], dtype=bool)

    found = pairs.filter(similar("grams_a", "grams_b"))
    return found.select(
        F.explode(
            F.array(
                F.struct(F.col("node_a").alias("node"), F.col("copies_b").alias("links"), F.col("node_a").alias("root")),
                F.struct(F.col("node_b").alias("node"), F.col("copies_a").alias("links"), F.col("node_a").alias("root")),
            )
        ).alias("link")
    ).select("link.*")


def _jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def _blocked(candidates: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links found through large buckets, once a pair: ``node, links, root``."""
    blocks = F.ceil(F.col("total") / BLOCK)
    members = (
        candidates.filter(F.col("total") > PAIRED)
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
        .select(
            "band",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "node",
            "copies",
        )
        .join(_large_buckets(candidates), "node")
        .join(sets, "node")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", ignore_index=True)
        band, low, high = (int(group[c].iat[0]) for c in ("band", "low", "high"))
        near = _similar(group["grams"], threshold)
        near &= _first_meeting(group["large"], band)
        block = group["block"].to_numpy()
        near &= (block[:, None] == low) & (block[None, :] == high) | (block[:, None] == high) & (block[None, :] == low)
        return forest(group["node"].to_numpy(), near, group["copies"].to_numpy(), "node")

    return members.groupBy("band", "low", "high").applyInPandas(compare, "node long, links long, root long")


def forest(ids: np.ndarray, near: np.ndarray, weights: np.ndarray, name: str) -> pd.DataFrame:
    """Of a symmetric link matrix: each linked id, the weights it links with, its smallest id."""
    np.fill_diagonal(near, False)
    links = near @ weights.astype(np.float64)
    label = np.where(near.any(axis=1), np.arange(len(ids)), -1)
    at = np.flatnonzero(label >= 0)
    near = near[np.ix_(at, at)]
    root = np.arange(len(at))
    while len(at):
        lowest = np.minimum(root, np.where(near, root[None, :], len(at)).min(axis=1))
        lowest = lowest[lowest]
        if (lowest == root).all():
            break
        root = lowest
    return pd.DataFrame({name: ids[at], "links": links[at].astype(np.int64), "root": ids[at][root] if len(at) else ids[at]})


def _similar(grams: pd.Series, threshold: float) -> np.ndarray:
    """Which sets reach the threshold, from an incidence matrix of what they share."""
    sets = [np.frombuffer(g, np.uint64) for g in grams]
    sizes = np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(len(sets)), sizes), count[column] > 1
    place = np.cumsum(count > 1) - 1
    row, column = row[shared], place[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int((count > 1).sum()), COLUMNS):
        at = slice(*np.searchsorted(column, (start, start + COLUMNS)))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[at], column[at] - start] = 1
        both += has @ has.T
    both = both.astype(np.float64)
    return both / (sizes[:, None] + sizes[None, :] - both) >= threshold


def _first_meeting(large: pd.Series, band: int) -> np.ndarray:
    """Pairs that meet in no large bucket of a smaller hash than ``band``."""
    earlier = [[int(b) for b in bands if b < band] for bands in large]
    flat = np.array([b for bands in earlier for b in bands], dtype=np.int64)
    row = np.repeat(np.arange(len(earlier)), [len(b) for b in earlier])
    names, column = np.unique(flat, return_inverse=True)
    met = np.zeros((len(earlier), len(earlier)), np.float32)
    for start in range(0, len(names), COLUMNS):
        at = (column >= start) & (column < start + COLUMNS)
        has = np.zeros((len(earlier), min(COLUMNS, len(names) - start)), np.float32)
        has[row[at], column[at] - start] = 1
        met += has @ has.T
    return met == 0
