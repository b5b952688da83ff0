"""A quality score by logistic regression on hashed word n-grams, trained with FTRL.

A text gives two groups of features: n-grams of its words, and n-grams of its
words' shapes (``Xx`` for a capitalised word, ``0`` for digits, other characters
as they are, runs taken together, ``=`` for a word that repeats the one before).
Each group has log counts scaled to length one. Words are what white space parts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from twinledger.llm.shared import Recent, bounded_batches

#: Distinct words that a worker takes for recent.
KEPT_WORDS = 100_000


class Settings(NamedTuple):
    """``bits``: of the feature table. ``max_rows``: labelled rows that are learnt from, the
    bound of the training sample. ``shard_rows``: rows a task learns from in sequence."""

    bits: int = 18
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.001
    epochs: int = 4
    max_rows: int = 32_768
    shard_rows: int = 2_048
    seed: int = 11


_RUNS = ((re.compile(r"[A-Z]+"), "X"), (re.compile(r"[a-z]+"), "x"), (re.compile(r"[0-9]+"), "0"))
_LETTERS = re.compile(r"[^\W\d_]+")


def shape(word: str) -> str:
    if not word.isascii():
        word = _LETTERS.sub(lambda m: "".join("A" if c.isupper() else "a" for c in m[0]), word)
    for runs, mark in _RUNS:
        word = runs.sub(mark, word)
    return word


def _hashes(word: str) -> tuple[int, int]:
    """Of a word and of its shape."""
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in (word.lower(), shape(word)))


def _known() -> Recent:
    return Recent(_hashes, KEPT_WORDS)


def _slots(streams: list[np.ndarray], bits: int, group: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = [(s ^ (s >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(65 - bits) for s in streams]
    slots, counts = np.unique(np.concatenate(mixed), return_counts=True)
    values = 1 + np.log(counts)
    return slots.astype(np.int64) * 2 + group, values / max(1e-9, np.sqrt((values**2).sum()))


def _grams(x: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    streams = []
    for size in sizes:
        total = np.full(max(0, len(x) - size + 1), size, dtype=np.uint64)
        for i in range(size):
            total = (total + x[i : len(x) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        streams.append(total)
    return streams


def features(text: str | None, bits: int, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the table and their values; slot 0 is the bias."""
    found = (text or "").split()
    pairs = np.array([known[w] for w in found], dtype=np.uint64).reshape(-1, 2)
    words, shapes = pairs[:, 0], pairs[:, 1].copy()
    shapes[1:][words[1:] == words[:-1]] = 1
    a, x = _slots(_grams(words, (1, 2)), bits, 0)
    b, y = _slots(_grams(shapes, (1, 2, 3)), bits, 1)
    return np.concatenate([[0], a, b]), np.concatenate([[1.0], x, y])


def _chance(total: float) -> float:
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
    return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)


def ftrl(texts: list[str | None], labels: np.ndarray, s: Settings) -> np.ndarray:
    """The weights after ``epochs`` passes of follow-the-regularised-leader updates."""
    known = _known()
    rows = [(i.astype(np.int32), v.astype(np.float32)) for i, v in (features(t, s.bits, known) for t in texts)]
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    random = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in random.permutation(len(rows)):
            slots, values = rows[i]
            own_z, own_n = z[slots], n[slots]
            w = _weights(own_z, own_n, s)
            gradient = (_chance(float(w @ values)) - labels[i]) * values
            squared = own_n + gradient**2
            z[slots] = own_z + gradient - (np.sqrt(squared) - np.sqrt(own_n)) / s.alpha * w
            n[slots] = squared
    return _weights(z, n, s)


def held_out(id_column) -> F.Column:
    """Rows that no label is learnt from: crc32 of the id as text is a multiple of five."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Weights learnt from the labelled rows that are not held out.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1, others and NULL are left
    out; a document labelled both ways counts as 0). At most ``max_rows`` ids,
    picked by hash, are learnt from, so that they can be broadcast. Each shard of
    ``shard_rows`` learns in a task of its own and the shards' weights are
    averaged. Only the weights, ``2 ** bits`` at most, reach the driver. Without
    a labelled row all weights are 0.
    """
    bounded_batches(docs.sparkSession)
    usable = labels.select(F.col("doc_id").cast("long").alias("id"), "quality").filter(
        F.col("id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("id"))
    )
    sample = (
        usable.groupBy("id")
        .agg(F.min("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("id", F.lit(settings.seed)), "id")
        .limit(settings.max_rows)
    )
    shards = max(1, -(-sample.count() // settings.shard_rows))
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("id"), "text")
        .join(F.broadcast(sample), "id")
        .withColumn("shard", F.pmod(F.xxhash64("id", F.lit(settings.seed + 1)), F.lit(shards)))
    )

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        weights = ftrl(list(group["text"]), group["label"].to_numpy(), settings)
        slots = np.flatnonzero(weights)
        return pd.DataFrame({"slot": slots, "weight": weights[slots]})

    learnt = (
        rows.groupBy("shard")
        .applyInPandas(learn, "slot long, weight double")
        .groupBy("slot")
        .agg(F.sum(F.col("weight").cast("decimal(30,15)")).cast("double").alias("weight"))
        .toPandas()
    )
    weights = np.zeros(1 << settings.bits, dtype=np.float32)
    weights[learnt["slot"].to_numpy(dtype=np.int64)] = learnt["weight"].to_numpy(dtype=np.float64) / shards
    return weights


def score(text, weights: np.ndarray, settings: Settings = Settings()) -> F.Column:
    """The chance of label 1 for a text column, as a sparse dot product with the weights.

    NULL and empty texts have the bias as their only feature.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _known()
        for batch in batches:
            totals = []
            for one in batch:
                slots, values = features(one, settings.bits, known)
                totals.append(float(weights[slots].astype(np.float64) @ values))
            yield pd.Series(_chance(np.array(totals, dtype=np.float64)))

    return scored(text)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (score >= ``threshold``) of every row of ``docs``."""
    scored = score(F.col("text"), train(docs, labels, settings), settings)
    return docs.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        scored.alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
