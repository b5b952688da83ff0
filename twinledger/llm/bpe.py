"""Byte-level BPE: ranked merges over the bytes of distinct words, and back.

A rank file has a token in base64 and its rank on each line. Texts are split
by a pattern; each piece is a word whose bytes are merged pair by pair, the lowest
rank first and of equal ranks the leftmost, until no neighbours have a rank. A
piece that is a token is that token. There are no special tokens.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession, functions as F

from twinledger.llm.shared import Recent, bounded_batches

#: Distinct words that a worker takes for recent, and the longest that it keeps.
KEPT_WORDS, KEPT_LENGTH = 150_000, 64
#: Words of more bytes are merged from a heap.
SHORT = 48
#: Characters of a batch's texts whose results are held at a time, or one text.
HELD = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word."""
    if word in ranks:
        return [ranks[word]]
    return _fold(word, ranks) if len(word) <= SHORT else _fold_long(word, ranks)


def _fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [word[i : i + 1] for i in range(len(word))]
    none = 1 << 62
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        at = pairs.index(low)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
    return [ranks[part] for part in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with the neighbours' ranks in a heap, for words of any length."""
    size = len(word)
    end = list(range(1, size + 1))  # of the part that starts here; 0 where none starts
    before = list(range(-1, size - 1))
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(size - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not middle or middle >= size or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < size:
            before[stop] = start
            token = word[start : end[stop]]
            if token in ranks:
                heapq.heappush(heap, (ranks[token], start, end[stop]))
        if start:
            token = word[before[start] : stop]
            if token in ranks:
                heapq.heappush(heap, (ranks[token], before[start], stop))
    ids, at = [], 0
    while at < size:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


class _Encoded(Recent):
    """The ids of words seen lately, as bytes; long words are not kept."""

    def __init__(self, ranks: dict[bytes, int]):
        def packed(word: str) -> bytes:
            ids = merge(word.encode("utf-8", "surrogatepass"), ranks)
            return struct.pack(f"<{len(ids)}I", *ids)

        super().__init__(packed, KEPT_WORDS)

    def __missing__(self, word: str) -> bytes:
        return super().__missing__(word) if len(word) <= KEPT_LENGTH else self.compute(word)


def rank_map(spark: SparkSession, path: str) -> Broadcast:
    """The rank file, for ``encode`` and ``decode``; its size is that of the vocabulary."""
    bounded_batches(spark)
    return spark.sparkContext.broadcast(read_ranks(path))


def _encoder(ranks: dict[bytes, int], pattern: str) -> Callable[[str | None], bytes]:
    split, known = regex.compile(pattern).findall, _Encoded(ranks)

    return lambda text: b"".join([known[word] for word in split(text or "")])


def _decoder(ranks: dict[bytes, int]) -> Callable[[bytes | None], bytes]:
    pieces = {rank: token for token, rank in ranks.items()}
    return lambda ids: b"".join([pieces[i] for i in np.frombuffer(ids or b"", "<u4").tolist()])


def _runs(batch: pd.Series) -> Iterator[pd.Series]:
    """A batch's rows in order, ``HELD`` characters at a time: workers keep the memory that their largest result took."""
    sizes = np.fromiter((len(x) if x is not None else 0 for x in batch), dtype=np.int64, count=len(batch))
    starts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // HELD, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(batch)]):
        yield batch.iloc[start:end]


def _round_trips(batches: Iterator[pd.Series], ranks: dict[bytes, int], pattern: str) -> Iterator[pd.DataFrame]:
    there, back = _encoder(ranks, pattern), _decoder(ranks)
    for batch in batches:
        for texts in _runs(batch):
            ids = [there(text) for text in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [back(x) for x in ids]}, dtype=object)


def encode(text: str | Column, ranks: Broadcast, pattern: str) -> Column:
    """The ids of whole texts as little-endian unsigned 32-bit integers.

    NULL and empty texts give no ids, not NULL.
    """

    @F.pandas_udf("binary")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = _encoder(ranks.value, pattern)
        for batch in batches:
            for texts in _runs(batch):
                yield pd.Series([one(text) for text in texts], dtype=object)

    return encoded(text)


def decode(ids: str | Column, ranks: Broadcast) -> Column:
    """The bytes that ids stand for, joined; NULL gives no bytes."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = _decoder(ranks.value)
        for batch in batches:
            for run in _runs(batch):
                yield pd.Series([one(x) for x in run], dtype=object)

    return decoded(ids)


def round_trip(text: str | Column, ranks: Broadcast, pattern: str) -> Column:
    """``ids`` as ``encode`` gives them and ``decoded``, what they decode to, from one worker a task."""

    @F.pandas_udf("ids binary, decoded binary")
    def there_and_back(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _round_trips(batches, ranks.value, pattern)

    return there_and_back(text)


def token_count(ids: str | Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
