"""Exact duplicates by a content sort.

Texts without their white space are ranged by sampled splitters, so that equal texts are
in one range or in ranges that follow each other; every range is sorted, and neighbours
are compared whole. A splitter ends in a hash of the row, so copies that fill more than a range
are cut as well; their runs are put together by the full texts of the runs' first rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinledger.functions.columns import named
from twinledger.llm.shared import checkpointed

# The characters that don't count.
BLANKS = " \t\n\x0b\x0c\r"


class Settings(NamedTuple):
    """``ranges``: for each shuffle partition; ``most``: ranges at most; ``samples``: rows sampled for each
    range on average; ``broadcast_rows``: up to here the cut runs are broadcast."""

    ranges: int = 8
    most: int = 16384
    samples: int = 16
    broadcast_rows: int = 100_000


#: Bytes of a text that a splitter starts with; a hash of the whole text follows.
START = 24


def _hashed(*columns: Column | str) -> Column:
    return F.lpad(F.hex(F.xxhash64(*columns)), 16, "0")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, content, chars``, and the two parts of the key that rows are ranged by: ``start``, ``tie``."""
    rows = docs.select(named(id_col).cast("long").alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    content = rows.select(
        "id",
        F.translate("text", BLANKS, "").alias("content"),
        F.char_length("text").alias("chars"),
        # copies are spread by it; any value gives the same result
        _hashed("id", F.monotonically_increasing_id()).alias("tie"),
    )
    first = F.rpad(F.hex(F.substring(F.col("content").cast("binary"), 1, START)), 2 * START, "0")
    return content.withColumn("start", F.concat(first, _hashed("content")))


def _splitters(docs: DataFrame, id_col: str, text_col: str, settings: Settings) -> list[str]:
    """Keys that part the rows into ranges of about as many bytes, from a bounded sample."""
    wanted = min(settings.most, settings.ranges * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    share = min(1.0, settings.samples * wanted / max(docs.count(), 1))
    weight = (F.octet_length("content") + F.lit(64)).alias("weight")
    picked = _keyed(docs.sample(share, 13), id_col, text_col).select(F.concat("start", "tie").alias("key"), weight)
    picked = sorted((row.key, row.weight) for row in picked.collect())
    step = sum(weight for _, weight in picked) / wanted
    found, passed = [], 0
    for key, weight in picked:
        passed += weight
        if passed >= step * (len(found) + 1):
            found.append(key)
    return found


def _range(splitters: list[str], key: Column) -> Column:
    """How many of the sorted splitters are at most ``key``, by bisection."""
    listed = F.split(F.lit(",".join(splitters)), ",")  # one literal of the plan
    steps = [1 << n for n in reversed(range(len(splitters).bit_length()))]
    further = lambda low, step: F.when(F.get(listed, low + step - 1) <= key, low + step).otherwise(low)
    return F.aggregate(F.lit(steps), F.lit(0), further)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are without the characters of ``BLANKS``; NULL counts as empty. Of equal
    ones the row with the most characters stays, of those the one with the smallest id, NULL
    ids last; of rows that repeat an id and a text one. The digest is that of the text without blanks.
    Empty tables give no rows, other columns are ignored.

    Whole texts are shuffled once. The driver gets a sample of bounded keys, no texts.
    """
    rows = _keyed(docs, id_col, text_col)
    splitters = _splitters(docs, id_col, text_col, settings)
    cell = _range(splitters, F.concat("start", "tie")) if splitters else F.lit(0)
    # if any splitter cuts a text's copies, one of the two around this row does
    around = F.split(F.lit(",".join(splitters)), ",")
    cuts = lambda at: F.coalesce(F.startswith(F.get(around, at), "start"), F.lit(False))
    ranged = rows.withColumn("range", cell).withColumn("cut", cuts(F.col("range") - 1) | cuts(F.col("range")))

    order = [F.col("content"), F.col("chars").desc(), F.col("id").asc_nulls_last()]
    within = Window.partitionBy("range").orderBy(*order)
    compared = ranged.select(
        "range",
        "id",
        "chars",
        F.row_number().over(within).alias("place"),
        F.coalesce(F.lag("content").over(within) != F.col("content"), F.lit(True)).alias("first"),
        F.sha2("content", 256).alias("digest"),
        "content",
        "cut",
    ).withColumn("content", F.when(F.col("first") & F.col("cut"), F.col("content")))
    run = Window.partitionBy("range", "run")
    runs = checkpointed(
        compared.withColumn("run", F.sum(F.col("first").cast("long")).over(Window.partitionBy("range").orderBy("place")))
        .withColumn("size", F.count(F.lit(1)).over(run))
        .withColumn("keep", F.max(F.when(F.col("first"), F.col("id"))).over(run))
        .select("range", "run", "id", "chars", "first", "digest", "content", "size", "keep")
    )
    whole = _put_together(runs.filter("content IS NOT NULL"))
    if runs.filter("content IS NOT NULL").count() <= settings.broadcast_rows:
        whole = F.broadcast(whole)
    joined = runs.drop("content").join(whole, ["range", "run"], "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("total").isNull(), F.col("keep")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("total", "size").alias("group_size"),
        (F.col("first") & F.coalesce(F.col("best.range") == F.col("range"), F.lit(True))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _put_together(firsts: DataFrame) -> DataFrame:
    """Runs of one text in several ranges: ``range, run, total, best``, from the first row of each."""
    by = Window.partitionBy("content")
    place = F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("none"), "id", "range")
    return firsts.select(
        "range", "run", F.sum("size").over(by).alias("total"), F.min(place).over(by).alias("best")
    )
