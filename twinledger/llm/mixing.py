"""Mixing sources to target weights under a cap on epochs.

Sizes are counted in words, the runs of characters other than ASCII white space.
The sources' shares of the whole are ``weight * level``, clamped at ``epochs``
times a source's own size; the level at which they add up to the whole is what
repeated redistribution of the excess by weight ends at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from twinledger.llm.shared import checkpointed

WEIGHTS = (5, 2, 1)
EPOCHS = 3
WORDS = r"[^\x20\x09-\x0D]+"
#: Up to so many sources, of at most 64 size classes each, the figures of each are broadcast.
FEW_SOURCES = 5000


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """The rows numbered from 0 by ``column``, NULL last, without sorting in one task.

    Range partitions are sorted on their own; the numbers of rows before each
    partition are the only thing summed in one place.
    """
    place = F.monotonically_increasing_id()
    ordered = checkpointed(df.orderBy(F.col(column).asc_nulls_last()).withColumn("_place", place))
    part = F.shiftright("_place", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ordered.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    return (
        ordered.withColumn("_part", part)
        .join(parts, "_part")
        .withColumn(name, F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_place", "_before")
    )


def water_filling(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (``source_size``, ``weight``) with ``target`` added.

    Every pass shares what the clamped sources leave among the others by weight
    and clamps those that then lie above their cap; only the sums of a pass reach
    the driver. A pass without a new clamped source is the last.
    """
    sources = checkpointed(sources)
    cap = F.col("source_size") * epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = F.lit(0.0)
    clamped, left, weight = -1, total, 0
    while True:
        over = cap < F.col("weight") * level
        sums = sources.agg(
            F.count_if(over).alias("clamped"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if sums["clamped"] == clamped or not sums["weight"]:
            break
        clamped, left, weight = sums["clamped"], total - sums["held"], sums["weight"]
        level = F.lit(float(left)) / F.lit(float(weight))
    share = F.col("weight") * F.lit(float(left)) / F.lit(float(max(1, weight)))
    return sources.withColumn("target", F.least(cap.cast("double"), share))


def mix(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = "mix",
    row_col: str | None = None,
) -> DataFrame:
    """Every document with how often the mix takes it.

    Returns ``id_col``, ``source`` (as ``source_col``), ``size``,
    ``source_size``, ``target``, ``copies`` and ``taken`` (``copies * size``), one row
    per row of ``docs``. Sources by code point, NULL last, weigh ``weights``,
    repeating.

    A document is taken ``floor(target / source_size)`` times and, in the seeded order
    of MD5, once more until the rest of the target is reached. That choice is
    made within strata of a source (sizes of the same power of two), and the
    stratum of the smallest documents that can do so evens out what the others
    miss, so that the words taken differ from the target by about half a
    document of that stratum. The running sums go over hash buckets, as many as the square root of a
    stratum's rows, so a source of any share is spread over tasks.

    NULL and empty texts have size 0 and are taken as often as their source's
    whole repetitions; a source of size 0 has target 0. Rows that repeat an id are
    separate documents of the same place in the order, smaller ones first, then by
    ``row_col``, a number of the rows that is returned as well if it is given.
    """
    rows = checkpointed(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            (F.lit(0).cast("long") if row_col is None else F.col(row_col)).alias("row"),
        ).withColumn("stratum", F.floor(F.log2(F.greatest("size", F.lit(1)))))
    )
    strata = rows.groupBy("source", "stratum").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    sources = numbered(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source", "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = water_filling(sources.select("source", "source_size", weight.cast("long").alias("weight")), epochs)
    # sources that are few by count are sent to the documents, many are met by a join
    small = F.broadcast if sources.count() <= FEW_SOURCES else lambda df: df
    sources = sources.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    chosen = _rest(rows, strata, sources, seed, small)
    copies = F.col("whole") + F.col("extra")
    return chosen.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        *([] if row_col is None else [F.col("row").alias(row_col)]),
    )


def _rest(
    rows: DataFrame, strata: DataFrame, sources: DataFrame, seed: str, small: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``rows`` with their source's figures and ``extra``, 1 for those that fill its rest."""
    plan = strata.join(sources.select(F.col("source").alias("of"), "source_size", "rest"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    plan = plan.withColumn(
        "quota", F.when(F.col("source_size") > 0, F.col("rest") * F.col("words") / F.col("source_size")).otherwise(0.0)
    ).withColumn("buckets", F.ceil(F.sqrt("docs")))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string")))
    dealt = (
        rows.join(
            small(plan.select(F.col("source").alias("of"), F.col("stratum").alias("in"), "buckets", "quota")),
            F.col("source").eqNullSafe(F.col("of")) & (F.col("stratum") == F.col("in")),
        )
        .drop("of", "in")
        .withColumn("order", order)
        .withColumn("bucket", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / 2.0**32 * F.col("buckets")))
    )
    before = Window.partitionBy("source", "stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("source", "stratum", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .drop("words")
    )
    within = (
        Window.partitionBy("source", "stratum", "bucket").orderBy("order", "id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = offsets.select(*(F.col(c).alias("o_" + c) for c in offsets.columns))
    placed = checkpointed(
        dealt.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(
            offsets,
            F.col("source").eqNullSafe(F.col("o_source"))
            & (F.col("stratum") == F.col("o_stratum"))
            & (F.col("bucket") == F.col("o_bucket")),
        )
        .withColumn("middle", F.col("o_offset") + F.col("inside") + F.col("size") / 2)
        .select("id", "row", "source", "stratum", "size", "quota", "middle")
    )
    reached = placed.groupBy("source", "stratum").agg(
        F.first("quota").alias("quota"),
        F.sum("size").alias("words"),
        F.coalesce(F.sum(F.when(F.col("middle") <= F.col("quota"), F.col("size"))), F.lit(0)).alias("got"),
    )
    miss = F.col("quota").cast("decimal(38,6)") - F.col("got")
    missed = reached.groupBy(F.col("source").alias("of")).agg(
        F.max(F.struct("words", "stratum")).getField("stratum").alias("largest"),
        F.sum(miss).cast("double").alias("missed"),
    )
    moved = F.col("got") + F.col("missed")
    pick = F.struct(F.col("stratum").alias("evens"), moved.alias("line"))
    fits = (moved >= 0) & (moved <= F.col("words"))
    even = (
        reached.join(missed, F.col("source").eqNullSafe(F.col("of")))
        .groupBy("of")
        .agg(F.coalesce(F.min(F.when(fits, pick)), F.min(F.when(F.col("stratum") == F.col("largest"), pick))).alias("pick"))
        .select("of", "pick.*")
    )
    sources = sources.join(even, F.col("source").eqNullSafe(F.col("of")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "whole", "evens", "line"
    )
    line = F.when(F.col("stratum") == F.col("evens"), F.col("line")).otherwise(F.col("quota"))
    return placed.join(small(sources), F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "extra", (F.col("size") > 0).cast("int") * (F.col("middle") <= line).cast("int")
    )
