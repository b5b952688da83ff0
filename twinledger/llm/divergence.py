"""How the words of a language's sources differ: counts in Arrow, divergences by shards of terms.

Tasks lower, split, encode and count texts as Arrow arrays, and send on partial counts of what they have read.
Those are added up, the terms of enough documents stay, and every language's terms are dealt
into shards. A shard is a table of sources by terms; it gives a partial divergence for every two sources,
and the partial ones add up. All of it is integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from twinledger.functions.columns import named
from twinledger.llm.shared import bounded_batches, checkpointed

# What stands between terms; one in so many parts; what is added to every count.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
ONE, ADDED = 1_000_000_000, 5


class Settings(NamedTuple):
    """``documents``: that a term must stand in, of its language; ``terms``: most ranks of the ``term`` part;
    ``held``: partial counts that a task holds at most; ``cells`` and ``sources``: of a shard at most;
    ``broadcast_rows``: up to here the groups are broadcast."""

    documents: int = 30
    terms: int = 50
    held: int = 1_000_000
    cells: int = 1 << 15
    sources: int = 512
    broadcast_rows: int = 100_000


COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("docs", pa.int64())]
)
_KEYS = ["lang", "source", "term"]
PARTIAL = ["lang", "one", "two", "value", "apart", "seen", "kept"]


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """The batch's counts of terms by language and source; the empty term stands for the group itself."""
    split = pc.split_pattern_regex(pc.ascii_lower(batch["text"]), pattern=BETWEEN)
    words = pc.list_flatten(split).dictionary_encode()
    groups = pa.Table.from_arrays([batch["lang"], batch["source"]], names=["lang", "source"])
    named = groups.append_column("row", pa.array(np.arange(batch.num_rows)))
    told = groups.group_by(["lang", "source"]).aggregate([])
    told = told.append_column("group", pa.array(np.arange(told.num_rows)))
    of_row = named.join(told, ["lang", "source"]).sort_by("row")["group"].combine_chunks()
    row = pc.list_parent_indices(split)
    by_doc = pa.table({"row": row, "code": words.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    by_doc = by_doc.append_column("group", of_row.take(by_doc["row"].combine_chunks()))
    found = by_doc.group_by(["group", "code"]).aggregate([("count_all", "sum"), ("count_all", "count")])
    group, code = found["group"].combine_chunks(), found["code"].combine_chunks()
    counts = pa.table(
        [
            told["lang"].combine_chunks().take(group),
            told["source"].combine_chunks().take(group),
            words.dictionary.take(code),
            found["count_all_sum"].combine_chunks().cast(pa.int64()),
            found["count_all_count"].combine_chunks().cast(pa.int64()),
        ],
        schema=COUNTS,
    )
    counts = counts.filter(pc.not_equal(counts["term"], ""))
    none = pa.array(np.zeros(told.num_rows, np.int64))
    empty = pa.array([""] * told.num_rows, pa.string())
    marks = pa.table([told["lang"].combine_chunks(), told["source"].combine_chunks(), empty, none, none], schema=COUNTS)
    return pa.concat_tables([counts, marks])


def _merged(tables: list[pa.Table]) -> pa.Table:
    added = pa.concat_tables(tables).group_by(_KEYS).aggregate([("count", "sum"), ("docs", "sum")])
    return added.rename_columns({"count_sum": "count", "docs_sum": "docs"}).select(COUNTS.names).cast(COUNTS)


def partial_counts(held: int):
    """A function of batches: counts of all the task has read, merged as often as ``held`` are waiting."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(_counted(batch))
                rows += waiting[-1].num_rows
            if rows > held:
                waiting = [_merged(waiting)]
                rows = waiting[0].num_rows
                if rows > held // 2:  # mostly new terms
                    yield from waiting[0].to_batches()
                    waiting, rows = [], 0
        if waiting:
            yield from _merged(waiting).to_batches()

    return count


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str, settings: Settings) -> DataFrame:
    """``lang, source, term, count, docs`` of every group and term; the empty term for every group."""
    text = lambda name: F.coalesce(named(name).cast("string"), F.lit(""))
    read = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    types = "lang string, source string, term string, count long, docs long"
    partial = read.mapInArrow(partial_counts(settings.held), types)
    return partial.groupBy(*_KEYS).agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """One and the share of a smoothed count, in parts of ``ONE``, rounded down; exact for any count."""
    smoothed = (count + F.lit(ADDED)).cast("decimal(20,0)") * F.lit(ONE).cast("decimal(10,0)")
    whole = F.call_function("div", smoothed, (total + F.lit(ADDED) * kept).cast("decimal(30,0)"))
    return F.lit(1).cast("long") + whole


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Divergences between the sources of every language: ``lang, source, part, item, value, rank``.

    Part ``pair`` has for every source each other source of its language and the sum over all kept terms of
    the difference of their shares; part ``term`` the terms that a source has more of than its language.
    Ranks are by value, then by item.

    NULL texts, languages and sources count as ''. A language without kept terms has pairs of value 0. Repeated
    rows are counted as often as they stand. Empty tables give no rows, other columns are ignored.

    Terms of a group are added up by tasks before they are shuffled, so frequent terms and large
    groups are a row a task. A shard has at most ``cells`` cells, or one block of sources.
    """
    bounded_batches(docs.sparkSession)
    of_term = Window.partitionBy("lang", "term")
    counts = (
        term_counts(docs, lang_col, source_col, text_col, settings)
        .withColumn("everywhere", F.sum("count").over(of_term))
        .withColumn("documents", F.sum("docs").over(of_term))
        .filter((F.col("documents") >= settings.documents) | (F.col("term") == ""))
        .select("lang", "source", "term", "count", "everywhere")
    )
    counts = checkpointed(counts)
    kept = counts.filter("term <> ''")
    groups = checkpointed(_groups(counts))
    small = F.broadcast if groups.count() <= settings.broadcast_rows else lambda df: df
    shared = kept.join(small(groups), ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("total"), F.col("kept")))

    over = F.col("p") - _share(F.col("everywhere"), F.col("of_lang"), F.col("kept"))
    terms = shared.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value"))
    pairs = _pairs(shared, groups, settings)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked(pairs).unionByName(ranked(terms.filter("value > 0")).filter(F.col("rank") <= settings.terms))


def _groups(counts: DataFrame) -> DataFrame:
    """``lang, source, place`` of every group, its ``total``, and the language's: ``of_lang, kept, sources``."""
    own = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    by_term = counts.groupBy("lang", "term").agg(F.first("everywhere").alias("everywhere"))
    lang = by_term.groupBy("lang").agg(
        F.sum("everywhere").alias("of_lang"), F.count_if(F.col("term") != "").alias("kept")
    )
    of_lang = Window.partitionBy("lang")
    return own.join(lang, "lang").select(
        "lang", "source", "total", "of_lang", "kept",
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("place"),
        F.count(F.lit(1)).over(of_lang).alias("sources"),
    )


def _pairs(shared: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """The sum of differences for every two sources of a language, from shards of its terms."""
    block = lambda n: F.floor(n / settings.sources).cast("int")
    blocks = block(F.col("sources") - 1) + 1
    least = F.least("sources", F.lit(settings.sources))
    # a shard gives sources x sources sums at most, so it has as many terms at least
    wide = F.greatest(F.floor(F.lit(settings.cells) / least), least)
    shards = F.greatest(F.ceil(F.col("kept") / wide), F.lit(1)).cast("int")
    mine = block(F.col("place"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    task = ["lang", "shard", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")]
    rows = shared.select(
        "lang", F.pmod(F.xxhash64("term"), shards).cast("int").alias("shard"), mine.alias("mine"), other, "place", "term", "p"
    ).select(*task, "place", "term", "p")
    none = _share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))
    base = (
        groups.select("lang", "source", "place", mine.alias("mine"), F.when(F.col("kept") > 0, none).otherwise(0).alias("p"), shards.alias("shards"), "kept", other)
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(*task, "source", "place", "p", "kept")
    )
    by = ["lang", "shard", "low", "high"]
    base = base.toDF(*(f"base_{name}" for name in base.columns))

    def diverge(rows: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        base = base.rename(columns=lambda name: name.removeprefix("base_")).sort_values("place", ignore_index=True)
        places, sources, none = (base[c].to_numpy() for c in ("place", "source", "p"))
        code, terms = pd.factorize(rows["term"])
        table = np.repeat(none[:, None], len(terms), axis=1)
        table[np.searchsorted(places, rows["place"].to_numpy()), code] = rows["p"].to_numpy()
        low, high = (places // settings.sources == base[end].iat[0] for end in ("low", "high"))
        left, right = np.flatnonzero(low), np.flatnonzero(high)
        found = []
        for i in left:
            at = right[right > i]
            sums = np.abs(table[at] - table[i]).sum(axis=1, dtype=np.int64)
            apart = np.abs(none[at] - none[i])
            found.append(pd.DataFrame({"one": sources[i], "two": sources[at], "value": sums, "apart": apart}))
        return pd.concat(found).assign(lang=base["lang"].iat[0], seen=len(terms), kept=base["kept"].iat[0])[PARTIAL]

    partial = rows.groupBy(*by).cogroup(base.groupBy(*(f"base_{name}" for name in by)))
    partial = partial.applyInPandas(diverge, "lang string, one string, two string, value long, apart long, seen long, kept long")
    # the sources of a shard are by as much apart in each term that none of them has
    rest = (F.max("kept") - F.sum("seen")) * F.max("apart")
    whole = partial.groupBy("lang", "one", "two").agg((F.sum("value") + rest).alias("value"))
    ways = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    return whole.select("lang", "value", ways.alias("way")).select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
