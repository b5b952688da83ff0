"""Mapping, naming and matching of names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinledger.functions.columns import all_named
from twinledger.functions.text import TOKEN_MARK, abbreviation_base, has_token


@dataclass(frozen=True)
class Rule:
    """If a value contains ``find``: write ``new`` over it or over the find.

    ``where`` narrows the rule to some rows.
    """

    find: str
    new: str
    whole: bool = False
    where: Column | None = None


def map_first_match(
    value: Column, rules: Sequence[Rule], otherwise: Column | None = None
) -> Column:
    """The first rule that fits decides; values with a token stay.

    Rule lists are written by hand and short, so they become one CASE and need
    no join. A rule that an earlier, shorter ``find`` shadows never fires.
    """
    result = F.when(has_token(value, TOKEN_MARK), value)
    for rule in rules:
        hit = value.contains(rule.find)
        if rule.where is not None:
            hit = hit & rule.where
        new = F.lit(rule.new)
        result = result.when(hit, new if rule.whole else F.replace(value, F.lit(rule.find), new))
    return result.otherwise(value if otherwise is None else otherwise)


def replace_head(value: Column, token: str, before: str = ".") -> Column:
    """Every occurrence of the part before the first ``before`` as ``token``."""
    head = F.substring_index(value, before, 1)
    return F.when(value.contains(before), F.replace(value, head, F.lit(token))).otherwise(value)


def route_by_type(kind: Column, routes: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Name of the first route whose list holds ``kind``; NULL if none does."""
    result = None
    for name, kinds in routes:
        hit = kind.isin(*kinds)
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return F.lit(None).cast("string") if result is None else result


def bucket_digits(df: DataFrame) -> Column:
    """Hex digits of a bucket, so that buckets are about the square root of the rows."""
    digits = F.ceil(F.log2(F.count(F.lit(1)) + 1) / 8).cast("int")
    return df.agg(F.greatest(digits, F.lit(1))).scalar()


def rank_in_group(
    df: DataFrame, group: Sequence[str], name: str, rank: str, digits: Column | None = None
) -> DataFrame:
    """Number the distinct ``name`` values of each group by their MD5.

    A window over the group would put a hot group into one task. The MD5 cuts
    each group into buckets in rank order: rows are numbered within their bucket
    and the sizes of the earlier buckets are added. There are about as many
    buckets as the square root of the rows, so that neither a bucket nor a
    group's list of buckets grows with more than that. ``digits`` may come from a
    table that is cheaper to count.
    """
    digits = bucket_digits(df) if digits is None else digits
    hashed = df.withColumn("_order", F.md5(name)).withColumn(
        "_bucket", F.substring("_order", 1, digits)
    )
    cells = [*group, "_bucket"]
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        hashed.groupBy(*cells)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    within = Window.partitionBy(*cells).orderBy("_order", name)
    return (
        hashed.withColumn("_within", F.row_number().over(within))
        .join(offsets, cells)
        .withColumn(rank, F.col("_before") + F.col("_within"))
        .drop("_order", "_bucket", "_before", "_within")
    )


def _settled(proposed: DataFrame, taken: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Proposals that are free and first of their text, and the others."""
    best = proposed.groupBy("_text").agg(F.min(F.struct(F.md5(name), name))[name].alias("_best"))
    free = best.join(taken.select(F.col("abbreviation").alias("_text")), "_text", "left_anti")
    marked = proposed.join(free, "_text", "left")
    won = F.col(name).eqNullSafe(F.col("_best"))
    return (
        marked.filter(won).select(name, "base", F.col("_text").alias("abbreviation")),
        marked.filter(~won).select(name, "base", "_text"),
    )


def abbreviate(
    names: DataFrame, name: str = "name", existing: DataFrame | None = None
) -> DataFrame:
    """(``name``, ``base``, ``abbreviation``) for every distinct name, all different.

    The first name of a base is given the base, later ones the base and their own
    last three characters. Of names that are given the same text, whatever their
    base, the first keeps it, unless it is among the ``abbreviation`` values of
    ``existing``; the others get it with their number, and where that is
    taken too, with the MD5 of the name. First and later go by MD5, a fixed order
    that does not depend on how the names arrive. NULL is no name.
    """
    present = names.select(F.col(name), abbreviation_base(F.col(name)).alias("base")).filter(F.col(name).isNotNull())
    if existing is None:
        existing = names.sparkSession.createDataFrame([], "abbreviation string")
    used = existing.select("abbreviation")
    firsts = present.groupBy("base").agg(F.min(F.struct(F.md5(name), name))[name].alias("_first"))
    longer = F.concat("base", F.right(name, F.lit(3)))
    text = F.when(F.col(name) == F.col("_first"), F.col("base")).otherwise(longer)
    proposed = present.distinct().join(firsts, "base").select(name, "base", text.alias("_text"))
    given, rest = _settled(proposed, used, name)
    placed = rank_in_group(rest, ["_text"], name, "_place", bucket_digits(names))
    counted = placed.select(name, "base", F.concat("_text", F.col("_place").cast("string")).alias("_text"))
    numbered, rest = _settled(counted, used.unionByName(given.select("abbreviation")), name)
    hashed = rest.select(name, "base", F.concat("_text", F.lit("-"), F.md5(name)).alias("abbreviation"))
    return given.unionByName(numbered).unionByName(hashed)


#: Starts of pieces in a part of a name.
PART = 1024


def contained(
    needles: DataFrame, needle: str, names: DataFrame, name: str, fold: Callable[[Column], Column] = lambda text: text
) -> DataFrame:
    """(``_needle``, ``name``): each distinct folded needle with each distinct name that, folded, contains it.

    Containment starts from an equality: a needle is keyed by its longest prefix
    whose length is a power of two, names are cut into their pieces of those
    lengths, of which there are few however many needles there are, and pieces
    that are no key are dropped by a semi join. Pieces and names are 64-bit hashes there: a piece is a
    few bytes however long its name is. What meets finds its name again and is then
    verified. NULL is in nothing and contains nothing.
    """
    size = F.length("_needle")
    power = F.pow(F.lit(2), F.floor(F.log2(F.greatest(size, F.lit(1))))).cast("int")
    keyed = (
        needles.select(fold(F.col(needle)).alias("_needle"))
        .filter(F.col("_needle").isNotNull())
        .distinct()
        .withColumn("_start", F.substring("_needle", F.lit(1), F.least(size, power)))
        .select("_needle", F.length("_start").alias("_size"), F.xxhash64("_start").alias("_piece"))
    )
    lengths = keyed.agg(F.collect_set("_size").alias("_lengths")).scalar()
    last = F.when(F.col("_size") == 0, 1).otherwise(F.length("_text") - F.col("_size") + 1)
    told = [F.xxhash64(F.lit(seed), name).alias(f"_name{seed}") for seed in (1, 2)]
    piece = lambda at: F.xxhash64(F.substring(F.col("_part"), at, F.col("_size")))
    # characters are counted from the start of a part, not of a name
    part = F.substring("_text", F.col("_at") + 1, F.lit(PART - 1) + F.col("_size")).alias("_part")
    starts = F.least(F.col("_last") - F.col("_at"), F.lit(PART)).alias("_starts")
    pieces = (
        names.select(*told, fold(F.col(name)).alias("_text"))
        .select("_name1", "_name2", "_text", F.explode(lengths).alias("_size"))
        .withColumn("_last", last)
        .filter("_last >= 1")
        .withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_last") - 1, F.lit(PART))))
        .select("_name1", "_name2", "_size", part, starts)
        .select("_name1", "_name2", "_size", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), "_starts"), piece))).alias("_piece"))
    )
    met = pieces.join(keyed.select("_size", "_piece").distinct(), ["_size", "_piece"], "left_semi").distinct()
    return (
        met.join(keyed, ["_size", "_piece"])
        .select("_name1", "_name2", "_needle")
        .distinct()
        .join(names.select(name, *told).distinct(), ["_name1", "_name2"])
        .filter(fold(F.col(name)).contains(F.col("_needle")))
    )


def slug_match(needles: DataFrame, names: DataFrame, needle: str, name: str) -> DataFrame:
    """For each needle the first name (by text) that contains it, and how many do. Letter case does not count."""
    wanted = needles.select(needle, F.lower(needle).alias("_needle")).distinct()
    found = (
        contained(wanted, "_needle", names, name, F.lower)
        .groupBy("_needle")
        .agg(F.min(name).alias(name), F.count_distinct(F.col(name)).alias("matches"))
    )
    return wanted.join(found, "_needle", "left").select(
        needle, name, F.coalesce("matches", F.lit(0).cast("bigint")).alias("matches")
    )


def map_by_rules(df: DataFrame, value: str, rules: DataFrame, mapped: str = "mapped") -> DataFrame:
    """``df`` with ``mapped``: what :func:`map_first_match` gives, for rules that are a table of any size.

    ``rules`` has (priority, find, new, whole); of those that are in a value the one of the least priority decides, of
    equal priorities the least ``find``. NULL finds fit nothing, a NULL ``new`` makes the value NULL. Distinct
    values meet the rules by :func:`contained` and each keeps its best one, so neither the size of the plan nor
    the rows that are shuffled grow with values times rules.
    """
    rule = F.struct("priority", "find", "new", "whole")
    best = rules.filter(F.col("find").isNotNull()).groupBy(F.col("find").alias("_needle")).agg(F.min(rule).alias("_rule"))
    values = df.select(F.col(value).alias("_value")).filter(~has_token(F.col(value), TOKEN_MARK)).distinct()
    fitting = (
        contained(best, "_needle", values, "_value")
        .join(best, "_needle")
        .groupBy("_value")
        .agg(F.min("_rule").alias("_rule"))
    )
    found = F.col("_rule")
    new = F.when(found["whole"], found["new"]).otherwise(F.replace(F.col(value), found["find"], found["new"]))
    joined = df.join(fitting, F.col(value) == F.col("_value"), "left")
    return joined.select(*all_named(df.columns), F.when(found.isNotNull(), new).otherwise(F.col(value)).alias(mapped))
