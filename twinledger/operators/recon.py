"""Row reconciliation: the full outer join of two fingerprinted tables.

The result of that join is only ever read as join keys plus a flag, and a key
with ``p`` rows on one side and ``t`` on the other gives ``p * t`` rows that
differ in nothing but the flag. So the join is not run as a join. Both sides
are counted per (keys, fingerprint), the counts are added up per key, and the
number of matching and differing pairs follows from them:

* pairs = p * t, matching pairs = the sum over fingerprints of p_h * t_h;
* a key with NULL in it matches nothing, as in a join.

Rows are dealt by their keys once, and both groupings run on that one exchange: keys and
the 16 bytes of an MD5 go over the wire. A key that holds more rows than a task should
get is found in a sample of the keys beforehand. The rows of such hot keys are
counted per (keys, fingerprint) where they are read, and their counts are dealt, in a branch of its own that
nothing runs where no key is hot. No pair is ever built.

Pair counts are ``decimal(38,0)``: a hot key may well exceed a bigint. The
products that fit are computed as bigints, which is all of them for ordinary
keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinledger.functions.columns import all_named, named
from twinledger.functions.hashing import row_hash, row_marks
from twinledger.operators.counts import BASELINE_ENV, CANDIDATE_ENV

# The flags, in the order they are tested.
MISSING_FROM_PROD = "MISSING FROM PROD"
MISSING_FROM_TEST = "MISSING FROM TEST"
NOT_MATCHING = "NOT MATCHING"
MATCHING = "MATCHING"
UNKNOWN = "WHAT??"
FLAGS = (MISSING_FROM_PROD, MISSING_FROM_TEST, NOT_MATCHING, MATCHING, UNKNOWN)
MISMATCHES = (MISSING_FROM_TEST, MISSING_FROM_PROD, NOT_MATCHING)

SAMPLE_ROWS = 10
# Spark's default limit of a window that keeps the first rows of each task
# (spark.sql.optimizer.windowGroupLimitThreshold).
WINDOW_ROWS = 1000
WIDE = "decimal(38,0)"
#: Counts the rows of both sides per key, as :func:`key_counts` does.
Count = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]
# Products of two counts up to this size, and sums of them, fit a bigint.
SMALL = 65535
# Rows of a key that are too many for one task, the most keys treated so (each other one has
# less than that part of all rows), and the part of the rows that is looked at to find them.
HOT_ROWS, HOT_KEYS, SAMPLED, HOT_SEED = 1 << 20, 10_000, 1 / 64, 11


def fingerprint(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], mode: str = "safe"
) -> DataFrame:
    """``keys`` and ``md5_col`` over ``columns``; nothing else is read."""
    return df.select(*all_named(keys), row_hash(df, columns, mode).alias("md5_col"))


def _sided(df: DataFrame, keys: Sequence[str], p: int, t: int, *more: Column) -> DataFrame:
    return df.select(
        *all_named(keys),
        F.lit(p).cast("bigint").alias("_p"),
        F.lit(t).cast("bigint").alias("_t"),
        *more,
    )


def _signed(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    mark = F.unhex("md5_col").alias("_h")
    return _sided(baseline, keys, 1, 0, mark).unionByName(_sided(candidate, keys, 0, 1, mark))


def hash_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per side for each (keys, fingerprint); fingerprints as the 16 bytes of the MD5."""
    return rows.groupBy(*all_named(keys), "_h").agg(F.sum("_p").alias("_p"), F.sum("_t").alias("_t"))


def hot_keys(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys of about ``HOT_ROWS`` rows or more, at most ``HOT_KEYS`` of them, as ``_k0``, ``_k1``, ...; None if there are none.

    Runs a job on a sample of the keys alone. A wrong estimate costs time, never a row.
    """
    both = baseline.select(*all_named(keys)).unionByName(candidate.select(*all_named(keys)))
    counted = both.sample(SAMPLED, HOT_SEED).groupBy(*all_named(keys)).agg(F.count(F.lit(1)).alias("_n"))
    hot = counted.filter(F.col("_n") >= HOT_ROWS * SAMPLED).orderBy(F.desc("_n")).limit(HOT_KEYS)
    hot = hot.select(*[named(key).alias(f"_k{i}") for i, key in enumerate(keys)])
    found = hot.collect()
    return baseline.sparkSession.createDataFrame(found, hot.schema) if found else None


def key_rows(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the rows of each side; reads the keys only."""
    return (
        _sided(baseline, keys, 1, 0)
        .unionByName(_sided(candidate, keys, 0, 1))
        .groupBy(*all_named(keys))
        .agg(F.sum("_p").alias("prod_rows"), F.sum("_t").alias("test_rows"))
    )


def _product(p: Column, t: Column) -> tuple[Column, Column]:
    """``p * t`` as a bigint where both are small, else as a decimal."""
    small = (p <= SMALL) & (t <= SMALL)
    large = p.cast("decimal(19,0)") * t.cast("decimal(19,0)")
    return F.when(small, p * t), F.when(~small, large)


def _whole(small: Column, large: Column) -> Column:
    """The two parts of a product as one decimal."""
    zero = F.lit(0).cast(WIDE)
    return (F.coalesce(small.cast(WIDE), zero) + F.coalesce(large.cast(WIDE), zero)).cast(WIDE)


def _per_key(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    small, large = _product(F.col("_p"), F.col("_t"))
    return counts.groupBy(*all_named(keys)).agg(
        F.sum("_p").alias("prod_rows"),
        F.sum("_t").alias("test_rows"),
        F.sum(small).alias("_match_small"),
        F.sum(large).alias("_match_large"),
    )


def key_counts(
    baseline: DataFrame,
    candidate: DataFrame,
    keys: Sequence[str],
    find: Callable[[], DataFrame | None] | None = None,
) -> DataFrame:
    """One row per key: rows on each side and matching pairs in two parts.

    ``find`` gives the hot keys where they are known already; else they are looked for.
    """
    sides = (baseline, candidate)
    hot = find() if find else hot_keys(*sides, keys)
    if hot is None:
        return _per_key(hash_counts(_signed(*sides, keys).repartition(*all_named(keys)), keys), keys)
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & named(key).eqNullSafe(F.col(f"_k{i}"))
    cold, spread = (
        _signed(*(side.join(F.broadcast(hot), same, how) for side in sides), keys) for how in ("left_anti", "left_semi")
    )
    dealt = _per_key(hash_counts(cold.repartition(*all_named(keys)), keys), keys)
    return dealt.unionByName(_per_key(hash_counts(spread, keys), keys))


def _one_side(side: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return side.groupBy(*all_named(keys)).agg(
        F.count(F.lit(1)).alias(f"{name}_rows"), F.min("md5_col").alias(f"_{name}_low"), F.max("md5_col").alias(f"_{name}_high")
    )


def stored_keys(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key's rows and its least and greatest fingerprint on each side; sides stored by ``keys`` are not shuffled."""
    return _one_side(baseline, keys, "prod").join(_one_side(candidate, keys, "test"), list(keys), "full_outer")


def stored_counts(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What :func:`key_counts` gives, of fingerprinted sides that are stored by ``keys``.

    A key whose rows are alike on each side is settled where it lies. Only rows of keys with
    differing rows on a side and some on the other are counted by an exchange.
    """
    met = stored_keys(baseline, candidate, keys)
    unlike = (F.col("_prod_low") != F.col("_prod_high")) | (F.col("_test_low") != F.col("_test_high"))
    mixed = F.coalesce(unlike & F.col("prod_rows").isNotNull() & F.col("test_rows").isNotNull(), F.lit(False))
    p, t = (F.coalesce(name, F.lit(0).cast("bigint")) for name in ("prod_rows", "test_rows"))
    same = F.coalesce(F.col("_prod_low") == F.col("_test_low"), F.lit(False))
    small, large = _product(p, t)
    settled = met.filter(~mixed).select(
        *all_named(keys),
        p.alias("prod_rows"),
        t.alias("test_rows"),
        F.when(same, small).otherwise(F.lit(0).cast("bigint")).alias("_match_small"),
        F.when(same, large).alias("_match_large"),
    )
    rest = met.filter(mixed).select(*all_named(keys))
    sides = [side.join(rest, list(keys), "left_semi") for side in (baseline, candidate)]
    return settled.unionByName(_per_key(hash_counts(_signed(*sides, keys), keys), keys))


def _no_null(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & named(key).isNotNull()
    return condition


def _pairs(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and pairs of each key from its counts."""
    both = _no_null(keys) & (F.col("prod_rows") > 0) & (F.col("test_rows") > 0)
    pairs = _whole(*_product(F.col("prod_rows"), F.col("test_rows")))
    matched = _whole(F.col("_match_small"), F.col("_match_large"))
    zero = F.lit(0).cast(WIDE)
    return counts.select(
        *all_named(keys),
        "prod_rows",
        "test_rows",
        F.when(both, matched).otherwise(zero).alias("matching_pairs"),
        F.when(both, pairs - matched).otherwise(zero).cast(WIDE).alias("differing_pairs"),
    )


def full_outer(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str], count: Count = key_counts) -> DataFrame:
    """The full outer join, one row per key with its rows and pairs."""
    return _pairs(count(baseline, candidate, keys), keys)


def flag_rows(
    baseline: DataFrame,
    candidate: DataFrame,
    keys: Sequence[str],
    flags: Sequence[str] = FLAGS,
    count: Count = key_counts,
) -> DataFrame:
    """(keys, ``dq_flag``, ``row_count``): every joined row, equal ones counted.

    Without MATCHING among the ``flags``, keys with one matching row a side,
    which is most of them, are dropped before anything is made of them. Flags
    of missing rows alone need no fingerprint, and none is computed.
    """
    if set(flags) <= {MISSING_FROM_PROD, MISSING_FROM_TEST}:
        none = F.lit(None).cast("bigint")
        counts = key_rows(baseline, candidate, keys).withColumns(
            {"_match_small": none, "_match_large": none}
        )
    else:
        counts = count(baseline, candidate, keys)
    if MATCHING not in flags:
        single = (F.col("prod_rows") == 1) & (F.col("test_rows") == 1)
        same = F.coalesce(F.col("_match_small") == 1, F.lit(False))
        counts = counts.filter(~(_no_null(keys) & single & same))
    null_key = ~_no_null(keys)
    alone_p = null_key | (F.col("test_rows") == 0)
    alone_t = null_key | (F.col("prod_rows") == 0)
    zero = F.lit(0).cast(WIDE)
    amounts = {
        MISSING_FROM_PROD: F.when(alone_t, F.col("test_rows").cast(WIDE)).otherwise(zero),
        MISSING_FROM_TEST: F.when(alone_p, F.col("prod_rows").cast(WIDE)).otherwise(zero),
        NOT_MATCHING: F.col("differing_pairs"),
        MATCHING: F.col("matching_pairs"),
    }
    entries = F.array(
        *[
            F.struct(F.lit(flag).alias("dq_flag"), amount.alias("row_count"))
            for flag, amount in amounts.items()
            if flag in flags
        ]
    )
    return (
        _pairs(counts, keys)
        .select(*all_named(keys), F.explode(entries).alias("_e"))
        .select(*all_named(keys), "_e.dq_flag", "_e.row_count")
        .filter(F.col("row_count") > 0)
    )


def flag_rollup(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str], count: Count = key_counts) -> DataFrame:
    """Joined rows per flag; flags that do not occur are left out."""
    p, t = F.col("prod_rows"), F.col("test_rows")
    keyed = _no_null(keys)
    both = keyed & (p > 0) & (t > 0)
    pair_small, pair_large = _product(p, t)

    def total(small: Column, large: Column) -> Column:
        return _whole(F.sum(F.when(both, small)), F.sum(F.when(both, large)))

    totals = count(baseline, candidate, keys).agg(
        F.sum(F.when(~keyed | (p == 0), t)).cast(WIDE).alias("_no_prod"),
        F.sum(F.when(~keyed | (t == 0), p)).cast(WIDE).alias("_no_test"),
        total(pair_small, pair_large).alias("_pairs"),
        total(F.col("_match_small"), F.col("_match_large")).alias("_matched"),
    )
    amounts = (
        (MISSING_FROM_PROD, F.col("_no_prod")),
        (MISSING_FROM_TEST, F.col("_no_test")),
        (NOT_MATCHING, (F.col("_pairs") - F.col("_matched")).cast(WIDE)),
        (MATCHING, F.col("_matched")),
    )
    entries = F.array(
        *[
            F.struct(F.lit(flag).alias("dq_flag"), amount.alias("row_count"))
            for flag, amount in amounts
        ]
    )
    return (
        totals.select(F.explode(entries).alias("_e")).select("_e.*").filter(F.col("row_count") > 0)
    )


def _sample_keys(rows: DataFrame) -> list[str]:
    return [name for name in rows.columns if name not in ("dq_flag", "row_count")]


def _spread(rows: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Counted rows as single rows again, at most ``n`` of each."""
    times = F.least(F.col("row_count"), F.lit(n).cast(WIDE)).cast("int")
    copies = F.explode(F.sequence(F.lit(1), times)).alias("_copy")
    return rows.select(*all_named(keys), "dq_flag", copies).drop("_copy")


def sample_rows(rows: DataFrame, flag: str, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` joined rows of a flag by key, equal rows repeated.

    An ordered limit: each task keeps ``n`` rows, whatever ``n`` is.
    """
    keys = _sample_keys(rows)
    order = [named(key).asc_nulls_first() for key in keys]
    first = rows.filter(F.col("dq_flag") == flag).orderBy(*order).limit(n)
    return _spread(first, keys, n).orderBy(*order).limit(n)


def mismatch_samples(rows: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The samples of all three mismatches; they share the exchange of ``rows``."""
    return reduce(DataFrame.unionByName, [sample_rows(rows, flag, n) for flag in MISMATCHES])


def samples_in_one_pass(rows: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """What :func:`mismatch_samples` gives, reading ``rows`` once.

    Each task keeps the first ``n`` rows of each flag before they meet. Spark's windows do that up to
    ``WINDOW_ROWS``; beyond it each flag has an ordered limit of its own.
    """
    if n > WINDOW_ROWS:
        return mismatch_samples(rows, n)
    keys = _sample_keys(rows)
    order = Window.partitionBy("dq_flag").orderBy(*[named(key).asc_nulls_first() for key in keys])

    def first(some: DataFrame) -> DataFrame:
        return some.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= n).drop("_at")

    return first(_spread(first(rows.filter(F.col("dq_flag").isin(*MISMATCHES))), keys, n))


def duplicate_keys(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per side: keys held by more than one row, and the rows beyond the first."""

    def side(name: str, env: str) -> Column:
        rows = F.col(name)
        many = _no_null(keys) & (rows > 1)
        return F.struct(
            F.lit(env).alias("env"),
            F.count(F.when(many, 1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(many, rows - 1)), F.lit(0).cast("bigint")).alias("extra_rows"),
        )

    sides = F.array(side("prod_rows", BASELINE_ENV), side("test_rows", CANDIDATE_ENV))
    return (
        key_rows(baseline, candidate, keys)
        .agg(sides.alias("_sides"))
        .select(F.explode("_sides").alias("_s"))
        .select("_s.*")
    )


def symmetric_difference(
    baseline: DataFrame,
    candidate: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Size of A-B and of B-A as multisets, per ``by`` group if given.

    Equal rows are netted in one grouping by their fingerprint, so that rows of
    any width shuffle 16 bytes: +1 for the baseline, -1 for the candidate. What
    is left above zero is A-B, below zero B-A.
    """
    names = list(dict.fromkeys([*by, *columns]))
    signed = baseline.select(*all_named(names), F.lit(1).cast("bigint").alias("_n")).unionByName(
        candidate.select(*all_named(names), F.lit(-1).cast("bigint").alias("_n"))
    )
    marks = [mark.alias(f"_hash{i}") for i, mark in enumerate(row_marks(signed, names))]
    marked = signed.select(*all_named(by), *marks, "_n")
    net = marked.groupBy(*all_named(by), "_hash0", "_hash1").agg(F.sum("_n").alias("_n"))

    def surplus(n: Column) -> Column:
        return F.coalesce(F.sum(F.when(n > 0, n)), F.lit(0).cast("bigint"))

    return net.groupBy(*all_named(by)).agg(
        surplus(F.col("_n")).alias("baseline_minus_candidate"),
        surplus(-F.col("_n")).alias("candidate_minus_baseline"),
    )
