"""Differences of nearly equal tables, found by digests of buckets.

Both tables are dealt into buckets by a hash of some columns. A bucket's digest is the number of its
rows and sums of their hashes, which add up in any order: a task sends a digest per bucket, not its
rows. Only rows of buckets whose digests differ are shuffled and compared one by one, so what
goes over the wire follows the difference. The price is a second read of the tables, which
is why this is a form of its own and not the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from twinledger.functions.columns import all_named, named
from twinledger.functions.hashing import row_marks
from twinledger.operators import recon

#: Buckets of a digest, the bound of what is broadcast.
BUCKETS = 1 << 14
#: The low half of a 64-bit hash; sums of halves fit a bigint for two billion rows a bucket.
LOW = 0xFFFFFFFF


def bucket_of(df: DataFrame, columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(row_marks(df, columns)[0], F.lit(buckets)).cast("int")


def _marked(df: DataFrame, columns: Sequence[str], by: Sequence[str], buckets: int, sign: int) -> DataFrame:
    halves = [
        half * F.lit(sign)
        for mark in row_marks(df, columns)
        for half in (mark.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(mark, 32))
    ]
    none = F.lit(False)
    for name in by:
        none = none | named(name).isNull()
    return df.select(
        bucket_of(df, by, buckets).alias("bucket"),
        F.lit(sign).cast("bigint").alias("sign"),
        none.cast("bigint").alias("unkeyed"),
        *[half.alias(f"d{i}") for i, half in enumerate(halves)],
    )


def bucket_digests(
    baseline: DataFrame, candidate: DataFrame, columns: Sequence[str], by: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """One row per bucket of ``by`` (all columns by default): rows and unkeyed rows per side, and whether it is ``same``.

    Unkeyed rows have a NULL in one of the ``by`` columns.
    """
    by = list(by) or list(columns)
    names = list(dict.fromkeys([*by, *columns]))
    marked = _marked(baseline.select(*all_named(names)), names, by, buckets, 1).unionByName(
        _marked(candidate.select(*all_named(names)), names, by, buckets, -1)
    )
    one = F.col("sign") > 0
    sums = [F.sum(f"d{i}") for i in range(4)]
    same = F.sum("sign") == 0
    for total in sums:
        same = same & (total == 0)
    return marked.groupBy("bucket").agg(
        F.count_if(one).alias("prod_rows"),
        F.count_if(~one).alias("test_rows"),
        F.coalesce(F.sum(F.when(one, F.col("unkeyed"))), F.lit(0).cast("bigint")).alias("prod_unkeyed"),
        F.coalesce(F.sum(F.when(~one, F.col("unkeyed"))), F.lit(0).cast("bigint")).alias("test_unkeyed"),
        same.alias("same"),
    )


def in_buckets(df: DataFrame, by: Sequence[str], digests: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``df`` in buckets that differ; those are ``buckets`` numbers at most, so they are broadcast."""
    wanted = F.broadcast(digests.filter("NOT same").select(F.col("bucket").alias("_bucket")))
    return df.join(wanted, bucket_of(df, by, buckets) == F.col("_bucket"), "left_semi")


def difference_by_bucket(
    baseline: DataFrame, candidate: DataFrame, columns: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """The sizes of A-B and B-A as :func:`recon.symmetric_difference` gives them.

    Buckets are chosen by the whole row, so two buckets differ at most for a changed row.
    """
    sides = [side.select(*all_named(columns)) for side in (baseline, candidate)]
    digests = bucket_digests(*sides, columns, buckets=buckets)
    return recon.symmetric_difference(*(in_buckets(side, columns, digests, buckets) for side in sides), columns)


def rollup_by_bucket(
    baseline: DataFrame, candidate: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """:func:`recon.flag_rollup` of two fingerprinted sides whose keys are unique.

    In a bucket of equal digests every row matches its like, and rows with a NULL in their key match
    nothing, as in a join. Keys that repeat on a side are compared exactly in buckets that
    differ; in equal ones their pairs are not counted, so look at ``duplicate_keys`` first
    where a table has no primary key.
    """
    digests = bucket_digests(baseline, candidate, [*keys, "md5_col"], keys, buckets)
    total = lambda column: F.coalesce(F.sum(column), F.lit(0).cast("bigint")).cast(recon.WIDE)
    amounts = {
        recon.MATCHING: total(F.col("prod_rows") - F.col("prod_unkeyed")),
        recon.MISSING_FROM_TEST: total(F.col("prod_unkeyed")),
        recon.MISSING_FROM_PROD: total(F.col("test_unkeyed")),
    }
    entries = [F.struct(F.lit(flag).alias("dq_flag"), n.alias("row_count")) for flag, n in amounts.items()]
    equal = digests.filter("same").agg(F.array(*entries).alias("_e")).select(F.explode("_e").alias("_e")).select("_e.*")
    rest = recon.flag_rollup(*(in_buckets(side, keys, digests, buckets) for side in (baseline, candidate)), keys)
    return (
        equal.unionByName(rest)
        .groupBy("dq_flag")
        .agg(F.sum("row_count").cast(recon.WIDE).alias("row_count"))
        .filter("row_count > 0")
    )
