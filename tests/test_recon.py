"""The reconciliation against a join done by hand, and its quirks."""

import random
import json
from collections import Counter
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T
from twinledger import reconcile
from twinledger.functions import hashing
from twinledger.operators import digest, recon
from twinledger.operators.scope import FULL, changed_since, choose_scope, snapshot

SCHEMA = "k1 int, k2 string, a int, b string"


def by_hand(prod, test):
    """Joined rows as a multiset of (keys, flag); NULL keys match nothing."""
    result, matched = Counter(), set()
    for p in prod:
        found = False
        for j, t in enumerate(test):
            if None not in p[:2] and p[:2] == t[:2]:
                found = True
                matched.add(j)
                flag = recon.MATCHING if p == t else recon.NOT_MATCHING
                result[(*p[:2], flag)] += 1
        if not found:
            result[(*p[:2], recon.MISSING_FROM_TEST)] += 1
    for j, t in enumerate(test):
        if j not in matched:
            result[(*t[:2], recon.MISSING_FROM_PROD)] += 1
    return result


def random_rows(seed, n):
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, 1, 1, 1, 2, 3]),
            rng.choice([None, "x", "x", "y"]),
            rng.choice([None, 1, 2]),
            rng.choice([None, "", "1", "N"]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "seed, small, hot", [(0, recon.SMALL, 9), (1, recon.SMALL, 1), (2, 2, 4), (3, 2, recon.HOT_ROWS)]
)
def test_same_as_join(spark, monkeypatch, seed, small, hot):
    """Also with hardly any product counted as small, for the decimal branch, and with some or all keys hot."""
    monkeypatch.setattr(recon, "SMALL", small)
    monkeypatch.setattr(recon, "HOT_ROWS", hot)
    monkeypatch.setattr(recon, "SAMPLED", 1.0)
    prod, test = random_rows(seed, 40), random_rows(seed + 100, 30)
    result = reconcile(
        spark.createDataFrame(prod, SCHEMA), spark.createDataFrame(test, SCHEMA), "k1, k2"
    )
    expected = by_hand(prod, test)
    found = {tuple(row[:3]): int(row[3]) for row in rows(result.rows)}
    assert found == dict(expected)
    rollup = Counter()
    for key, count in expected.items():
        rollup[key[2]] += count
    assert {flag: int(n) for flag, n in rows(result.rollup)} == dict(rollup)
    stored = result.stored(3)
    assert {flag: int(n) for flag, n in rows(stored.rollup)} == dict(rollup)
    assert {tuple(row[:3]): int(row[3]) for row in rows(stored.rows)} == dict(expected)
    report = result.report().collect()
    for flag in recon.MISMATCHES:
        items = [json.dumps(dict(zip(("k1", "k2"), key)), separators=(",", ":")) for key in first(expected, flag)]
        assert sorted(r["item"] for r in report if r["section"] == f"sample {flag}") == sorted(items)


def first(expected, flag, n=10):
    """The first joined rows of a flag in key order, NULL before anything."""

    def order(key):
        return tuple((part is not None, part) if part is not None else (False,) for part in key[:2])

    return sorted((key for key in expected.elements() if key[2] == flag), key=order)[:n]


def test_hot_keys_are_found(spark, monkeypatch):
    monkeypatch.setattr(recon, "HOT_ROWS", 1000)
    base = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    assert recon.hot_keys(base, base.filter("false"), ["k"]).collect() == [(None,)]
    assert recon.hot_keys(base.filter("k IS NOT NULL"), base.filter("false"), ["k"]) is None
    result = reconcile(base, base.withColumn("v", F.col("v") + F.col("v") % 2), "k")
    assert {flag: int(n) for flag, n in rows(result.rollup)} == {
        recon.MISSING_FROM_PROD: 2000, recon.MISSING_FROM_TEST: 2000, recon.MATCHING: 2000, recon.NOT_MATCHING: 2000
    }


@pytest.mark.parametrize("flag", recon.MISMATCHES)
def test_samples_are_the_first_rows(spark, flag):
    prod, test = random_rows(7, 40), random_rows(107, 30)
    result = reconcile(
        spark.createDataFrame(prod, SCHEMA), spark.createDataFrame(test, SCHEMA), "k1, k2"
    )
    found = [tuple(row) for row in result.samples(flag).collect()]
    assert found == first(by_hand(prod, test), flag)


def test_counts_beyond_bigint(spark):
    """Pair counts of a hot key multiply without overflow."""
    keyed = spark.range(1).select(
        F.lit(10**15).alias("prod_rows"), F.lit(10**14).alias("test_rows")
    )
    small, large = recon._product(F.col("prod_rows"), F.col("test_rows"))
    assert keyed.select(recon._whole(small, large)).first()[0] == Decimal(10) ** 29


def fixture(spark):
    base = spark.range(200).select(
        F.col("id").alias("k"),
        (F.col("id") % 7).cast("int").alias("a"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit(" v"), "id")).alias("b"),
    )
    changed = base.filter("k % 10 <> 3").withColumn(
        "a", F.when(F.col("k") % 11 == 0, F.col("a") + 1).otherwise(F.col("a"))
    )
    return base, changed.union(changed.limit(5).withColumn("k", F.col("k") + 1000))


def flags(df):
    return {flag: int(n) for flag, n in rows(df)}


@pytest.mark.parametrize("mode", hashing.MODES)
def test_self_compare_only_matches(spark, mode):
    base, _ = fixture(spark)
    assert flags(reconcile(base, base, "k", mode=mode).rollup) == {recon.MATCHING: 200}


def test_swap_swaps_missing(spark):
    base, other = fixture(spark)
    one, two = (flags(reconcile(*sides, "k").rollup) for sides in ((base, other), (other, base)))
    assert one[recon.MISSING_FROM_PROD] == two[recon.MISSING_FROM_TEST]
    assert one[recon.MISSING_FROM_TEST] == two[recon.MISSING_FROM_PROD]
    assert one[recon.NOT_MATCHING] == two[recon.NOT_MATCHING]


def test_rollup_sums_to_rows(spark):
    result = reconcile(*fixture(spark), "k")
    assert sum(flags(result.rollup).values()) == result.rows.agg(F.sum("row_count")).first()[0]
    assert recon.UNKNOWN not in flags(result.rollup)


def test_written_rows(spark):
    result = reconcile(*fixture(spark), "k")
    assert rows(result.report(rows=result.written_rows())) == rows(result.report())


def two_rows(spark, first, second, schema="k int, a string, b string"):
    return spark.createDataFrame([first], schema), spark.createDataFrame([second], schema)


def test_compat_keeps_collisions_and_safe_has_none(spark):
    moved = two_rows(spark, (1, "ab", "c"), (1, "a", "bc"))
    null = two_rows(spark, (1, None, "c"), (1, "-1", "c"))
    blank = two_rows(spark, (1, "a ", "c"), (1, "a", "c"))
    for sides in (moved, null, blank):
        assert flags(reconcile(*sides, "k", mode="compat").rollup) == {recon.MATCHING: 1}
        assert flags(reconcile(*sides, "k", mode="safe").rollup) == {recon.NOT_MATCHING: 1}


@pytest.mark.parametrize("mode", hashing.MODES)
def test_every_type_survives_null(spark, mode):
    schema = T.StructType(
        [
            T.StructField("k", T.IntegerType()),
            T.StructField("flag", T.BooleanType()),
            T.StructField("ratio", T.DoubleType()),
            T.StructField("at", T.TimestampType()),
            T.StructField("raw", T.BinaryType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
            T.StructField("props", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("fraction", T.DecimalType(2, 2)),
            T.StructField("whole", T.DecimalType(38, 0)),
            T.StructField("deep", T.DecimalType(38, 38)),
        ]
    )
    df = spark.createDataFrame([(1,) + (None,) * 9, (None,) * 10], schema)
    hashes = df.select(hashing.row_hash(df, df.columns, mode).alias("h"))
    assert hashes.filter("h is null").count() == 0
    assert flags(reconcile(df, df, "k", mode=mode).rollup) == {
        recon.MATCHING: 1, recon.MISSING_FROM_PROD: 1, recon.MISSING_FROM_TEST: 1,
    }


def test_map_order_does_not_count(spark):
    one = spark.sql("select 1 k, map('a', 1, 'b', 2) m")
    two = spark.sql("select 1 k, map('b', 2, 'a', 1) m")
    assert flags(reconcile(one, two, "k").rollup) == {recon.MATCHING: 1}


def test_excluded_columns_leave_the_hash(spark):
    sides = two_rows(spark, (1, "a", "x"), (1, "a", "y"))
    assert flags(reconcile(*sides, " k ", exclude="b , nothing").rollup) == {recon.MATCHING: 1}


def test_audit_columns_leave_the_hash_wherever_they_stand(spark):
    base = spark.sql("select date'2020-01-01' dw_creation_date, 1 k, 'a' a, timestamp_ntz'2020-01-01' dw_last_updated")
    other = spark.sql("select date'2021-01-01' dw_creation_date, 1 k, 'a' a, timestamp_ntz'2021-01-01' dw_last_updated")
    assert flags(reconcile(base, other, "k", scope=FULL).rollup) == {recon.MATCHING: 1}


def test_compares_without_region(spark):
    report = reconcile(*fixture(spark), "k").report()
    sections = {row["section"] for row in report.collect()}
    assert "count total" in sections and "flags" in sections
    assert "count region" not in sections


def test_empty_side_is_counted_as_zero(spark):
    base, _ = fixture(spark)
    counts = reconcile(base, base.limit(0), "k").counts
    assert rows(counts.select("env", "row_count")) == [("PRODUCTION", 200), ("TESTING", 0)]


def test_type_drift_is_reported_and_text_compared(spark):
    base = spark.sql("select 1 k, 5 a")
    other = spark.sql("select 1L k, 5L a")
    result = reconcile(base, other, "K")
    assert flags(result.rollup) == {recon.MATCHING: 1}
    assert result.schema_summary.first()["type_drift"] == "a int -> bigint,k int -> bigint"


def test_duplicate_keys(spark):
    base = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int").withColumn("a", F.lit(1))
    result = reconcile(base, base.filter("k = 2"), "k")
    assert rows(result.duplicate_keys) == [("PRODUCTION", 1, 2), ("TESTING", 0, 0)]


def test_bad_arguments(spark):
    base, other = fixture(spark)
    with pytest.raises(ValueError):
        reconcile(base, other, " , ")
    with pytest.raises(ValueError):
        reconcile(base, other, "nope")
    with pytest.raises(ValueError):
        reconcile(base, other, "k", mode="other").rollup
    with pytest.raises(ValueError):
        choose_scope(["snapshot_day"])


def test_scope_choice():
    day, cutoff = "2020/01/01", "2020/01/01 00:00:00"
    assert choose_scope(["SNAPSHOT_DAY", "dw_last_updated"], day, cutoff) == snapshot(day)
    assert choose_scope(["dw_last_updated"], day, cutoff) == changed_since(cutoff)
    assert choose_scope(["a"], day, cutoff) == FULL


def test_symmetric_difference_is_multiset(spark):
    one = spark.createDataFrame([(1, None), (1, None), (2, "a"), (3, "b")], "k int, a string")
    two = spark.createDataFrame([(1, None), (2, "c"), (2, "c")], "k int, a string")
    result = recon.symmetric_difference(one, two, ["k", "a"])
    left, right = one.exceptAll(two).count(), two.exceptAll(one).count()
    assert rows(result) == [(left, right)] == [(3, 2)]
    assert rows(recon.symmetric_difference(one, one, ["k", "a"])) == [(0, 0)]


def flags_of(one, two, keys="k"):
    return {row["dq_flag"]: int(row["row_count"]) for row in reconcile(one, two, keys).rollup.collect()}


def test_equal_nested_values_match(spark):
    one = spark.sql("select 1 k, array(map('a', 1, 'b', 2)) m, map('x', map('p', 1, 'q', 2)) n, named_struct('d', 0.0D, 'e', array(0.0D)) s, 0.0D z")
    two = spark.sql("select 1 k, array(map('b', 2, 'a', 1)) m, map('x', map('q', 2, 'p', 1)) n, named_struct('d', -0.0D, 'e', array(-0.0D)) s, -0.0D z")
    other = spark.sql("select 1 k, array(map('b', 2, 'a', 9)) m, map('x', map('q', 2, 'p', 1)) n, named_struct('d', 0.0D, 'e', array(0.0D)) s, 0.0D z")
    assert flags_of(one, two) == {"MATCHING": 1}
    assert flags_of(one, other) == {"NOT MATCHING": 1}


def test_names_with_dots(spark):
    one = spark.sql("select 1 `k.k`, 2 `a.b`, 3 `c``d`")
    two = spark.sql("select 1 `k.k`, 5 `a.b`, 3 `c``d`")
    result = reconcile(one, two, "k.k")
    assert [r["dq_flag"] for r in result.rows.collect()] == ["NOT MATCHING"]
    assert result.samples("NOT MATCHING").count() == 1 and result.duplicate_keys.count() == 2
    assert result.report().filter("section = 'sample NOT MATCHING'").first()["item"] == '{"k.k":1}'


def test_hot_keys_with_differing_rows(spark):
    one = spark.range(2000).selectExpr("if(id % 3 = 0, 7, id + 100) as k", "id % 5 as v")
    two = spark.range(2000).selectExpr("if(id % 3 = 0, 7, id + 100) as k", "id % 4 as v")
    joined = one.alias("p").join(two.alias("t"), "k", "full_outer")
    flag = F.when(F.col("p.v").isNull(), "MISSING FROM PROD").when(F.col("t.v").isNull(), "MISSING FROM TEST").when(F.expr("p.v <> t.v"), "NOT MATCHING").otherwise("MATCHING")
    assert flags_of(one, two) == {r[0]: r[1] for r in joined.groupBy(flag).count().collect()}


def test_samples_beyond_a_thousand(spark):
    one = spark.range(5000).selectExpr("id as k", "'a' as v")
    two = spark.range(5000).selectExpr("id as k", "'b' as v")
    result = reconcile(one, two, "k")
    rows_of = recon.mismatch_samples(result.rows, 3000)
    assert rows_of.count() == 3000
    text = rows_of._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "Window" not in text


@pytest.mark.parametrize("n", [1, 3, 10, 2000])
def test_samples_in_one_pass(spark, n):
    one = spark.range(60).selectExpr("if(id % 7 = 0, null, id div 4) as k", "id % 3 as v")
    two = spark.range(60).selectExpr("if(id % 5 = 0, null, id div 3 + 5) as k", "id % 2 as v")
    result = reconcile(one, two, "k")
    assert rows(recon.samples_in_one_pass(result.rows, n)) == rows(recon.mismatch_samples(result.rows, n))


def test_types_of_the_baseline_on_request(spark):
    one = spark.sql("select 1 k, 5 a, date'2024-01-02' d")
    two = spark.sql("select 1L k, 5.00BD a, '2024-01-02' d")
    assert flags_of(one, two) == {"NOT MATCHING": 1}
    result = reconcile(one, two, "k", cast=True)
    assert flags(result.rollup) == {recon.MATCHING: 1}
    assert "a int -> decimal" in result.schema_summary.first()["type_drift"]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_digests_of_buckets(spark, buckets):
    """Multisets: also where all buckets differ, or none."""
    prod, test = random_rows(11, 60), random_rows(12, 50)
    base, other = (spark.createDataFrame(side, SCHEMA) for side in (prod, test))
    names = ["k1", "k2", "a", "b"]
    for one, two in ((base, other), (base, base), (base, base.union(base.limit(2))), (base.limit(0), other)):
        exact = recon.symmetric_difference(one, two, names).collect()
        assert digest.difference_by_bucket(one, two, names, buckets).collect() == exact
    p, t = (Counter(side) for side in (prod, test))
    found = digest.difference_by_bucket(base, other, names, buckets).first()
    assert tuple(found) == (sum((p - t).values()), sum((t - p).values()))


@pytest.mark.parametrize("mode", hashing.MODES)
def test_rollup_by_bucket(spark, mode):
    base, other = fixture(spark)
    nulls = base.limit(3).withColumn("k", F.lit(None).cast("bigint"))
    result = reconcile(base.union(nulls), other.union(nulls), "k", mode=mode)
    for buckets in (1, 5, 1000):
        assert flags(result.rollup_by_bucket(buckets)) == flags(result.rollup)
