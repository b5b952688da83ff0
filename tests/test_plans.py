"""The physical plans are the ones meant for large data."""

import re

import pytest
from pyspark.sql import functions as F
from twinledger import reconcile
from twinledger.operators import counts, digest, recon
from twinledger.operators.scope import FULL, changed_since, snapshot
from twinledger.suite import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sides"))
    base = spark.range(1000).select(
        F.col("id").alias("k"),
        (F.col("id") % 5).cast("int").alias("region_id"),
        F.concat(F.lit("v"), "id").alias("v"),
        F.lit("unused").alias("w"),
        F.expr("date_add(date'2024-01-01', cast(id % 50 as int))").alias("snapshot_day"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int))").alias("dw_last_updated"),
    )
    base.write.parquet(f"{path}/p")
    base.write.parquet(f"{path}/t")
    return spark.read.parquet(f"{path}/p"), spark.read.parquet(f"{path}/t")


def exchanges(text):
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|Single)", text))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


def test_rollup_is_one_exchange_of_rows_and_no_join(sides):
    text = plan(reconcile(*sides, "k", scope=FULL).rollup)
    assert "Join" not in text
    assert exchanges(text) == 2 and text.count("Exchange hashpartitioning(k") == text.count("Exchange SinglePartition") == 1
    assert text.count("FileScan") == 2


def test_hot_keys_are_counted_where_they_are_read(sides, monkeypatch):
    monkeypatch.setattr(recon, "HOT_ROWS", 2)
    monkeypatch.setattr(recon, "SAMPLED", 1.0)
    text = plan(reconcile(*sides, "region_id", scope=FULL).rollup)
    assert "SortMergeJoin" not in text and "LeftAnti" in text and "LeftSemi" in text
    assert "Exchange hashpartitioning(region_id#" in text and re.search(r"Exchange hashpartitioning\(region_id#\d+, _h#", text)


@pytest.mark.parametrize("n", [10, 5000])
def test_samples_are_cut_in_each_task(sides, n):
    text = plan(recon.mismatch_samples(reconcile(*sides, "k", scope=FULL).rows, n))
    assert text.count("TakeOrderedAndProject") >= 3 and "Window" not in text


def test_samples_of_all_flags_in_one_pass(sides):
    text = plan(recon.samples_in_one_pass(reconcile(*sides, "k", scope=FULL).rows, 10))
    assert "TakeOrderedAndProject" not in text and text.count("FileScan") == 2
    # the first rows of each flag are kept before the rows meet, and after
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text and "Final" in text
    beyond = plan(recon.samples_in_one_pass(reconcile(*sides, "k", scope=FULL).rows, 5000))
    assert "Window" not in beyond


def test_keys_alone_answer_what_needs_no_fingerprint(sides):
    result = reconcile(*sides, "k", scope=FULL)
    for df in (result.duplicate_keys, result.samples("MISSING FROM TEST"), result.samples("MISSING FROM PROD")):
        text = plan(df)
        assert "md5" not in text and "ReadSchema: struct<k:bigint>" in text and "v:string" not in text


def test_scope_and_columns_reach_the_scan(sides):
    for scope, column in (
        (snapshot("2024/01/05"), "EqualTo(snapshot_day"),
        (changed_since("2024/01/01 05:00:00"), "GreaterThanOrEqual(dw_last_updated"),
    ):
        df = reconcile(*sides, "k", exclude="w", scope=scope).rollup
        text = df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert text.count(column) >= 2
        assert "w:string" not in text


def test_count_report_scans_each_side_once(sides):
    text = plan(counts.count_report(*sides, snapshot("2024/01/05")))
    assert text.count("FileScan") == 2
    assert "ReadSchema: struct<region_id:int,snapshot_day:date>" in text


def test_report_reads_each_side_twice(sides):
    """Once for the counts, once for the fingerprints all flag sections share."""
    df = reconcile(*sides, "k", scope=snapshot("2024/01/05")).report()
    df.collect()
    text = plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in text
    assert "TakeOrderedAndProject" in text


def test_difference_is_one_grouping_of_fingerprints(sides):
    text = plan(recon.symmetric_difference(*sides, ["k", "v"]))
    assert "hashpartitioning(_hash0" in text and "md5" not in text
    assert "Join" not in text
    assert exchanges(text) == 2


def test_stored_sides_are_not_shuffled_again(sides):
    result = reconcile(*sides, "k", scope=FULL).stored(4)
    assert exchanges(plan(recon.stored_keys(*result.tables, ["k"]))) == 0
    text = plan(result.rollup)
    assert text.count("Bucketed: true") >= 2 and "v:string" not in text
    # one for the rows of keys that are not settled where they lie, and for their counts
    assert text.count("Exchange hashpartitioning(k#") == 2 and "LeftSemi" in text


def test_equal_buckets_are_not_compared_row_by_row(sides):
    base, same = sides
    other = same.withColumn("v", F.when(F.col("k") == 77, "changed").otherwise(F.col("v")))
    digests = digest.bucket_digests(base, other, ["k", "v"], buckets=256)
    assert digests.filter("NOT same").count() == 2
    left = [digest.in_buckets(side.select("k", "v"), ["k", "v"], digests, 256).count() for side in (base, other)]
    assert sum(left) < 30
    assert digest.bucket_digests(base, same, ["k", "v"]).filter("NOT same").isEmpty()
    text = plan(digest.difference_by_bucket(base, other, ["k", "v"]))
    assert "LeftSemi" in text and "SortMergeJoin" not in text


def test_a_partitioned_side_is_read_in_part(spark, sides, tmp_path):
    """A snapshot day or a region that is a partition: the other partitions' files are not listed for reading."""
    base = sides[0]
    for column, scope in (("snapshot_day", snapshot("2024/01/05")), ("dw_last_updated", None)):
        if scope is None:
            continue
        path = str(tmp_path / column)
        base.repartition(column).write.partitionBy(column).parquet(path)
        stored = spark.read.parquet(path)
        assert len(stored.inputFiles()) == 50
        text = plan(reconcile(stored, stored, "k", scope=scope).rollup)
        assert text.count("PartitionFilters: [isnotnull(snapshot_day") == 2 and "PushedFilters: []" in text
        read = scope.apply(stored).select(F.col("_metadata.file_path").alias("file")).distinct().collect()
        assert len(read) == 1 and "snapshot_day=2024-01-05" in read[0].file
    path = str(tmp_path / "regions")
    base.repartition("region_id").write.partitionBy("region_id").parquet(path)
    wanted = spark.createDataFrame([(2, "UTC")], "region_id int, zone string")
    text = plan(spark.read.parquet(path).join(F.broadcast(wanted.filter("zone = 'UTC'")), "region_id").select("k", "v"))
    assert "dynamicpruning" in text
