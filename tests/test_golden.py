"""Counts both engines produced for the fixture at sf0.01."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from twinledger.suite import QUERIES

ROLLUPS = {
    "dq_flag_rollup": {"MATCHING": 14532, "MISSING FROM PROD": 147, "MISSING FROM TEST": 302, "NOT MATCHING": 166},
    "dq_flag_rollup_safe": {"MATCHING": 14443, "MISSING FROM PROD": 147, "MISSING FROM TEST": 302, "NOT MATCHING": 255},
    "dq_flag_rollup_snapshot": {"MATCHING": 183, "MISSING FROM TEST": 2, "NOT MATCHING": 1},
    "dq_flag_rollup_snapshot_safe": {"MATCHING": 179, "MISSING FROM TEST": 2, "NOT MATCHING": 5},
    "dq_flag_rollup_changed": {"MATCHING": 1271, "MISSING FROM PROD": 8, "MISSING FROM TEST": 21, "NOT MATCHING": 16},
    "dq_flag_rollup_changed_safe": {"MATCHING": 1266, "MISSING FROM PROD": 8, "MISSING FROM TEST": 21, "NOT MATCHING": 21},
}


@pytest.mark.parametrize("name", ROLLUPS)
def test_rollup(spark, middle, name):
    assert dict(rows(QUERIES[name](spark, middle))) == ROLLUPS[name]


def test_totals(spark, middle):
    assert dict(rows(QUERIES["count_total"](spark, middle))) == {"PRODUCTION": 15000, "TESTING": 14845}


def test_regions(spark, middle):
    counts = QUERIES["count_by_region"](spark, middle).orderBy("env", "region_id").collect()
    assert [row["row_count"] for row in counts] == [
        2883, 3019, 3091, 3047, 2960, 2850, 2989, 3061, 3016, 2929,
    ]


def test_symmetric_difference(spark, middle):
    assert rows(QUERIES["symmetric_difference"](spark, middle)) == [(468, 313)]


def test_repeated_keys_fan_out(spark, middle):
    total = QUERIES["recon_repeated_keys"](spark, middle).agg(F.sum("row_count")).first()[0]
    assert total == 93792


def test_schedule_classes(spark, middle):
    counts = QUERIES["schedule_class"](spark, middle).groupBy("class").count()
    assert dict(rows(counts)) == {"hourly": 9, "2h": 38, "4h": 37, "8h": 37, "unchanged": 29}


def test_versions(spark, middle):
    latest = QUERIES["latest_version"](spark, middle)
    assert rows(latest.agg(F.count("version"), F.sum("version"))) == [(1500, 20262122)]
    following = QUERIES["next_version"](spark, middle)
    assert following.filter("next_version = 1").count() == 150
    assert following.count() == 1500
    assert QUERIES["not_existing"](spark, middle).count() == 150


def test_upsert(spark, middle):
    result = QUERIES["upsert"](spark, middle)
    assert rows(result.agg(F.count("o_orderkey"), F.count_distinct("o_orderkey"))) == [(15147, 15147)]


def test_ordered_mapping(spark, middle):
    from twinledger.operators.naming import map_first_match
    from twinledger.suite.corpus import TYPE_RULES

    part = spark.read.parquet(f"{middle}/part.parquet")
    mapped = part.groupBy(map_first_match(F.col("p_type"), TYPE_RULES).alias("m")).count()
    assert dict(rows(mapped)) == {
        "$[A]": 311, "$[C]": 331, "LARGE": 340, "MEDIUM": 353, "SMALL": 322, "STANDARD": 343,
    }


def test_abbreviations(spark, middle):
    from twinledger.operators.naming import abbreviate

    part = spark.read.parquet(f"{middle}/part.parquet")
    names = part.select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))
    result = abbreviate(names)
    counts = result.agg(
        F.count("name"), F.count_distinct("base"), F.count_distinct("abbreviation")
    )
    assert rows(counts)[0][0] == 64
    assert rows(counts)[0][2] == 64
