"""Labelled counts and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.operators import counts, versions
from twinledger.operators.scope import FULL, changed_since, snapshot
from twinledger.suite.registry import END_OF_DAY, RUN_DATE, fx_sides, query, table, with_fx

ON_DAY = "WHERE snapshot_day = DATE '1998-10-01'"
SINCE = "WHERE dw_last_updated >= TIMESTAMP '2001-01-01'"


def count_sql(where: str = "", region: bool = False) -> str:
    parts = []
    for env, side in (("PRODUCTION", "fx_prod"), ("TESTING", "fx_test")):
        columns = "region_id, " if region else ""
        group = "GROUP BY region_id" if region else ""
        parts.append(
            f"SELECT {columns}'{env}' AS env, count(*) AS row_count FROM {side} {where} {group}"
        )
    return with_fx(" UNION ALL ".join(parts))


def register(name, scope, where, by):
    def run(spark, sf_dir):
        return counts.side_counts(*fx_sides(spark, sf_dir), scope=scope, by=by)

    query(name, count_sql(where, bool(by)))(run)


register("count_total", FULL, "", [])
register("count_by_region", FULL, "", ["region_id"])
register("count_snapshot", snapshot(RUN_DATE), ON_DAY, [])
register("count_region_snapshot", snapshot(RUN_DATE), ON_DAY, ["region_id"])
register("count_changed", changed_since(END_OF_DAY), SINCE, [])
register("count_region_changed", changed_since(END_OF_DAY), SINCE, ["region_id"])


def count_sections(where: str = "") -> str:
    """The sections of the count report, one subquery each."""
    sections = [("total", "", False), ("region", "", True)]
    if where:
        sections += [("scope", where, False), ("region_scope", where, True)]
    parts = []
    for section, condition, region in sections:
        for env, side in (("PRODUCTION", "fx_prod"), ("TESTING", "fx_test")):
            value = "CAST(region_id AS VARCHAR)" if region else "CAST(NULL AS VARCHAR)"
            parts.append(
                f"SELECT '{section}' AS section, {value} AS region_id, '{env}' AS env, "
                f"count(*) AS row_count FROM {side} {condition} "
                + ("GROUP BY region_id" if region else "")
            )
    return " UNION ALL ".join(parts)


@query("count_report", with_fx(count_sections(ON_DAY)))
def count_report(spark, sf_dir):
    return counts.count_report(*fx_sides(spark, sf_dir), snapshot(RUN_DATE))


def order_versions(spark, sf_dir):
    """Customers as tables, their orders as versions."""
    return table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_custkey": "table_id", "o_orderkey": "version"}
    )


@query(
    "latest_version",
    """
    SELECT o_custkey AS table_id, max(o_orderkey) AS version,
           arg_max(o_orderstatus, o_orderkey) AS o_orderstatus,
           arg_max(o_orderdate, o_orderkey) AS o_orderdate
    FROM orders GROUP BY o_custkey
    """,
)
def latest_version(spark, sf_dir):
    return versions.latest_version(
        order_versions(spark, sf_dir), ["table_id"], "version", ["o_orderstatus", "o_orderdate"]
    )


@query(
    "latest_version_ties",
    """
    SELECT o_custkey AS table_id, max(o_orderkey % 4) AS version,
           max(o_orderpriority || o_orderkey) FILTER (o_orderkey % 4 = top) AS note
    FROM (SELECT *, max(o_orderkey % 4) OVER (PARTITION BY o_custkey) AS top FROM orders) GROUP BY o_custkey
    """,
)
def latest_version_ties(spark, sf_dir):
    """Many rows of the same highest version."""
    rows = order_versions(spark, sf_dir).select(
        "table_id",
        (F.col("version") % 4).alias("version"),
        F.concat("o_orderpriority", F.col("version").cast("string")).alias("note"),
    )
    return versions.latest_version(rows, ["table_id"], "version", ["note"])


# Tables in this class have no version yet.
NEW_TABLE = "table_id % 10 = 0"


@query(
    "next_version",
    """
    SELECT o_custkey AS table_id,
           CAST(CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE max(o_orderkey) + 1 END AS BIGINT) AS next_version
    FROM orders GROUP BY o_custkey
    """,
)
def next_version(spark, sf_dir):
    known = order_versions(spark, sf_dir)
    return versions.next_version(known, known.filter(f"NOT ({NEW_TABLE})"), ["table_id"], "version")


@query(
    "not_existing",
    "SELECT DISTINCT o_custkey AS table_id FROM orders WHERE o_custkey % 10 = 0",
)
def not_existing(spark, sf_dir):
    known = order_versions(spark, sf_dir)
    requested = known.select("table_id").distinct()
    return versions.not_existing(requested, known.filter(f"NOT ({NEW_TABLE})"), ["table_id"])


LOOKUP_SQL = """
SELECT o_custkey AS table_id,
       arg_max('S' || substring(o_orderpriority, 1, 1), o_orderkey) FILTER (o_orderstatus = 'F') AS beta_scheme,
       max(o_orderkey) FILTER (o_orderstatus = 'F') AS beta_version,
       arg_max('S' || substring(o_orderpriority, 1, 1), o_orderkey) FILTER (o_orderstatus <> 'F') AS prod_scheme,
       max(o_orderkey) FILTER (o_orderstatus <> 'F') AS prod_version
FROM orders GROUP BY o_custkey
"""
MISSING_SQL = "nullif(concat_ws(',', CASE WHEN beta_version IS NULL THEN 'beta' END, CASE WHEN prod_version IS NULL THEN 'prod' END), '')"


@query("stage_lookup", f"SELECT *, {MISSING_SQL} AS missing_stages FROM ({LOOKUP_SQL})")
def stage_lookup(spark, sf_dir):
    known = order_versions(spark, sf_dir)
    metadata = known.select(
        "table_id",
        "version",
        F.when(F.col("o_orderstatus") == "F", "beta").otherwise("prod").alias("stage"),
        F.concat(F.lit("S"), F.substring("o_orderpriority", 1, 1)).alias("scheme"),
    )
    return versions.stage_lookup(known, metadata, ["table_id"])


def config_sql() -> str:
    parts = []
    for stage in ("beta", "prod"):
        for column, suffix in (("scheme", "PartitionScheme"), ("version", "VersionNumber")):
            parts.append(
                f"SELECT table_id, '{stage}' AS stage, 't' || table_id || '{suffix}' AS config_key, "
                f"'\"' || {stage}_{column} || '\"' AS config_value, "
                f"'{stage}.*.t' || table_id || '{suffix}=\"' || {stage}_{column} || '\";' AS line FROM l "
                "WHERE beta_version IS NOT NULL AND prod_version IS NOT NULL"
            )
    return f"WITH l AS ({LOOKUP_SQL}) " + " UNION ALL ".join(parts)


@query("config_long", config_sql())
def config_long(spark, sf_dir):
    lookup = stage_lookup(spark, sf_dir).withColumn(
        "abbreviation", F.concat(F.lit("t"), F.col("table_id"))
    )
    return (
        versions.config_long(lookup)
        .withColumn("line", versions.config_line())
        .drop("abbreviation")
    )
