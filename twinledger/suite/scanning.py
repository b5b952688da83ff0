"""Scans, projections, filters and run parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions import dates, text
from twinledger.operators import schema
from twinledger.operators.naming import route_by_type
from twinledger.operators.scope import FULL, changed_since, choose_scope, snapshot
from twinledger.sources.shared import new_path
from twinledger.sources.tables import append_rows, read_table, write_report
from twinledger.suite.registry import (
    END_OF_DAY,
    FX_COLUMNS,
    RUN_DATE,
    fx_prod,
    fx_sides,
    fx_test,
    query,
    table,
    with_fx,
)


@query("scan_table", "SELECT * FROM lineitem")
def scan_table(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/lineitem.parquet")


@query("project_exclude", "SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem")
def project_exclude(spark, sf_dir):
    return schema.project_exclude(table(spark, sf_dir, "lineitem"), "l_tax , l_discount")


@query("project_common", with_fx(f"SELECT {FX_COLUMNS} FROM fx_test"))
def project_common(spark, sf_dir):
    prod, test = fx_sides(spark, sf_dir)
    return schema.project_common(test, prod, test)


@query(
    "identifier_parts",
    """
    SELECT p_partkey, p_type AS schema_name, replace(p_name, ' ', '_') AS table_name,
           lower(p_type || '.' || replace(p_name, ' ', '_')) AS lower_name,
           upper(p_type || '.' || replace(p_name, ' ', '_')) AS upper_name
    FROM part
    """,
)
def identifier_parts(spark, sf_dir):
    name = F.concat("p_type", F.lit("."), F.replace("p_name", F.lit(" "), F.lit("_")))
    parts = text.identifier_parts(name)
    return table(spark, sf_dir, "part").select(
        "p_partkey", *[column.alias(alias) for alias, column in parts.items()]
    )


@query(
    "filter_snapshot",
    with_fx(f"SELECT {FX_COLUMNS} FROM fx_prod WHERE snapshot_day = DATE '1998-10-01'"),
)
def filter_snapshot(spark, sf_dir):
    return snapshot(RUN_DATE).apply(fx_prod(spark, sf_dir))


@query(
    "filter_changed_since",
    with_fx(f"SELECT {FX_COLUMNS} FROM fx_prod WHERE dw_last_updated >= TIMESTAMP '2001-01-01'"),
)
def filter_changed_since(spark, sf_dir):
    return changed_since(END_OF_DAY).apply(fx_prod(spark, sf_dir))


@query(
    "scope_precedence",
    with_fx(
        """
        SELECT 'both' AS variant, 'snapshot' AS scope, count(*) AS row_count
        FROM fx_test WHERE snapshot_day = DATE '1998-10-01'
        UNION ALL SELECT 'change date only', 'changed', count(*)
        FROM fx_test WHERE dw_last_updated >= TIMESTAMP '2001-01-01'
        UNION ALL SELECT 'neither', 'full', count(*) FROM fx_test
        """
    ),
)
def scope_precedence(spark, sf_dir):
    test = fx_test(spark, sf_dir)
    variants = {
        "both": test,
        "change date only": test.drop("snapshot_day"),
        "neither": test.drop("snapshot_day", "dw_last_updated"),
    }
    result = None
    for name, df in variants.items():
        scope = choose_scope(df.columns, RUN_DATE, END_OF_DAY)
        counted = scope.apply(df).agg(F.count(F.lit(1)).alias("row_count"))
        part = counted.select(
            F.lit(name).alias("variant"), F.lit(scope.kind).alias("scope"), "row_count"
        )
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "param_filter",
    """
    SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderpriority <> '5-LOW'
    """,
)
def param_filter(spark, sf_dir):
    return spark.sql(
        """
        SELECT o_orderkey, o_orderdate, o_orderpriority FROM {orders}
        WHERE o_orderdate >= to_timestamp_ntz(:end_of_day, 'yyyy/MM/dd HH:mm:ss')
          AND o_orderpriority <> :priority
        """,
        args={"end_of_day": END_OF_DAY, "priority": "5-LOW"},
        orders=table(spark, sf_dir, "orders"),
    )


@query(
    "parse_run_date",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS run_date,
           date_trunc('day', o_orderdate) + INTERVAL 86399 SECOND AS end_of_day
    FROM orders
    """,
)
def parse_run_date(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy/MM/dd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.parse_run_date(day).alias("run_date"),
        dates.parse_end_of_day(F.concat(day, F.lit(" 23:59:59"))).alias("end_of_day"),
    )


@query(
    "region_cutoff",
    with_fx(
        """
        SELECT region_id, cutoff, count(*) AS row_count FROM fx_prod
        JOIN (SELECT id AS region_id, timezone('UTC', timezone(zone, TIMESTAMP '2001-01-01')) AS cutoff
              FROM (VALUES (1, 'America/Los_Angeles'), (2, 'Europe/Paris'), (3, 'Asia/Tokyo'),
                           (4, 'Asia/Kolkata'), (5, 'America/Sao_Paulo')) AS z(id, zone)) USING (region_id)
        WHERE dw_last_updated >= cutoff GROUP BY region_id, cutoff
        """
    ),
)
def region_cutoff(spark, sf_dir):
    rows = dates.region_cutoff(fx_prod(spark, sf_dir), END_OF_DAY)
    return (
        rows.filter(F.col("dw_last_updated") >= F.col("cutoff"))
        .groupBy("region_id", "cutoff")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


# Every seventh customer has a region without a zone, every eleventh none.
PLANTED = "CASE WHEN o_custkey % 7 = 0 THEN 6 WHEN o_custkey % 11 <> 0 THEN region_id END"


@query(
    "region_without_zone",
    with_fx(
        f"""
        SELECT region_id, count(*) AS row_count, count(*) FILTER (region_id BETWEEN 1 AND 5) AS with_cutoff
        FROM (SELECT {PLANTED} AS region_id FROM fx_prod) GROUP BY region_id
        """
    ),
)
def region_without_zone(spark, sf_dir):
    planted = fx_prod(spark, sf_dir).withColumn("region_id", F.expr(PLANTED).cast("int"))
    return (
        dates.region_cutoff(planted, END_OF_DAY)
        .groupBy("region_id")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count("cutoff").alias("with_cutoff"))
    )


@query(
    "filter_interval",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'",
)
def filter_interval(spark, sf_dir):
    bounds = dates.day_bounds("2024-01-08", "2024-01-15")
    return table(spark, sf_dir, "events").filter(dates.in_interval(F.col("ts"), *bounds))


@query(
    "date_window",
    """
    SELECT o_orderkey, o_orderdate, DATE '1998-09-21' AS start_date, DATE '1998-10-11' AS end_date
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-09-21' AND o_orderdate < TIMESTAMP '1998-10-11'
    """,
)
def date_window(spark, sf_dir):
    start, end = dates.date_window(dates.parse_run_date(F.lit(RUN_DATE)))
    bounds = (start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    return (
        table(spark, sf_dir, "orders")
        .filter(dates.in_interval(F.col("o_orderdate"), *bounds))
        .select("o_orderkey", "o_orderdate", start.alias("start_date"), end.alias("end_date"))
    )


@query(
    "route_by_type",
    """
    SELECT event_id, event_type,
           CASE WHEN event_type IN ('view', 'click') THEN 'update'
                WHEN event_type IN ('purchase') THEN 'describe' END AS route
    FROM events
    """,
)
def events_by_route(spark, sf_dir):
    routes = (("update", ("view", "click")), ("describe", ("purchase",)))
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", route_by_type(F.col("event_type"), routes).alias("route")
    )


@query(
    "write_report",
    with_fx(
        """
        SELECT snapshot_day, region_id, count(*) AS row_count
        FROM fx_test GROUP BY snapshot_day, region_id
        """
    ),
)
def report_round_trip(spark, sf_dir):
    counts = (
        FULL.apply(fx_test(spark, sf_dir))
        .groupBy("snapshot_day", "region_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    template = new_path(spark, "report") + "/DQ_{table}_{user}_{run}"
    path = write_report(counts, template, "orders", "Tester", "1", files=4)
    return spark.read.schema(counts.schema).option("header", True).csv(path)


@query(
    "append_rows",
    "SELECT p_type AS kind, p_partkey AS id FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'LARGE')",
)
def appended_list(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("kind"), F.col("p_partkey").alias("id")
    )
    path = new_path(spark, "profiles")
    append_rows(parts.filter(F.col("kind").isin("ECONOMY", "PROMO")), path)
    append_rows(parts.filter(F.col("kind") == "LARGE"), path)
    return spark.read.schema(parts.schema).csv(path)
