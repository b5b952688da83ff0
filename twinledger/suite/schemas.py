"""Schema comparison over catalogs of as many tables as there are customers.

Each customer stands for a table and the priorities of its orders for the
table's columns, so a catalog has one row per order, repeats included. The
candidate lacks some rows and has some columns of its own.
"""

from __future__ import annotations

from twinledger.operators import schema
from twinledger.suite.registry import query, table

COLUMN = """
CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'snapshot_day' WHEN '2' THEN 'region_id'
     WHEN '3' THEN 'dw_last_updated' WHEN '4' THEN 'note' ELSE 'amount' END
"""

CATALOG = """
SELECT 'SALES' AS table_schema, concat('t_', CAST(o_custkey AS {text})) AS table_name,
       {column} AS column_name, {type} AS data_type,
       CAST(substring(o_orderpriority, 1, 1) AS INT) + {shift} AS ordinal_position
FROM {orders} {where}
"""

# Orders the candidate does not have, orders that give it a column of its own,
# and orders whose column has another type there.
LOST = "o_orderkey % 4 = 0"
OWN = "o_orderkey % 101 = 0"
TEST_COLUMN = f"CASE WHEN {OWN} THEN concat('own_', {COLUMN}) ELSE {COLUMN} END"
TEST_TYPE = "CASE WHEN o_custkey % 7 = 0 THEN 'bigint' ELSE 'string' END"


def catalog_sql(side: str, orders: str, text: str) -> str:
    if side == "prod":
        parts = {"column": COLUMN, "type": "'string'", "shift": 0, "where": ""}
    else:
        parts = {
            "column": TEST_COLUMN,
            "type": TEST_TYPE,
            "shift": f"CASE WHEN {OWN} THEN 10 ELSE 0 END",
            "where": f"WHERE NOT ({LOST})",
        }
    return CATALOG.format(orders=orders, text=text, **parts)


def catalogs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return tuple(
        spark.sql(catalog_sql(side, "{orders}", "string"), orders=orders)
        for side in ("prod", "test")
    )


def with_catalogs(body: str) -> str:
    prod, test = (catalog_sql(side, "orders", "varchar") for side in ("prod", "test"))
    return (
        f"WITH p AS (SELECT DISTINCT * FROM ({prod})), t AS (SELECT DISTINCT * FROM ({test})) {body}"
    )


ON = ("table_name", "column_name")
BOTH = "SELECT * FROM {0} WHERE {2} EXISTS (SELECT 1 FROM {1} WHERE {1}.table_name = {0}.table_name AND {1}.column_name = {0}.column_name)"


@query("column_catalog", with_catalogs("SELECT * FROM p"))
def column_catalog(spark, sf_dir):
    prod, _ = catalogs(spark, sf_dir)
    return schema.column_catalog(prod, "Sales")


@query("schema_common", with_catalogs(BOTH.format("p", "t", "")))
def schema_common(spark, sf_dir):
    return schema.common_columns(*catalogs(spark, sf_dir), on=ON)


@query("schema_prod_only", with_catalogs(BOTH.format("p", "t", "NOT")))
def schema_prod_only(spark, sf_dir):
    prod, test = catalogs(spark, sf_dir)
    return schema.only_columns(prod, test, on=ON)


@query("schema_test_only", with_catalogs(BOTH.format("t", "p", "NOT")))
def schema_test_only(spark, sf_dir):
    prod, test = catalogs(spark, sf_dir)
    return schema.only_columns(test, prod, on=ON)


@query(
    "schema_flags",
    with_catalogs(
        f"""
        SELECT table_name, bool_or(column_name = 'snapshot_day') AS has_snapshot_day,
               bool_or(column_name = 'region_id') AS has_region_id,
               bool_or(column_name = 'dw_last_updated') AS has_dw_last_updated
        FROM ({BOTH.format("p", "t", "")}) GROUP BY table_name
        """
    ),
)
def schema_flags(spark, sf_dir):
    return schema.capability_flags(schema_common(spark, sf_dir), by=["table_name"])


@query(
    "schema_summary",
    with_catalogs(
        """
        SELECT coalesce(p.table_name, t.table_name) AS table_name,
               coalesce(string_agg(CASE WHEN t.column_name IS NULL THEN p.column_name END, ','
                                   ORDER BY p.ordinal_position), '') AS baseline_only,
               coalesce(string_agg(CASE WHEN p.column_name IS NULL THEN t.column_name END, ','
                                   ORDER BY t.ordinal_position), '') AS candidate_only,
               count(p.column_name) AS baseline_columns, count(t.column_name) AS candidate_columns,
               count(CASE WHEN p.column_name = t.column_name THEN 1 END) AS common_columns,
               coalesce(string_agg(CASE WHEN p.data_type <> t.data_type THEN
                   p.column_name || ' ' || p.data_type || ' -> ' || t.data_type END, ','
                   ORDER BY p.column_name), '') AS type_drift
        FROM p FULL OUTER JOIN t ON p.table_name = t.table_name AND p.column_name = t.column_name
        GROUP BY 1
        """
    ),
)
def schema_summary(spark, sf_dir):
    return schema.summary(*catalogs(spark, sf_dir), by=["table_name"])
