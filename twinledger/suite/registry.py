"""Query registry and the tables and fixture views that queries read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The two sides of the comparison, with planted differences: rows the candidate
# lacks (97), re-keyed rows (101), changed prices (89), NULL text (83) and NULL
# against the text that compat mode writes for it (83 and even).
FX_PROD = """
SELECT o.o_orderkey, c.c_nationkey AS nation_id, n.n_regionkey + 1 AS region_id,
       o.o_custkey, o.o_orderstatus,
       CASE WHEN o.o_orderkey % 83 = 0 THEN NULL ELSE o.o_orderpriority END AS o_orderpriority,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS snapshot_day,
       o.o_orderdate AS dw_last_updated
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

FX_TEST = """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN o_orderkey + 10000000 ELSE o_orderkey END AS o_orderkey,
       nation_id, region_id, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 83 = 0 AND o_orderkey % 2 = 0 THEN '-1' ELSE o_orderpriority END AS o_orderpriority,
       CAST(CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2)) AS o_totalprice,
       snapshot_day, dw_last_updated, 'x' AS extra_col
FROM {fx_prod}
WHERE o_orderkey % 97 <> 0
"""

FX_COLUMNS = (
    "o_orderkey, nation_id, region_id, o_custkey, o_orderstatus, o_orderpriority, "
    "o_totalprice, snapshot_day, dw_last_updated"
)

RUN_DATE = "1998/10/01"
END_OF_DAY = "2001/01/01 00:00:00"
KEYS = ["o_orderkey"]


def fx_prod(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "customer", "nation")
    return spark.sql(FX_PROD, **{name: table(spark, sf_dir, name) for name in names})


def fx_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    prod = fx_prod(spark, sf_dir)
    return prod, spark.sql(FX_TEST, fx_prod=prod)


def fx_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_sides(spark, sf_dir)[1]


def with_fx(body: str, more: str = "") -> str:
    """``body`` as SQL over the two fixture views."""
    prod = FX_PROD.format(orders="orders", customer="customer", nation="nation")
    test = FX_TEST.format(fx_prod="fx_prod")
    return f"WITH fx_prod AS ({prod}), fx_test AS ({test}){more} {body}"
