"""Fingerprints, the reconciliation itself, samples and the full report."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions import hashing
from twinledger.operators import digest, recon
from twinledger.operators.scope import FULL, changed_since, snapshot
from twinledger.plans.reconcile import reconcile
from twinledger.suite.counting import ON_DAY, SINCE, count_sections
from twinledger.suite.registry import (
    END_OF_DAY,
    FX_COLUMNS,
    KEYS,
    RUN_DATE,
    fx_prod,
    fx_sides,
    query,
    table,
    with_fx,
)

HASHED = (
    "o_orderkey",
    "nation_id",
    "region_id",
    "o_custkey",
    "o_orderstatus",
    "o_orderpriority",
    "o_totalprice",
)

COMPAT_SQL = """
md5(trim(cast(coalesce(o_orderkey, -1) as varchar)) || trim(cast(coalesce(nation_id, -1) as varchar))
 || trim(cast(coalesce(region_id, -1) as varchar)) || trim(cast(coalesce(o_custkey, -1) as varchar))
 || trim(coalesce(o_orderstatus, '-1')) || trim(coalesce(o_orderpriority, '-1'))
 || trim(cast(coalesce(o_totalprice, cast(-1.0 as decimal(18,2))) as varchar)))
"""

SAFE_SQL = (
    "md5(concat_ws('|', "
    + ", ".join(
        f"coalesce(concat(length(cast({name} as varchar)), ':', cast({name} as varchar)), 'N')"
        if name not in ("o_orderpriority",)
        else f"CASE WHEN {name} IS NULL THEN 'N' ELSE length({name}) || ':' || {name} END"
        for name in HASHED
    )
    + "))"
)
FORMULAS = {"compat": COMPAT_SQL, "safe": SAFE_SQL}


def joined_sql(body: str, mode: str, where: str = "") -> str:
    """``body`` over j: the real full outer join with its flag."""
    side = "SELECT o_orderkey, {0} AS md5_col FROM {1} {2}"
    more = f""",
    p AS ({side.format(FORMULAS[mode], 'fx_prod', where)}),
    t AS ({side.format(FORMULAS[mode], 'fx_test', where)}),
    j AS (SELECT coalesce(p.o_orderkey, t.o_orderkey) AS o_orderkey,
                 p.md5_col AS prod_md5, t.md5_col AS test_md5,
                 CASE WHEN p.md5_col IS NULL THEN 'MISSING FROM PROD'
                      WHEN t.md5_col IS NULL THEN 'MISSING FROM TEST'
                      WHEN p.md5_col <> t.md5_col THEN 'NOT MATCHING'
                      WHEN p.md5_col = t.md5_col THEN 'MATCHING' ELSE 'WHAT??' END AS dq_flag
          FROM p FULL OUTER JOIN t ON p.o_orderkey = t.o_orderkey)"""
    return with_fx(body, more)


def as_bigint(df, *names):
    """Counts of a fixture this size as the SQL side has them."""
    return df.withColumns({name: F.col(name).cast("bigint") for name in names})


def comparison(spark, sf_dir, mode="compat", scope=FULL):
    return reconcile(*fx_sides(spark, sf_dir), KEYS, scope=scope, mode=mode)


@query(
    "null_sentinels",
    with_fx(
        """
        SELECT o_orderkey, coalesce(o_custkey, -1) AS o_custkey,
               coalesce(region_id, -1) AS region_id,
               coalesce(o_orderpriority, '-1') AS o_orderpriority,
               coalesce(o_totalprice, CAST(-1.0 AS DECIMAL(18,2))) AS o_totalprice,
               coalesce(snapshot_day, DATE '1970-01-01') AS snapshot_day,
               coalesce(dw_last_updated, TIMESTAMP '1970-01-01 00:00:00') AS dw_last_updated
        FROM (SELECT o_orderkey, region_id, o_orderpriority,
                     CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey,
                     CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
                     CASE WHEN o_orderkey % 11 <> 0 THEN snapshot_day END AS snapshot_day,
                     CASE WHEN o_orderkey % 13 <> 0 THEN dw_last_updated END AS dw_last_updated
              FROM fx_prod)
        """
    ),
)
def null_sentinels(spark, sf_dir):
    holes = {"o_custkey": 5, "o_totalprice": 7, "snapshot_day": 11, "dw_last_updated": 13}
    df = fx_prod(spark, sf_dir).withColumns(
        {name: F.when(F.col("o_orderkey") % n != 0, F.col(name)) for name, n in holes.items()}
    )
    names = ["o_custkey", "region_id", "o_orderpriority", *list(holes)[1:]]
    return df.select(
        "o_orderkey",
        *[hashing.with_sentinel(df[n], df.schema[n].dataType).alias(n) for n in names],
    )


@query(
    "row_fingerprint",
    with_fx(
        f"SELECT o_orderkey, {COMPAT_SQL} AS compat_md5, {SAFE_SQL} AS safe_md5 FROM fx_prod"
    ),
)
def row_fingerprint(spark, sf_dir):
    df = fx_prod(spark, sf_dir)
    return df.select(
        "o_orderkey",
        hashing.row_hash(df, df.columns, "compat").alias("compat_md5"),
        hashing.row_hash(df, df.columns, "safe").alias("safe_md5"),
    )


@query(
    "row_fingerprint_nested",
    """
    SELECT o_orderkey, 'MATCHING' AS maps_and_zero,
           CASE WHEN o_orderkey % 5 = 0 THEN 'NOT MATCHING' ELSE 'MATCHING' END AS deep_value
    FROM orders
    """,
)
def row_fingerprint_nested(spark, sf_dir):
    """Documents of orders against the same with map entries turned round and zeros negated."""
    orders = table(spark, sf_dir, "orders")

    def document(turned: bool):
        pairs = [F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority")]
        pairs = pairs[2:] + pairs[:2] if turned else pairs
        inner = F.create_map(*pairs)
        zero = F.lit(-0.0 if turned else 0.0)
        return F.struct(
            F.array(inner, inner).alias("list"),
            F.create_map(F.lit("in"), inner).alias("map"),
            F.struct(zero.alias("zero"), F.array(zero).alias("zeros")).alias("part"),
        )

    deep = F.array(F.create_map(F.lit("p"), F.struct(F.col("o_orderkey").alias("k"))))
    other = F.array(F.create_map(F.lit("p"), F.struct(F.expr("o_orderkey + int(o_orderkey % 5 = 0)").alias("k"))))
    both = orders.select(
        "o_orderkey",
        document(False).alias("one"),
        document(True).alias("two"),
        deep.alias("deep_one"),
        other.alias("deep_two"),
    )
    same = lambda a, b: F.when(hashing.row_hash(both, [a]) == hashing.row_hash(both, [b]), "MATCHING").otherwise("NOT MATCHING")
    return both.select(
        "o_orderkey", same("one", "two").alias("maps_and_zero"), same("deep_one", "deep_two").alias("deep_value")
    )


ROLLUP = "SELECT dq_flag, count(*) AS row_count FROM j GROUP BY dq_flag"


def register_rollup(name, mode, scope, where):
    def run(spark, sf_dir):
        return as_bigint(comparison(spark, sf_dir, mode, scope).rollup, "row_count")

    query(name, joined_sql(ROLLUP, mode, where))(run)


for _mode, _suffix in (("compat", ""), ("safe", "_safe")):
    register_rollup(f"dq_flag_rollup{_suffix}", _mode, FULL, "")
    register_rollup(f"dq_flag_rollup_snapshot{_suffix}", _mode, snapshot(RUN_DATE), ON_DAY)
    register_rollup(f"dq_flag_rollup_changed{_suffix}", _mode, changed_since(END_OF_DAY), SINCE)


@query("dq_flag_rollup_by_bucket", joined_sql(ROLLUP, "safe"))
def dq_flag_rollup_by_bucket(spark, sf_dir):
    """The rollup by digests of buckets; rows of equal buckets are not shuffled."""
    return as_bigint(comparison(spark, sf_dir, "safe").rollup_by_bucket(), "row_count")


@query("recon_stored", joined_sql(ROLLUP, "compat"))
def recon_stored(spark, sf_dir):
    """The rollup of stored sides, which are joined where they lie."""
    return as_bigint(comparison(spark, sf_dir).stored(8).rollup, "row_count")


@query(
    "recon_full_outer",
    joined_sql(
        """
        SELECT o_orderkey, count(DISTINCT prod_md5) AS prod_rows, count(DISTINCT test_md5) AS test_rows,
               count(CASE WHEN dq_flag = 'MATCHING' THEN 1 END) AS matching_pairs,
               count(CASE WHEN dq_flag = 'NOT MATCHING' THEN 1 END) AS differing_pairs
        FROM j GROUP BY o_orderkey
        """,
        "compat",
    ),
)
def recon_full_outer(spark, sf_dir):
    return as_bigint(comparison(spark, sf_dir).joined, "matching_pairs", "differing_pairs")


@query(
    "dq_flag_rows",
    joined_sql(
        "SELECT o_orderkey, dq_flag, count(*) AS row_count FROM j GROUP BY o_orderkey, dq_flag",
        "compat",
    ),
)
def dq_flag_rows(spark, sf_dir):
    return as_bigint(comparison(spark, sf_dir).rows, "row_count")


def line_sides(spark, sf_dir):
    """Line items against themselves; keys repeat, some prices differ."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    changed = F.when(F.col("l_partkey") % 50 == 0, F.col("price") + 1).otherwise(F.col("price"))
    return lines, lines.withColumn("price", changed.cast("decimal(18,2)"))


LINES_SQL = """
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem),
t AS (SELECT l_orderkey, l_linenumber, l_partkey,
             CAST(CASE WHEN l_partkey % 50 = 0 THEN price + 1 ELSE price END AS DECIMAL(18,2)) AS price FROM p)
"""
LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query(
    "recon_repeated_keys",
    LINES_SQL
    + """
    SELECT CASE WHEN p.l_orderkey IS NULL THEN 'MISSING FROM PROD' WHEN t.l_orderkey IS NULL THEN 'MISSING FROM TEST'
                WHEN p.l_partkey = t.l_partkey AND p.price = t.price THEN 'MATCHING'
                ELSE 'NOT MATCHING' END AS dq_flag, count(*) AS row_count
    FROM p FULL OUTER JOIN t ON p.l_orderkey = t.l_orderkey AND p.l_linenumber = t.l_linenumber
    GROUP BY 1
    """,
)
def recon_repeated_keys(spark, sf_dir):
    result = reconcile(*line_sides(spark, sf_dir), LINE_KEYS)
    return as_bigint(result.rollup, "row_count")


@query(
    "duplicate_keys",
    LINES_SQL
    + """
    SELECT env, count(*) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS extra_rows FROM (
        SELECT 'PRODUCTION' AS env, count(*) AS n FROM p GROUP BY l_orderkey, l_linenumber
        UNION ALL SELECT 'TESTING', count(*) FROM t GROUP BY l_orderkey, l_linenumber)
    WHERE n > 1 GROUP BY env
    """,
)
def duplicate_keys(spark, sf_dir):
    return reconcile(*line_sides(spark, sf_dir), LINE_KEYS).duplicate_keys


SAMPLE_NAMES = {
    "samples_missing_test": recon.MISSING_FROM_TEST,
    "samples_missing_prod": recon.MISSING_FROM_PROD,
    "samples_not_matching": recon.NOT_MATCHING,
}


def register_samples(name, flag):
    def run(spark, sf_dir):
        return comparison(spark, sf_dir).samples(flag)

    body = f"SELECT o_orderkey, dq_flag FROM j WHERE dq_flag = '{flag}' ORDER BY o_orderkey LIMIT 10"
    query(name, joined_sql(body, "compat"))(run)


for _name, _flag in SAMPLE_NAMES.items():
    register_samples(_name, _flag)


DIFFERENCE_SQL = with_fx(
    """
    SELECT (SELECT count(*) FROM (SELECT o_orderkey, o_totalprice FROM fx_prod
                                  EXCEPT ALL SELECT o_orderkey, o_totalprice FROM fx_test)) AS baseline_minus_candidate,
           (SELECT count(*) FROM (SELECT o_orderkey, o_totalprice FROM fx_test
                                  EXCEPT ALL SELECT o_orderkey, o_totalprice FROM fx_prod)) AS candidate_minus_baseline
    """
)


@query("symmetric_difference", DIFFERENCE_SQL)
def symmetric_difference(spark, sf_dir):
    return recon.symmetric_difference(*fx_sides(spark, sf_dir), ["o_orderkey", "o_totalprice"])


@query(
    "difference_by_bucket",
    """
    WITH p AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
    t AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                 CAST(CASE WHEN o_orderkey % 4999 = 7 THEN price + 1 ELSE price END AS DECIMAL(18,2)) AS price
          FROM p WHERE o_orderkey % 7001 <> 3)
    SELECT (SELECT count(*) FROM (SELECT * FROM p EXCEPT ALL SELECT * FROM t)) AS baseline_minus_candidate,
           (SELECT count(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM p)) AS candidate_minus_baseline
    """,
)
def difference_by_bucket(spark, sf_dir):
    """Orders against nearly equal ones; rows of equal buckets are not shuffled."""
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", price)
    changed = F.when(F.col("o_orderkey") % 4999 == 7, F.col("price") + 1).otherwise(F.col("price"))
    nearly = orders.filter("o_orderkey % 7001 <> 3").withColumn("price", changed.cast("decimal(18,2)"))
    return digest.difference_by_bucket(orders, nearly, orders.columns)


def report_sql() -> str:
    none = "CAST(NULL AS VARCHAR)"
    parts = [
        f"SELECT 'count ' || section AS section, region_id, env AS item, row_count FROM ({count_sections(ON_DAY)})",
        f"SELECT 'flags', {none}, dq_flag, count(*) FROM j GROUP BY dq_flag",
    ]
    for item, count in (("baseline_only", "''"), ("candidate_only", "'extra_col'"), ("type_drift", "''")):
        parts.append(f"SELECT 'schema {item}', {none}, {count}, NULL")
    for item, count in (("baseline", 9), ("candidate", 10), ("common", 9)):
        parts.append(f"SELECT 'schema {item}_columns', {none}, {none}, {count}")
    for flag in SAMPLE_NAMES.values():
        parts.append(
            f"SELECT * FROM (SELECT 'sample {flag}', {none}, '{{\"o_orderkey\":' || o_orderkey || '}}', 1 "
            f"FROM j WHERE dq_flag = '{flag}' ORDER BY o_orderkey LIMIT 10)"
        )
    body = " UNION ALL ".join(parts)
    return joined_sql(
        f"SELECT section, region_id, item, CAST(row_count AS BIGINT) AS row_count FROM ({body})",
        "safe",
        ON_DAY,
    )


@query("full_report", report_sql())
def full_report(spark, sf_dir):
    result = comparison(spark, sf_dir, "safe", snapshot(RUN_DATE))
    return as_bigint(result.report(one_pass=True), "row_count")
