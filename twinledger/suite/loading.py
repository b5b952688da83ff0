"""Validation, clones and loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions.text import fits_length
from twinledger.operators import load, recon, rules
from twinledger.suite.counting import order_versions
from twinledger.sources.shared import new_path
from twinledger.suite.registry import FX_COLUMNS, KEYS, fx_sides, query, table, with_fx

RULES_SQL = with_fx(
    """
    SELECT rule, resource, dataset_date, metric, expected, actual,
           CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS outcome
    FROM (
        SELECT 'run succeeded' AS rule, 'run/' || id AS resource, '1998-10-01' AS dataset_date,
               'status' AS metric, 'equalTo("SUCCESS")' AS expected,
               CASE WHEN tested > 0 THEN 'SUCCESS' ELSE 'ERROR' END AS actual, tested > 0 AS passed FROM c
        UNION ALL
        SELECT 'rows returned', 'run/' || id, '1998-10-01', 'rowsReturned', 'greaterThan(0)',
               CAST(tested AS VARCHAR), tested > 0 FROM c
        UNION ALL
        SELECT 'no difference', 'difference/' || id, '1998-10-01', 'rowsReturned', '0',
               CAST(differing AS VARCHAR), differing = 0 FROM c
    )
    """,
    """,
    d AS (SELECT o_custkey AS id, count(*) AS n FROM (
            SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice FROM fx_prod
                           EXCEPT ALL SELECT o_custkey, o_orderkey, o_totalprice FROM fx_test)
            UNION ALL
            SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice FROM fx_test
                           EXCEPT ALL SELECT o_custkey, o_orderkey, o_totalprice FROM fx_prod)) GROUP BY 1),
    c AS (SELECT o_custkey AS id,
                 (SELECT count(*) FROM fx_test WHERE fx_test.o_custkey = fx_prod.o_custkey) AS tested,
                 coalesce((SELECT n FROM d WHERE d.id = fx_prod.o_custkey), 0) AS differing
          FROM fx_prod GROUP BY o_custkey)
    """,
)


@query("validate_rules", RULES_SQL)
def validate_rules(spark, sf_dir):
    """One suite per customer, checked against what its comparison returned."""
    prod, test = fx_sides(spark, sf_dir)
    ids = prod.select(F.col("o_custkey").cast("string").alias("id")).distinct()
    suites = ids.select(
        rules.build_suite(
            F.concat(F.lit("run/"), "id"), F.concat(F.lit("difference/"), "id"), F.lit("1998-10-01")
        ).alias("suite")
    )
    tested = test.groupBy(F.col("o_custkey").cast("string").alias("id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = F.coalesce("n", F.lit(0).cast("bigint"))
    runs = ids.join(tested, "id", "left").select(
        F.concat(F.lit("run/"), "id").alias("resource"),
        F.when(rows > 0, "SUCCESS").otherwise("ERROR").alias("status"),
        rows.alias("rows_returned"),
    )
    differences = recon.symmetric_difference(
        prod, test, ["o_orderkey", "o_totalprice"], by=["o_custkey"]
    ).select(
        F.concat(F.lit("difference/"), F.col("o_custkey").cast("string")).alias("resource"),
        F.lit("SUCCESS").alias("status"),
        (F.col("baseline_minus_candidate") + F.col("candidate_minus_baseline")).alias(
            "rows_returned"
        ),
    )
    return rules.validate(rules.suite_rules(suites), runs.unionByName(differences))


@query(
    "length_rule",
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_text, length(text) < 100 AS fits FROM documents",
)
def length_rule(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length("text").alias("n_text"), fits_length(F.col("text")).alias("fits")
    )


@query("clone_schema", "SELECT * FROM orders")
def clone_schema(spark, sf_dir):
    """An empty clone of the orders, loaded with the orders."""
    orders = table(spark, sf_dir, "orders")
    return load.upsert(load.clone_schema(orders), orders, KEYS)


@query(
    "upsert",
    with_fx(
        f"""
        SELECT {FX_COLUMNS} FROM fx_prod WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fx_test)
        UNION ALL SELECT {FX_COLUMNS} FROM fx_test
        """
    ),
)
def upsert(spark, sf_dir):
    return load.upsert(*fx_sides(spark, sf_dir), KEYS)


@query(
    "upsert_partitioned",
    with_fx(
        f"""
        SELECT {FX_COLUMNS} FROM fx_prod
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fx_test WHERE region_id <= 2)
        UNION ALL SELECT {FX_COLUMNS} FROM fx_test WHERE region_id <= 2
        """
    ),
)
def upsert_partitioned(spark, sf_dir):
    """Two regions' rows into a table that is partitioned by region; the other partitions stay as they are."""
    prod, test = fx_sides(spark, sf_dir)
    path = new_path(spark, "loads")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    prod.repartition("region_id").write.partitionBy("region_id").option("path", path).saveAsTable(name)
    load.upsert_table(name, test.filter("region_id <= 2"), KEYS)
    return spark.table(name).select(*prod.columns)


# Orders against themselves: every key comes in once to three times, priced by its turn.
TURNS = "1 + o_orderkey % 3"


@query(
    "upsert_repeated",
    f"""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus || ({TURNS}) ELSE o_orderstatus END AS state
    FROM orders
    UNION ALL
    SELECT NULL, o_custkey, o_orderstatus || turn FROM orders, unnest(range(1, 2 + o_orderkey % 3)) AS t(turn)
    WHERE o_orderkey % 100 = 0
    """,
)
def upsert_repeated(spark, sf_dir):
    """The latest of repeated incoming rows counts; NULL keys are added as they come."""
    orders = table(spark, sf_dir, "orders")
    base = orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("state"))
    turns = orders.withColumn("turn", F.explode(F.expr(f"sequence(1L, {TURNS})")))
    state = F.concat("o_orderstatus", F.col("turn").cast("string")).alias("state")
    even = turns.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", state, "turn")
    unkeyed = turns.filter("o_orderkey % 100 = 0").select(
        F.lit(None).cast("bigint").alias("o_orderkey"), "o_custkey", state, "turn"
    )
    return load.upsert(base, even.unionByName(unkeyed), ["o_orderkey"], order=["turn"])


@query(
    "clone_definition",
    """
    SELECT 'new_owner' AS owner, 'copy_' || o_custkey AS name, o_orderkey + 1 AS number,
           o_orderstatus AS media, o_orderpriority AS split_key, 'o_orderkey' AS main_key,
           'struct ' || o_custkey AS layout, 'DRAFT' AS state, 'keep' AS entry_keys,
           'price ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS notes,
           CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'files' END AS storage, 'zone ' || o_orderstatus AS zone,
           o_orderkey % 2 = 0 AS governed, 'someone' AS changed_by, false AS has_link, false AS has_extra
    FROM orders
    """,
)
def clone_definition(spark, sf_dir):
    """Every carried field, a default for absent storage, and what is left behind."""
    version = F.struct(
        F.struct(
            F.col("o_orderstatus").alias("media"),
            F.array("o_orderpriority").alias("splitKeys"),
            F.struct(
                F.array(F.lit("o_orderkey")).alias("mainKeys"),
                F.concat(F.lit("struct "), F.col("table_id")).alias("layout"),
                F.lit("elsewhere").alias("link"),
            ).alias("shape"),
            F.when(F.col("version") % 3 != 0, "files").alias("storage"),
            F.struct(
                F.struct(
                    F.concat(F.lit("zone "), F.col("o_orderstatus")).alias("zone"),
                    F.lit("own").alias("extra"),
                ).alias("disk")
            ).alias("place"),
        ).alias("body"),
        F.concat(
            F.lit("price "), F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        ).alias("notes"),
        F.struct(
            F.create_map(F.lit("keep"), F.lit("1"), F.lit("drop"), F.lit("2")).alias("entries")
        ).alias("extras"),
        F.struct(F.lit("someone").alias("by")).alias("history"),
        (F.col("version") % 2 == 0).alias("governed"),
    )
    versions = order_versions(spark, sf_dir).withColumn("v", version)
    copy = load.clone_definition(
        F.col("v"),
        versions.schema["v"].dataType,
        new={
            "owner": F.lit("new_owner"),
            "name": F.concat(F.lit("copy_"), F.col("table_id")),
            "number": F.col("version") + 1,
            "state": F.lit("DRAFT"),
        },
        carried=(
            "body.media", "body.splitKeys", "body.shape", "body.storage", "body.place.disk.zone",
            "notes", "extras", "history", "governed", "body.unknown",
        ),
        dropped=["body.shape.link"],
        without={"extras.entries": ["drop"]},
        defaults={"body.storage": F.lit("")},
    )
    copies = versions.select(copy.alias("c"))
    kept = copies.schema["c"].dataType["body"].dataType
    return copies.select(
        "c.owner",
        "c.name",
        "c.number",
        F.col("c.body.media").alias("media"),
        F.col("c.body.splitKeys")[0].alias("split_key"),
        F.col("c.body.shape.mainKeys")[0].alias("main_key"),
        F.col("c.body.shape.layout").alias("layout"),
        "c.state",
        F.array_join(F.map_keys("c.extras.entries"), ",").alias("entry_keys"),
        "c.notes",
        F.col("c.body.storage").alias("storage"),
        F.col("c.body.place.disk.zone").alias("zone"),
        "c.governed",
        F.col("c.history.by").alias("changed_by"),
        F.lit("link" in kept["shape"].dataType.fieldNames()).alias("has_link"),
        F.lit("extra" in kept["place"].dataType["disk"].dataType.fieldNames()).alias("has_extra"),
    )
