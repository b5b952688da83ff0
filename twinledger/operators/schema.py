"""Schema comparison over column catalogs.

A catalog is a DataFrame with one row per column of a table. It may hold one
table (``describe``) or a whole warehouse; the operators are joins either way,
so nothing is collected. Sides are matched on ``on``: the column name alone for
two single tables, table and column name for two whole catalogs. Names match
without regard to case, as Spark itself resolves them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from twinledger.functions.text import split_names

CATALOG_SCHEMA = (
    "table_schema string, table_name string, column_name string, "
    "data_type string, ordinal_position int"
)

# Columns that decide how a table is scoped and grouped.
SNAPSHOT_COLUMN = "snapshot_day"
REGION_COLUMN = "region_id"
CHANGED_COLUMN = "dw_last_updated"


def describe(df: DataFrame, table_schema: str, table_name: str) -> DataFrame:
    """The catalog rows of one DataFrame, from its schema alone."""
    rows = [
        (table_schema, table_name, field.name, field.dataType.simpleString(), position)
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(rows, CATALOG_SCHEMA)


def column_catalog(
    catalog: DataFrame, table_schema: str, table_name: str | None = None
) -> DataFrame:
    """A table's distinct catalog rows; none at all is an error of the plan.

    Without a table name: those of every table of the schema.
    """
    found = catalog.filter(F.upper("table_schema") == table_schema.upper())
    if table_name is not None:
        found = found.filter(F.upper("table_name") == table_name.upper())
    distinct = found.dropDuplicates()
    error = F.raise_error(F.lit(f"no columns found for {table_schema}.{table_name or '*'}"))
    none = F.when(F.col("_rows") == 0, error.cast("boolean")).otherwise(F.lit(False))
    check = distinct.agg(F.count(F.lit(1)).alias("_rows")).filter(none)
    return distinct.unionByName(
        check.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in distinct.schema.fields])
    )


def _keyed(catalog: DataFrame, on: Sequence[str]) -> DataFrame:
    return catalog.withColumns({f"_{name}": F.lower(name) for name in on})


def _match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    names = [f"_{name}" for name in on]
    known = _keyed(right, on).select(*names).distinct()
    rows = _keyed(left.dropDuplicates(), on)
    return rows.join(known, names, how).select(*left.columns)


def common_columns(
    baseline: DataFrame, candidate: DataFrame, on: Sequence[str] = ("column_name",)
) -> DataFrame:
    """Columns on both sides, described as the baseline has them."""
    return _match(baseline, candidate, on, "left_semi")


def only_columns(
    side: DataFrame, other: DataFrame, on: Sequence[str] = ("column_name",)
) -> DataFrame:
    """Columns of ``side`` that ``other`` lacks."""
    return _match(side, other, on, "left_anti")


def capability_flags(common: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether the common columns allow snapshots, regions and change dates."""

    def has(name: str):
        found = F.max((F.lower("column_name") == name).cast("int")) == 1
        return F.coalesce(found, F.lit(False)).alias(f"has_{name}")

    return common.groupBy(*by).agg(
        has(SNAPSHOT_COLUMN), has(REGION_COLUMN), has(CHANGED_COLUMN)
    )


def summary(
    baseline: DataFrame, candidate: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Difference lists, the three counts and type drift, per ``by`` group.

    Both sides go through one union and two groupings. The lists hold at most
    the columns of one table.
    """
    columns = [*by, "column_name", "data_type", "ordinal_position"]
    both = (
        baseline.select(*columns, F.lit(True).alias("_baseline"))
        .unionByName(candidate.select(*columns, F.lit(False).alias("_baseline")))
        .withColumn("_name", F.lower("column_name"))
    )
    in_baseline, in_candidate = F.col("_baseline"), ~F.col("_baseline")

    def first(flag, name):
        return F.min(F.when(flag, F.col(name)))

    per_column = both.groupBy(*by, "_name").agg(
        F.coalesce(first(in_baseline, "column_name"), F.min("column_name")).alias("column_name"),
        first(in_baseline, "ordinal_position").alias("_b"),
        first(in_candidate, "ordinal_position").alias("_c"),
        first(in_baseline, "data_type").alias("_b_type"),
        first(in_candidate, "data_type").alias("_c_type"),
    )
    has_b, has_c = F.col("_b").isNotNull(), F.col("_c").isNotNull()

    def listed(flag, position):
        items = F.collect_list(F.when(flag, F.struct(F.col(position), F.col("column_name"))))
        return F.array_join(F.transform(F.array_sort(items), lambda i: i["column_name"]), ",")

    drift = F.concat_ws(" ", "column_name", "_b_type", F.lit("->"), "_c_type")
    drifted = has_b & has_c & (F.col("_b_type") != F.col("_c_type"))
    return per_column.groupBy(*by).agg(
        listed(has_b & ~has_c, "_b").alias("baseline_only"),
        listed(has_c & ~has_b, "_c").alias("candidate_only"),
        F.count("_b").alias("baseline_columns"),
        F.count("_c").alias("candidate_columns"),
        F.count(F.when(has_b & has_c, 1)).alias("common_columns"),
        F.array_join(F.array_sort(F.collect_list(F.when(drifted, drift))), ",").alias(
            "type_drift"
        ),
    )


def shared_names(baseline: DataFrame, candidate: DataFrame) -> list[str]:
    """Names both DataFrames have, in the baseline's order and spelling."""
    known = {name.lower() for name in candidate.columns}
    return [name for name in baseline.columns if name.lower() in known]


def project_common(df: DataFrame, baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """``df`` cut down to the common columns, in the baseline's order."""
    return df.select(*shared_names(baseline, candidate))


def project_exclude(df: DataFrame, exclude: str | Sequence[str]) -> DataFrame:
    """``df`` without the columns of a comma list or sequence."""
    return df.drop(*split_names(exclude))
