"""Validation suites: from documents to rules to pass or fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The three expectations a table's suite holds.
RUN_SUCCEEDED = 'equalTo("SUCCESS")'
ROWS_FOUND = "greaterThan(0)"
NO_DIFFERENCE = "0"
RESPONSE_CODE = "200"

SUITE_SCHEMA = """
    TestCases array<struct<TestUnits: array<struct<
        Name: string, Resource: string,
        Input: struct<Body: struct<datasetDate: string>>,
        Output: struct<ResponseCode: string, Validators: map<string, string>>
    >>>>
"""


def build_suite(run: Column, difference: Column, dataset_date: Column) -> Column:
    """The suite of one table: run succeeded, rows came back, no difference."""

    def unit(name: str, resource: Column, metric: str, expected: str) -> Column:
        return F.struct(
            F.lit(name).alias("Name"),
            resource.alias("Resource"),
            F.struct(F.struct(dataset_date.alias("datasetDate")).alias("Body")).alias("Input"),
            F.struct(
                F.lit(RESPONSE_CODE).alias("ResponseCode"),
                F.create_map(F.lit(metric), F.lit(expected)).alias("Validators"),
            ).alias("Output"),
        )

    units = F.array(
        unit("run succeeded", run, "status", RUN_SUCCEEDED),
        unit("rows returned", run, "rowsReturned", ROWS_FOUND),
        unit("no difference", difference, "rowsReturned", NO_DIFFERENCE),
    )
    return F.struct(F.array(F.struct(units.alias("TestUnits"))).alias("TestCases"))


def suite_rules(suites: DataFrame, suite: str = "suite") -> DataFrame:
    """One row per validator: name, resource, dataset_date, metric, expected."""
    return (
        suites.select(F.explode(F.col(suite)["TestCases"]).alias("_case"))
        .select(F.explode("_case.TestUnits").alias("_unit"))
        .select(
            F.col("_unit.Name").alias("rule"),
            F.col("_unit.Resource").alias("resource"),
            F.col("_unit.Input.Body.datasetDate").alias("dataset_date"),
            F.explode("_unit.Output.Validators").alias("metric", "expected"),
        )
    )


def check(actual: Column, expected: Column) -> Column:
    """Whether ``actual`` meets ``equalTo("x")``, ``greaterThan(n)`` or ``x``."""
    equal = F.regexp_extract(expected, r'^equalTo\("(.*)"\)$', 1)
    above = F.regexp_extract(expected, r"^greaterThan\((-?\d+)\)$", 1)
    return (
        F.when(expected.startswith("equalTo("), actual == equal)
        .when(
            expected.startswith("greaterThan("),
            actual.try_cast("decimal(38,0)") > above.try_cast("decimal(38,0)"),
        )
        .otherwise(actual == expected)
    )


def validate(rules: DataFrame, runs: DataFrame) -> DataFrame:
    """Rules against run results (resource, status, rows_returned).

    The outcome is PASS or FAIL, for every run of the rule's resource; a rule
    whose resource never ran fails. The rules that ran are an inner join, which
    Spark can split where one resource has very many runs.
    """
    on = ["resource", "metric"]
    facts = runs.select(
        "resource",
        F.explode(
            F.create_map(
                F.lit("status"),
                F.col("status"),
                F.lit("rowsReturned"),
                F.col("rows_returned").cast("string"),
            )
        ).alias("metric", "actual"),
    )
    ran = rules.join(facts, on)
    never = rules.join(facts.select(*on).distinct(), on, "left_anti").withColumn(
        "actual", F.lit(None).cast("string")
    )
    passed = F.coalesce(check(F.col("actual"), F.col("expected")), F.lit(False))
    return ran.unionByName(never).withColumn(
        "outcome", F.when(passed, "PASS").otherwise("FAIL")
    )
