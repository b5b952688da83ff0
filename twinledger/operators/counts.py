"""Row counts per side, region and scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from twinledger.operators.schema import REGION_COLUMN
from twinledger.operators.scope import FULL, Scope

# The tags of the two sides.
BASELINE_ENV = "PRODUCTION"
CANDIDATE_ENV = "TESTING"

SECTIONS = ("total", "region", "scope", "region_scope")


def tagged(
    baseline: DataFrame, candidate: DataFrame, columns: Sequence[str | Column]
) -> DataFrame:
    """Both sides in one DataFrame, each row tagged with its side."""
    return baseline.select(F.lit(BASELINE_ENV).alias("env"), *columns).unionByName(
        candidate.select(F.lit(CANDIDATE_ENV).alias("env"), *columns)
    )


def _zero_rows(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(BASELINE_ENV, 0), (CANDIDATE_ENV, 0)], "env string, row_count bigint"
    )


def side_counts(
    baseline: DataFrame,
    candidate: DataFrame,
    scope: Scope = FULL,
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows per side, or per ``by`` group and side, within ``scope``.

    A side without rows still gets its zero when nothing is grouped by.
    """
    both = tagged(scope.apply(baseline), scope.apply(candidate), list(by))
    counts = both.groupBy(*by, "env").agg(F.count(F.lit(1)).alias("row_count"))
    if not by:
        counts = (
            counts.unionByName(_zero_rows(baseline))
            .groupBy("env")
            .agg(F.sum("row_count").alias("row_count"))
        )
    return counts.orderBy(*by, "env")


def count_report(
    baseline: DataFrame,
    candidate: DataFrame,
    scope: Scope = FULL,
    region: str | None = REGION_COLUMN,
) -> DataFrame:
    """All count sections from one scan of each side.

    The scan is grouped by side and region with a plain and a conditional
    count; the four sections are sums over that small result.
    """
    condition = scope.condition
    in_scope = F.lit(False) if condition is None else F.coalesce(condition, F.lit(False))
    region_value = F.col(region).cast("string") if region else F.lit(None).cast("string")
    both = tagged(
        baseline,
        candidate,
        [region_value.alias("region_id"), in_scope.alias("in_scope")],
    )
    cells = both.groupBy("env", "region_id").agg(
        F.count(F.lit(1)).alias("_all"), F.count(F.when(F.col("in_scope"), 1)).alias("_scoped")
    )
    none = F.lit(None).cast("string")
    wanted = [("total", none, "_all")]
    if region:
        wanted.append(("region", F.col("region_id"), "_all"))
    if condition is not None:
        wanted.append(("scope", none, "_scoped"))
        if region:
            wanted.append(("region_scope", F.col("region_id"), "_scoped"))
    entries = F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                group.alias("region_id"),
                F.col(count).alias("row_count"),
            )
            for section, group, count in wanted
        ]
    )
    spread = cells.select("env", F.explode(entries).alias("e")).select("env", "e.*")
    zeros = _zero_rows(baseline)
    plain = [section for section, _, _ in wanted if not section.startswith("region")]
    for section in plain:
        spread = spread.unionByName(
            zeros.select("env", F.lit(section).alias("section"), none.alias("region_id"), "row_count")
        )
    report = spread.groupBy("section", "region_id", "env").agg(
        F.sum("row_count").alias("row_count")
    )
    return report.filter((F.col("row_count") > 0) | F.col("section").isin(plain))
