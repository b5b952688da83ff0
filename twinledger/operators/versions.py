"""Versions of many tables at once, and lookups of their metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

STAGES = ("beta", "prod")
MISSING_STAGES = "missing_stages"


def latest_version(
    versions: DataFrame, by: Sequence[str], version: str, payload: Sequence[str] = ()
) -> DataFrame:
    """The highest version of each table, with the row's ``payload``.

    Of rows of the same version the one with the largest payload counts, so
    the result does not depend on how rows arrive. Combined before the shuffle,
    so a table with very many versions sends one row per task.
    """
    best = F.max(version).alias(version)
    if not payload:
        return versions.groupBy(*by).agg(best)
    row = F.struct(F.col(version).alias("_version"), F.struct(*payload).alias("_payload"))
    highest = F.max(F.when(F.col(version).isNotNull(), row)).alias("_row")
    return versions.groupBy(*by).agg(highest).select(
        *by, F.col("_row._version").alias(version), "_row._payload.*"
    )


def next_version(
    requested: DataFrame, versions: DataFrame, by: Sequence[str], version: str
) -> DataFrame:
    """One more than the highest version; 1 for a table without versions."""
    latest = latest_version(versions, by, version)
    return requested.select(*by).distinct().join(latest, list(by), "left").select(
        *by, F.coalesce(F.col(version) + 1, F.lit(1)).cast("bigint").alias("next_version")
    )


def not_existing(requested: DataFrame, existing: DataFrame, by: Sequence[str]) -> DataFrame:
    """Requested tables that do not exist yet."""
    return requested.join(existing.select(*by).distinct(), list(by), "left_anti")


def stage_lookup(
    tables: DataFrame,
    metadata: DataFrame,
    by: Sequence[str],
    stage: str = "stage",
    version: str = "version",
    scheme: str = "scheme",
) -> DataFrame:
    """The recommended scheme and version of each table in both stages.

    ``metadata`` is folded to one row per table first, so one join serves both
    stages; of equal versions the largest scheme counts. Every table is in the
    result: ``missing_stages`` lists those it lacks, and is NULL if it has both.
    """

    def best(name: str) -> Column:
        here = (F.col(stage) == name) & F.col(version).isNotNull()
        row = F.struct(F.col(version).alias("version"), F.col(scheme).alias("scheme"))
        return F.max(F.when(here, row)).alias(f"_{name}")

    folded = metadata.groupBy(*by).agg(*[best(name) for name in STAGES])
    found = [
        F.col(f"_{name}.{column}").alias(f"{name}_{column}")
        for name in STAGES
        for column in ("scheme", "version")
    ]
    lacking = F.concat_ws(",", *[F.when(F.col(f"_{n}").isNull(), n) for n in STAGES])
    return (
        tables.select(*by)
        .distinct()
        .join(folded, list(by), "left")
        .select(*by, *found, F.nullif(lacking, F.lit("")).alias(MISSING_STAGES))
    )


def config_long(lookup: DataFrame, abbreviation: str = "abbreviation") -> DataFrame:
    """Wide lookup rows as (stage, config_key, config_value), values quoted.

    A table that lacks a stage is left out: half a configuration is not written.
    """
    if MISSING_STAGES in lookup.columns:
        lookup = lookup.filter(F.col(MISSING_STAGES).isNull()).drop(MISSING_STAGES)
    entries = F.array(
        *[
            F.struct(
                F.lit(stage).alias("stage"),
                F.concat(F.col(abbreviation), F.lit(suffix)).alias("config_key"),
                F.concat(
                    F.lit('"'), F.col(f"{stage}_{column}").cast("string"), F.lit('"')
                ).alias("config_value"),
            )
            for column, suffix in (("scheme", "PartitionScheme"), ("version", "VersionNumber"))
            for stage in STAGES
        ]
    )
    kept = [
        name
        for name in lookup.columns
        if not name.startswith(tuple(f"{stage}_" for stage in STAGES))
    ]
    return lookup.select(*kept, F.explode(entries).alias("_e")).select(*kept, "_e.*")


def config_line() -> Column:
    """A row of :func:`config_long` as the configuration file spells it."""
    return F.concat("stage", F.lit(".*."), "config_key", F.lit("="), "config_value", F.lit(";"))
