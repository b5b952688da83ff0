"""Compare a candidate table with its baseline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from twinledger.functions.columns import all_named, named
from twinledger.functions.text import split_names
from twinledger.operators import counts, digest, recon, schema
from twinledger.operators.scope import FULL, Scope, choose_scope
from twinledger.sources.shared import materialise, store


@dataclass(frozen=True)
class Reconciliation:
    """One comparison; every property is a lazy DataFrame.

    Those that compare fingerprints look for hot keys first, in a small job that runs once.
    """

    baseline: DataFrame
    candidate: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    scope: Scope = FULL
    mode: str = "safe"
    region: str | None = None
    cast: bool = False
    #: Both sides' keys and fingerprints as tables in buckets of the keys, see :meth:`stored`.
    tables: tuple[DataFrame, DataFrame] | None = None

    def _aligned(self) -> DataFrame:
        """The candidate as it is compared: with ``cast``, in the baseline's types."""
        if not self.cast:
            return self.candidate
        types = {f.name.lower(): f.dataType for f in self.baseline.schema.fields}
        wanted = {name.lower() for name in (*self.keys, *self.columns)}
        return self.candidate.select(
            *[
                named(f.name).try_cast(types[f.name.lower()]).alias(f.name)
                if f.name.lower() in wanted and f.dataType != types[f.name.lower()]
                else named(f.name)
                for f in self.candidate.schema.fields
            ]
        )

    def _sides(self) -> tuple[DataFrame, DataFrame]:
        if self.tables is not None:
            return self.tables
        return tuple(
            recon.fingerprint(self.scope.apply(side), self.keys, self.columns, self.mode)
            for side in (self.baseline, self._aligned())
        )

    @cached_property
    def _hot(self) -> DataFrame | None:
        return recon.hot_keys(*self._sides(), self.keys)

    def _count(self, baseline: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
        if self.tables is not None:
            return recon.stored_counts(baseline, candidate, keys)
        return recon.key_counts(baseline, candidate, keys, lambda: self._hot)

    def stored(self, buckets: int = 200) -> Reconciliation:
        """The same comparison over stored fingerprints of both sides.

        Each side is read, hashed and dealt by the keys once, into ``buckets`` files of a table in the shared
        folder. Everything that compares fingerprints reads those tables, and joins them without an
        exchange. Worth its cost where several results, or several jobs, are made of them.
        """
        return replace(self, tables=tuple(store(side, "fingerprints", self.keys, buckets) for side in self._sides()))

    def rollup_by_bucket(self, buckets: int = digest.BUCKETS) -> DataFrame:
        """:attr:`rollup` of two nearly equal tables with unique keys, shuffling what differs."""
        return digest.rollup_by_bucket(*self._sides(), self.keys, buckets)

    @property
    def schema_summary(self) -> DataFrame:
        return schema.summary(
            schema.describe(self.baseline, "baseline", "baseline"),
            schema.describe(self.candidate, "candidate", "candidate"),
        )

    @property
    def counts(self) -> DataFrame:
        return counts.count_report(self.baseline, self.candidate, self.scope, self.region)

    @property
    def joined(self) -> DataFrame:
        return recon.full_outer(*self._sides(), self.keys, self._count)

    @property
    def rows(self) -> DataFrame:
        return recon.flag_rows(*self._sides(), self.keys, count=self._count)

    @property
    def rollup(self) -> DataFrame:
        return recon.flag_rollup(*self._sides(), self.keys, self._count)

    @property
    def duplicate_keys(self) -> DataFrame:
        return recon.duplicate_keys(*self._sides(), self.keys)

    def written_rows(self) -> DataFrame:
        """:attr:`rows` as a table in the shared folder, split by flag.

        Worth its cost where the rows have several readers in separate jobs.
        """
        return materialise(self.rows, "rows", ("dq_flag",))

    def samples(self, flag: str, n: int = recon.SAMPLE_ROWS) -> DataFrame:
        rows = recon.flag_rows(*self._sides(), self.keys, (flag,), self._count)
        return recon.sample_rows(rows, flag, n)

    def report(self, n: int = recon.SAMPLE_ROWS, rows: DataFrame | None = None, one_pass: bool = False) -> DataFrame:
        """All sections in one DataFrame: section, region_id, item, row_count.

        The flag totals and the samples read the same grouped rows. Spark
        computes them once and reuses the exchange; ``rows`` may instead be
        :meth:`written_rows`. With ``one_pass`` the samples of all flags are taken in one reading of those rows,
        sorted in each task, instead of an ordered limit a flag.
        """
        sampled = recon.samples_in_one_pass if one_pass else recon.mismatch_samples
        if rows is None:
            mismatches = recon.flag_rows(*self._sides(), self.keys, recon.MISMATCHES, self._count)
            rollup = self.rollup
        else:
            mismatches = rows
            rollup = rows.groupBy("dq_flag").agg(
                F.sum("row_count").cast(recon.WIDE).alias("row_count")
            )
        none = F.lit(None).cast("string")
        parts = [
            self.counts.select(
                F.concat(F.lit("count "), "section").alias("section"),
                "region_id",
                F.col("env").alias("item"),
                F.col("row_count").cast(recon.WIDE).alias("row_count"),
            ),
            self._schema_section(none),
            rollup.select(
                F.lit("flags").alias("section"),
                none.alias("region_id"),
                F.col("dq_flag").alias("item"),
                "row_count",
            ),
        ]
        key_text = F.to_json(F.struct(*all_named(self.keys)), {"ignoreNullFields": "false"})
        parts.append(
            sampled(mismatches, n).select(
                F.concat(F.lit("sample "), "dq_flag").alias("section"),
                none.alias("region_id"),
                key_text.alias("item"),
                F.lit(1).cast(recon.WIDE).alias("row_count"),
            )
        )
        report = parts[0]
        for part in parts[1:]:
            report = report.unionByName(part)
        return report

    def _schema_section(self, none) -> DataFrame:
        lists = ("baseline_only", "candidate_only", "type_drift")
        sizes = ("baseline_columns", "candidate_columns", "common_columns")
        entries = [
            F.struct(
                F.lit(f"schema {name}").alias("section"),
                F.col(name).alias("item"),
                none.cast(recon.WIDE).alias("row_count"),
            )
            for name in lists
        ] + [
            F.struct(
                F.lit(f"schema {name}").alias("section"),
                none.alias("item"),
                F.col(name).cast(recon.WIDE).alias("row_count"),
            )
            for name in sizes
        ]
        return (
            self.schema_summary.select(F.explode(F.array(*entries)).alias("_e"))
            .select("_e.*")
            .select("section", none.alias("region_id"), "item", "row_count")
        )


def reconcile(
    baseline: DataFrame,
    candidate: DataFrame,
    keys: str | Sequence[str],
    exclude: str | Sequence[str] = (),
    scope: Scope | None = None,
    run_date: str | None = None,
    end_of_day: str | None = None,
    mode: str = "safe",
    cast: bool = False,
) -> Reconciliation:
    """Set up a comparison of two tables on their common columns.

    ``exclude`` columns are neither compared nor counted as differences. With
    no ``scope`` the tables' columns choose one, and ``run_date`` or
    ``end_of_day`` gives its value. Region sections appear if both tables have
    the region column; nothing else depends on it. With ``cast`` the candidate's
    columns are compared in the baseline's types (NULL where a value has no such
    form); the schema sections show the types as they are.
    """
    key_names = split_names(keys)
    if not key_names:
        raise ValueError("at least one join key is needed")
    shared = schema.shared_names(baseline, candidate)
    by_lower = {name.lower(): name for name in shared}
    missing = [key for key in key_names if key.lower() not in by_lower]
    if missing:
        raise ValueError(f"join keys not in both tables: {', '.join(missing)}")
    excluded = {name.lower() for name in split_names(exclude)}
    columns = [name for name in shared if name.lower() not in excluded]
    if scope is None:
        scope = choose_scope(shared, run_date, end_of_day)
    return Reconciliation(
        baseline,
        candidate,
        tuple(by_lower[key.lower()] for key in key_names),
        tuple(columns),
        scope,
        mode,
        by_lower.get(schema.REGION_COLUMN),
        cast,
    )
