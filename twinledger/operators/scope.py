"""Which rows of a table a run looks at."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from twinledger.functions.dates import parse_end_of_day, parse_run_date
from twinledger.operators.schema import CHANGED_COLUMN, SNAPSHOT_COLUMN


@dataclass(frozen=True)
class Scope:
    """``snapshot`` (one day), ``changed`` (since a cutoff) or ``full``."""

    kind: str = "full"
    value: str | None = None

    @property
    def condition(self) -> Column | None:
        """The filter, as a plain comparison that reaches the scan."""
        if self.kind == "snapshot":
            return F.col(SNAPSHOT_COLUMN) == parse_run_date(F.lit(self.value))
        if self.kind == "changed":
            return F.col(CHANGED_COLUMN) >= parse_end_of_day(F.lit(self.value))
        return None

    @property
    def column(self) -> str | None:
        return {"snapshot": SNAPSHOT_COLUMN, "changed": CHANGED_COLUMN}.get(self.kind)

    def apply(self, df: DataFrame) -> DataFrame:
        condition = self.condition
        return df if condition is None else df.filter(condition)


FULL = Scope()


def snapshot(run_date: str) -> Scope:
    """Rows of one snapshot day, given as ``yyyy/MM/dd``."""
    return Scope("snapshot", run_date)


def changed_since(end_of_day: str) -> Scope:
    """Rows changed at or after a cutoff, given as ``yyyy/MM/dd HH:mm:ss``."""
    return Scope("changed", end_of_day)


def choose_scope(
    common: Iterable[str], run_date: str | None = None, end_of_day: str | None = None
) -> Scope:
    """A snapshot day if the tables have one, else a change date, else all rows."""
    names = {name.lower() for name in common}
    if SNAPSHOT_COLUMN in names:
        if run_date is None:
            raise ValueError(f"tables with {SNAPSHOT_COLUMN} need a run_date")
        return snapshot(run_date)
    if CHANGED_COLUMN in names:
        if end_of_day is None:
            raise ValueError(f"tables with {CHANGED_COLUMN} need an end_of_day")
        return changed_since(end_of_day)
    return FULL
