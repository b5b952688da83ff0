"""Columns by their very names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def named(name: str) -> Column:
    """The column of that name, which may hold dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_named(names: Sequence[str]) -> list[Column]:
    return [named(name) for name in names]
