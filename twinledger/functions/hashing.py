"""Row fingerprints.

Two formulas are on offer. ``compat`` concatenates trimmed text with a typed
sentinel in place of NULL and no delimiter, so ``('ab', 'c')`` equals
``('a', 'bc')`` and NULL equals the sentinel. ``safe`` writes every value as
``length:value``, NULL as ``N``, and joins them with ``|``; it has neither
collision.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from twinledger.functions.columns import named

# Columns that never take part in a fingerprint.
AUDIT_COLUMNS = ("dw_last_updated", "snapshot_day", "dw_creation_date")

# What stands for NULL in the compat formula.
INTEGER_SENTINEL = -1
TEXT_SENTINEL = "-1"
DATE_SENTINEL = "1970-01-01"
TIMESTAMP_SENTINEL = "1970-01-01 00:00:00"
DECIMAL_SENTINEL = "-1.0"

MODES = ("safe", "compat")


def with_sentinel(column: Column, dtype: T.DataType) -> Column:
    """``column`` with NULL replaced by the sentinel of its type, type kept.

    Types outside the sentinel table come back as text, so that one NULL in
    them cannot make a whole fingerprint NULL.
    """
    if isinstance(dtype, T.DecimalType):
        if dtype.scale == 0:
            return F.coalesce(column, F.lit(INTEGER_SENTINEL).cast(dtype))
        # decimal(2,2) has no room for -1.00, so widen by one digit there
        whole = max(dtype.precision - dtype.scale, 1)
        wide = T.DecimalType(min(whole + dtype.scale, 38), dtype.scale)
        if wide.precision - wide.scale < 1:
            return F.coalesce(column.cast("string"), F.lit(DECIMAL_SENTINEL))
        return F.coalesce(column.cast(wide), F.lit(DECIMAL_SENTINEL).cast(wide))
    if isinstance(dtype, T.IntegralType):
        return F.coalesce(column, F.lit(INTEGER_SENTINEL).cast(dtype))
    if isinstance(dtype, T.DateType):
        return F.coalesce(column, F.lit(DATE_SENTINEL).cast(dtype))
    if isinstance(dtype, T.TimestampNTZType):
        return F.coalesce(column, F.lit(TIMESTAMP_SENTINEL).cast(dtype))
    return F.coalesce(as_text(column, dtype), F.lit(TEXT_SENTINEL))


def _by_key(one: Column, other: Column) -> Column:
    return F.when(one["key"] < other["key"], -1).when(one["key"] > other["key"], 1).otherwise(0)


def normal(column: Column, dtype: T.DataType) -> Column:
    """``column`` in the one form that all equal values share, at any depth.

    Maps become their entries in key order, negative zero becomes zero.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(column == 0, F.lit(0).cast(dtype)).otherwise(column)
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda item: normal(item, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [normal(column.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else column
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(column),
            lambda entry: F.struct(
                normal(entry["key"], dtype.keyType).alias("key"),
                normal(entry["value"], dtype.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries, _by_key)
    return column


def as_text(column: Column, dtype: T.DataType) -> Column:
    """One text per value, equal for equal values; nested values become JSON."""
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, T.BinaryType):
        return F.hex(column)
    if isinstance(dtype, T.MapType):
        return F.to_json(normal(column, dtype))
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        return F.to_json(normal(column, dtype), {"ignoreNullFields": "false"})
    return normal(column, dtype).cast("string")


def compat_text(column: Column, dtype: T.DataType) -> Column:
    return F.trim(with_sentinel(column, dtype).cast("string"))


def safe_text(column: Column, dtype: T.DataType) -> Column:
    text = as_text(column, dtype)
    return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("N"))


def hashed_columns(columns: Iterable[str]) -> list[str]:
    """The columns that count for a fingerprint, in the order given."""
    return [name for name in columns if name.lower() not in AUDIT_COLUMNS]


def row_hash(df: DataFrame, columns: Iterable[str], mode: str = "safe") -> Column:
    """Hex MD5 over ``columns`` of ``df``; audit columns are left out."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    types = {field.name.lower(): field.dataType for field in df.schema.fields}
    chosen = hashed_columns(columns)
    if not chosen:
        raise ValueError("no column is left to fingerprint")
    if mode == "compat":
        parts = [compat_text(named(name), types[name.lower()]) for name in chosen]
        return F.md5(F.concat(*parts))
    return all_hash(df, chosen)


def _safe_line(df: DataFrame, columns: Iterable[str]) -> Column:
    types = {field.name.lower(): field.dataType for field in df.schema.fields}
    return F.concat_ws("|", *[safe_text(named(name), types[name.lower()]) for name in columns])


def row_marks(df: DataFrame, columns: Iterable[str]) -> list[Column]:
    """Two 64-bit hashes of different seeds over ``columns``: as telling as an MD5 and much cheaper."""
    line = _safe_line(df, columns)
    return [F.xxhash64(F.lit(seed), line) for seed in (1, 2)]


def all_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """The safe fingerprint over all of ``columns``, audit columns too."""
    return F.md5(_safe_line(df, columns))
