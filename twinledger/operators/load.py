"""Cloning table shapes and loading rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from twinledger.functions.columns import all_named, named
from twinledger.functions.hashing import row_marks
from twinledger.functions.nested import drop_field, edit_field, field_type
from twinledger.sources.shared import materialise

UPSERT = "UPSERT"


def clone_schema(df: DataFrame) -> DataFrame:
    """An empty DataFrame with the columns and types of ``df``."""
    return df.sparkSession.createDataFrame([], df.schema)


def upsert(
    base: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    option: str | None = "",
    order: Sequence[str] = (),
) -> DataFrame:
    """``base`` with incoming rows added and rows of the same key replaced.

    An absent or empty ``option`` means UPSERT, the only one there is. Columns
    the base lacks are not loaded, columns the incoming rows lack are NULL in
    them. Of several incoming rows of a key the one that is last by the ``order``
    columns counts, of equal ones the one with the largest fingerprint; without
    an order, a repeated key is an error of the plan. A key with NULL in it
    matches nothing: such rows are added as they come, by every load again.
    """
    if (option or UPSERT) != UPSERT:
        raise ValueError(f"unknown merge option {option!r}")
    keys = list(keys)
    known = {name.lower() for name in incoming.columns}
    loaded = [
        named(f.name) if f.name.lower() in known else F.lit(None).cast(f.dataType).alias(f.name)
        for f in base.schema.fields
    ]
    row = F.struct(*loaded)
    # without an order a key comes once, or the load fails
    place = F.struct(*all_named(order), *row_marks(incoming, incoming.columns)) if order else F.lit(True)
    whole = F.lit(True)
    for key in keys:
        whole = whole & named(key).isNotNull()
    by_key = (
        incoming.filter(whole)
        .select(*[named(key).alias(f"_k{i}") for i, key in enumerate(keys)], row.alias("_row"), place.alias("_place"))
        .groupBy(*[f"_k{i}" for i in range(len(keys))])
        .agg(F.max_by("_row", "_place").alias("_row"), F.count(F.lit(1)).alias("_n"))
    )
    if not order:
        error = F.raise_error(F.lit("incoming rows repeat a key and no order is given"))
        by_key = by_key.filter(F.when(F.col("_n") > 1, error.cast("boolean")).otherwise(F.lit(True)))
    latest = by_key.select("_row.*")
    kept = base.join(incoming.select(*all_named(keys)).distinct(), keys, "left_anti")
    return (
        kept.select(*all_named(base.columns))
        .unionByName(latest)
        .unionByName(incoming.filter(~whole).select(*loaded))
    )


OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def upsert_table(table: str, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """:func:`upsert` into a partitioned table of the catalog, rewriting only partitions that it touches.

    Touched are the partitions of the incoming rows, and those that hold a row to be replaced. If the
    partition columns are not all keys, the latter are found in the base's keys alone. Files of other
    partitions are neither read nor written. The touched ones are merged into a table of
    their own first, so a task or job that fails changes nothing, and a load that is run again gives the same
    (but for rows with a NULL key, which every load adds). Partitions left without a row are dropped.
    """
    spark = incoming.sparkSession
    base = spark.table(table)
    parts = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    if not parts:
        raise ValueError(f"{table} has no partitions")
    keys = list(keys)
    fresh = materialise(upsert(clone_schema(base), incoming, keys, order=order), "incoming")
    replaced = fresh.select(*all_named(keys)).dropna().distinct()
    places = fresh.select(*all_named(parts))
    if not {name.lower() for name in parts} <= {name.lower() for name in keys}:
        held = base.select(*all_named(dict.fromkeys([*keys, *parts]))).join(replaced, keys, "left_semi")
        places = places.unionByName(held.select(*all_named(parts)))
    touched = set(places.distinct().collect())  # a row per partition of the table at most
    if not touched:
        return base
    rest = base.filter(_is_among(touched, parts)).join(replaced, keys, "left_anti")
    merged = materialise(rest.select(*all_named(base.columns)).unionByName(fresh), "merged", tuple(parts))
    before = spark.conf.get(OVERWRITE)
    spark.conf.set(OVERWRITE, "dynamic")
    try:
        merged.select(*all_named(base.columns)).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE, before)
    for gone in touched - set(merged.select(*all_named(parts)).distinct().collect()):
        place = ", ".join(f"`{name}` = {_literal(value)}" for name, value in gone.asDict().items())
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({place})")
    return spark.table(table)


def _is_among(places: set[Row], parts: Sequence[str]) -> Column:
    """Rows of one of the partitions, as a condition that the scan is pruned by."""
    if len(parts) == 1:
        values = [place[0] for place in places if place[0] is not None]
        found = named(parts[0]).isin(values) if values else F.lit(False)
        return found | named(parts[0]).isNull() if len(values) < len(places) else found
    found = F.lit(False)
    for place in places:
        same = F.lit(True)
        for name, value in place.asDict().items():
            same = same & (named(name).isNull() if value is None else named(name) == F.lit(value))
        found = found | same
    return found


def _literal(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def clone_definition(
    version: Column,
    dtype: T.StructType,
    new: dict[str, Column],
    carried: Sequence[str],
    dropped: Sequence[str] = (),
    without: dict[str, Sequence[str]] | None = None,
    defaults: dict[str, Column] | None = None,
) -> Column:
    """A version struct as the first draft of another table's version.

    All names are the caller's, as dotted paths into ``dtype``: ``new`` values,
    the paths ``carried`` over as they are, those ``dropped`` from what is carried,
    map entries it goes ``without``, and ``defaults`` for carried values that are
    absent, also where the type lacks the path. Other carried paths that the
    type lacks are left out.
    """
    without, defaults = without or {}, defaults or {}
    for path, names in without.items():
        version = edit_field(
            version, dtype, path, lambda old, n=names: F.map_filter(old, lambda key, _: ~key.isin(*n))
        )
    version = drop_field(version, dtype, *dropped)
    found = dict(new)
    for path in carried:
        if field_type(dtype, path) is not None:
            value = version
            for name in path.split("."):
                value = value.getField(name)
            found[path] = F.coalesce(value, defaults[path]) if path in defaults else value
        elif path in defaults:
            found[path] = defaults[path]
    return _nested(found)


def _nested(paths: dict[str, Column]) -> Column:
    """A struct of values at dotted paths, fields in the order of their first path."""
    heads: dict[str, dict[str, Column]] = {}
    for path, value in paths.items():
        head, _, rest = path.partition(".")
        heads.setdefault(head, {})[rest] = value
    return F.struct(
        *[(inner[""] if "" in inner else _nested(inner)).alias(head) for head, inner in heads.items()]
    )
