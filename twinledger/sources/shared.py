"""The folder that written intermediate tables go to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from twinledger.functions.columns import all_named

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it.

    Where that is unset, a folder in the session's warehouse, which a cluster shares as
    well. A warehouse in a local folder does for a local master; on a cluster every machine
    would write to its own disk, so that is an error.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE)
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{SETTING} is not set, and the warehouse {warehouse} is one machine's own")
    return warehouse.rstrip("/") + "/_shared"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a table and read it back: shared, lasting, columnar."""
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def store(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` as a table of ``buckets`` files, dealt and sorted by ``keys``.

    Joins and groupings by the keys read it without an exchange. The table is the catalog's as
    long as the session; its files stay in the shared folder.
    """
    path = new_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = df.repartition(buckets, *all_named(keys))
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
