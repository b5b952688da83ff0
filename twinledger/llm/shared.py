"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from twinledger.sources import shared as sources

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, in which checkpoints go too."""
    folder = sources.shared_folder(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of a few MB, whatever the length of the texts."""
    if spark.conf.get(BATCH) == "67108864b":  # Spark's own default
        spark.conf.set(BATCH, "8m")


class Recent(dict):
    """Values computed once and kept while they are asked for.

    When ``most`` are held, those become the old ones, which are forgotten the next time
    unless they were asked for again: frequent keys stay, and twice ``most`` bounds what is held.
    """

    def __init__(self, compute: Callable, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = self.copy()
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the cluster's shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
