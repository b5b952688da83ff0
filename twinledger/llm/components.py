"""Connected components of a link table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from twinledger.llm.shared import checkpointed


def components(links: DataFrame) -> DataFrame:
    """Each linked node with the smallest node it is connected to.

    ``links`` has the bigint columns ``a`` and ``b`` in any order, repeats
    allowed; NULL ends and links of a node with itself are ignored. The result
    has ``node`` and ``component``, nodes without links are not in it.

    A round hooks every node onto its smallest neighbour, if that is smaller,
    follows the hooks to their ends by pointer doubling, and replaces the
    links by links between ends. Every component loses at least half of its
    local maxima a round, so there are few rounds; each is checkpointed.
    """
    left = checkpointed(_oriented(links.select("a", "b")))
    nodes = left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).distinct()
    steps = []
    while not left.isEmpty():
        ends = _ends(left.groupBy("a").agg(F.min("b").alias("end")))
        steps.append(ends)
        left = checkpointed(_oriented(_moved(_moved(left, "a", ends), "b", ends)))
    found = nodes.withColumn("component", F.col("node"))
    return reduce(lambda df, ends: _moved(df, "component", ends), steps, found)


def _oriented(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _moved(df: DataFrame, column: str, ends: DataFrame) -> DataFrame:
    """``df`` with ``column`` replaced by its end, where it has one."""
    to = ends.select(F.col("a").alias("_from"), F.col("end").alias("_to"))
    return df.join(to, F.col(column) == F.col("_from"), "left").select(
        *(F.coalesce("_to", c).alias(c) if c == column else F.col(c) for c in df.columns)
    )


def _ends(hooks: DataFrame) -> DataFrame:
    """Every hook followed to the node that hooks onto nothing."""
    hooks = checkpointed(hooks)
    while True:
        further = hooks.select(F.col("a").alias("_at"), F.col("end").alias("_next"))
        hooks = checkpointed(
            hooks.select("a", "end")
            .join(further, F.col("end") == F.col("_at"), "left")
            .select("a", F.coalesce("_next", "end").alias("end"), F.col("_next").isNotNull().alias("moved"))
        )
        if hooks.filter("moved").isEmpty():
            return hooks.select("a", "end")
