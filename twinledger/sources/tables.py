"""Tables in, reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.functions.text import file_path, line_value


def read_table(spark: SparkSession, name: str, format: str | None = None, **options) -> DataFrame:
    """A table by catalog name, by path, or through a reader such as ``jdbc``.

    With a format, ``name`` is the path, or ``dbtable`` for JDBC. A name with a
    slash is a parquet path. A table that is not there raises. JDBC reads in one task unless the options
    split it, as :func:`read_split` does.
    """
    if format == "jdbc":
        return spark.read.format("jdbc").options(dbtable=name, **options).load()
    if format is not None:
        return spark.read.format(format).options(**options).load(name)
    if "/" in name:
        return spark.read.options(**options).parquet(name)
    return spark.table(name)


def read_split(spark: SparkSession, name: str, key: str, parts: int, **options) -> DataFrame:
    """A warehouse table through JDBC in ``parts`` ranges of ``key``, a number, date or time.

    The least and the greatest key are asked for first. Rows whose key is NULL are in the first range; a table
    without keys is read by one task.
    """
    bounds = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {name}) bounds"
    least, greatest = read_table(spark, bounds, "jdbc", **options).head()
    if least is None:
        return read_table(spark, name, "jdbc", **options)
    ranges = {"partitionColumn": key, "lowerBound": str(least), "upperBound": str(greatest), "numPartitions": parts}
    return read_table(spark, name, "jdbc", **ranges, **options)


def report_path(template: str, table: str, user: str, run: str) -> str:
    """A report's path from its template: ``{table}``, ``{user}``, ``{run}``."""
    return template.format(table=table.upper(), user=user.lower(), run=run)


def write_report(
    df: DataFrame, template: str, table: str, user: str, run: str, files: int | None = None
) -> str:
    """Write a result as text files with a header; returns the path.

    As many files as the result has partitions, unless a small report is asked
    for as so many ``files``.
    """
    path = report_path(template, table, user, run)
    written = df if files is None else df.repartition(files)
    written.write.option("header", True).csv(path)
    return path


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a comma list on disk."""
    df.write.mode("append").csv(path)


def read_line_values(spark: SparkSession, path: str, labels: dict[str, str]) -> DataFrame:
    """Labelled values out of text files: one row per file, a column per label."""
    texts = spark.read.text(path, wholetext=True)
    values = [line_value(F.col("value"), label).alias(name) for name, label in labels.items()]
    return texts.select(file_path().alias("path"), *values)
