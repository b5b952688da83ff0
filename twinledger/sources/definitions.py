"""Definition documents: JSON files of jobs and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from twinledger.functions.nested import patch_document
from twinledger.functions.text import file_path

# Fixed value: a path through this folder holds a job, any other a profile.
JOBS_FOLDER = "/jobs/"
WRITTEN_JOBS = "/kind=job/"


def _reader(spark: SparkSession, one_per_file: bool):
    return spark.read.options(
        recursiveFileLookup=True, pathGlobFilter="*.json", multiLine=one_per_file
    )


def _known_first(found: T.DataType, known: T.DataType | None) -> T.DataType:
    """``found`` with the types of ``known`` where it has them."""
    if isinstance(found, T.StructType) and isinstance(known, T.StructType):
        fields = {f.name: f.dataType for f in found.fields}
        for field in known.fields:
            fields[field.name] = _known_first(fields.get(field.name, field.dataType), field.dataType)
        return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])
    if isinstance(found, T.ArrayType) and isinstance(known, T.ArrayType):
        return T.ArrayType(_known_first(found.elementType, known.elementType))
    return found if known is None else known


def definition_schema(
    spark: SparkSession, path: str, known: T.StructType | None = None, one_per_file: bool = True
) -> T.StructType:
    """The fields that the documents below ``path`` have, which takes a pass over them.

    ``known`` types win over found ones, so an array that is empty in every
    document has the type of its items.
    """
    return _known_first(_reader(spark, one_per_file).json(path).schema, known)


def kind_of(path: Column) -> Column:
    job = path.contains(JOBS_FOLDER) | path.contains(WRITTEN_JOBS)
    return F.when(job, "job").otherwise("profile")


def unknown_fields(found: T.DataType, known: T.DataType, path: str = "") -> list[str]:
    """Dotted paths of the fields of ``found`` that ``known`` lacks."""
    if isinstance(found, T.ArrayType) and isinstance(known, T.ArrayType):
        return unknown_fields(found.elementType, known.elementType, path + "[]")
    if not (isinstance(found, T.StructType) and isinstance(known, T.StructType)):
        return []
    fields = {f.name: f.dataType for f in known.fields}
    missing = []
    for field in found.fields:
        name = f"{path}.{field.name}".lstrip(".")
        missing += unknown_fields(field.dataType, fields[field.name], name) if field.name in fields else [name]
    return missing


def read_definitions(
    spark: SparkSession, path: str, schema: T.StructType, one_per_file: bool = True, strict: bool = False
) -> DataFrame:
    """All ``*.json`` below ``path`` as (path, kind, doc), with the fields of ``schema``.

    Nothing is inferred; :func:`definition_schema` says what a corpus holds. Fields that the
    schema lacks are not read, so a document written from them loses them (:func:`read_documents` keeps
    them); with ``strict`` they are an error, which takes a pass over the documents. The path is the file's as it is named.
    """
    if strict:
        lost = unknown_fields(_reader(spark, one_per_file).json(path).schema, schema)
        if lost:
            raise ValueError(f"fields that the schema lacks: {', '.join(lost)}")
    files = _reader(spark, one_per_file).schema(schema).json(path)
    return files.select(
        file_path().alias("path"),
        kind_of(file_path()).alias("kind"),
        F.struct(*[F.col(f"`{name}`") for name in files.columns]).alias("doc"),
    )


def read_documents(spark: SparkSession, path: str, schema: T.StructType, one_per_file: bool = True) -> DataFrame:
    """All ``*.json`` below ``path`` as (path, kind, text, doc): the text as it stands and the fields of ``schema``.

    What the schema lacks is still in the text, so :func:`patched_documents` keeps it. ``doc`` is NULL
    where the text is no JSON object.
    """
    files = spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.json").text(path, wholetext=one_per_file)
    return files.select(
        file_path().alias("path"),
        kind_of(file_path()).alias("kind"),
        F.col("value").alias("text"),
        F.from_json("value", schema).alias("doc"),
    )


def patched_documents(docs: DataFrame) -> DataFrame:
    """Standardised ``docs`` with ``text`` changed where ``doc`` differs from ``before``, and nowhere else."""
    kinds = [docs.schema[name].dataType for name in ("before", "doc")]
    return docs.withColumn("text", patch_document(F.col("text"), F.col("before"), F.col("doc"), *kinds))


def write_definitions(df: DataFrame, path: str, file_name: str | None = None) -> None:
    """Write (kind, doc) rows as JSON to a new path, jobs and profiles in folders of their own.

    One write for both. With ``file_name``, a column that is unique per document,
    each document becomes an indented file of its own. Otherwise each line is a
    document, which is the layout for large corpora. Absent fields stay absent.
    """
    if file_name is None:
        df.select("doc.*", "kind").write.partitionBy("kind").json(path)
    else:
        named = df.select("doc.*", "kind", F.col(file_name).alias("file"))
        named.write.partitionBy("kind", "file").option("pretty", True).json(path)
