"""Documents as files of their own names."""

from __future__ import annotations

import posixpath
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# Tasks get this module's writer with the plan: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "named_files"
STAGING = "_temporary"
DONE = "_SUCCESS"
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|[^\s\[\]{},:"]+|[\[\]{},:]')


def indented(text: str, width: int) -> str:
    """JSON text with a member or item a line; texts and numbers stay as they are written."""
    out, depth, empty = [], 0, False
    for token in TOKEN.findall(text):
        if token in "]}":
            depth -= 1
            if not empty:
                out.append("\n" + " " * (width * depth))
        elif empty:
            out.append("\n" + " " * (width * depth))
        empty = token in "[{"
        depth += empty
        out.append(token)
        if token == ",":
            out.append("\n" + " " * (width * depth))
        elif token == ":":
            out.append(" ")
    return "".join(out)


def _folder(root: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a folder, by URI or as a local path."""
    local = root.removeprefix("file:") if root.startswith("file:/") else root
    if local.startswith("/"):
        return fs.LocalFileSystem(), posixpath.normpath("/" + local.lstrip("/"))
    return fs.FileSystem.from_uri(root)


@dataclass
class Written(WriterCommitMessage):
    files: int


class NamedWriter(DataSourceWriter):
    def __init__(self, root: str, indent: int | None) -> None:
        self.root, self.indent = root, indent

    def write(self, iterator: Iterator[Row]) -> Written:
        """Each file is written aside and then moved to its name, so that none is ever seen in part.

        A task that is run again writes the same files to the same names.
        """
        files, folder = _folder(self.root)
        aside = f"{folder}/{STAGING}/{uuid.uuid4().hex}"
        files.create_dir(aside, recursive=True)
        made, count = set(), 0
        for name, text in iterator:
            part, whole = f"{aside}/{count}", f"{folder}/{name}"
            with files.open_output_stream(part) as out:
                out.write((text if self.indent is None else indented(text, self.indent)).encode())
            parent = posixpath.dirname(whole)
            if parent not in made:
                files.create_dir(parent, recursive=True)
                made.add(parent)
            files.move(part, whole)
            count += 1
        return Written(count)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = _folder(self.root)
        files.create_dir(folder, recursive=True)
        if files.get_file_info(f"{folder}/{STAGING}").type != fs.FileType.NotFound:
            files.delete_dir(f"{folder}/{STAGING}")
        with files.open_output_stream(f"{folder}/{DONE}") as out:
            out.write(str(sum(message.files for message in messages if message)).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = _folder(self.root)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


class NamedFiles(DataSource):
    """The writer behind :func:`write_named`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        indent = self.options.get("indent")
        return NamedWriter(self.options["root"], None if indent is None else int(indent))


def write_named(df: DataFrame, root: str, name: str = "path", text: str = "text", indent: int | None = None) -> None:
    """Write each row's ``text`` as the file ``name`` below ``root``, a folder that must not be there yet.

    Names are relative paths. Names that are NULL, lead out of the folder, start a part with a dot or an
    underscore (readers skip those) or occur twice are an error, found before anything is written; NULL text is
    an empty file, which readers give no row for. Files are written by the tasks. When all are done the folder gets a ``_SUCCESS`` with their
    number; when the job fails the folder is removed. With ``indent`` the text is JSON and laid out by
    it. The file system is one that Arrow opens: local, HDFS, S3 or GCS.
    """
    files, folder = _folder(root)
    if files.get_file_info(folder).type != fs.FileType.NotFound:
        raise ValueError(f"{root} is there already")
    named = df.select(F.col(name).alias("name"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bad = F.col("name").isNull() | F.col("name").rlike(r"^$|^/|/$|(^|/)([._]|/)")
    wrong = named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(bad | (F.col("n") > 1)).head(5)
    if wrong:
        raise ValueError(f"not usable as names of one file each: {', '.join(str(row['name']) for row in wrong)}")
    df.sparkSession.dataSource.register(NamedFiles)
    writer = named.write.format(FORMAT).mode("append").option("root", root)
    (writer if indent is None else writer.option("indent", indent)).save()
