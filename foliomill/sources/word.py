"""Word documents as a data source, in batches and as a stream.

``register(spark)``, then ``spark.read.format("foliomill_docx").load(folder)`` or
``spark.readStream`` with the same format.  Rows are those of ``docx.docx_blocks``:
a row for each block of each .docx file, one row with an error for each file that
can't be read.  Hidden files and those whose names begin with _ or ~ are left out.

Files are spread over partitions by their bytes.  Filters on ``path`` (equal, one
of, beginning, end, part) choose files before any is opened, and a schema that the
user gives prunes columns: without a block's columns a file that isn't asked for
its status is not opened either.

Options: ``recursive`` (false), ``partitionBytes`` (16 MB), and for streams ``log``,
a folder that driver and executors share, where each batch's files are listed
once; a batch that is tried again reads the same files.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from fnmatch import fnmatch

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

from . import docx

NAME = "foliomill_docx"
PARTITION_BYTES = 16 << 20


def store_of(folder: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a folder, the folder there, and what stands before it in full paths."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder.rstrip("/"), ""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").strip("/"), ""
    files, inner = fs.FileSystem.from_uri(folder)
    return files, inner.rstrip("/"), folder.rstrip("/").removesuffix(inner.rstrip("/"))


def listed(options: dict) -> list[tuple[str, int]]:
    """Full path and bytes of the Word files of the folder, by path."""
    files, folder, scheme = store_of(options["path"])
    found = files.get_file_info(fs.FileSelector(folder, recursive=str(options.get("recursive", "false")).lower() == "true"))
    names = [f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._~" and fnmatch(f.base_name.lower(), "*.doc*") and f.extension.lower() in ("doc", "docx")]
    return sorted((scheme + f.path, f.size) for f in names)


class Files(InputPartition):
    """The files that one task reads."""

    def __init__(self, paths: list[str]):
        self.paths = paths


def spread(files: list[tuple[str, int]], most: int) -> list[Files]:
    """Files in the order of their names, up to so many bytes to a partition; a larger file is one of its own."""
    out, held, size = [], [], 0
    for path, n in files:
        if held and size + n > most:
            out.append(Files(held))
            held, size = [], 0
        held.append(path)
        size += n
    return [*out, Files(held)] if held else out


def rows(part: Files, columns: list[str]) -> Iterator[tuple]:
    """The asked columns of each block; files are opened one at a time."""
    for path in part.paths:
        content = None
        if not path.lower().endswith(".doc"):
            files, inner, _ = store_of(path)
            with files.open_input_stream(inner) as f:
                content = f.read()
        for block in docx.blocks_of(path, content):
            yield tuple(block[c] for c in columns)


class Reader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns, self.tests = options, columns, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("path",) and isinstance(f, (EqualTo, EqualNullSafe, In, IsNotNull, StringStartsWith, StringEndsWith, StringContains)):
                self.tests.append((type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def _asked(self, path: str) -> bool:
        holds = {
            "EqualTo": lambda v: path == v, "EqualNullSafe": lambda v: path == v, "In": lambda v: path in v, "IsNotNull": lambda v: True,
            "StringStartsWith": path.startswith, "StringEndsWith": path.endswith, "StringContains": lambda v: v in path,
        }
        return all(holds[kind](value) for kind, value in self.tests)

    def partitions(self) -> list[Files]:
        return spread([f for f in listed(self.options) if self._asked(f[0])], int(self.options.get("partitionBytes", PARTITION_BYTES))) or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        return rows(partition, self.columns)


class StreamReader(DataSourceStreamReader):
    """Offsets count batches; the files of batch n are listed in n.json of the log."""

    def __init__(self, options: dict, columns: list[str]):
        if "log" not in options:
            raise ValueError("a stream needs the option log: a folder that driver and executors share")
        self.options, self.columns = options, columns

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def _batches(self) -> dict[int, list]:
        files, log, _ = store_of(self.options["log"])
        files.create_dir(log, recursive=True)
        names = [f for f in files.get_file_info(fs.FileSelector(log)) if f.extension == "json"]
        return {int(f.base_name.removesuffix(".json")): json.loads(files.open_input_stream(f.path).read()) for f in names}

    def latestOffset(self) -> dict:
        logged = self._batches()
        last, seen = max(logged, default=0), {path for batch in logged.values() for path, _ in batch}
        new = [f for f in listed(self.options) if f[0] not in seen]
        if not new:
            return {"batch": last}
        files, log, _ = store_of(self.options["log"])
        with files.open_output_stream(f"{log}/{last + 1}.part") as f:
            f.write(json.dumps(new).encode())
        files.move(f"{log}/{last + 1}.part", f"{log}/{last + 1}.json")
        return {"batch": last + 1}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        logged = self._batches()
        files = sorted((p, n) for i in range(start["batch"] + 1, end["batch"] + 1) for p, n in logged[i])
        return spread(files, int(self.options.get("partitionBytes", PARTITION_BYTES)))

    def read(self, partition: Files) -> Iterator[tuple]:
        return rows(partition, self.columns)


class WordSource(DataSource):
    """The blocks of Word documents."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return docx.BLOCKS

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options, schema.fieldNames())

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.options, schema.fieldNames())


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WordSource)
