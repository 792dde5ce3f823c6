"""Files of any name as a Spark data source, in batches and streams.

``spark.read.format("treeframe_files")`` and ``spark.readStream`` of the same name give
every file under a folder, also those that Spark's file sources pass over: names that begin with
``_`` or ``.`` and files of zero bytes. Options: ``path``, ``glob`` (``*``), ``recursive``
(true), ``maxBytes`` (of one file) and, for streams, ``settle`` (0): seconds that a file
must be old, for writers that do not rename whole files into place.

A stream's offset is the time and path of the last file; a file comes once, also
after a restart. The list of files is made where the plan is made, as for Spark's
own file stream; contents are read in tasks, by bytes.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from treeframe.sources.corpus import decoded_files
from treeframe.sources.files import MAX_BYTES, TASK_BYTES, located, read_rows

NAME = "treeframe_files"
TASK_FILES = 10_000
_SCHEMA = "path string, raw binary, error string"

Found = tuple[int, str, int]  # time of change in nanoseconds, path, bytes


@dataclass
class _Files(InputPartition):
    paths: list[str]


def _found(options: dict[str, str]) -> list[Found]:
    """Files under the path that match, by time and path."""
    root = options.get("path")
    if not root:
        raise ValueError("treeframe_files needs a path")
    store, inside, before = located(root.rstrip("/") or "/")
    own = store.get_file_info(inside)
    if own.type == fs.FileType.NotFound:
        raise FileNotFoundError(2, "No such file or directory", root)
    deep = options.get("recursive", "true").lower() == "true"
    entries = [own] if own.is_file else store.get_file_info(fs.FileSelector(inside, recursive=deep))
    glob = options.get("glob", "*")
    return sorted(
        (e.mtime_ns or 0, before + e.path, e.size or 0)
        for e in entries if e.is_file and fnmatchcase(e.base_name, glob)
    )


def _dealt(found: list[Found]) -> list[_Files]:
    """Files in tasks of about as many bytes."""
    out: list[_Files] = []
    held = TASK_BYTES
    for _, path, size in found:
        if held >= TASK_BYTES or len(out[-1].paths) >= TASK_FILES:
            out.append(_Files([]))
            held = 0
        out[-1].paths.append(path)
        held += size
    return out


class _Reader:
    def __init__(self, options: dict[str, str]):
        self.options = options

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        limit = int(self.options.get("maxbytes", self.options.get("maxBytes", MAX_BYTES)))
        return read_rows(((path, None) for path in partition.paths), limit)


class _Batch(_Reader, DataSourceReader):
    def partitions(self) -> list[_Files]:
        # No partition at all would be read as one without a value.
        return _dealt(_found(self.options)) or [_Files([])]


class _Stream(_Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        before = time.time_ns() - int(float(self.options.get("settle", "0")) * 1e9)
        settled = [f for f in _found(self.options) if f[0] <= before]
        if not settled:
            return self.initialOffset()
        return {"time": settled[-1][0], "path": settled[-1][1]}

    def partitions(self, start: dict, end: dict) -> list[_Files]:
        low, high = ((o["time"], o["path"]) for o in (start, end))
        return _dealt([f for f in _found(self.options) if low < f[:2] <= high]) or [_Files([])]


class FilesSource(DataSource):
    """Registered with ``spark.dataSource.register``, or by the functions below."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> _Batch:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> _Stream:
        return _Stream(dict(self.options))


def load_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """The files under ``root`` as a corpus, by the data source."""
    spark.dataSource.register(FilesSource)
    read = spark.read.format(NAME).option("glob", glob).option("recursive", str(recursive))
    return decoded_files(read.load(root))


def stream_files(
    spark: SparkSession, root: str, glob: str = "*", recursive: bool = True, settle: float = 0
) -> DataFrame:
    """Files as they come under ``root``, as a stream of corpus rows."""
    spark.dataSource.register(FilesSource)
    read = (
        spark.readStream.format(NAME).option("glob", glob).option("recursive", str(recursive))
        .option("settle", str(settle))
    )
    return decoded_files(read.load(root))
