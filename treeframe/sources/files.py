"""Files of any name, listed and read inside Spark's tasks.

Spark's own file sources pass over names that begin with ``_`` or ``.``, over folders
of such names, and over files of zero bytes. A code base has many of these, so
files are listed level by level and read with ``pyarrow.fs``, which knows local
and shared folders and object stores by their address.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeframe.session import scratch_dir

# A file is one row, and a row has to fit into a task several times over.
MAX_BYTES = 512 << 20
# Handed to Spark at a time, and to one task in all, about.
BATCH_BYTES, TASK_BYTES = 32 << 20, 256 << 20

_ENTRY = "path string, is_file boolean, size bigint, error string"


def located(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what stands before that path in the address."""
    store, inside = fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))
    return store, inside, path[: -len(inside)] if path.endswith(inside) else ""


def _listed(path: str, glob: str) -> Iterator[tuple]:
    """A file itself; of a folder what is in it, files by name."""
    store, inside, before = located(path)
    own = store.get_file_info(inside)
    if own.type == fs.FileType.NotFound:
        raise FileNotFoundError(2, "No such file or directory", path)
    entries = [own] if own.is_file else store.get_file_info(fs.FileSelector(inside))
    for entry in entries:
        if not entry.is_file:
            yield before + entry.path, False, 0, None
        elif fnmatchcase(entry.base_name, glob):
            yield before + entry.path, True, entry.size, None


def _expand(glob: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    rows = list(_listed(path, glob))
                except OSError as problem:  # the folder's or file's own row says why
                    rows = [(path, True, 0, str(problem))]
                if rows:
                    kinds = [pa.string(), pa.bool_(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                        ["path", "is_file", "size", "error"],
                    )

    return run


def list_files(
    spark: SparkSession, root: str | list[str], glob: str = "*", recursive: bool = True
) -> DataFrame:
    """(path, size, error) of every file under ``root`` whose name matches ``glob``.

    One job per level of folders; each level is written to the shared scratch folder.
    """
    roots = [root] if isinstance(root, str) else list(root)
    level = spark.createDataFrame([(r.rstrip("/") or "/",) for r in roots], "path string")
    found = None
    while True:
        place = scratch_dir(spark, "listing")
        level.mapInArrow(_expand(glob), _ENTRY).write.parquet(place)
        entries = spark.read.schema(_ENTRY).parquet(place)
        files = entries.where("is_file").drop("is_file")
        found = files if found is None else found.unionByName(files)
        level = entries.where("not is_file").select("path")
        if not recursive or level.isEmpty():
            return found
        level = level.repartition("path")


def _one(path: str, problem: str | None, max_bytes: int) -> tuple[bytes | None, str | None]:
    try:
        if problem is not None:
            return None, problem
        store, inside, _ = located(path)
        size = store.get_file_info(inside).size or 0
        if size > max_bytes:
            return None, f"File too large: {size} bytes"
        with store.open_input_stream(inside) as stream:
            return stream.read(), None
    except (OSError, pa.ArrowException) as problem:
        return None, str(problem)


def read_rows(files: Iterable[tuple[str, str | None]], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches of (path, raw, error) of files, given by path and what is wrong with them."""
    kinds = [pa.string(), pa.binary(), pa.string()]

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["path", "raw", "error"]
        )

    rows, held = [], 0
    for path, problem in files:
        raw, error = _one(path, problem, max_bytes)
        rows.append((path, raw, error))
        held += len(raw or b"")
        if held >= BATCH_BYTES or len(rows) >= 1000:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def _contents(max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = (
            row for batch in batches
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        )
        yield from read_rows(files, max_bytes)

    return run


def read_files(files: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(path, raw, error) of every row of ``files``; what cannot be read has its error's text.

    ``files`` has ``path`` and may have ``size`` and ``error`` as from ``list_files``; with sizes,
    they are dealt out by the bytes to read.
    """
    error = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    rows = files.select("path", error.alias("error"))
    if "size" in files.columns:
        total = files.agg(F.sum("size")).first()[0] or 0
        cores = files.sparkSession.sparkContext.defaultParallelism
        rows = rows.repartition(max(cores, total // TASK_BYTES), "path")
    return rows.mapInArrow(_contents(max_bytes), "path string, raw binary, error string")
