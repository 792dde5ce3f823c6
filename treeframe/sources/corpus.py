"""Corpora from directories and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from treeframe.functions.text import decoded
from treeframe.sources.files import list_files, read_files

# The read error text.
READ_ERROR = "Error reading file: "
UNKNOWN = "unknown"


def _as_column(value: str | Column | None, kind: str = "string") -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    return value if isinstance(value, Column) else F.col(value)


def spread(files: DataFrame) -> DataFrame:
    """Files over all cores when their input has fewer splits than there are cores.

    A large input has more splits than cores and is returned as it is: no
    shuffle. A small one is dealt out row by row with its contents. Nothing calls
    this but the queries of the catalog; use it on a table as read, before parsing
    it, as a plan that already shuffles would be run to find its splits.
    """
    if files.isStreaming:
        return files
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files if files.rdd.getNumPartitions() >= cores else files.repartition(cores)


def decode_text(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Replace a binary column by ``content`` and ``encoding``."""
    return (
        df.withColumn("_text", decoded(F.col(raw)))
        .withColumns({"content": F.col("_text.content"), "encoding": F.col("_text.encoding")})
        .drop("_text", raw)
    )


def read_corpus(
    spark: SparkSession, root: str | list[str], glob: str = "*", recursive: bool = True
) -> DataFrame:
    """Every file under ``root`` whose name matches ``glob``, decoded.

    Names of any kind and empty files count. ``file_id`` is a 128-bit hash of the
    path, so it is the same in every run and task. What cannot be read is a row
    with the reason.
    """
    return decoded_files(read_files(list_files(spark, root, glob, recursive)))


def read_requested(requested: DataFrame) -> DataFrame:
    """One row per requested path, read as it is asked for: the file, or why it cannot be read.

    ``requested`` has ``path`` and may have ``language``, which is kept.
    """
    files = decoded_files(read_files(requested.select("path").distinct()))
    if "language" not in requested.columns:
        return files
    asked = requested.select("path", F.when(F.col("language") != "", F.col("language")).alias("_asked"))
    unknown = F.when(F.col("read_error").isNotNull(), F.lit(UNKNOWN))
    return (
        files.join(asked, "path").withColumn("language", F.coalesce("_asked", unknown))
        .select(*files.columns)
    )


def decoded_files(read: DataFrame) -> DataFrame:
    """Corpus rows of files that were read: path, raw, error."""
    return decode_text(read).select(
        F.md5("path").alias("file_id"), "path", "content",
        F.lit(None).cast("string").alias("language"), "encoding",
        F.concat(F.lit(READ_ERROR), F.col("error")).alias("read_error"),
    )


def corpus_from_table(
    df: DataFrame,
    id: str | Column,
    content: str | Column,
    language: str | Column | None = None,
    path: str | Column | None = None,
) -> DataFrame:
    """Text that is already in a table, as a corpus. Ids are numbers (bigint) or keep their type."""
    corpus = df.select(
        _as_column(id).alias("file_id"),
        _as_column(path).alias("path"),
        _as_column(content).alias("content"),
        _as_column(language).alias("language"),
        F.lit("utf-8").alias("encoding"),
        F.lit(None).cast("string").alias("read_error"),
    )
    if isinstance(corpus.schema["file_id"].dataType, IntegralType):
        corpus = corpus.withColumn("file_id", F.col("file_id").cast("bigint"))
    return corpus


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """Files of several corpora. Ids of different types all become text."""
    kinds = {c.schema["file_id"].dataType.simpleString() for c in corpora}
    if len(kinds) > 1:
        corpora = tuple(c.withColumn("file_id", F.col("file_id").cast("string")) for c in corpora)
    first, *more = corpora
    for corpus in more:
        first = first.unionByName(corpus)
    return first


def _path_id(found: DataFrame) -> Column:
    """An id for a path that has no file, of the kind that ``found`` has."""
    kind = found.schema["file_id"].dataType
    return F.md5("path") if kind.simpleString() == "string" else F.xxhash64("path")


def with_read_errors(requested: DataFrame, found: DataFrame) -> DataFrame:
    """One row per requested path: the file of a table, or a read error.

    For paths of a file system use ``read_requested``, which says why a read
    failed. ``requested`` has ``path`` and may have ``language``. Contents are joined
    to the requests only where both exist, so a short request list is
    broadcast and contents stay where they are; absent paths are found by the
    paths alone.
    """
    wanted = requested.select(
        "path",
        _as_column("language" if "language" in requested.columns else None).alias("_asked"),
    )
    asked = F.when(F.col("_asked") != "", F.col("_asked"))
    got = (
        found.join(wanted, "path")
        .withColumn("language", F.coalesce(asked, F.col("language")))
        .drop("_asked")
    )
    missing = wanted.join(found.select("path").distinct(), "path", "left_anti").select(
        _path_id(found).alias("file_id"), "path",
        F.lit(None).cast("string").alias("content"),
        F.coalesce(asked, F.lit(UNKNOWN)).alias("language"),
        F.lit(None).cast("string").alias("encoding"),
        F.concat(F.lit(READ_ERROR), F.lit("No such file or directory: '"), F.col("path"),
                 F.lit("'")).alias("read_error"),
    )
    return got.select(*missing.columns).unionByName(missing)
