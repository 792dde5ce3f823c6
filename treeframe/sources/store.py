"""Saving results and getting them back.

``save_results`` writes a folder once. A *store* takes results again and again
(``commit_results``): every commit is a folder of id-prefix buckets with a Bloom
filter on the id, and a manifest that lists the folders that count from then on. The later
result of an id wins; ``compact_results`` makes one folder of all.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeframe.operators.results import report_text, result_json


def result_id(
    content_hash: Column, language: Column, parser: Column, version: Column
) -> Column:
    """Id of a result: the same content, language, parser and version give the same id."""
    return F.sha2(F.concat_ws("|", content_hash, F.lower(language), parser, version), 256)


def with_result_id(results: DataFrame) -> DataFrame:
    """Add ``id``; needs ``content_hash`` beside the result columns."""
    return results.withColumn(
        "id",
        result_id(
            F.col("content_hash"), F.col("language"), F.col("metadata.parser"),
            F.col("metadata.parser_version"),
        ),
    )


def write_results_json(results: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per line and result."""
    results.select(result_json().alias("value")).write.mode(mode).text(path)


def write_reports(results: DataFrame, path: str, mode: str = "error") -> None:
    results.select(report_text().alias("value")).write.mode(mode).text(path)


def save_results(results: DataFrame, path: str, mode: str = "error") -> None:
    """Save results with an ``id``, by language.

    Rows are ordered inside each task only, which needs no shuffle and lets a
    look-up by id skip row groups.
    """
    (
        results.sortWithinPartitions("language", "id")
        .write.mode(mode).partitionBy("language").parquet(path)
    )


def fetch_result(
    spark: SparkSession, path: str, id: str, language: str | None = None
) -> DataFrame:
    """Saved rows with an id; none when the id is unknown.

    The id filter reaches the parquet scan; a language also prunes folders.
    """
    saved = spark.read.parquet(path).where(F.col("id") == id)
    return saved if language is None else saved.where(F.col("language") == language)


def fetch_results(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Saved rows for many ids at once."""
    return spark.read.parquet(path).join(ids.select("id").distinct(), "id", "left_semi")


# Buckets by the first two hex digits of the id, which is a hash: they are of even size.
BUCKET_DIGITS = 2


def _bucket(id: Column) -> Column:
    return F.conv(F.substring(id, 1, BUCKET_DIGITS), 16, 10).cast("int")


def _latest(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Number of the last commit and the folders that count, oldest first; 0 and none at first."""
    try:
        commits = spark.read.schema("place int, folder string, commit int").parquet(f"{path}/commits")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    # A few rows for each commit.
    last = commits.agg(F.max("commit")).first()[0] or 0
    rows = commits.where(F.col("commit") == last).orderBy("place").collect()
    return last, [r.folder for r in rows]


def _publish(spark: SparkSession, path: str, commit: int, folders: list[str]) -> None:
    rows = spark.createDataFrame(list(enumerate(folders)), "place int, folder string")
    # Fails if another writer took the number.
    rows.coalesce(1).write.mode("error").parquet(f"{path}/commits/commit={commit}")


def _write_buckets(results: DataFrame, path: str, files: int) -> str:
    folder = f"{uuid.uuid4().hex}"
    one = results.groupBy("id").agg(F.first(F.struct(*results.columns)).alias("_row")).select("_row.*")
    (
        one.withColumn("bucket", _bucket(F.col("id")))
        .repartition(F.col("bucket"), F.pmod(F.xxhash64("id"), F.lit(files)))
        .sortWithinPartitions("bucket", "id")
        .write.option("parquet.bloom.filter.enabled#id", "true").partitionBy("bucket")
        .parquet(f"{path}/data/{folder}")
    )
    return folder


def commit_results(results: DataFrame, path: str, files: int = 1) -> int:
    """Add results with an ``id`` to the store, one row for each id; gives the commit's number.

    Equal ids are equal results, so they combine before the shuffle. ``files`` is the
    number of files of a bucket. Readers see all of a commit or nothing of it.
    """
    spark = results.sparkSession
    last, folders = _latest(spark, path)
    folder = _write_buckets(results, path, files)
    _publish(spark, path, last + 1, [*folders, folder])
    return last + 1


def _commits(spark: SparkSession, path: str, keep) -> DataFrame | None:
    """Rows of all folders that count, each with its folder's place; ``keep`` filters them."""
    found = None
    for place, folder in enumerate(_latest(spark, path)[1]):
        rows = keep(spark.read.parquet(f"{path}/data/{folder}")).withColumn("_place", F.lit(place))
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    if found is None:
        raise ValueError(f"no results in {path}")
    return found


def _winners(rows: DataFrame) -> DataFrame:
    columns = [c for c in rows.columns if c not in ("bucket", "_place")]
    return rows.groupBy("id").agg(
        F.max_by(F.struct(*columns), "_place").alias("_row")
    ).select("_row.*")


def stored_results(spark: SparkSession, path: str) -> DataFrame:
    """All results of a store, the latest of each id."""
    return _winners(_commits(spark, path, lambda rows: rows))


def look_up(spark: SparkSession, path: str, id: str) -> DataFrame:
    """The latest result of an id, or none: reads that id's bucket alone."""
    key = F.lit(id)
    return _winners(_commits(
        spark, path, lambda rows: rows.where((F.col("bucket") == _bucket(key)) & (F.col("id") == key))
    ))


def look_up_all(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """The latest results of many ids; Spark prunes buckets as it sees the ids."""
    wanted = ids.select("id").distinct().withColumn("bucket", _bucket(F.col("id")))
    return _winners(_commits(
        spark, path, lambda rows: rows.join(wanted, ["bucket", "id"], "left_semi")
    ))


def compact_results(spark: SparkSession, path: str, files: int = 1) -> int:
    """One folder in place of all earlier ones, which readers still at work may finish with."""
    last, _ = _latest(spark, path)
    folder = _write_buckets(stored_results(spark, path), path, files)
    _publish(spark, path, last + 1, [folder])
    return last + 1
