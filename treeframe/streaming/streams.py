"""Streaming forms: parse files as they arrive, drop repeated content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from treeframe.functions.text import content_hash
from treeframe.plans.parse import parse_corpus
from treeframe.registry import CODE_LANGUAGES, Registry


def stream_results(
    files: DataFrame,
    path: str,
    checkpoint: str,
    registry: Registry = CODE_LANGUAGES,
    trigger: dict[str, object] | None = None,
    **options,
) -> StreamingQuery:
    """Append the results of a stream of files to parquet.

    Parsing keeps no state between rows, so the batch plan runs unchanged. By
    default the query takes what is available and stops, and goes on when
    started again; ``trigger`` may name another one, as ``{"processingTime": "1 minute"}``.
    """
    return (
        parse_corpus(files, registry, **options)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def dedup_stream(
    files: DataFrame, time: str = "ts", delay: str = "10 minutes", content: str = "content"
) -> DataFrame:
    """A stream with content that repeats within the delay let through once.

    State is one hash per content and is dropped once the watermark passes it;
    rows later than the watermark are dropped too, so a backfill whose files are
    not in time order loses content: use ``drop_known`` on batches there. State
    grows with the contents of one delay; keep it in RocksDB by
    ``spark.sql.streaming.stateStore.providerClass``.
    """
    return (
        files.withColumns({
            time: F.col(time).cast("timestamp"), "content_hash": content_hash(F.col(content)),
        })
        .withWatermark(time, delay)
        .dropDuplicatesWithinWatermark(["content_hash"])
    )


def drop_known(files: DataFrame, known: DataFrame, content: str = "content") -> DataFrame:
    """A batch without content whose hash is in ``known`` (content_hash), each new one once.

    For backfills and ``foreachBatch``: nothing is dropped for being late. Of files
    with equal content the smallest ``file_id`` stays; a NULL content is never equal.
    """
    hashed = files.withColumn("content_hash", content_hash(F.col(content)))
    first = (
        hashed.where(F.col("content_hash").isNotNull()).groupBy("content_hash")
        .agg(F.min("file_id").alias("_id"))
        .join(known.select("content_hash").distinct(), "content_hash", "left_anti")
        .withColumnRenamed("content_hash", "_hash")
    )
    # By hash and id: an id may come back with a content that is known.
    same = (F.col("content_hash") == F.col("_hash")) & F.col("file_id").eqNullSafe(F.col("_id"))
    return (
        hashed.join(first, same, "left")
        .where(F.col("_hash").isNotNull() | F.col("content_hash").isNull())
        .select(*hashed.columns)
    )
