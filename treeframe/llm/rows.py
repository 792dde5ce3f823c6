"""Helpers shared by the operators: written steps, checked broadcasts, running sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeframe.session import scratch_dir

# A table is broadcast only if it was written and counted, and has no more rows.
BROADCAST_ROWS = 500_000
# Rows that a task of a written step gets, if their number is known: narrow ones, and ones
# with sets or minima.
FILE_ROWS, HEAVY_ROWS = 100_000, 2_000
# Rows of one Arrow batch at most: texts are long, and a batch is held by the JVM and by
# Python at once.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words between ASCII white space, in any regular expression dialect.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str | Column) -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def saved(
    df: DataFrame, purpose: str, rows: int | None = None, each: int = FILE_ROWS
) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    It cuts the lineage: what is lost with an executor is read again from there.
    ``rows``, a bound of the rows that the last step reads or makes, lets its tasks be
    joined until each gets ``each`` of them: a short table is few files, however many
    shuffle partitions it comes from. Where Hadoop has no native library, each file
    on a local disk starts processes from the executor to set permissions, and
    until such a process has begun its own program it counts as a second executor.
    """
    if rows is not None:
        df = df.coalesce(rows // each + 1)
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(written: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it is counted as short.

    A longer one is left as it is, and joined by a shuffle.
    """
    return F.broadcast(written) if written.count() <= rows else written


def running_sums(
    df: DataFrame, order: list[Column], values: dict[str, str | Column], purpose: str,
    rows: int | None = None,
) -> DataFrame:
    """``df`` with, for each of ``values`` (by its new name), the sum over all rows before it.

    Rows are range-sorted and written with the number of their part; sums of
    the parts are few, and a window runs within each part only, so no task gets
    more than one range. Rows that ``order`` does not tell apart come in any
    order. ``rows`` is their number, if it is known: see ``saved``.
    """
    parts = saved(
        df.withColumns({f"_v_{k}": v if isinstance(v, Column) else F.col(v)
                        for k, v in values.items()})
        .repartitionByRange(*order).withColumn("_part", F.spark_partition_id()),
        purpose, rows,
    )
    sums = parts.groupBy("_part").agg(*[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in values])
    # One row for each part: as many rows as there are partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_part",
        *[F.coalesce(F.sum(f"_s_{k}").over(earlier), F.lit(0)).alias(f"_o_{k}") for k in values],
    )
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        parts.join(F.broadcast(starts), "_part")
        .withColumns({
            k: F.col(f"_o_{k}") + F.coalesce(F.sum(f"_v_{k}").over(within), F.lit(0))
            for k in values
        })
        .select(*df.columns, *values)
    )
    return summed if rows is None else summed.coalesce(rows // FILE_ROWS + 1)


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``df.mapInArrow`` with batches of a bounded number of rows.

    The bound is a setting of the session, and stays set for it unless a lower
    one is there already.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, str(BATCH_ROWS))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(bounded, schema)
