"""A saved index from node types to files, as bitmaps.

A row of the index is a node type, a bucket of file ids and a bitmap of the files of that
bucket that hold the type. Questions about constructs are then answered from a few bitmaps,
by and, or and not, without parsing a file again. File ids are numbers; a bucket
stands for 32,768 of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeframe.functions.arrays import let

BYTES = 4096  # of one bitmap, as Spark's bitmap functions make them
EVERY = ""  # the type under which all files stand


def construct_bitmaps(trees: DataFrame) -> DataFrame:
    """Node type, bucket and bitmap of the files of ``trees`` (file_id, tree).

    A file without a tree holds no type, but is one of all files. A file gives one
    row for each of its types, and rows of a type and bucket combine before the shuffle.
    """
    types = F.array_distinct(F.transform("tree", lambda n: n["node_type"]))
    held = F.concat(F.array(F.lit(EVERY)), F.coalesce(types, F.array().cast("array<string>")))
    rows = trees.select(F.col("file_id").cast("bigint").alias("file_id"), F.explode(held).alias("node_type"))
    return rows.where(F.col("file_id").isNotNull()).groupBy(
        "node_type", F.bitmap_bucket_number("file_id").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("file_id")).alias("bitmap"))


def save_construct_index(trees: DataFrame, path: str, mode: str = "append") -> None:
    """Write the bitmaps of ``trees``; files that come later are appended.

    Rows are sorted by type, so a question reads the row groups of its types only.
    """
    (
        construct_bitmaps(trees).repartitionByRange("node_type", "bucket")
        .sortWithinPartitions("node_type", "bucket").write.mode(mode).parquet(path)
    )


def files_where(
    spark: SparkSession, path: str, all: Iterable[str] = (), any: Iterable[str] = (),
    none: Iterable[str] = (),
) -> DataFrame:
    """File ids that hold each of ``all``, one of ``any`` at least, and none of ``none``.

    An empty list asks for nothing. Bitmaps of the asked types meet by bucket, one
    for each type; everything else happens inside a bucket's row.
    """
    all, any, none = tuple(all), tuple(any), tuple(none)
    asked = sorted({EVERY, *all, *any, *none})
    # Several saves may each have a bitmap of a type and bucket.
    whole = (
        spark.read.parquet(path).where(F.col("node_type").isin(asked))
        .groupBy("bucket", "node_type").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    )
    per_type = [
        F.max(F.when(F.col("node_type") == t, F.hex("bitmap"))).alias(f"b{i}")
        for i, t in enumerate(asked)
    ]
    buckets = whole.groupBy("bucket").agg(*per_type).where(F.col(f"b{asked.index(EVERY)}").isNotNull())

    def bits(name: str, at: Column) -> Column:
        """A byte of a type's bitmap; a type that no file of the bucket holds has none."""
        code = F.conv(F.substring(F.col(f"b{asked.index(name)}"), at * 2 + 1, F.lit(2)), 16, 10)
        return F.coalesce(code.cast("int"), F.lit(0))

    def byte(at: Column) -> Column:
        found = bits(EVERY, at)
        for name in all:
            found = found.bitwiseAND(bits(name, at))
        if any:
            either = bits(any[0], at)
            for name in any[1:]:
                either = either.bitwiseOR(bits(name, at))
            found = found.bitwiseAND(either)
        for name in none:
            found = found.bitwiseAND(F.bitwise_not(bits(name, at)))
        return found

    def positions(at: Column) -> Column:
        return let(byte(at), lambda b: F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(7)), lambda j: F.call_function("shiftright", b, j).bitwiseAND(F.lit(1)) == 1),
            lambda j: at * 8 + j,
        ))

    found = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BYTES - 1)), positions))
    per = F.lit(8 * BYTES).cast("bigint")
    # Ids over 0 fill buckets from 1 on upwards, all others from 0 on downwards.
    file_id = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * per + F.col("at") + 1).otherwise(
        F.col("bucket") * per - F.col("at")
    )
    return buckets.select("bucket", F.explode(found).alias("at")).select(file_id.alias("file_id"))


def count_where(
    spark: SparkSession, path: str, all: Iterable[str] = (), any: Iterable[str] = (),
    none: Iterable[str] = (),
) -> int:
    """How many files :func:`files_where` gives."""
    return files_where(spark, path, all, any, none).count()
