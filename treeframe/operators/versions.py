"""Content hashes, duplicates, incremental work and outline differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeframe.functions import trees as T
from treeframe.functions.arrays import over
from treeframe.functions.text import content_hash

def with_content_hash(df: DataFrame, content: str = "content") -> DataFrame:
    return df.withColumn("content_hash", content_hash(F.col(content)))


def duplicate_groups(df: DataFrame, content: str = "content") -> DataFrame:
    """Contents found in more than one file: how often, and the first file.

    Counts combine before the shuffle, so one content held by a large share of
    the corpus costs no more than any other.
    """
    return (
        with_content_hash(df, content)
        .groupBy("content_hash")
        .agg(F.count("*").alias("files"), F.min("file_id").alias("first_file_id"))
        .where(F.col("files") > 1)
    )


def with_key(
    files: DataFrame, parser: Column | str, version: Column | str, content: str = "content"
) -> DataFrame:
    """Add ``content_hash`` and ``key``, under which a parse result stays valid.

    The key stands for content, language, parser and its version. A file that
    could not be read has none, so it is never taken for another one.
    """
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    hashed = with_content_hash(files, content)
    language = F.lower(F.coalesce("language", F.lit("")))
    key = F.sha2(F.concat_ws("|", language, as_column(parser), as_column(version)), 256)
    return hashed.withColumn("key", F.concat("content_hash", F.lit(":"), key))


def incremental(new: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of ``new`` to parse: one file per key that ``done`` lacks, and all without a key.

    A file is its key and id, as an id may come back with another content. ``done`` is
    read once and needs no other column than ``key``; ``new`` is read twice,
    for its keys and for the rows themselves. Only keys and ids are shuffled to find
    the files, each once per task.
    """
    sides = new.where(F.col("key").isNotNull()).select(
        "key", "file_id", F.lit(False).alias("_done")
    ).unionByName(done.select(
        "key", F.lit(None).cast(new.schema["file_id"].dataType).alias("file_id"),
        F.lit(True).alias("_done"),
    ))
    todo = (
        sides.groupBy(F.col("key").alias("_key"))
        .agg(F.min("file_id").alias("_id"), F.max("_done").alias("_done")).where(~F.col("_done"))
    )
    same = (F.col("key") == F.col("_key")) & F.col("file_id").eqNullSafe(F.col("_id"))
    # A file without a key meets no key, and is kept for itself.
    return (
        new.join(todo, same, "left").where(F.col("_key").isNotNull() | F.col("key").isNull())
        .select(*new.columns)
    )


def merge_results(new: DataFrame, done: DataFrame, fresh: DataFrame) -> DataFrame:
    """The result of every file of ``new``, by its key, from earlier and fresh results.

    ``done`` and ``fresh`` hold results with their ``key``; a file without a key
    takes the fresh result of its own id.
    """
    outcome = ["language", "success", "ast_text", "metadata", "error"]
    known = done.select("key", *outcome).unionByName(fresh.select("key", *outcome))
    known = known.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.first(F.struct(*outcome)).alias("_outcome")
    )
    files = new.where(F.col("key").isNotNull()).select("file_id", "path", "key")
    found = files.join(known, "key").select("file_id", "path", "_outcome.*")
    own = fresh.where(F.col("key").isNull()).select("file_id", "path", *outcome)
    return found.unionByName(own)


def outline_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per file, place and type: nodes kept, added and removed between versions.

    Takes node rows with ancestors. Both versions are counted in one
    aggregation over their union, so no join is needed and a file's counts are
    combined in the task that made its nodes.
    """

    def side(nodes: DataFrame, a: int, b: int) -> DataFrame:
        return nodes.select(
            "file_id", F.array_join("path_types", "/").alias("place"), "node_type",
            F.lit(a).alias("_a"), F.lit(b).alias("_b"),
        )

    counted = (
        side(before, 1, 0).unionByName(side(after, 0, 1))
        .groupBy("file_id", "place", "node_type")
        .agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    )
    return counted.select(
        "file_id", "place", "node_type",
        F.least("_a", "_b").alias("kept"),
        F.greatest(F.col("_b") - F.col("_a"), F.lit(0)).alias("added"),
        F.greatest(F.col("_a") - F.col("_b"), F.lit(0)).alias("removed"),
    )


def subtree_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per file, how many nodes were kept, moved, changed, added and removed between versions.

    Takes trees. A node is kept if an equal subtree stands at the same path of
    types in the other version, moved if one stands at another path, changed if what is
    left has a node of its type at its path, and else added or removed. Equal subtrees
    are told by 64-bit hashes; where only some of several can have moved, the first
    paths count.

    Both versions are counted in one aggregation over their union; after that a
    row is a distinct subtree and place of a file.
    """

    def side(trees: DataFrame, a: int, b: int) -> DataFrame:
        return trees.select(
            "file_id", F.inline_outer(over(T.placed_subtrees, "tree")),
            F.lit(a).alias("_a"), F.lit(b).alias("_b"),
        ).where(F.col("hash").isNotNull())

    counted = (
        side(before, 1, 0).unionByName(side(after, 0, 1))
        .groupBy("file_id", "place", "node_type", "hash")
        .agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
        .withColumn("kept", F.least("_a", "_b"))
        .withColumns({"_a": F.col("_a") - F.col("kept"), "_b": F.col("_b") - F.col("kept")})
    )
    # The places of one subtree in one file.
    same = Window.partitionBy("file_id", "hash")
    ahead = same.orderBy("place", "node_type").rowsBetween(Window.unboundedPreceding, -1)
    moving = F.least(F.sum("_a").over(same), F.sum("_b").over(same))

    def moved(c: str) -> Column:
        open_ = moving - F.coalesce(F.sum(c).over(ahead), F.lit(0))
        return F.greatest(F.least(F.col(c), open_), F.lit(0))

    placed = (
        counted.withColumns({"_ma": moved("_a"), "_mb": moved("_b")})
        .groupBy("file_id", "place", "node_type")
        .agg(F.sum("kept").alias("kept"), F.sum("_mb").alias("moved"),
             F.sum(F.col("_a") - F.col("_ma")).alias("_a"), F.sum(F.col("_b") - F.col("_mb")).alias("_b"))
        .withColumn("changed", F.least("_a", "_b"))
    )
    return placed.groupBy("file_id").agg(
        F.sum("kept").alias("kept"), F.sum("moved").alias("moved"), F.sum("changed").alias("changed"),
        F.sum(F.col("_b") - F.col("changed")).alias("added"),
        F.sum(F.col("_a") - F.col("changed")).alias("removed"),
    )
