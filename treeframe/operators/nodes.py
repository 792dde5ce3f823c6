"""From files to trees, between trees and node rows, and pruning."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe import schemas
from treeframe.functions import trees as T
from treeframe.functions.arrays import over
from treeframe.operators.languages import with_language_config
from treeframe.registry import Registry

PART_NODES = 50_000


def _trees(files: DataFrame, build: Callable[[Column], Column], content: str) -> DataFrame:
    return files.withColumn("tree", over(build, content)).drop(content)


def markup_trees(files: DataFrame, content: str = "content") -> DataFrame:
    """One row per file with the tree of its markup."""
    return _trees(files, T.markup_tree, content)


def prose_trees(files: DataFrame, content: str = "content") -> DataFrame:
    """One row per file with its document - line - sentence tree."""
    return _trees(files, T.prose_tree, content)


def outline_trees(results: DataFrame, outline: str = "ast_text") -> DataFrame:
    """One row per result with the tree that its outline shows."""
    return _trees(results, T.outline_tree, outline)


def explode_nodes(trees: DataFrame, paths: bool = True) -> DataFrame:
    """One row per node; with ``paths`` also its parent and ancestors.

    Every tree has a root, so the outer form drops nothing; it also keeps
    Catalyst from evaluating the tree a second time in an inferred filter.
    """
    tree = over(T.with_paths, "tree") if paths else F.col("tree")
    keep = [c for c in trees.columns if c != "tree"]
    return trees.select(*keep, F.inline_outer(tree)).where(F.col("ord").isNotNull())


def markup_nodes(files: DataFrame, content: str = "content") -> DataFrame:
    return explode_nodes(markup_trees(files.select("file_id", content), content))


def text_nodes(files: DataFrame, content: str = "content") -> DataFrame:
    return explode_nodes(prose_trees(files.select("file_id", content), content))


def outline_nodes(results: DataFrame, outline: str = "ast_text") -> DataFrame:
    return explode_nodes(outline_trees(results.select("file_id", outline), outline))


def with_tree_paths(nodes: DataFrame, part_nodes: int = PART_NODES) -> DataFrame:
    """Add parent and ancestors to node rows that lack them; any depth, any size.

    A file is worked on in parts of ``part_nodes`` nodes, so that one with a large
    share of all nodes is spread over tasks. Only what is open at the end of
    each part, a few nodes, is brought together by file.
    """
    fields = schemas.NODE.fieldNames()
    parts = (
        nodes.select("file_id", *fields, F.floor(F.col("ord") / part_nodes).alias("part"))
        .groupBy("file_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("tree"))
    )
    starts = (
        parts.select(
            "file_id", "part",
            F.array_min(F.transform("tree", lambda n: n["depth"])).alias("low"),
            over(T.open_at_end, "tree").alias("tail"),
        )
        .groupBy("file_id")
        .agg(F.array_sort(F.collect_list(F.struct("part", "low", "tail"))).alias("parts"))
        .select("file_id", F.inline_outer(over(T.open_at_starts, "parts")))
    )
    return parts.join(starts, ["file_id", "part"]).select(
        "file_id", F.inline_outer(over(T.with_paths_after, "tree", "start"))
    )


def prune_include(nodes: DataFrame, include: Iterable[str] | Column) -> DataFrame:
    """Nodes whose ancestors are all of included types (needs ancestor columns)."""
    allowed = include if isinstance(include, Column) else F.array(*[F.lit(t) for t in include])
    return nodes.where(F.forall("path_types", lambda t: F.array_contains(allowed, t)))


def prune_exclude(nodes: DataFrame, exclude: Iterable[str] | Column) -> DataFrame:
    """Nodes with no ancestor of an excluded type (needs ancestor columns)."""
    hidden = exclude if isinstance(exclude, Column) else F.array(*[F.lit(t) for t in exclude])
    return nodes.where(~F.exists("path_types", lambda t: F.array_contains(hidden, t)))


def prune_by_language(nodes: DataFrame, registry: Registry) -> DataFrame:
    """Prune node rows by the lists of their ``language`` column."""
    joined = with_language_config(nodes, registry)
    shown = (
        F.when(
            F.size("include_types") > 0,
            F.forall("path_types", lambda t: F.array_contains("include_types", t)),
        )
        .when(
            F.size("exclude_types") > 0,
            ~F.exists("path_types", lambda t: F.array_contains("exclude_types", t)),
        )
        .otherwise(F.lit(True))
    )
    return joined.where(shown).select(*nodes.columns)


def prune_trees(
    trees: DataFrame,
    include: Iterable[str] | None = None,
    exclude: Iterable[str] | None = None,
) -> DataFrame:
    """Prune whole trees row by row; same result as pruning their node rows."""
    include, exclude = (None if t is None else tuple(t) for t in (include, exclude))
    return trees.withColumn("tree", over(T.prune, "tree", include=include, exclude=exclude))


def render_outline(trees: DataFrame) -> DataFrame:
    return trees.withColumn("ast_text", over(T.render, "tree")).drop("tree")


def render_types(trees: DataFrame) -> DataFrame:
    return trees.withColumn("ast_text", over(T.render_types, "tree")).drop("tree")
