"""Counts and measures over trees and node rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe.functions import trees as T
from treeframe.functions.arrays import let, over, run_lengths


def _per_file(trees: DataFrame, **columns) -> DataFrame:
    return trees.withColumns(columns).drop("tree")


def node_counts(trees: DataFrame) -> DataFrame:
    """Nodes per file, over the whole tree."""
    return _per_file(trees, node_count=F.size("tree").cast("bigint"))


def node_count(nodes: DataFrame) -> DataFrame:
    """Nodes per file from node rows; partial counts are shuffled, not nodes."""
    return nodes.groupBy("file_id").agg(F.count("*").alias("node_count"))


def construct_counts(trees: DataFrame) -> DataFrame:
    """Nodes per file and type, counted inside each file's row."""
    keep = [c for c in trees.columns if c != "tree"]
    return trees.select(*keep, F.inline_outer(over(T.type_counts, "tree"))).withColumnsRenamed(
        {"value": "node_type", "n": "nodes"}
    )


def corpus_constructs(trees: DataFrame) -> DataFrame:
    """Nodes and files per type over the corpus, from per-file counts."""
    return construct_counts(trees).groupBy("node_type").agg(
        F.sum("nodes").alias("nodes"), F.count("*").alias("files")
    )


def pivot_constructs(trees: DataFrame, types: Iterable[str]) -> DataFrame:
    """One column per listed type with its count in each file."""

    def count(wanted: str) -> Column:
        return F.size(F.filter("tree", lambda n: n["node_type"] == wanted)).cast("bigint")

    return _per_file(trees, **{t: count(t) for t in types})


def nesting_metrics(trees: DataFrame, control_types: Iterable[str]) -> DataFrame:
    """Deepest and mean level, and the most control nodes around any node."""
    return _per_file(
        trees,
        max_depth=over(T.max_depth, "tree"),
        mean_depth=over(T.mean_depth, "tree"),
        max_nesting=F.array_max(over(T.enclosing, "tree", types=tuple(control_types))),
    )


def prune_ratio(trees: DataFrame, include=None, exclude=None) -> DataFrame:
    """Nodes in the tree, nodes an outline shows, and the share removed."""
    include, exclude = (None if t is None else tuple(t) for t in (include, exclude))
    return (
        _per_file(
            trees,
            raw_nodes=F.size("tree").cast("bigint"),
            shown_nodes=F.size(over(T.prune, "tree", include=include, exclude=exclude)).cast(
                "bigint"
            ),
        )
        .withColumn("removed", 1 - F.col("shown_nodes") / F.col("raw_nodes"))
    )


def defects(files: DataFrame, content: str = "content") -> DataFrame:
    """Unbalanced markup: one row per file and tag opened and closed unequally often.

    ``unmatched_closes`` counts the file's closing tags that had nothing of their
    name open, ``left_open`` the elements still open at its end. A file with defects
    still parses.
    """
    found = over(_markup_defects, content)
    return files.select("file_id", F.inline_outer(found)).where(F.col("node_type").isNotNull())


def _tags(tokens: Column, weight: int) -> Column:
    return F.map_from_entries(
        run_lengths(
            F.transform(
                F.filter(tokens, lambda t: t["weight"] == weight), lambda t: t["tag"]
            )
        )
    )


def _levels(tokens: Column) -> Column:
    # State: open elements, and closings that found none of their name.
    return F.aggregate(
        tokens,
        F.struct(T.no_open().alias("path"), F.lit(0).alias("unmatched")),
        lambda s, t: let(
            T.after_token(s["path"], t),
            lambda path: F.struct(
                path.alias("path"),
                (s["unmatched"] + ((t["weight"] == -1) & (path == s["path"])).cast("int"))
                .alias("unmatched"),
            ),
        ),
        lambda s: F.struct(T.open_count(s["path"]).alias("open"), s["unmatched"].alias("unmatched")),
    )


def _unbalanced(tokens: Column) -> Column:
    counted = F.struct(
        _tags(tokens, 1).alias("opened"), _tags(tokens, -1).alias("closed"),
        _levels(tokens).alias("levels"),
    )

    def rows(c: Column) -> Column:
        seen = F.array_union(F.map_keys(c["opened"]), F.map_keys(c["closed"]))
        count = lambda side, tag: F.coalesce(F.try_element_at(c[side], tag), F.lit(0))
        return F.filter(
            F.transform(
                seen,
                lambda tag: F.struct(
                    tag.alias("node_type"),
                    count("opened", tag).cast("bigint").alias("opened"),
                    count("closed", tag).cast("bigint").alias("closed"),
                    c["levels"]["unmatched"].cast("bigint").alias("unmatched_closes"),
                    c["levels"]["open"].cast("bigint").alias("left_open"),
                ),
            ),
            lambda r: r["opened"] != r["closed"],
        )

    return let(counted, rows)


def _markup_defects(content: Column) -> Column:
    return let(T.markup_tokens(content), _unbalanced)
