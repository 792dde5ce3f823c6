"""The whole way from files to parse results."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe import schemas
from treeframe.functions import trees as T
from treeframe.functions.arrays import over
from treeframe.operators.languages import check_supported, resolve_language
from treeframe.plans.producers import (
    ENTRIES_DDL,
    NativeProducer,
    PandasProducer,
    Producers,
    default_producers,
    entries_tree,
    python_entries,
)
from treeframe.registry import CODE_LANGUAGES, EXTENSIONS, Registry
from treeframe.sources.corpus import corpus_from_table

# A file whose content is NULL, or whose parser gave nothing.
NO_TREE = "No content to parse"


def parse_trees(
    files: DataFrame,
    registry: Registry = CODE_LANGUAGES,
    producers: Producers | None = None,
    parser: str | None = None,
    extensions: dict[str, str] = EXTENSIONS,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Language, support check and tree of each file: one row out per row in.

    ``parser`` picks one producer for every supported language; otherwise each
    language's own is used. Native producers need no shuffle and no Python.
    """
    producers = producers or default_producers()
    if parser:
        registry = registry.with_producer(producers.choose(parser).name, *registry.names())
    known = set(producers.names())
    registry = Registry(
        lang if lang.producer in known else replace(lang, producer=None) for lang in registry
    )
    kept = ["file_id", "path", "language", *keep, "include_types", "exclude_types", "producer"]
    checked = check_supported(resolve_language(files, extensions), registry)

    used = {lang.producer for lang in registry}
    native = [p for p in producers.of_kind(NativeProducer) if p.name in used]
    python = [p for p in producers.of_kind(PandasProducer) if p.name in used]

    ready = F.col("error").isNull()
    tree = F.lit(None).cast(schemas.TREE_DDL)
    for producer in native:
        tree = F.when(
            ready & (F.col("producer") == producer.name), over(producer.build, "content")
        ).otherwise(tree)
    if python:
        # One pass: files of native producers pass a NULL, which is not parsed.
        asked = F.when(
            ready & F.col("producer").isin([p.name for p in python]) & F.col("content").isNotNull(),
            F.struct("producer", "content", "language"),
        )
        fields = [asked[f].alias(f) for f in ("producer", "content", "language")]
        checked = checked.withColumn("_entries", python_entries(python)(F.struct(*fields)))
        tree = F.coalesce(tree, entries_tree(F.col("_entries")))
    else:
        checked = checked.withColumn("_entries", F.lit(None).cast(ENTRIES_DDL))
    error = F.coalesce("error", "_entries.error")
    out = checked.select(*kept, tree.alias("tree"), error.alias("error"))
    return out.withColumn(
        "error", F.coalesce("error", F.when(F.col("tree").isNull(), F.lit(NO_TREE)))
    )


def _pruned_outline(tree: Column, include: Column, exclude: Column) -> Column:
    return T.render(T.prune(tree, include, exclude))


def parse_corpus(
    files: DataFrame,
    registry: Registry = CODE_LANGUAGES,
    producers: Producers | None = None,
    parser: str | None = None,
    extensions: dict[str, str] = EXTENSIONS,
    keep: Iterable[str] = (),
    pruned: bool = True,
) -> DataFrame:
    """Parse results of a corpus, with any ``keep`` columns of the input.

    Failures are results too: unreadable, undetected, unsupported and failed
    files come back with an empty outline and an error.
    """
    producers = producers or default_producers()
    keep = list(keep)
    trees = parse_trees(files, registry, producers, parser, extensions, keep)
    # A tree is used twice below, so Catalyst keeps it as a column and builds it
    # once per row, or not at all when neither use is asked for.
    shown = (
        over(_pruned_outline, "tree", "include_types", "exclude_types")
        if pruned else over(T.render, "tree")
    )
    versions = {p.name: p.version for p in producers.items}
    version = F.lit(None).cast("string")
    for name, value in versions.items():
        version = F.when(F.col("producer") == name, F.lit(value)).otherwise(version)
    success = F.col("error").isNull()
    return trees.select(
        "file_id", "path", "language",
        success.alias("success"),
        F.when(success, shown).otherwise(F.lit("")).alias("ast_text"),
        F.struct(
            F.coalesce("producer", F.lit(producers.choose().name)).alias("parser"),
            F.when(success, F.size("tree")).cast("bigint").alias("node_count"),
            F.when(success, version).alias("parser_version"),
        ).alias("metadata"),
        "error",
        *keep,
    )


def parse_code(
    df: DataFrame, id: str, content: str, language: str, registry: Registry, **options
) -> DataFrame:
    """Parse a table's text column whose language column is known."""
    return parse_corpus(corpus_from_table(df, id, content, language), registry, **options)
