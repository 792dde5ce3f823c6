"""Operators over parse results: filters, previews, summaries, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe.functions import text as X

# Report layout.
RULE_WIDTH = 40


def successes(results: DataFrame) -> DataFrame:
    return results.where(F.col("error").isNull())


def failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("error").isNotNull())


def preview(results: DataFrame, column: str = "ast_text", chars: int = 500) -> DataFrame:
    return results.withColumn("preview", X.preview(F.col(column), chars))


def preview_lines(results: DataFrame, column: str = "ast_text", lines: int = 20) -> DataFrame:
    return results.withColumn("preview", X.preview_lines(F.col(column), lines))


def outline_stats(results: DataFrame, column: str = "ast_text") -> DataFrame:
    """Number of outline lines, and of those at the top level."""
    return results.withColumns({
        "n_lines": X.line_count(F.col(column)),
        "n_top_level": X.top_level_lines(F.col(column)),
    })


def text_occurrences(results: DataFrame, word: str, column: str = "ast_text") -> DataFrame:
    return results.withColumn("occurrences", X.occurrences(F.col(column), word))


def size_ratio(results: DataFrame, content: str = "content") -> DataFrame:
    """Outline characters per source character; NULL for an empty source."""
    return results.withColumn(
        "size_ratio", F.try_divide(F.length("ast_text"), F.length(content))
    )


def corpus_summary(results: DataFrame, by: str | None = None) -> DataFrame:
    """Successful and total files, and nodes of the successful ones.

    With ``by``, one row per value plus a grand total (NULL key).
    """
    success = F.col("error").isNull()
    nodes = F.when(success, F.coalesce(F.col("metadata.node_count"), F.lit(0)))
    grouped = results.rollup(by) if by else results.groupBy()
    return grouped.agg(
        F.count_if(success).alias("successful"),
        F.count("*").alias("total"),
        F.coalesce(F.sum(nodes), F.lit(0)).cast("bigint").alias("total_nodes"),
    )


def error_breakdown(results: DataFrame) -> DataFrame:
    return failures(results).groupBy("language", "error").agg(F.count("*").alias("files"))


def report_text(path: str = "path") -> Column:
    """Text report of one result."""
    return F.when(
        F.col("error").isNull(),
        F.concat(
            F.lit("Language: "), F.col("language"), F.lit("\nFile: "), F.col(path),
            F.lit("\n" + "-" * RULE_WIDTH + "\n"), F.col("ast_text"),
        ),
    ).otherwise(F.concat(F.lit("Error parsing file: "), F.col("error")))


def format_report(results: DataFrame) -> DataFrame:
    return results.withColumn("report", report_text())


def result_json() -> Column:
    """One result as a JSON object with a fixed set of keys; nulls are written."""
    return F.to_json(
        F.struct(
            F.col("path").alias("file"), "language", "success",
            F.col("ast_text").alias("ast"), "metadata", "error",
        ),
        {"ignoreNullFields": "false"},
    )
