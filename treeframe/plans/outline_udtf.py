"""``outline_lines``: the nodes of an outline as a table function for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

# One row per line that shows something; ``literal`` is the quoted text of a leaf,
# whose type may hold a colon.
BODY = r"""
SELECT CAST(place AS INT), CAST((length(line) - length(ltrim(line))) DIV 2 AS INT),
  CASE WHEN leaf <> '' THEN leaf ELSE ltrim(line) END,
  CASE WHEN leaf <> '' THEN substring(ltrim(line), length(leaf) + 3) END
FROM LATERAL (
  SELECT place, line, regexp_extract(line, '(?s)^ *(.+?): [\'"]', 1) AS leaf
  FROM LATERAL posexplode(filter(split(outline, '\n'), l -> l RLIKE '[^ \\t\\r\\f]')) AS t(place, line)
)
"""


def register_outline_lines(spark: SparkSession, name: str = "outline_lines") -> None:
    """Make ``name(outline)`` known: ord, depth, node_type, literal per line. Built-ins only."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(outline STRING) "
        f"RETURNS TABLE(ord INT, depth INT, node_type STRING, literal STRING) RETURN {BODY}"
    )
