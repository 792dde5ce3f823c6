"""Language resolution, support checks and registry look-ups."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe import schemas
from treeframe.functions import languages as L
from treeframe.registry import EXTENSIONS, Registry

INLINE_LANGUAGES = 64

# Error and message texts.
NOT_DETECTED = "Could not detect language from file extension"
UNKNOWN = "unknown"


def not_supported(language: Column) -> Column:
    return F.concat(F.lit("Language "), language, F.lit(" not supported"))


def no_producer(language: Column) -> Column:
    return F.concat(F.lit("No producer available for language: "), language)


def detect_language(
    df: DataFrame, path: str = "path", extensions: dict[str, str] = EXTENSIONS
) -> DataFrame:
    """Add ``detected``: the language of each path, NULL when unknown."""
    return df.withColumn("detected", L.detect(F.col(path), extensions))


def resolve_language(df: DataFrame, extensions: dict[str, str] = EXTENSIONS) -> DataFrame:
    """Settle ``language``: a given one wins, else the path decides.

    Rows that stay open get ``unknown`` and an error; names are lower-cased.
    An error that is already there, such as a failed read, is kept.
    """
    given = F.lower(F.when(F.col("language") != "", F.col("language")))
    found = F.coalesce(given, L.detect(F.col("path"), extensions))
    failed = F.lit(None).cast("string")
    if "read_error" in df.columns:
        failed = F.col("read_error")
        found = F.when(failed.isNull(), found).otherwise(given)
    return df.withColumns({
        "language": F.coalesce(found, F.lit(UNKNOWN)),
        "error": F.coalesce(failed, F.when(found.isNull(), F.lit(NOT_DETECTED))),
    })


def with_language_config(df: DataFrame, registry: Registry) -> DataFrame:
    """Attach the registry row of each row's language; NULLs when there is none.

    A short registry becomes a literal of the plan and needs no join. A longer
    one is joined, in the way that Spark chooses by its size.
    """
    if len(registry) <= INLINE_LANGUAGES:
        entry = F.try_element_at(registry_literal(registry), F.lower("language"))
        return df.withColumn("_entry", entry).select(
            *df.columns,
            *[f"_entry.{name}" for name in schemas.LANGUAGES.fieldNames() if name != "language"],
        )
    table = registry.to_df(df.sparkSession)
    return (
        df.withColumn("_key", F.lower("language"))
        .join(table.withColumnRenamed("language", "_key"), "_key", "left")
        .drop("_key")
    )


def registry_literal(registry: Registry) -> Column:
    """The registry as a map from language to its row; Catalyst folds it to a constant."""
    rows = {
        lang.name: {
            "registry_pos": position,
            "extensions": lang.extensions,
            "include_types": lang.include_types,
            "exclude_types": lang.exclude_types,
            "producer": lang.producer,
        }
        for position, lang in enumerate(registry)
    }
    return F.from_json(
        F.lit(json.dumps(rows)), f"map<string,{schemas.LANGUAGES.simpleString()}>"
    )


def check_supported(df: DataFrame, registry: Registry) -> DataFrame:
    """Mark rows whose language is not in the registry, or that nothing can parse."""
    joined = with_language_config(df, registry)
    before = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return joined.withColumn(
        "error",
        F.coalesce(
            before,
            F.when(F.col("registry_pos").isNull(), not_supported(F.lower("language")))
            .when(F.col("producer").isNull(), no_producer(F.lower("language"))),
        ),
    )


def check_languages(df: DataFrame, registry: Registry) -> DataFrame:
    """Per requested language: whether it is supported and can be parsed."""
    supported = F.col("registry_pos").isNotNull()
    return with_language_config(df, registry).select(
        "language",
        supported.alias("supported"),
        F.col("producer").isNotNull().alias("grammar_available"),
        F.concat(
            F.lit("Language "), F.col("language"),
            F.when(supported, F.lit(" is supported")).otherwise(F.lit(" is not supported")),
        ).alias("message"),
    )


def list_languages(languages: DataFrame) -> DataFrame:
    """The names of a registry table in order, each with the number of languages.

    The names end up in one row, so pass a registry (which is bounded) or names
    filtered by one.
    """
    names = languages.agg(F.array_sort(F.collect_set("language")).alias("names"))
    return names.select(
        F.explode("names").alias("language"), F.size("names").cast("bigint").alias("count")
    )


def supported_in(df: DataFrame, registry: Registry) -> DataFrame:
    """Languages of a corpus that the registry supports, in order, with their number."""
    names = df.select(F.lower("language").alias("language"))
    return list_languages(names.where(F.col("language").isin(registry.names())))


def compare_detectors(
    df: DataFrame,
    registry: Registry,
    path: str = "path",
    extensions: dict[str, str] = EXTENSIONS,
) -> DataFrame:
    """Suffixes in a corpus on which the path table and the registry differ."""
    ext = L.suffix(F.col(path))
    return (
        df.select(ext.alias("ext")).where(F.col("ext") != "")
        .groupBy("ext").agg(F.count("*").alias("files"))
        .select(
            "ext",
            L.lookup(F.col("ext"), extensions).alias("by_path"),
            L.by_extension(F.col("ext"), registry).alias("by_registry"),
            "files",
        )
        .where(~F.col("by_path").eqNullSafe(F.col("by_registry")))
    )
