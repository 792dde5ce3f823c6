"""Language detection expressions over small driver-side tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from treeframe.registry import EXTENSIONS, Registry


def lookup(key: Column, table: dict[str, str]) -> Column:
    """Value for ``key`` in a driver-side table, inlined as a map literal."""
    if not table:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def suffix(path: Column) -> Column:
    """Lower-cased suffix of a path, with its dot; empty when there is none.

    The name is cut off first, and then only its last dot counts, so a long path
    takes one pass.
    """
    name = F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)
    dot = F.substring_index(name, ".", -1)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(dot) - 1)
    has = (F.length(dot) > 0) & (F.length(dot) < F.length(name)) & (F.ltrim(stem, F.lit(".")) != "")
    return F.lower(F.when(has, F.concat(F.lit("."), dot)).otherwise(F.lit("")))


def url_path(url: Column) -> Column:
    """A URL without query and fragment, for suffix detection."""
    return F.regexp_replace(url, r"[?#].*$", "")


def detect(path: Column, extensions: dict[str, str] = EXTENSIONS) -> Column:
    """Language of a path by its suffix; NULL when unknown."""
    return lookup(suffix(path), extensions)


def by_extension(ext: Column, registry: Registry) -> Column:
    """Language whose registry entry lists ``ext`` first; a missing dot is added."""
    lowered = F.lower(ext)
    return lookup(
        F.when(lowered.startswith("."), lowered).otherwise(F.concat(F.lit("."), lowered)),
        registry.by_extension(),
    )
