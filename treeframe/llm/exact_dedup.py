"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Rows whose length is theirs alone are settled by the length; of the rest, those
whose length and prefix hash are theirs alone; only what is left has its whole
text hashed and compared. Only numbers and hashes are shuffled. DataFrame
functions only.

Defined results: a null text counts as empty, and empty texts equal each other;
texts are equal when identical after lower-casing A-Z. Of equal texts the row
with the largest id stays; a null id is smaller than any other. Rows repeated
with the same id and text, case aside, are both marked as kept by
``exact_groups``, and one of them stays in ``drop_duplicates``, also if the id
is null or has other texts too. Other columns are not looked at, whatever
their names. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe.llm.rows import lower_ascii, saved, small, text_of

PREFIX = 64


def _measured(docs: DataFrame, id: str, text: str) -> DataFrame:
    body = text_of(text)
    return docs.select(
        F.col(id).alias("doc_id"),
        body.alias("_text"),
        F.octet_length(body).alias("length"),
        F.xxhash64(lower_ascii(F.substring(body, 1, PREFIX))).alias("prefix"),
    )


def full_hash(text: Column) -> Column:
    return F.unhex(F.sha2(lower_ascii(text), 256))


def duplicate_texts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int | None = None
) -> DataFrame:
    """Texts that more than one row has: length, full_hash, keep_id, group_size.

    ``n`` is the number of rows of ``docs``, if it is known.
    """
    rows = _measured(docs, id, text)
    lengths = saved(
        rows.groupBy("length").count().filter("count > 1").select("length"), "exact-lengths", n
    )
    prefixes = saved(
        rows.join(small(lengths), "length", "left_semi")
        .groupBy("length", "prefix").count().filter("count > 1").select("length", "prefix"),
        "exact-prefixes", n,
    )
    return (
        rows.join(small(prefixes), ["length", "prefix"], "left_semi")
        .select("doc_id", "length", full_hash(F.col("_text")).alias("full_hash"))
        .groupBy("length", "full_hash")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, full_hash (binary).

    Every row leaves with its digest, so here all texts are hashed once more in
    the scan; the groups themselves come from the refinement.
    """
    n = docs.count()
    groups = saved(duplicate_texts(docs, id, text, n), "exact-groups", n)
    rows = _measured(docs, id, text).select(
        "doc_id", "length", full_hash(F.col("_text")).alias("full_hash")
    )
    joined = rows.join(small(groups, 200_000), ["length", "full_hash"], "left")
    keep = F.coalesce("keep_id", "doc_id")
    return joined.select(
        "doc_id", keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "full_hash",
    )


def drop_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text a row with a larger id has too.

    Only rows of repeated texts are looked up; all others pass the scan.
    """
    body, n = text_of(text), docs.count()
    groups = saved(duplicate_texts(docs, id, text, n), "exact-groups", n)
    keys = saved(
        _measured(docs, id, text)
        .join(
            small(saved(groups.select("length").distinct(), "exact-kept", n)), "length", "left_semi"
        )
        .select("doc_id", "length", full_hash(F.col("_text")).alias("full_hash"),
                F.xxhash64("_text").alias("raw"))
        .join(small(groups, 200_000), ["length", "full_hash"])
        .groupBy("doc_id", "full_hash", "raw", "keep_id").count(),
        "exact-keys", n,
    )
    raw = [F.col("doc_id").alias("__llm_id"), F.col("raw").alias("__llm_raw")]
    chosen = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Of one id's texts that differ in case, one stays.
    stays = saved(
        keys.filter(chosen).groupBy("doc_id", "full_hash").agg(
            F.min(F.struct("raw", "count")).alias("least"), F.count(F.lit(1)).alias("variants")
        ).select("doc_id", "full_hash", "least.raw", "least.count", "variants"),
        "exact-stays", n,
    )
    varied = stays.filter("variants > 1").select(
        F.col("doc_id").alias("_id"), F.col("full_hash").alias("_hash"), F.col("raw").alias("_raw")
    )
    others = keys.filter(chosen).join(
        small(varied),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("full_hash") == F.col("_hash"))
        & (F.col("raw") != F.col("_raw")),
        "left_semi",
    )
    dropped = saved(
        keys.filter(~chosen).select(*raw).unionByName(others.select(*raw)), "exact-dropped"
    )
    here = [F.col(id).eqNullSafe(F.col("__llm_id")), F.xxhash64(body) == F.col("__llm_raw")]
    left = docs.join(small(dropped), here, "left_anti")
    # Whole rows that occur again: rare, and only they are compared with each other.
    again = saved(stays.filter("count > 1").select(*raw), "exact-again")
    if again.isEmpty():
        return left
    return left.join(small(again), here, "left_anti").unionByName(
        left.join(small(again), here, "left_semi").withColumn("__llm_raw", F.xxhash64(body))
        .dropDuplicates([id, "__llm_raw"]).drop("__llm_raw")
    )
