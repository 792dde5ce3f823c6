"""Mixing sources to target weights, cut at each source's exact budget.

Every row gets a hash-random key; rows are range-sorted by source and key, a
distributed prefix sum of sizes gives each row its place in its source, and the
source's budget cuts there: whole epochs first, then the rows before the cut,
the last of them in part. A source of any share of the rows is many ranges.

Targets: sources in code point order, null last, weigh ``weights`` in turn and
share ``share`` times all sizes; a target stops at ``limit`` times its source's
size, and what is over goes to the others by weight.

Defined results: a null text has size 0; a null source is a source of its own;
a source without words gets nothing; rows repeated with one id each take part.
An empty table gives an empty table. The same rows give the same mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeframe.llm.rows import SPACED_WORD, running_sums, saved, small, text_of

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
SEED = "mix"


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """Per source of rows ``(source, size)``: source, source_size, start, target.

    ``start`` is the sum of sizes of all sources before it. With sources by
    growing cap per weight, a source is capped if the level that all later
    ones could share reaches its cap; prefix sums give that level.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = running_sums(
        totals, [F.col("source").asc_nulls_last()],
        {"start": "source_size", "place": F.lit(1)}, "mix-sources",
    )
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = placed.select(
        "source", "source_size", "start",
        F.get(turn, (F.col("place") % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * limit).alias("cap"),
    )
    by_level = running_sums(
        weighed,
        [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()],
        {"caps_before": "cap", "weights_before": "weight"}, "mix-levels",
    )
    whole = by_level.agg(F.sum("source_size") * share, F.sum("weight")).first()
    budget, weight = float(whole[0] or 0), float(whole[1] or 0)
    level = (F.lit(budget) - F.col("caps_before")) / (F.lit(weight) - F.col("weights_before"))
    judged = by_level.withColumn("capped", F.col("cap") <= level * F.col("weight"))
    full = judged.filter("capped").agg(F.sum("cap"), F.sum("weight")).first()
    rest = weight - float(full[1] or 0)
    shared = (budget - float(full[0] or 0)) / rest if rest > 0 else 0.0
    return judged.select(
        "source", F.col("source_size").cast("bigint").alias("source_size"), "start",
        F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.lit(shared))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
    seed: str = SEED,
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, epochs, taken.

    ``taken`` counts the words that the mix takes of the row, repeats counted.
    """
    name = F.coalesce(F.col(id).cast("string"), F.lit(""))
    rows = saved(
        docs.select(
            F.col(id).alias("doc_id"), F.col(source).alias("source"),
            F.regexp_count(text_of(text), F.lit(SPACED_WORD)).cast("bigint").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), name)).alias("key"),
        ),
        "mix-rows",
    )
    targets = saved(source_targets(rows, weights, share, limit), "mix-targets")
    placed = running_sums(
        rows, [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size")],
        {"before": "size"}, "mix-order", rows.count(),
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - F.col("epochs") * F.col("source_size") - (F.col("before") - F.col("start"))
    part = F.greatest(F.lit(0), F.least(left, F.col("size")))
    joined = placed.join(
        small(targets.withColumnRenamed("source", "_source")),
        F.col("source").eqNullSafe(F.col("_source")),
    )
    return joined.withColumn("epochs", epochs.cast("bigint")).select(
        "doc_id", "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + part).cast("bigint").alias("taken"),
    )
