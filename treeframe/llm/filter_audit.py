"""What each filter of a chain removes, for every order of the filters.

Every document fails some of the five filters; which ones is a mask of five
bits, computed in one scan. Documents are counted by part and mask, at most 32
rows a part, and all else is arithmetic on these counts:

1. A coalition S of filters removes v(S) documents: those that fail one of S.
   The 32 sums are made for each part, of all documents and of marked ones.
2. Differences of coalitions supply the steps: after the filters of S, filter i
   removes v(S + i) - v(S).
3. The Hart-Mas-Colell potential of the removal game is
   P(S) = (v(S) + sum of P(S - i) over i in S) / |S|, P of nothing being 0; the
   Shapley value of i is P(all) - P(all without i). It is kept in whole numbers,
   as |S|! P(S), so that the sum over all 120 orders is exact.

Filter E needs the least id of each text. Texts meet as digests: rows are
first counted by digest, mask, part, marks and id, then by all but the id,
with the least id and its count, so a text that a third of all rows share
arrives as one row for each task. Only narrow rows of these are shuffled.

Defined results: a null text is empty; a null ``part`` counts as the empty
string; a null id has no smaller id, nor is it smaller than any, so such a row
never fails E; rows that repeat the least id of a text do not fail E either. An id is
marked if any of its label rows marks it; labels of null ids mark nothing. An
empty table gives an empty result.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeframe.llm.rows import saved, small, text_of

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
SPACES = " \t\n\v\f\r"
_ALL = (1 << len(FILTERS)) - 1
_MARKS = ("good", "toxic")


def _bits(mask: int) -> list[int]:
    return [i for i in range(len(FILTERS)) if mask >> i & 1]


def text_mask(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 0 to 3.

    One transform names the words, so that they are found once.
    """
    words = F.array_remove(
        F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), ""
    )
    capitals = F.char_length(text) - F.char_length(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    )

    def mask(of: Column) -> Column:
        n = F.size(of)
        return (
            F.when(n < LEAST_WORDS, 1).otherwise(0)
            + F.when(100 * F.size(F.array_distinct(of)) < LEAST_DISTINCT * n, 2).otherwise(0)
            + F.when(100 * capitals > MOST_CAPITALS * F.char_length(text), 4).otherwise(0)
            + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)
        )

    return F.get(F.transform(F.array(words), mask), F.lit(0))


def _marked(labels: DataFrame, id: str, marks: dict[str, str]) -> DataFrame:
    """One row an id that has a mark."""
    ones = [F.max((F.col(c) == 1).cast("int")).alias(f"_{m}") for m, c in marks.items()]
    rows = labels.filter(F.col(id).isNotNull()).groupBy(F.col(id).alias("_id")).agg(*ones)
    return saved(rows.filter(" or ".join(f"_{m} = 1" for m in marks)), "audit-labels")


def masks(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    part: str = "lang", good: str = "quality", toxic: str = "toxic",
) -> DataFrame:
    """Documents counted by part and failed filters: part, mask, n, good, toxic."""
    body = text_of(text)
    rows = docs.select(
        F.col(id).alias("_id"), text_of(F.col(part).cast("string")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("_digest"), text_mask(body).alias("_mask"),
    )
    marked = _marked(labels, id, {"good": good, "toxic": toxic})
    rows = rows.join(small(marked), "_id", "left").fillna(0, [f"_{m}" for m in _MARKS])
    kind = ["_digest", "part", "_mask", *[f"_{m}" for m in _MARKS]]
    by_id = rows.groupBy(*kind, "_id").agg(F.count(F.lit(1)).alias("_n"))
    # Ids of a text that share part and marks; a null id is no least one.
    groups = by_id.groupBy(*kind).agg(
        F.sum("_n").alias("_n"), F.min("_id").alias("_least"),
        F.min_by("_n", "_id").alias("_n_least"),
        F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("_n"))), F.lit(0)).alias("_n_null"),
    )
    # As many rows to a text as it has parts and marks.
    first = F.min("_least").over(Window.partitionBy("_digest"))
    kept = F.col("_n_null") + F.when(F.col("_least") == F.col("_first"), F.col("_n_least")).otherwise(0)
    told = groups.withColumn("_first", first).withColumn("_kept", kept)
    copies = F.array(
        F.struct(F.col("_mask").alias("mask"), F.col("_kept").alias("n")),
        F.struct((F.col("_mask") + 16).alias("mask"), (F.col("_n") - F.col("_kept")).alias("n")),
    )
    return (
        told.select("part", *[f"_{m}" for m in _MARKS], F.explode(copies).alias("_c"))
        .groupBy("part", F.col("_c.mask").alias("mask"))
        .agg(
            F.sum("_c.n").alias("n"),
            *[F.sum(F.col(f"_{m}") * F.col("_c.n")).alias(m) for m in _MARKS],
        )
        .filter("n > 0")
    )


def removal_game(counts: DataFrame) -> DataFrame:
    """Per part, arrays over the 32 coalitions: what each removes (v, good, toxic), and ``total``."""
    # 32 rows for each of at most 32 masks of a part.
    coalitions = counts.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(_ALL))))
    hit = F.col("mask").bitwiseAND(F.col("s")) != 0
    sums = coalitions.groupBy("part", "s").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("n", *_MARKS)],
    )
    rows = F.sort_array(F.collect_list(F.struct("s", "n", *_MARKS, "total")))
    return sums.groupBy("part").agg(rows.alias("rows")).select(
        "part", F.col("rows")[0]["total"].alias("total"),
        F.col("rows")["n"].alias("v"), *[F.col("rows")[m].alias(m) for m in _MARKS],
    )


def potential(v: Column) -> Column:
    """|S|! P(S) for every coalition S, from what coalitions remove; whole numbers.

    With Q(S) = |S|! P(S) the recursion is Q(S) = (|S| - 1)! v(S) + sum of Q(S - i).
    Coalitions come in the order of their masks, so subsets come first.
    """
    factorial = F.array(*[F.lit(f).cast("bigint") for f in (1, 1, 2, 6, 24)])
    places = F.array(*[F.lit(1 << i) for i in range(len(FILTERS))])

    def step(done: Column, s: Column) -> Column:
        below = F.aggregate(
            places, F.lit(0).cast("bigint"),
            lambda total, bit: total
            + F.when(s.bitwiseAND(bit) != 0, F.get(done, s - bit)).otherwise(F.lit(0)),
        )
        own = F.get(factorial, F.bit_count(s) - 1) * F.get(v, s)
        return F.array_append(done, own + below)

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_ALL)), F.array(F.lit(0).cast("bigint")), step
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    part: str = "lang", good: str = "quality", toxic: str = "toxic",
) -> DataFrame:
    """Per part, order and step: what the step's filter does there, and its Shapley sum."""
    games = removal_game(masks(docs, labels, id, text, part, good, toxic))
    games = games.withColumn("q", potential(F.col("v")))
    steps = F.array(*[
        F.struct(
            F.lit(order).alias("filter_order"), F.lit(k + 1).alias("step"),
            F.lit(sum(1 << FILTERS.index(f) for f in order[:k])).alias("before"),
            F.lit(1 << FILTERS.index(order[k])).alias("own"),
        )
        for order in ORDERS for k in range(len(order))
    ])
    rows = games.select("*", F.explode(steps).alias("at")).select("*", "at.*")
    after = F.col("before") + F.col("own")

    def gained(c: str) -> Column:
        return F.get(c, after) - F.get(c, F.col("before"))

    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("v", after)).alias("kept"),
        gained("v").alias("removed"),
        (F.get("v", F.col("own")) - gained("v")).alias("redundant"),
        (F.get("v", F.lit(_ALL)) - F.get("v", F.lit(_ALL) - F.col("own"))).alias("unique_fails"),
        gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"),
        # 120 (P(all) - P(all without i)), P of four filters being Q / 24.
        (F.get("q", F.lit(_ALL)) - 5 * F.get("q", F.lit(_ALL) - F.col("own"))).alias("shapley"),
    )
