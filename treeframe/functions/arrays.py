"""Small building blocks over array columns.

A file is one row, so order-dependent work inside a file is done on the row's
own array: no shuffle, no window, and no file can outgrow a group.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# A fold copies what it has gathered at every step, so states are gathered over
# short blocks only. An array of a few blocks is one block: what it copies costs less than
# to find the states between its blocks first.
BLOCK, ONE_BLOCK = 32, 128
# Longer than any array, small enough that a start position can be added to it.
_ALL = 2_000_000_000


@lru_cache(maxsize=256)
def over(build: Callable[..., Column], *names: str, **options) -> Column:
    """``build`` applied to named columns, with hashable options.

    A long expression takes many calls into the JVM to make, so it is made
    once and used in every plan that needs it.
    """
    return build(*[F.col(name) for name in names], **options)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Naming the value as a lambda variable keeps Catalyst from copying its
    expression to each place that uses it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(
    items: Column, start: Column, step: Callable[[Column, Column], Column]
) -> Column:
    """All states of a left fold over ``items``, one per item.

    Long arrays are cut into blocks, and those of very long ones into groups of
    blocks: a first fold finds the state at the start of each piece and keeps
    nothing else, then each piece is folded from there. The cost grows with
    the number of items.
    """

    def gathered(part: Column, first: Column) -> Column:
        states = F.aggregate(
            part,
            F.array(first),
            lambda done, item: F.array_append(done, step(F.element_at(done, -1), item)),
        )
        return F.slice(states, 2, _ALL)

    def piecewise(whole: Column, first: Column, length: Column, inner) -> Column:
        begins = F.filter(
            F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), length),
            lambda b: b < F.size(whole),
        )
        firsts = F.aggregate(
            F.filter(begins, lambda b: b + length < F.size(whole)),
            F.array(first),
            lambda done, b: F.array_append(
                done, F.aggregate(F.slice(whole, b + 1, length), F.element_at(done, -1), step)
            ),
        )
        return let(
            firsts,
            lambda known: F.flatten(
                F.transform(
                    begins,
                    lambda b, k: let(
                        F.slice(whole, b + 1, length), lambda part: inner(part, F.get(known, k))
                    ),
                )
            ),
        )

    def blocks(whole: Column, first: Column) -> Column:
        length = F.when(F.size(whole) <= ONE_BLOCK, F.lit(ONE_BLOCK)).otherwise(F.lit(BLOCK))
        return piecewise(whole, first, length, gathered)

    return let(
        items,
        lambda whole: F.when(F.size(whole) <= BLOCK * BLOCK, blocks(whole, start)).otherwise(
            piecewise(whole, start, F.lit(BLOCK * BLOCK), blocks)
        ),
    )


def run_lengths(values: Column) -> Column:
    """Distinct values with their counts, as ``array<struct<value, n>>``."""

    def ends(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        return F.filter(
            F.transform(ordered, lambda v, i: F.struct(v.alias("value"), i.alias("end"))),
            lambda x: (x["end"] == last) | (F.get(ordered, x["end"] + 1) != x["value"]),
        )

    return let(
        let(F.array_sort(values), ends),
        lambda runs: F.transform(
            runs,
            lambda run, k: F.struct(
                run["value"].alias("value"),
                (run["end"] - F.coalesce(F.get(runs, k - 1)["end"], F.lit(-1)))
                .cast("bigint").alias("n"),
            ),
        ),
    )
