"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Items of at most ``BASE`` shingles are found exactly: of n shingles of which m
have to be shared, any n - m + 1 hold a shared one, so the rarest of these are
looked up among all shingles of the document.

Longer items are parted by the number of their shingles: part c holds those with
at most ``BASE * 2**c``. For each part, a document is cut into windows of twice
that many shingles, each beginning halfway through the one before, so an item's
passage lies within one window however long the document is, and the
containment that is sought implies a Jaccard similarity that does not depend on
the document's length. Minima over the smallest blocks are computed once and
merged pairwise for the larger parts.

A window and an item of its part that share one of ``HASHES`` minima are a
candidate; at the smallest similarity that a part can hold (0.19 at a
containment of 0.8) all minima miss with a probability of about 1e-6. All
candidates are verified on full sets: the share of the item's distinct shingles
that the whole document has.

The benchmark's index goes to the tasks as a broadcast value of bounded size;
a benchmark of more items is searched in several passes of that size, each over
the documents as they are. Documents are read once per pass and not shuffled.

Words are letters and digits, A-Z in lower case; a shingle has ``WIDTH`` words,
and a text of fewer words is one shingle of all its words. Defined results: a
text without words has no shingles: no item of this kind is found, and no such
document has items. Rows that repeat an id or a text are judged each on its
own; null ids stay null. Empty tables, on either side, give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeframe.llm.rows import map_batches, saved, small, text_of
from treeframe.llm.words import LETTERS, U64, Words, mixed, shingles, slices

WIDTH, CONTAINMENT = 5, 0.8
BASE, HASHES = 8, 64
# Items of one pass: their sets and minima take some 100 MB.
ITEMS = 50_000
BITS = 16
FOUND = "doc_id bigint, mark bigint, item_id bigint, n_shingles bigint, n_shared bigint"

FACTORS = np.random.default_rng(11).integers(0, 2**63, HASHES, dtype=np.uint64) * U64(2) + U64(1)


def size_class(n: np.ndarray) -> np.ndarray:
    """The part of an item with ``n`` shingles."""
    return np.maximum(np.ceil(np.log2(np.maximum(n, 1) / BASE)), 0).astype(np.int64)


def minima_tables(sets: list[np.ndarray]) -> dict[int, list[tuple]]:
    """By part above the least, for each hash function: items' minima in order, the
    items, and a filter."""
    sizes = size_class(np.array([len(s) for s in sets]))
    parts = {}
    for c in np.unique(sizes[sizes > 0]):
        of = np.flatnonzero(sizes == c)
        parts[int(c)] = tables = []
        for factor in FACTORS:
            low = np.array([(sets[i] * factor).min() for i in of], U64)
            tables.append(_table(low, of))
    return parts


def short_table(sets: list[np.ndarray], containment: float) -> tuple | None:
    """Shingles of the items of the least part, one of which each match has, in order,
    the items, and a filter."""
    of = [i for i, s in enumerate(sets) if len(s) <= BASE]
    if not of:
        return None
    _, place, count = np.unique(
        np.concatenate([sets[i] for i in of]), return_inverse=True, return_counts=True
    )
    keys, items, at = [], [], 0
    for i in of:
        n = len(sets[i])
        least = next((m for m in range(1, n + 1) if m >= containment * n), n)
        rare = np.argsort(count[place[at : at + n]], kind="stable")[: n - least + 1]
        keys.append(sets[i][rare])
        items.append(np.full(len(rare), i))
        at += n
    return _table(np.concatenate(keys), np.concatenate(items))


def _table(values: np.ndarray, items: np.ndarray) -> tuple:
    order = np.argsort(values, kind="stable")
    seen = np.zeros(1 << BITS, bool)
    seen[(mixed(values) & U64((1 << BITS) - 1)).astype(np.int64)] = True
    return values[order], items[order], seen


def _lookup(table, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``values``, item) of all equal minima."""
    low, items, seen = table
    at = np.flatnonzero(seen[(mixed(values) & U64((1 << BITS) - 1)).astype(np.int64)])
    begin = np.searchsorted(low, values[at], "left")
    n = np.searchsorted(low, values[at], "right") - begin
    place = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(at, n), items[place]


def _candidates(
    short: tuple | None, parts: dict, values: np.ndarray, first: np.ndarray
) -> set[tuple[int, int]]:
    """(text, item) of every text and short item that share a shingle looked up, and of
    every window and item of its part that share a minimum.

    ``first`` holds each text's first shingle. A text's last block is short.
    """
    n = np.diff(first)
    blocks = -(-n // BASE)
    starts = np.concatenate([[0], np.cumsum(blocks)])
    text = np.repeat(np.arange(len(n)), blocks)
    begins = first[text] + (np.arange(len(text)) - starts[text]) * BASE
    found: set[tuple[int, int]] = set()
    if not len(begins):
        return found
    if short:
        at, item = _lookup(short, values)
        own = np.searchsorted(first, at, "right") - 1
        found.update(zip(own.tolist(), item.tolist()))
    if not parts:
        return found
    top = max(parts)
    for k, factor in enumerate(FACTORS):
        low = np.minimum.reduceat(values * factor, begins)
        own, count = text, blocks
        for c in range(top + 1):
            if c:  # merge blocks two by two within each text
                at = np.concatenate([[0], np.cumsum(count)])
                place = np.arange(len(low)) - at[own]
                even = np.flatnonzero(place % 2 == 0)
                low, own, count = np.minimum.reduceat(low, even), own[even], -(-count // 2)
            if c in parts:
                window = low.copy()
                same = own[1:] == own[:-1]
                window[:-1][same] = np.minimum(low[:-1], low[1:])[same]
                at, item = _lookup(parts[c][k], window)
                found.update(zip(own[at].tolist(), item.tolist()))
    return found


def _search(index, containment: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, short, parts = index.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(1), LETTERS, lower=True)
                values, first = shingles(words, WIDTH)
                rows, last, own = [], -1, None
                for text, item in sorted(_candidates(short, parts, values, first)):
                    if text != last:
                        last, own = text, np.unique(values[first[text] : first[text + 1]])
                    have = sets[item]
                    at = np.minimum(np.searchsorted(own, have), len(own) - 1)
                    shared = int((own[at] == have).sum())
                    if shared >= containment * len(have):
                        rows.append((part.column(0)[text].as_py(), part.column(2)[text].as_py(),
                                     ids[item], len(have), shared))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows)],
                        ["doc_id", "mark", "item_id", "n_shingles", "n_shared"],
                    )

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", containment: float = CONTAINMENT,
    items_per_pass: int = ITEMS,
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, n_shingles (of the
    item's set), n_shared, containment."""
    return _found(
        docs, benchmark, id, text, item_id, item_text, containment, items_per_pass
    ).drop("mark")


def _found(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", containment: float = CONTAINMENT,
    items_per_pass: int = ITEMS,
) -> DataFrame:
    """``contaminated`` with a hash of the text as mark."""
    spark = docs.sparkSession
    wanted = benchmark.select(
        F.col(item_id).cast("bigint").alias("item_id"), text_of(item_text).alias("text")
    )
    passes = wanted.count() // items_per_pass + 1
    wanted = wanted.withColumn("_pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    rows = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), text_of(text).alias("text"),
        F.xxhash64(text_of(text)).alias("mark"),
    )
    found = None
    for k in range(passes):
        # A bounded share of the benchmark, not of the documents.
        items = wanted.filter(F.col("_pass") == k).select("item_id", "text").toArrow()
        sets, ids = [], []
        for batch in items.to_batches():
            values, first = shingles(Words(batch.column(1), LETTERS, lower=True), WIDTH)
            for i in np.flatnonzero(np.diff(first)):
                ids.append(batch.column(0)[i].as_py())
                sets.append(np.unique(values[first[i] : first[i + 1]]))
        if not sets:
            continue
        index = spark.sparkContext.broadcast(
            (ids, sets, short_table(sets, containment), minima_tables(sets))
        )
        part = map_batches(rows, _search(index, containment), FOUND)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.

    Rows are told apart by id and text, so a clean row stays whatever its id.
    """
    hit = saved(
        _found(docs, benchmark, id, text, **options)
        .select(F.col("doc_id").alias("__llm_id"), F.col("mark").alias("__llm_mark")).distinct(),
        "contaminated", docs.count(),
    )
    here = F.col(id).eqNullSafe(F.col("__llm_id")) & (F.xxhash64(text_of(text)) == F.col("__llm_mark"))
    return docs.join(small(hit), here, "left_anti")
