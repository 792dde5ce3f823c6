"""Text quality: votes of the nearest labelled texts in a latent semantic space.

1. Terms of a text are its words in lower case, the shapes of its words (runs of
   capitals, small letters and digits; other characters as they are), and
   whether a word repeats the one before it. Of the labelled sample, the terms that stand
   in most texts are kept.
2. A text is a vector of sqrt(occurrences) times the inverse document frequency;
   words, shapes and repetition are brought to length one each, so that none outweighs the
   others. Truncated singular vectors of the sample (by a randomised range
   finder with a fixed seed) turn it into ``DIMENSIONS`` numbers of length one.
3. The labelled vectors are broadcast. Every text is compared with all of them,
   block by block, as a product of matrices, so its nearest ones are exact;
   ``NEIGHBOURS`` of them, and all that are as near as the last, vote with their
   similarity. The score is the share of votes for quality.

Fitting takes at most ``SAMPLE`` labelled rows, the first by a hash of the id,
one text of each; that is the bound of all that goes to the driver and back. Equal
vectors count as one, with the mean of their labels. Scoring reads every text in one pass.

Defined results: a null or empty text, or one without known terms, gets the
share of good labels; several labels of one id count as good if one of them
is; a null label or id is not learned from; of several texts of one id the one with the
least digest is learned from. Without labels every text gets 0. Empty tables
give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeframe.llm.rows import map_batches, saved, text_of
from treeframe.llm.toxicity import held_out
from treeframe.llm.words import SPACED, U64, Words, buffer_of, mixed, slices

SAMPLE, TERMS, DIMENSIONS, NEIGHBOURS = 4000, 2048, 64, 15
LEAST = 5  # labelled texts that a term stands in
BLOCK = 1024  # texts compared at a time
BITS = 16
KINDS = 3
SHAPE, REPEATED, FRESH = U64(0x5A17), U64(1), U64(2)

# Capitals as A, small letters and all beyond ASCII as a, digits as 0, white space as a space.
CLASSES = np.arange(256, dtype=np.uint8)
CLASSES[65:91], CLASSES[97:123], CLASSES[128:], CLASSES[48:58] = 65, 97, 97, 48
CLASSES[~SPACED] = 32


class Model(NamedTuple):
    terms: np.ndarray  # sorted hashes
    kinds: np.ndarray  # of each term: word, shape or repetition
    idf: np.ndarray
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled x dimensions
    labels: np.ndarray
    share: float  # of good labels


def _shapes(column: pa.Array) -> Words:
    """Words of the texts after each run of characters of a class became one of them."""
    data, marks = buffer_of(column)
    classes = CLASSES[data]
    kept = np.ones(len(classes), bool)
    kept[1:] = classes[1:] != classes[:-1]
    kept[marks[marks < len(classes)]] = True
    left = np.concatenate([[0], np.cumsum(kept)])[marks]
    buffers = [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(classes[kept])]
    return Words(pa.Array.from_buffers(pa.large_string(), len(column), buffers))


def _terms(column: pa.Array) -> tuple[list[np.ndarray], Words]:
    """For each word its three terms."""
    words = Words(column, lower=True)
    content, shape = words.hashes(), _shapes(column).hashes()
    same = np.zeros(len(content), bool)
    same[1:] = content[1:] == content[:-1]
    same[words.first[:-1][words.counts > 0]] = False
    return [content, mixed(shape ^ SHAPE), np.where(same, REPEATED, FRESH)], words


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, texts that have it) of each part of the sample."""
    for batch in batches:
        for part in slices(batch, "text"):
            kinds, words = _terms(part.column(0))
            if not len(words.starts):
                continue
            for kind, terms in enumerate(kinds):
                text = words.text_index()
                order = np.lexsort((text, terms))
                text, terms = text[order], terms[order]
                new = np.ones(len(text), bool)
                new[1:] = (terms[1:] != terms[:-1]) | (text[1:] != text[:-1])
                values, n = np.unique(terms[new], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(np.full(len(n), kind, np.int32)),
                     pa.array(n.astype(np.int64))], ["term", "kind", "n"],
                )


class _Space:
    """Texts as weighted vectors of chosen terms."""

    def __init__(self, terms: np.ndarray, kinds: np.ndarray, idf: np.ndarray):
        self.terms, self.idf = terms, idf.astype(np.float32)
        self.of_kind = np.equal.outer(kinds, np.arange(KINDS)).astype(np.float32)
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(terms >> U64(64 - BITS)).astype(np.int64)] = True

    def blocks(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(first text, a row per text) of ``BLOCK`` texts at a time."""
        kinds, words = _terms(column)
        size, n = len(self.terms), len(column)
        text, place = words.text_index(), []
        for values in kinds:
            at = np.flatnonzero(self.seen[(values >> U64(64 - BITS)).astype(np.int64)])
            found = np.minimum(np.searchsorted(self.terms, values[at]), size - 1)
            hit = self.terms[found] == values[at]
            place.append(text[at[hit]] * size + found[hit])
        places = np.sort(np.concatenate(place))
        for at in range(0, n, BLOCK):
            to = min(at + BLOCK, n)
            low, high = np.searchsorted(places, [at * size, to * size])
            counts = np.bincount(places[low:high] - at * size, minlength=(to - at) * size)
            counts = counts.reshape(to - at, size).astype(np.float32)
            rows = np.sqrt(counts) * self.idf
            length = np.sqrt(np.square(rows) @ self.of_kind)
            yield at, rows / np.maximum(length @ self.of_kind.T, 1e-6)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-6)


def _axes(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """Right singular vectors of the largest singular values, each with a fixed sign."""
    dimensions = min(dimensions, *rows.shape)
    start = np.random.default_rng(0).standard_normal((rows.shape[1], min(dimensions + 16, *rows.shape)))
    basis = np.linalg.qr(rows @ start.astype(np.float32))[0]
    for _ in range(6):
        basis = np.linalg.qr(rows @ np.linalg.qr(rows.T @ basis)[0])[0]
    axes = np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:dimensions]
    largest = axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)]
    return (axes * np.sign(largest)[:, None]).T


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    label: str = "quality", sample: int = SAMPLE, terms: int = TERMS, dimensions: int = DIMENSIONS,
) -> Model:
    """Terms, axes and labelled vectors, from labelled rows that are not held out."""
    usable = labels.filter(~held_out(id) & F.col(id).isNotNull() & F.col(label).isNotNull())
    chosen = saved(
        usable.groupBy(F.col(id).alias("_doc")).agg(F.max(F.col(label).cast("int")).alias("good"))
        .orderBy(F.xxhash64("_doc"), "_doc").limit(sample),
        "quality-labels",
    )
    body = text_of(text)
    rows = saved(
        docs.select(F.col(id).alias("_doc"), body.alias("text"), F.sha2(body, 256).alias("_digest"))
        .join(F.broadcast(chosen), "_doc").groupBy("_doc")
        .agg(F.min_by("text", "_digest").alias("text"), F.max("good").alias("good"))
        .select("text", "good"),
        "quality-sample",
    )
    n, good = rows.agg(F.count(F.lit(1)), F.sum("good")).first()
    none = np.zeros(0)
    if not n:
        return Model(none.astype(U64), none, none, none, none, none, 0.0)
    counts = (
        map_batches(rows, _counted, "term bigint, kind int, n bigint").groupBy("term")
        .agg(F.sum("n").alias("n"), F.min("kind").alias("kind")).filter(F.col("n") >= min(LEAST, n))
        .orderBy(F.col("n").desc(), "term").limit(terms).toArrow()
    )
    if not counts.num_rows:
        return Model(none.astype(U64), none, none, none, none, none, good / n)
    values = counts["term"].to_numpy().view(U64)
    order = np.argsort(values)
    values, kinds = values[order], counts["kind"].to_numpy()[order]
    # Terms that all texts have tell them apart by how often they stand there.
    idf = 0.1 + np.log((1 + n) / counts["n"].to_numpy()[order])
    idf[kinds == KINDS - 1] = 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = _Space(values, kinds, idf)
        for batch in batches:
            for part in slices(batch, "text"):
                for at, block in space.blocks(part.column(0)):
                    row, place = np.nonzero(block)
                    bounds = np.searchsorted(row, np.arange(len(block) + 1))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1).slice(at, len(block)),
                         *[pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), v) for v in
                           (pa.array(place, pa.int32()), pa.array(block[row, place]))]],
                        ["good", "places", "weights"],
                    )

    found = map_batches(
        rows, vectors, "good int, places array<int>, weights array<float>"
    ).toArrow()
    matrix = np.zeros((found.num_rows, len(values)), np.float32)
    places = found["places"].combine_chunks()
    at = np.repeat(np.arange(len(matrix)), np.diff(places.offsets.to_numpy()))
    matrix[at, places.flatten().to_numpy()] = found["weights"].combine_chunks().flatten().to_numpy()
    marks = found["good"].to_numpy().astype(np.float32)
    matrix = _unit(matrix)
    # In an order of their own, however tasks returned them.
    order = np.lexsort((marks, *np.round(matrix[:, :8].T, 4)))
    matrix, marks = matrix[order], marks[order]
    axes = _axes(matrix, dimensions).astype(np.float32)
    points = _unit(matrix @ axes)
    distinct, group = np.unique(np.round(points, 4), axis=0, return_inverse=True)
    means = np.bincount(group.ravel(), marks) / np.bincount(group.ravel())
    return Model(values, kinds, idf, axes, _unit(distinct), means.astype(np.float32), float(good) / n)


def _votes(points: np.ndarray, model: Model, neighbours: int) -> np.ndarray:
    """Share of votes for quality among the nearest labelled vectors of each row."""
    near = np.round(points @ model.vectors.T, 4)
    k = min(neighbours, near.shape[1])
    last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k, None]
    weights = np.where((near >= last) & (near > 0), near, 0)
    total = weights.sum(axis=1)
    some = (total > 0) & points.any(axis=1)
    return np.where(some, weights @ model.labels / np.where(some, total, 1), model.share)


def score(
    docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text",
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """Per row: doc_id, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        space = _Space(model.terms, model.kinds, model.idf) if len(model.terms) else None
        for batch in batches:
            for part in slices(batch, "text"):
                scores = np.full(part.num_rows, model.share)
                for at, block in space.blocks(part.column(1)) if space else ():
                    points = _unit(_unit(block) @ model.axes)
                    scores[at : at + len(block)] = _votes(points, model, neighbours)
                scores = np.round(np.clip(scores, 0, 1), 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores)], ["doc_id", "score"]
                )

    rows = docs.select(F.col(id).alias("doc_id"), text_of(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, score double")
