"""Toxicity: a linear classifier trained with a counterfactual penalty.

Features are the distinct words of a text and their beginnings (4, 5 and 6
bytes, for compounds), each present or not. They are counted in Spark over the
training rows, and those that tell the labels apart best are used. The model is
a logistic regression; besides the label loss it pays for every change of the
score between a labelled text and its counterfactual, in which each identity
term is swapped for another one (a text without any gets one added). So terms
that name a group carry no weight of their own, and a neutral mention of a
group is no reason to reject a text.

Training takes at most ``SAMPLE`` labelled rows, the first by a hash of the id;
that is the bound of everything that is fitted or sent to the driver. Scoring
reads every text in one pass.

Defined results: a null or empty text gets the score of a text without
features; several labels of one id count as toxic if one of them is; a null
label or id is not learned from. Without labels of both kinds every text gets
the share of toxic labels, or 0, as its score. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe.llm.rows import map_batches, saved, text_of
from treeframe.llm.words import LETTERS, U64, Words, mixed, slices

SAMPLE, FEATURES, LEAST = 20_000, 4096, 3
PREFIXES = (None, 4, 5, 6)
L2, FAIRNESS, ROUNDS, RATE = 1e-5, 1.0, 400, 0.1
# Squared deviations from the mean share that a feature needs: chance among millions has fewer.
EVIDENCE = 30.0
BITS = 18

# Words that name groups of people; each is swapped for the next.
IDENTITY_TERMS = (
    "women", "men", "girls", "boys", "muslims", "christians", "jews", "hindus", "buddhists",
    "atheists", "blacks", "whites", "asians", "africans", "americans", "europeans", "mexicans",
    "arabs", "immigrants", "natives", "gay", "straight", "lesbian", "bisexual", "transgender",
    "disabled", "blind", "deaf", "elderly", "young", "frauen", "männer", "muslime", "christen",
    "juden", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "mujeres", "hombres",
    "musulmanes", "cristianos", "judíos",
)


def held_out(id: str | Column) -> Column:
    """Rows never learned from: those whose crc32 of the id as text divides by 5."""
    id = F.col(id) if isinstance(id, str) else id
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % 5 == 0


def _of_words(words: Words) -> list[np.ndarray]:
    """For each kind of feature, one for each word."""
    return [
        mixed(values ^ U64(size or 0))
        for size, values in zip(PREFIXES, words.prefix_hashes(PREFIXES))
    ]


def _terms() -> list[np.ndarray]:
    return _of_words(Words(pa.array([" ".join(IDENTITY_TERMS)]), LETTERS))


def _distinct(kinds: list[np.ndarray], text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs, by feature."""
    features = np.concatenate(kinds)
    text = np.tile(text, len(kinds))
    order = np.lexsort((text, features))
    features, text = features[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (features[1:] != features[:-1]) | (text[1:] != text[:-1])
    return text[new], features[new]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, texts, toxic texts) of each part of the sample."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column(0), LETTERS, lower=True)
            if not len(words.starts):
                continue
            toxic = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            text, features = _distinct(_of_words(words), words.text_index(), len(toxic))
            at = np.flatnonzero(np.concatenate([[True], features[1:] != features[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(features[at].view(np.int64)),
                 pa.array(np.diff(at, append=len(features))),
                 pa.array(np.add.reduceat(toxic[text], at))],
                ["feature", "n", "n_toxic"],
            )


class _Table:
    """Positions of chosen features; a bitmap keeps most look-ups short."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(features >> U64(64 - BITS)).astype(np.int64)] = True

    def find(self, kinds: list[np.ndarray], text: np.ndarray):
        """Distinct (text, position) pairs."""
        pairs = []
        for values in kinds:
            at = np.flatnonzero(self.seen[(values >> U64(64 - BITS)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.features, values[at]), len(self.features) - 1)
            hit = self.features[place] == values[at]
            pairs.append(text[at[hit]] * len(self.features) + place[hit])
        both = np.unique(np.concatenate(pairs))
        return both // len(self.features), both % len(self.features)


def _vectors(features: np.ndarray):
    """Per sampled text its label, features, and its counterfactual's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, terms = _Table(features), _terms()
        order = np.argsort(terms[0])
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(0), LETTERS, lower=True)
                kinds, text, n = _of_words(words), words.text_index(), part.num_rows
                place = np.minimum(np.searchsorted(terms[0][order], kinds[0]), len(order) - 1)
                named = terms[0][order][place] == kinds[0]
                other = (order[place[named]] + 1) % len(order)
                swapped = []
                bare = np.setdiff1d(np.arange(n), text[named])
                for values, term in zip(kinds, terms):
                    values = values.copy()
                    values[named] = term[other]
                    swapped.append(np.concatenate([values, term[bare % len(order)]]))
                columns = [part.column(1)]
                for pair in (table.find(kinds, text),
                             table.find(swapped, np.concatenate([text, bare]))):
                    bounds = np.searchsorted(pair[0], np.arange(n + 1))
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(bounds, pa.int32()), pa.array(pair[1], pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "features", "swapped"])

    return run


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all list members."""
    lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy()


def _descend(toxic: np.ndarray, own, swapped, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise label loss, size of weights and counterfactual changes."""
    n = len(toxic)
    weights, bias = np.zeros(size), float(np.log((toxic.sum() + 1) / (n - toxic.sum() + 1)))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, ROUNDS + 1):
        logit = np.bincount(own[0], weights[own[1]], n) + bias
        change = np.bincount(swapped[0], weights[swapped[1]], n) + bias - logit
        slope = (1 / (1 + np.exp(-logit)) - toxic) / n
        pull = 2 * FAIRNESS * change / n
        grad = np.bincount(own[1], (slope - pull)[own[0]], size)
        grad += np.bincount(swapped[1], pull[swapped[0]], size) + 2 * L2 * weights
        grad = np.append(grad, slope.sum())
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        step = RATE * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
        weights, bias = weights - step[:-1], bias - step[-1]
    return weights, float(bias)


Model = tuple[np.ndarray, np.ndarray, float]


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    label: str = "toxic", sample: int = SAMPLE, features: int = FEATURES,
) -> Model:
    """Features, weights and bias, learned from labelled rows that are not held out."""
    spark = docs.sparkSession
    usable = labels.filter(~held_out(id) & F.col(id).isNotNull() & F.col(label).isNotNull())
    chosen = saved(
        usable.groupBy(F.col(id).alias("_doc")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("_doc"), "_doc").limit(sample),
        "toxicity-labels",
    )
    rows = saved(
        docs.select(F.col(id).alias("_doc"), text_of(text).alias("text"))
        .join(F.broadcast(chosen), "_doc").select("text", "toxic"),
        "toxicity-sample",
    )
    n, positive = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    positive = positive or 0
    nothing = np.zeros(0, U64), np.zeros(0)
    if not 0 < positive < n:
        return (*nothing, float(np.log(1e6) if n and positive else -np.log(1e6)))
    counts = map_batches(rows, _counted, "feature bigint, n bigint, n_toxic bigint").groupBy(
        "feature"
    ).agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("k"))
    # How far the share of toxic texts is from that of all, in standard deviations, squared.
    share = positive / n
    gain = F.pow(F.col("k") - F.col("n") * share, F.lit(2)) / F.col("n")
    best = (
        counts.filter((F.col("n") >= LEAST) & (gain >= EVIDENCE * share * (1 - share))).orderBy(gain.desc(), "feature").limit(features)
        .select("feature").toArrow()["feature"].to_numpy().astype(np.int64).view(U64)
    )
    best = np.unique(np.concatenate([best, *_terms()]))
    found = map_batches(
        rows, _vectors(best), "toxic int, features array<int>, swapped array<int>"
    ).toArrow()
    toxic = found["toxic"].to_numpy().astype(float)
    weights, bias = _descend(toxic, _flat(found["features"]), _flat(found["swapped"]), len(best))
    return best, weights, bias


def _scores(column: pa.Array, table: _Table, weights: np.ndarray, bias: float) -> np.ndarray:
    words = Words(column, LETTERS, lower=True)
    logit = np.full(len(column), bias)
    if len(weights) and len(words.starts):
        text, place = table.find(_of_words(words), words.text_index())
        logit += np.bincount(text, weights[place], len(column))
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, score."""
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, bias = model.value
        table = _Table(features)
        for batch in batches:
            for part in slices(batch, "text"):
                scores = _scores(part.column(1), table, weights, bias)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores)], ["doc_id", "score"]
                )

    rows = docs.select(F.col(id).alias("doc_id"), text_of(text).alias("text"))
    kind: Any = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; one pass, no join."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, bias = model.value
        table = _Table(features)
        for batch in batches:
            for part in slices(batch, text):
                scores = _scores(
                    part.column(part.schema.get_field_index(text)), table, weights, bias
                )
                yield part.filter(pa.array(scores < threshold))

    return map_batches(docs, run, docs.schema)
