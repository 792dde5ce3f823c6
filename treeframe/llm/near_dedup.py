"""Near duplicates: MinHash bands propose pairs, sequential Bayesian tests prune them,
exact set comparison confirms them.

A document's set holds its distinct ``width``-word shingles (one shingle of all
words if there are fewer). Documents with equal sets are one class, and only
classes are compared.

1. Signatures: ``bands * rows`` minima per class; ``rows`` is the largest for
   which a pair at the threshold misses all bands with at most ``miss``.
2. Candidates: classes that share a band's minima are a bucket. Each is paired
   with its bucket's centre, the member that has most company over all bands
   (what many copies stem from), so a bucket of any size gives one pair per
   member.
3. Sequential Bayesian verification: agreements are counted batch by batch; as
   soon as the posterior probability (uniform prior) that the similarity reaches
   the threshold is under ``miss``, the pair is dropped.
4. Survivors are confirmed or refused on their full sets.
5. Links form components. Buckets that still hold several components are
   searched again: members outside the bucket's largest component against all
   members of other components, in blocks of bounded size, which finds every
   link that the centres did not. A block also holds the upper halves of the
   members' hashes, so that only pairs that are links, but for hash collisions,
   leave it; steps 3 and 4 judge these pairs too.

Defined results: a null text, and one without words, has an empty set and is
linked with nothing. Of a component, one text is kept: that with the smallest id
and, if several texts have it, the smallest hash; rows that repeat both id and
text are kept together. A null id is larger than any other. Empty tables give
empty tables; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeframe.llm.components import components
from treeframe.llm.rows import HEAVY_ROWS, map_batches, saved, small, text_of
from treeframe.llm.words import SPACED, U64, Words, mixed, shingles, slices

WIDTH, THRESHOLD = 5, 0.8
BANDS = 28
BAND_MISS, MISS = 1e-4, 1e-6
BATCH = 28  # minima compared at a time
BLOCK = 256  # classes on each side of a block
CHUNK = 1 << 16  # shingles whose minima are taken at a time


def rows_per_band(threshold: float, bands: int = BANDS, miss: float = BAND_MISS) -> int:
    """The most rows with which a pair at the threshold misses all bands with at most ``miss``."""
    rows = 1
    while (1 - threshold ** (rows + 1)) ** bands <= miss:
        rows += 1
    return rows


def least_agreements(n: int, threshold: float, miss: float = MISS) -> int:
    """Fewest of ``n`` equal minima with which a pair is not yet dropped.

    With a uniform prior, the chance that the similarity reaches the threshold
    after m of n agreements is that of at most m successes in n + 1 draws.
    """
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def _sets(part: pa.RecordBatch, text: int, width: int) -> list[np.ndarray]:
    values, first = shingles(Words(part.column(text), SPACED, lower=True), width)
    return [np.unique(values[s:e]) for s, e in zip(first[:-1], first[1:])]


def _node(members: np.ndarray) -> int:
    """A set's name: equal for equal sets."""
    return int.from_bytes(blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)


def _minima(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """For each non-empty set, the smallest member under each factor's order, as 16 bits."""
    out = np.empty((len(sets), len(factors)), np.uint16)
    sizes = np.array([len(s) for s in sets], np.int64)
    at = 0
    while at < len(sets):
        to = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK, "right")))
        values = np.concatenate(sets[at:to])
        begins = np.cumsum(sizes[at:to]) - sizes[at:to]
        for k, factor in enumerate(factors):
            low = np.minimum.reduceat(values * factor, begins)
            out[at:to, k] = mixed(low).astype(np.uint16)
        at = to
    return out


def _factors(size: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, size, dtype=np.uint64) * U64(2) + U64(1)


def _signed(width: int, size: int):
    factors = _factors(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _sets(part, 2, width)
                full = [s for s in sets if len(s)]
                marks = iter(_minima(full, factors)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([next(marks).tobytes() if len(s) else None for s in sets],
                              pa.binary())],
                    ["doc_id", "mark", "n_shingles", "node", "minima"],
                )

    return run


def _with_sets(width: int, size: int, batches: Iterator[pa.RecordBatch]):
    """Of each text its node, members, their upper halves, and minima."""
    for batch in batches:
        for part in slices(batch, "text"):
            sets = _sets(part, 0, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(s) for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([np.unique((s >> U64(32)).astype(np.uint32)).tobytes() for s in sets],
                          pa.binary()),
                 pa.array([m.tobytes() for m in _minima(sets, _factors(size))], pa.binary())],
                ["node", "n", "members", "halves", "minima"],
            )


def _stages(size: int, threshold: float) -> list[tuple[int, int, int]]:
    """(from, to, least agreements up to there) of each batch of minima."""
    ends = [*range(BATCH, size, BATCH), size]
    return [(s, e, least_agreements(e, threshold)) for s, e in zip([0, *ends], ends)]


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.stack([np.frombuffer(v.as_buffer(), kind) for v in column])


def _likely(size: int, threshold: float, batches: Iterator[pa.RecordBatch]):
    """Pairs that no batch of minima rules out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = _matrix(batch.column(2), np.uint16), _matrix(batch.column(3), np.uint16)
        live, agreed = np.arange(len(left)), np.zeros(len(left), np.int64)
        for s, e, least in _stages(size, threshold):
            agreed[live] += (left[live, s:e] == right[live, s:e]).sum(axis=1)
            live = live[agreed[live] >= least]
        kept = batch.select([0, 1]).take(pa.array(live))
        yield kept


def _confirmed(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(v.as_buffer(), U64) for v in (left, right))
            low = min(len(a), len(b))
            if 100 * low < percent * max(len(a), len(b)):
                keep.append(False)
                continue
            common = _common(a, b)
            keep.append(100 * common >= percent * (len(a) + len(b) - common))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.sort(np.concatenate([a, b]))
    return int((both[1:] == both[:-1]).sum())


def _block_pairs(bands: int, rows: int, threshold: float, percent: int):
    """Pairs of one block that can be links: members outside the main component against all.

    What the minima do not rule out is compared on the upper halves of all
    members. Equal halves of different members only add to what two sets share,
    by no more than a set loses in size, so the bound that follows refuses no
    link. A pair that meets in several bands is judged in the first.
    """

    def run(block):
        node = block["node"].to_numpy()
        label = block["label"].to_numpy()
        band = block["band"][0].as_py()
        rest = block["rest"].to_numpy(zero_copy_only=False).astype(bool)
        minima = _matrix(block["minima"].combine_chunks(), np.uint16)
        a, b = np.flatnonzero(rest), np.flatnonzero(~rest)
        i, j = np.nonzero(label[a][:, None] != label[b][None, :])
        i, j = a[i], b[j]
        agreed = np.zeros(len(i), np.int64)
        for s, e, least in _stages(bands * rows, threshold):
            agreed += (minima[i, s:e] == minima[j, s:e]).sum(axis=1)
            live = agreed >= least
            i, j, agreed = i[live], j[live], agreed[live]
        for k in range(band):
            part = slice(k * rows, (k + 1) * rows)
            met = (minima[i, part] == minima[j, part]).all(axis=1)
            i, j = i[~met], j[~met]
        sizes = block["n"].to_numpy()
        halves = [np.frombuffer(v.as_buffer(), np.uint32) for v in block["halves"].combine_chunks()]
        keep = np.zeros(len(i), bool)
        for at, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
            lost = min(sizes[x] - len(halves[x]), sizes[y] - len(halves[y]))
            most = min(_common(halves[x], halves[y]) + lost, sizes[x], sizes[y])
            keep[at] = 100 * most >= percent * (sizes[x] + sizes[y] - most)
        i, j = i[keep], j[keep]
        return pa.table({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])})

    return run


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH,
    threshold: float = THRESHOLD, bands: int = BANDS,
) -> DataFrame:
    """Per row: doc_id, mark (a hash of the text), n_shingles, node, component_id, kept."""
    rows, percent = rows_per_band(threshold, bands), round(threshold * 100)
    size = bands * rows
    source = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.xxhash64(text_of(text)).alias("mark"),
        text_of(text).alias("text"),
    )
    signed = saved(
        map_batches(
            source, _signed(width, size),
            "doc_id bigint, mark bigint, n_shingles bigint, node bigint, minima binary",
        ),
        "near-signed",
    )
    n = signed.count()
    classes = signed.filter("node is not null")
    bits = 2 * rows
    keys = classes.select(
        "node",
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(bands - 1)),
            lambda k: F.xxhash64(k, F.substring(F.col("minima"), k * bits + 1, F.lit(bits))),
        )).alias("band", "key"),
    )
    # Equal classes are counted once: the smallest and largest node differ in a real bucket.
    shared = saved(
        keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low <> high").select("key"),
        "near-buckets", bands * n,
    )
    member = saved(
        keys.join(small(shared), "key", "left_semi").distinct(), "near-members", bands * n
    )
    n_members = member.count()
    company = member.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    weight = member.join(company, "key").groupBy("node").agg(F.sum("n").alias("weight"))
    centre = (
        member.join(weight, "node").groupBy("key")
        .agg(F.max(F.struct("weight", "node")).alias("top"))
        .select("key", F.col("top.node").alias("centre"))
    )
    stars = saved(
        member.join(centre, "key").filter("node <> centre")
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        .distinct(),
        "near-stars", n_members,
    )
    active = saved(member.select("node").distinct(), "near-active", n)
    # One row's text stands for its class.
    chosen = saved(
        classes.join(small(active), "node", "left_semi").groupBy("node")
        .agg(F.min(F.struct("doc_id", "mark")).alias("row")),
        "near-chosen", n,
    )
    picked = chosen.select(F.col("row.doc_id").alias("__llm_id"), F.col("row.mark").alias("__llm_mark"))
    sets = saved(
        map_batches(
            source.join(
                small(saved(picked, "near-picked")),
                F.col("doc_id").eqNullSafe(F.col("__llm_id"))
                & (F.col("mark") == F.col("__llm_mark")),
                "left_semi",
            ).select("text"),
            partial(_with_sets, width, size),
            "node bigint, n bigint, members binary, halves binary, minima binary",
        ),
        "near-sets",
    )
    n_sets = sets.count()
    if n_sets > active.count():  # rows that repeat an id and a text
        sets = saved(sets.dropDuplicates(["node"]), "near-sets")

    def joined(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
        at_a = values.select(F.col("node").alias("a"), F.col(name).alias("_a"))
        at_b = values.select(F.col("node").alias("b"), F.col(name).alias("_b"))
        return pairs.join(at_a, "a").join(at_b, "b").select("a", "b", "_a", "_b")

    pair = "a bigint, b bigint"

    def confirmed(pairs: DataFrame) -> DataFrame:
        return map_batches(joined(pairs, sets, "members"), partial(_confirmed, percent), pair)

    likely = saved(
        map_batches(joined(stars, sets, "minima"), partial(_likely, size, threshold), pair),
        "near-likely", n_sets + stars.count(), HEAVY_ROWS,
    )
    links = saved(confirmed(likely), "near-links", n_sets + likely.count(), HEAVY_ROWS)
    first = components(links).withColumnRenamed("component", "label")

    labelled = saved(
        member.join(first, "node", "left").withColumn("label", F.coalesce("label", "node")),
        "near-labelled", n_members,
    )
    counts = (
        labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
        .agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
        .filter("main.n < n")
    )
    split = saved(
        counts.select(
            "key", F.col("main.label").alias("main"),
            F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("int").alias("n_rest"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("n_all"),
        ),
        "near-split", n_members,
    )
    open_members = labelled.join(split, "key").withColumn("hash", F.xxhash64("node"))
    own_i = F.pmod("hash", "n_rest").cast("int")
    own_j = F.pmod("hash", "n_all").cast("int")
    to_all = F.sequence(F.lit(0), F.col("n_all") - 1)
    to_rest = F.sequence(F.lit(0), F.col("n_rest") - 1)
    left = open_members.filter("label <> main").select(
        "key", "band", own_i.alias("i"), F.explode(to_all).alias("j"), "node", "label",
        F.lit(True).alias("rest"),
    )
    right = open_members.select(
        "key", "band", F.explode(to_rest).alias("i"), own_j.alias("j"), "node", "label",
        F.lit(False).alias("rest"),
    )
    more = (
        left.unionByName(right).join(sets.select("node", "n", "halves", "minima"), "node")
        .groupBy("key", "i", "j").applyInArrow(_block_pairs(bands, rows, threshold, percent), pair)
    )
    fresh = saved(more.distinct().join(likely, ["a", "b"], "left_anti"), "near-fresh")
    n_fresh = fresh.count()
    if n_fresh:
        links = links.unionByName(
            saved(confirmed(fresh), "near-links", n_sets + n_fresh, HEAVY_ROWS)
        )
    named = saved(components(links), "near-components")

    ids = F.coalesce("doc_id", F.lit(2**63 - 1))
    rows_named = signed.drop("minima").join(small(named), "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = saved(
        rows_named.filter("node is not null").groupBy("component")
        .agg(F.min(F.struct(ids.alias("id"), "mark")).alias("least"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select("component", F.col("least.id").alias("least"), F.col("least.mark").alias("least_mark")),
        "near-least", n,
    )
    group = F.coalesce("least", "doc_id")
    return rows_named.join(small(least), "component", "left").select(
        "doc_id", "mark", "n_shingles", "node",
        F.when(group < 2**63 - 1, group).alias("component_id"),
        F.coalesce((F.col("least") == ids) & (F.col("least_mark") == F.col("mark")), F.lit(True))
        .alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component; all columns as they are."""
    judged = near_duplicates(docs, id, text, **options)
    gone = saved(
        judged.filter("not kept").select(F.col("doc_id").alias("__llm_id"), F.col("mark").alias("__llm_mark")),
        "near-dropped",
    )
    here = F.col(id).eqNullSafe(F.col("__llm_id")) & (F.xxhash64(text_of(text)) == F.col("__llm_mark"))
    return docs.join(small(gone), here, "left_anti")
