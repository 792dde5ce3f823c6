"""Repeated passages: every window of words is hashed, and hashes are counted in Spark.

A window is ``width`` consecutive words of one text. Each task hashes the
windows of its texts (two independent Rabin-Karp hashes), a slice of some MB at a time. In a
slice a window counts once for each text, and only the text with the smallest id
asks for it: the others are known to lose it there and then. Open windows are
dealt into buckets by the second hash and shipped as one block per bucket; where a bucket's
blocks meet, the smallest id that has each hash is found. So a window that all
texts share is one entry for each slice, and the number of buckets grows
with the corpus. Lost windows go to their texts, by groups of texts of bounded size, and there
repeated windows merge into maximal removal intervals.

Windows are equal if both hashes and so over 64 bits agree.

Defined results: a null text has no words; texts shorter than a window lose
nothing; windows are judged on the input. An id is only compared with others:
rows that repeat one id do not remove each other's words, and a null id counts
as larger than any other. Empty tables give empty tables; further columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeframe.llm.rows import map_batches, saved, small, text_of
from treeframe.llm.words import STEP_B, U64, Words, rolling, slices

WIDTH = 13
# Text that one bucket's windows stand for: some two million windows.
BUCKET_BYTES = 12 << 20
SLICE = 4 << 20

# Windows of texts by bucket; those of buckets under 0 are lost, and come by group of texts.
BLOCK = "bucket int, ids binary, marks binary, counts binary, hashes binary"
HIT = "grp int, ids binary, marks binary, counts binary, hashes binary"
RESULT = (
    "doc_id bigint, n_words bigint, n_removed bigint, "
    "intervals array<struct<start:bigint,end:bigint>>, kept_text string"
)


def _windows(words: Words, width: int):
    """First and second hash and text of every window, in order."""
    hashes = words.hashes()
    if len(hashes) < width:
        return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64)
    whole = words.room()[: len(hashes) - width + 1] >= width
    return (
        rolling(hashes, width)[whole], rolling(hashes, width, STEP_B)[whole] >> U64(32),
        words.text_index()[: len(whole)][whole],
    )


def _by_key(group: np.ndarray, ids, marks, text, hashes) -> list[tuple]:
    """Entries as one row per group: texts with their marks, counts and hashes."""
    order = np.lexsort((text, group))
    group, text, hashes = group[order], text[order], hashes[order]
    rows = []
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(group) else []
    for s, e in zip(edge[:-1], edge[1:]):
        own = text[s:e]
        at = np.flatnonzero(np.diff(own, prepend=-1))
        # Steps between ids compress better than ids.
        rows.append((
            int(group[s]), np.diff(ids[own[at]], prepend=0).tobytes(), marks[own[at]].tobytes(),
            np.diff(at, append=len(own)).astype(np.uint32).tobytes(), hashes[s:e].tobytes(),
        ))
    return rows


def _blocks(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                hashes, second, text = _windows(Words(part.column(2)), width)
                if not len(hashes):
                    continue
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                marks = part.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
                # Texts by id; rows that repeat id and text are one.
                keys, rank = np.unique(np.stack([ids, marks.astype(np.int64)]), axis=1, return_inverse=True)
                ids, marks = keys[0], keys[1].astype(np.int32)
                text = rank.ravel()[text]
                order = np.lexsort((text, hashes))
                hashes, text = hashes[order], text[order]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                hashes, second, text = hashes[new], second[order[new]], text[new]
                first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
                least = np.repeat(ids[text[first]], np.diff(first, append=len(hashes)))
                bucket = (second % U64(buckets)).astype(np.int32)
                lost = ids[text] > least
                bucket[lost] = -1 - marks[text[lost]] % buckets
                rows = _by_key(bucket, ids, marks, text, hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 4)],
                    ["bucket", "ids", "marks", "counts", "hashes"],
                )

    return run


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    """The binary values of a column, one after the other, as numbers."""
    return np.concatenate([
        np.frombuffer(value.as_buffer(), kind) for chunk in column.chunks for value in chunk
    ])


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """Ids, which are stored as steps in each value."""
    return np.concatenate([
        np.cumsum(np.frombuffer(v.as_buffer(), np.int64)) for chunk in column.chunks for v in chunk
    ])


def _judge(groups: int):
    """Of one bucket, the windows that a smaller id has too, by group of texts."""

    def run(block):
        if block["bucket"][0].as_py() < 0:
            group = pa.array(np.full(block.num_rows, -1 - block["bucket"][0].as_py(), np.int32))
            return pa.table([group, *block.columns[1:]], ["grp", *block.column_names[1:]])
        ids, marks = _ids(block["ids"]), _joined(block["marks"], np.int32)
        text = np.repeat(np.arange(len(ids)), _joined(block["counts"], np.uint32))
        hashes = _joined(block["hashes"], U64)
        order = np.argsort(hashes)
        hashes, text = hashes[order], text[order]
        del order
        at = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        owner = ids[text]
        lost = owner > np.repeat(np.minimum.reduceat(owner, at), np.diff(at, append=len(owner)))
        hashes, text = hashes[lost], text[lost]
        rows = _by_key(marks[text] % groups, ids, marks, text, hashes)
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int32()] + [pa.binary()] * 4
        names = ["grp", "ids", "marks", "counts", "hashes"]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})

    return run


def _losing(hits):
    """The texts of one group that lose something, each once."""
    pairs = np.unique(np.stack([
        _ids(hits["ids"]), _joined(hits["marks"], np.int32).astype(np.int64)
    ]), axis=1)
    return pa.table({"doc_id": pairs[0], "mark": pairs[1].astype(np.int32)})


def _cut(part: pa.RecordBatch, hits: dict, width: int) -> pa.RecordBatch:
    """Per row (doc_id, last, mark, text): the words that stay, and the intervals that go.

    ``hits`` has lists of the hashes of lost windows by last and mark.
    """
    words = Words(part.column(3))
    hashes = _windows(words, width)[0] if hits else None
    window = np.concatenate([[0], np.cumsum(np.maximum(words.counts - width + 1, 0))])
    raw = words.data.tobytes()
    removed, spans, texts = [], [], []
    keys = zip(part.column(1).to_pylist(), part.column(2).to_pylist())
    for i, key in enumerate(keys):
        kept = raw[words.marks[i] : words.marks[i + 1]].split()
        if key not in hits:
            removed.append(0)
            spans.append([])
            texts.append(b" ".join(kept).decode())
            continue
        change = np.zeros(len(kept) + 1, np.int64)
        at = np.flatnonzero(np.isin(hashes[window[i] : window[i + 1]], np.concatenate(hits[key])))
        change[at] += 1
        change[at + width] -= 1
        gone = np.cumsum(change[:-1]) > 0
        edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        spans.append([{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2])])
        removed.append(int(gone.sum()))
        texts.append(b" ".join(w for w, g in zip(kept, gone) if not g).decode())
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()),
         pa.array(spans, pa.list_(pair)), pa.array(texts, pa.string())],
        ["doc_id", "n_words", "n_removed", "intervals", "kept_text"],
    )


def _cut_whole(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield _cut(part, {}, width)

    return run


def _cut_group(width: int):
    def run(docs, flagged):
        hits: dict = {}
        for row in flagged.select(["ids", "marks", "counts", "hashes"]).to_pylist():
            counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
            lost = np.split(np.frombuffer(row["hashes"], U64), np.cumsum(counts)[:-1])
            ids = np.cumsum(np.frombuffer(row["ids"], np.int64)).tolist()
            marks = np.frombuffer(row["marks"], np.int32).tolist()
            for key, own in zip(zip(ids, marks), lost):
                hits.setdefault(key, []).append(own)
        docs = docs.select(["doc_id", "last", "mark", "text"])
        cut = [
            _cut(part, hits, width)
            for batch in docs.to_batches() for part in slices(batch, "text", SLICE)
        ]
        return pa.Table.from_batches(cut)

    return run


def remove_repeated_passages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, intervals (in words), kept_text."""
    body = text_of(text)
    doc_id = F.col(id).cast("bigint")
    rows = docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(2**63 - 1)).alias("last"),
        F.shiftrightunsigned(F.xxhash64(doc_id, body), 33).cast("int").alias("mark"),
        body.alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = total // bucket_bytes + 1
    blocks = map_batches(rows.select("last", "mark", "text"), _blocks(width, buckets), BLOCK)
    hits = saved(blocks.groupBy("bucket").applyInArrow(_judge(buckets), HIT), "repeated-windows")
    # Only texts that lose something meet their flags in a shuffle.
    losing = small(saved(
        hits.groupBy("grp").applyInArrow(_losing, "doc_id bigint, mark int"), "repeated-ids"
    ))
    here = [rows["last"] == losing["doc_id"], rows["mark"] == losing["mark"]]
    whole = map_batches(
        rows.join(losing, here, "left_anti"), _cut_whole(width), RESULT
    )
    part = (
        rows.join(losing, here, "left_semi")
        .withColumn("grp", (F.col("mark") % buckets).cast("int")).groupBy("grp")
        .cogroup(hits.groupBy("grp")).applyInArrow(_cut_group(width), RESULT)
    )
    return whole.unionByName(part)
