"""Words and word windows of many texts at once, as arrays of 64-bit hashes.

Texts of an Arrow batch lie one after the other in one buffer, so words are
found and hashed with array operations over slices of that buffer, whatever
the length of a single text. Hashes are Rabin-Karp sums modulo 2^64, finished
with a mixing step; equal words or windows have equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE, STEP, STEP_B = U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF95), U64(0x2545F4914F6CDD1D)
INVERSE = U64(pow(int(BASE), -1, 1 << 64))
SPAN = 1 << 19  # bytes hashed at a time, if no word is longer
SLICE = 4 << 20  # bytes of text worked on at a time

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: Digits, a-z and all beyond ASCII; for texts in lower case.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of ``h``."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of texts; a null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, marks, data = column.buffers()
    marks = np.frombuffer(marks, kind)[column.offset : column.offset + len(column) + 1]
    marks = marks.astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)[marks[0] : marks[-1]]
    return data, marks - marks[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes of text, or one text."""
    if not batch.num_rows:
        return
    _, marks = buffer_of(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(marks, marks[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Words of a column of texts: byte ranges, hashes, and the first word of each text."""

    def __init__(self, column: pa.Array, kind: np.ndarray = SPACED, lower: bool = False):
        data, self.marks = buffer_of(column)
        self.data = LOWER[data] if lower else data
        inside = kind[self.data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edge = self.marks[self.marks < len(data)]
        begins[edge] = inside[edge]
        edge = self.marks[self.marks > 0] - 1
        stops[edge] = inside[edge]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, self.marks)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A hash for each word."""
        return self.prefix_hashes((None,))[0]

    def prefix_hashes(self, sizes: tuple[int | None, ...]) -> list[np.ndarray]:
        """For each size, a hash of each word's first so many bytes; None: of all."""
        out = [np.empty(len(self.starts), U64) for _ in sizes]
        # Not kept between calls: functions travel to tasks with their module, and
        # what a module keeps would be there once for each task.
        n = min(SPAN, len(self.data)) + 1
        up, down = powers(BASE, n), powers(INVERSE, n)
        at = 0
        while at < len(self.starts):
            to = int(np.searchsorted(self.ends, self.starts[at] + SPAN, "right"))
            to = max(to, at + 1)
            low = self.starts[at]
            begin = self.starts[at:to] - low
            end = self.ends[at:to] - low
            if end[-1] >= len(up):
                up, down = powers(BASE, int(end[-1]) + 1), powers(INVERSE, int(end[-1]) + 1)
            sums = np.zeros(int(end[-1]) + 1, U64)
            part = self.data[low : low + int(end[-1])].astype(U64)
            part += U64(1)
            part *= up[: len(part)]
            np.cumsum(part, out=sums[1:])
            for size, values in zip(sizes, out):
                stop = end if size is None else np.minimum(end, begin + size)
                values[at:to] = (
                    (sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(U64) * STEP
                )
            at = to
        return [mixed(values) for values in out]

    def text_index(self) -> np.ndarray:
        """For each word, the text it is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def room(self) -> np.ndarray:
        """For each word, the words from it to the end of its text."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def rolling(hashes: np.ndarray, n: int, step: np.uint64 = STEP) -> np.ndarray:
    """Rabin-Karp sums of every ``n`` words in a row, texts not told apart."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    size = len(hashes) - n + 1
    out = hashes[:size].copy()
    for k in range(1, n):
        out *= step
        out += hashes[k : k + size]
    return mixed(out)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word shingles, and each text's first one in them.

    A text of fewer words has its whole sequence as its one shingle; one
    without words has none.
    """
    hashes = words.hashes()
    counts = np.where(words.counts >= n, words.counts - n + 1, np.minimum(words.counts, 1))
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(first[-1], U64)
    whole = np.repeat(words.counts >= n, counts)
    if len(hashes) >= n:
        out[whole] = rolling(hashes, n)[words.room()[: len(hashes) - n + 1] >= n]
    for size in range(1, n):
        of = np.flatnonzero(words.counts == size)
        at = words.first[of]
        value = np.full(len(of), U64(size))
        for k in range(size):
            value = value * STEP + hashes[at + k]
        out[first[of]] = mixed(mixed(value))
    return out, first
