"""Conversations repaired to alternating turns at the least cost, with an audit of the edits.

A repaired conversation is empty or has an optional system turn and then pairs of a user's
and an assistant's turn. Edits: K keeps a turn (0), R gives it the role that
must come next (3), D deletes it (4; the only edit for blank and duplicate turns), I
inserts an empty turn (3). A truncated turn that stays costs 3 more. Of the cheapest
lists of edits the least in ASCII is taken.

1. Turns become symbols in Spark: the initial of the role and the fault. Equal
   turns of a conversation are counted first, so copies of a turn are one row; a
   turn is a duplicate if an equal one stands earlier, which one aggregation of
   narrow rows (ids and digests, no texts) tells.
2. These rows are range-sorted by conversation and place, so a conversation may
   span many tasks. Each batch collapses equal consecutive symbols into runs: a
   segment of a conversation is its runs and a few counts.
3. Segments of a conversation meet, about as many bytes as its audit has at
   most. Run-length dynamic program: four states (nothing yet, after system, after
   user, after assistant), a min-plus matrix for each symbol, and cached binary
   powers of it. Runs are passed from the last to the first for the costs; then each
   run is unrolled into its edits by halves, with the costs in the middle from the
   same powers. Pieces seen before come from a cache.
4. For digests and repaired turns the texts are shuffled once, by conversation
   and in order, behind the audit, and read as a stream; no conversation is held
   whole. A digest of a whole conversation is one chain, so one task reads it.

Defined results: a null role or text counts as one space, a null turn comes
first. Turns with equal numbers come by role, then by the digest of the text. Roles
that begin with s, u and a are those of the grammar; a role that begins with
another character, or an empty one, fits nowhere unless changed. An empty table gives an
empty result; null conversation ids are one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from treeframe.llm.rows import map_batches, saved, small

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# States: nothing yet, after a system turn, after a user's, after an assistant's.
STATES = range(4)
NEXT = (2, 2, 3, 2)
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_INITIAL = "uuau"
ENDS = (0, 3)
# Symbols: s, u, a, o (another initial), in capitals if truncated; X must be deleted.
GONE = "X"
LEGAL = ("su", "ua", "au")
FAR = 1 << 60
CACHED_POWER = 10  # edits of up to 2^10 equal turns are remembered
DAMAGES = 20
ORDER = ("conv_id", "turn", "role", "digest")
VISIBLE, CLOSING = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*+\z"

Costs = tuple[int, ...]
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SEGMENT = (
    "place bigint, symbols string, counts array<bigint>, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, turns bigint"
)


def damaged(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Turns with planted faults, by a checksum of conversation and turn.

    ``copies`` says how often a turn stands there: 0 if dropped, 2 if repeated.
    """
    def key(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        key(role).alias("role"), key(text).alias("text"),
        (F.crc32(F.concat(key(conv), F.lit(":"), key(turn))) % DAMAGES).alias("_what"),
    )
    what = F.col("_what")
    return rows.select(
        "conv_id", "turn",
        F.when(what == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(what == 1, "").when(what == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(what == 0, 0).when(what == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


class Machine:
    """The dynamic program, with its powers and remembered pieces."""

    def __init__(self):
        self.powers: dict[tuple[str, int], tuple[Costs, ...]] = {}
        self.known: dict[tuple[str, int, Costs], Costs] = {}
        self.pieces: dict[tuple[str, int, int, Costs], tuple[str, int]] = {}
        self.end = tuple(self._inserted(tuple(0 if q in ENDS else FAR for q in STATES)))

    @staticmethod
    def _inserted(costs: Costs) -> list[int]:
        """Least costs when turns may be inserted first."""
        out = list(costs)
        for _ in STATES:
            out = [min(out[q], INSERT + out[NEXT[q]]) for q in STATES]
        return out

    @staticmethod
    def edits(symbol: str, q: int) -> Iterator[tuple[str, int, int]]:
        """Edits of one turn in ASCII order: letter, cost, state after it."""
        yield "D", DELETE, q
        if symbol == GONE:
            return
        more = TRUNCATED if symbol.isupper() else 0
        initial = symbol.lower()
        if initial == NEXT_INITIAL[q]:
            yield "K", KEEP + more, NEXT[q]
        elif initial == "s" and q == 0:
            yield "K", KEEP + more, 1
        yield "R", REROLE + more, NEXT[q]

    def power(self, symbol: str, k: int) -> tuple[Costs, ...]:
        """Row per end state: least costs from each state over 2^k turns of a symbol."""
        found = self.powers.get((symbol, k))
        if found is None:
            if k:
                half = self.power(symbol, k - 1)
                found = tuple(_times(half, column) for column in half)
            else:
                found = tuple(
                    tuple(self._inserted(tuple(
                        min((c for _, c, to in self.edits(symbol, q) if to == end), default=FAR)
                        for q in STATES
                    ))) for end in STATES
                )
            self.powers[symbol, k] = found
        return found

    def before(self, symbol: str, n: int, costs: Costs) -> Costs:
        """Least costs before a run of ``n`` turns, from those after it."""
        least = min(costs)
        key = symbol, n, tuple(c - least for c in costs)
        found = self.known.get(key)
        if found is None:
            found, k = key[2], 0
            while n >> k:
                if n >> k & 1:
                    found = _times(self.power(symbol, k), found)
                k += 1
            if len(self.known) < 1 << 16:
                self.known[key] = found
        return tuple(c + least for c in found)

    def one(self, symbol: str, q: int, costs: Costs) -> tuple[str, int]:
        """Edits of one turn, insertions before it included, and the state after it."""
        left = _times(self.power(symbol, 0), costs)
        letters = ""
        while True:
            options = [(a, c + costs[to], to, True) for a, c, to in self.edits(symbol, q)]
            options.append(("I", INSERT + left[NEXT[q]], NEXT[q], False))
            letter, _, q, done = min(o for o in options if o[1] == left[q])
            letters += letter
            if done:
                return letters, q

    def piece(self, symbol: str, k: int, q: int, costs: Costs) -> tuple[str, int]:
        """Edits of 2^k turns of a symbol, by halves, and the state after them."""
        least = min(costs)
        key = symbol, k, q, tuple(c - least for c in costs)
        found = self.pieces.get(key)
        if found is None:
            if k:
                left, q = self.piece(symbol, k - 1, q, _times(self.power(symbol, k - 1), key[3]))
                right, q = self.piece(symbol, k - 1, q, key[3])
                found = left + right, q
            else:
                found = self.one(symbol, q, key[3])
            if k <= CACHED_POWER and len(self.pieces) < 1 << 16:
                self.pieces[key] = found
        return found

    def solve(self, runs: list[tuple[str, int]]) -> tuple[int, str]:
        """Least cost and the least audit of a conversation, given as runs of symbols."""
        after = [self.end]
        for symbol, n in reversed(runs):
            after.append(self.before(symbol, n, after[-1]))
        cost, q, letters = after.pop()[0], 0, []
        for symbol, n in runs:
            costs = after.pop()
            for k in reversed(range(n.bit_length())):
                if n >> k & 1:
                    rest = n & ((1 << k) - 1)
                    letter, q = self.piece(symbol, k, q, self.before(symbol, rest, costs))
                    letters.append(letter)
        while q not in ENDS:
            letters.append("I")
            q = NEXT[q]
        return cost, "".join(letters)


def _times(matrix: tuple[Costs, ...], costs: Costs) -> Costs:
    """Min-plus product of a matrix, given by end states, and costs after it."""
    return tuple(min(matrix[end][q] + costs[end] for end in STATES) for q in STATES)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs and counts of each conversation's rows in a batch, in their order.

    Rows: conversation, part, turn, initial, fault of the first copy, copies.
    """
    number = 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        convs = batch.column(0)
        # Neighbours differ if one alone is null, or both have values that differ.
        null = convs.is_null().to_numpy(zero_copy_only=False)
        differ = pc.not_equal(convs[1:], convs[:-1]).fill_null(False)
        new = (null[1:] != null[:-1]) | differ.to_numpy(zero_copy_only=False)
        marks = np.flatnonzero(np.concatenate([[True], new, [True]]))
        parts, turns, initials, faults, copies = (batch.column(i).to_pylist() for i in range(1, 6))
        rows = []
        for at, to in zip(marks[:-1].tolist(), marks[1:].tolist()):
            row = _segment(zip(turns[at:to], initials[at:to], faults[at:to], copies[at:to]))
            rows.append((parts[at] << 32 | number, *row))
            number += 1
        schema = [pa.int64(), pa.string(), pa.list_(pa.int64()), *[pa.int64()] * 4,
                  pa.string(), pa.string(), *[pa.int64()] * 3]
        names = [c.split()[0] for c in _SEGMENT.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [convs.take(pa.array(marks[:-1])), *[pa.array(c, t) for c, t in zip(zip(*rows), schema)]],
            ["conv_id", *names],
        )


def _segment(rows) -> tuple:
    symbols: list[str] = []
    counts: list[int] = []
    faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
    illegal, first, last, low, high, turns = 0, None, None, None, None, 0

    def add(symbol: str, n: int) -> None:
        if symbols and symbols[-1] == symbol:
            counts[-1] += n
        elif n:
            symbols.append(symbol)
            counts.append(n)

    for turn, initial, fault, n in rows:
        if not n:
            continue
        # The first copy has its own fault; further copies are blank or duplicates.
        rest = "blank" if fault == "blank" else "duplicate"
        faults[fault] += 1
        faults[rest] += n - 1
        symbol = initial if initial in "sua" and initial else "o"
        symbol = GONE if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol
        add(symbol, 1)
        add(GONE, n - 1)
        illegal += n - 1 + (first is not None and last + initial not in LEGAL)
        first, last = initial if first is None else first, initial
        if turn is not None and turn != high:
            low, high, turns = turn if low is None else low, turn, turns + 1
    return ("".join(symbols), counts, faults["blank"], faults["duplicate"], faults["truncated"],
            illegal, first, last, low, high, turns)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batched(rows: Iterator[tuple], schema: pa.Schema, limit: int = 8 << 20):
    """Record batches of some MB of text."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held), schema)]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    for row in rows:
        held.append(row)
        size += 200 + sum(len(v) for v in row if isinstance(v, str))
        if size >= limit:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Counts, cost and audit of each conversation, from its segments in order."""
    machine = Machine()
    for conv, segments in groupby(_rows(batches), itemgetter(0)):
        runs: list[tuple[str, int]] = []
        sums = [0, 0, 0, 0]
        last = low = high = None
        turns = 0
        for _, _, symbols, counts, *faults, first, end, least, most, n_turns in segments:
            for symbol, n in zip(symbols, counts):
                if runs and runs[-1][0] == symbol:
                    n += runs.pop()[1]
                runs.append((symbol, n))
            sums = [a + b for a, b in zip(sums, faults)]
            if first is not None:
                sums[3] += last is not None and last + first not in LEGAL
                last = end
            if least is not None:
                # A turn number may stand on both sides of a cut.
                turns += n_turns - (high == least)
                low, high = least if low is None else low, most
        gaps = 0 if low is None else high - low + 1 - turns
        yield (conv, gaps, *sums, *machine.solve(runs))


def _digest(text: Column) -> Column:
    """16 bytes of SHA-256."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _keyed(turns: DataFrame) -> DataFrame:
    """Turns with a digest of their text. Dropped turns keep the conversation alone."""
    there = F.col("copies") > 0
    return turns.select(
        "conv_id", *[F.when(there, F.col(c)).alias(c) for c in ("turn", "role", "text")], "copies",
        F.when(there, _digest(F.col("text"))).alias("digest"),
    )


def _placed(turns: DataFrame) -> DataFrame:
    """Narrow rows, one for each conversation, turn, role and text, in ranges of their order."""
    fault = F.when(~F.col("text").rlike(VISIBLE), "blank").when(
        F.col("text").rlike(CLOSING), ""
    ).otherwise("truncated")
    initial = F.substring("role", 1, 1)
    counted = saved(
        _keyed(turns).select(
            "conv_id", "turn", "role", "digest", "copies",
            F.when(F.col("digest").isNotNull(), initial).alias("initial"),
            F.when(F.col("digest").isNotNull(), fault).alias("fault"),
        )
        .groupBy("conv_id", "turn", "role", "digest", "initial", "fault")
        .agg(F.sum("copies").alias("copies")),
        "conversations-turns",
    )
    # Turns that come back with another number: the first of them, a null one before all.
    again = saved(
        counted.filter("digest is not null and fault <> 'blank'")
        .groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"),
                 F.col("digest").alias("_digest"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("turn").alias("_least"),
             F.max(F.col("turn").isNull()).alias("_null"))
        .filter("_n > 1").drop("_n"),
        "conversations-again",
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
        & (F.col("digest") == F.col("_digest"))
    )
    later = F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_least"))
    return (
        counted.join(small(again), same, "left")
        .withColumn("fault", F.when(later, "duplicate").otherwise(F.col("fault")))
        .select("conv_id", "turn", "role", "digest", "initial", "fault", "copies")
        .repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
        .select("conv_id", F.spark_partition_id().cast("bigint").alias("part"),
                "turn", "initial", "fault", "copies")
    )


def audit(turns: DataFrame) -> DataFrame:
    """Per conversation its gaps, faults, cost of repair and edits.

    ``turns`` has conv_id, turn, role, text and copies, as :func:`damaged` gives them.
    """
    kind = turns.schema["conv_id"].dataType
    segments = map_batches(
        _placed(turns), _segments, f"conv_id {kind.simpleString()}, {_SEGMENT}"
    )
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *[(c, pa.int64()) for c in COUNTS],
                        ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(_solved(batches), schema)

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return map_batches(
        segments.repartition("conv_id").sortWithinPartitions("conv_id", "place"), run,
        f"conv_id {kind.simpleString()}, {counts}, audit string",
    )


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal turns of a batch as one row, so that copies of a turn are not all shuffled."""
    for batch in batches:
        keys = [c for c in batch.schema.names if c != "copies"]
        table = pa.Table.from_batches([batch]).group_by(keys).aggregate([("copies", "sum")])
        table = table.rename_columns([*keys, "copies"]).select(batch.schema.names)
        yield from table.combine_chunks().to_batches()


def _edited(audit: str, turns: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired turns; ``turns`` has role, text and copies, in order."""
    at = q = 0

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal at, q
        while audit[at : at + 1] == "I":
            yield "I", NEXT_ROLE[q], ""
            at, q = at + 1, NEXT[q]

    for role, text, copies in turns:
        while copies:
            yield from inserted()
            letter = audit[at]
            at, copies = at + 1, copies - 1
            if letter == "K":
                yield "K", role, text
                q = 1 if q == 0 and role.startswith("s") else NEXT[q]
            elif letter == "R":
                yield "R", NEXT_ROLE[q], text
                q = NEXT[q]
            elif copies and audit.startswith("D" * copies, at):
                at, copies = at + copies, 0
    yield from inserted()


def _with_texts(turns: DataFrame, audits: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over each conversation's audit, followed by its turns in order."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    columns = f"conv_id {kind}, turn bigint, role string, digest binary, text string, copies bigint"
    texts = map_batches(
        _keyed(turns).filter("copies > 0").select(
            "conv_id", "turn", "role", "digest",
            # What is blank is deleted; its place is all that counts.
            F.when(F.col("text").rlike(VISIBLE), F.col("text")).alias("text"), "copies",
        ),
        _combined, columns,
    )
    none = F.lit(None)
    rows = audits.select(
        "conv_id", F.lit(0).alias("_kind"), none.cast("bigint").alias("turn"),
        none.cast("string").alias("role"), none.cast("binary").alias("digest"),
        F.col("audit").alias("text"), none.cast("bigint").alias("copies"), *COUNTS,
    ).unionByName(
        texts.withColumn("_kind", F.lit(1)).withColumns({c: none.cast("bigint") for c in COUNTS})
    )
    return map_batches(
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "_kind", "turn", "role", "digest")
        .select("conv_id", "role", "text", "copies", *COUNTS),
        run, schema,
    )


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Of each conversation the row of its audit, and its repaired turns, one by one."""
    for _, rows in groupby(_rows(batches), itemgetter(0)):
        head = next(rows)
        yield head, _edited(head[2], (row[1:4] for row in rows))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """Turns after the repair: conv_id, place, edit, role, text."""
    kind = turns.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("place", pa.int64()),
                        ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(
            ((head[0], i, *turn) for head, edited in _streams(batches)
             for i, turn in enumerate(edited)), schema,
        )

    audits = saved(audit(turns), "conversations-audits")
    return _with_texts(
        turns, audits, run,
        f"conv_id {kind.simpleString()}, place bigint, edit string, role string, text string",
    )


def repair_report(turns: DataFrame) -> DataFrame:
    """Per conversation :func:`audit`, and the digest of its repaired turns."""
    kind = turns.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *[(c, pa.int64()) for c in COUNTS],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for head, edited in _streams(batches):
                total = hashlib.sha256()
                for i, (_, role, text) in enumerate(edited):
                    total.update(("\n" * (i > 0) + f"{role}:{text}").encode())
                yield (head[0], *head[4:], head[2], total.hexdigest())

        yield from _batched(digests(), schema)

    audits = saved(audit(turns), "conversations-audits")
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return _with_texts(
        turns, audits, run,
        f"conv_id {kind.simpleString()}, {counts}, audit string, repaired_sha256 string",
    )
