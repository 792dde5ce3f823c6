"""Conversation repair against a plain search over whole edit lists."""

import hashlib
import random
import re
import zlib

import pytest

from treeframe.llm import conversations
from treeframe.llm.conversations import Machine

SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies int, part string, audit string, place int"
SPACE = "\t\n\v\f\r "


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(key.encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        row = (conv, turn, "user" if what == 4 else role, text)
        out += [row, row] if what == 3 else [row]
    return out


def repaired(rows):
    """(cost, audit, turns) by trying every edit in every place, the best of each state kept."""
    after = {"": "", "s": "s", "u": "u", "a": "a"}
    best = {"": (0, "", [])}

    def insert(states):
        for _ in range(3):
            for q, (cost, audit, turns) in list(states.items()):
                role = "assistant" if q == "u" else "user"
                new = (cost + 3, audit + "I", [*turns, f"{role}:"])
                states[role[0]] = min(states.get(role[0], new), new)
        return states

    for _, _, role, text, fault in rows:
        states = {}

        def put(q, value):
            states[q] = min(states.get(q, value), value)

        for q, (cost, audit, turns) in insert(best).items():
            put(q, (cost + 4, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[q]
            if role and role[0] in allowed:
                put(after[role[0]], (cost + more, audit + "K", [*turns, f"{role}:{text}"]))
            new = "assistant" if q == "u" else "user"
            put(new[0], (cost + 3 + more, audit + "R", [*turns, f"{new}:{text}"]))
        best = states
    best = insert(best)
    return min(best[q] for q in ("", "a") if q in best)


def report(rows):
    """Plain version of the query, for original rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = [r for r in damaged(rows) if r[0] == conv]
        digest = lambda t: hashlib.sha256(t.encode()).digest()[:16]
        kept.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r[3])))
        seen, judged = set(), []
        for row in kept:
            body = row[3].strip(SPACE)
            fault = ("blank" if not body else "duplicate" if row[2:] in seen
                     else "truncated" if body[-1] not in ".!?" else "")
            seen.add(row[2:])
            judged.append((*row, fault))
        turns = [r[1] for r in kept if r[1] is not None]
        initials = [r[2][:1] for r in kept]
        cost, audit, done = repaired(judged)
        assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in done))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[sum(r[4] == f for r in judged) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest(),
        )
    return out


def got(spark, rows, parts=3):
    full = [(*r, 7, "x", "y", 1) for r in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(parts)
    found = conversations.repair_report(conversations.damaged(df)).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r)[1:] for r in found}


def test_odd_conversations(spark):
    """Nulls, other roles, empty and long texts, repeated rows and turns, gaps."""
    pick = random.Random(4)
    roles = ["user", "assistant", "system", "tool", None, "", "utter"]
    texts = ["One.", "Two!", "Three", " \t", None, "", "x" * 50_000 + "?", "é. \x0b", "a "]
    rows = [
        (pick.choice([*range(60), None]), pick.choice([*range(6), 40, None]), pick.choice(roles), pick.choice(texts))
        for _ in range(900)
    ]
    rows += [(100, 1, "user", "Hi.")] * 40 + [(100, t, "user", "Hi.") for t in range(30)]
    assert got(spark, rows) == report(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA).coalesce(1)
    assert conversations.repair_report(conversations.damaged(df)).count() == 0
    assert conversations.repaired_turns(conversations.damaged(df)).count() == 0


def test_conversation_with_most_of_the_rows(spark):
    """One conversation over all ranges: its segments meet, its order stays."""
    pick = random.Random(5)
    rows = [(1, t, pick.choice(["user", "assistant"]), f"Text {pick.randrange(2000)}.") for t in range(4000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(2, 300) for t in range(4)]
    assert got(spark, rows, 8) == report(rows)


def test_repaired_turns(spark):
    rows = [(1, 3, "user", "B."), (1, 5, "assistant", "C"), (2, 1, "assistant", "A.")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    from pyspark.sql import functions as F

    done = conversations.repaired_turns(turns.withColumn("copies", F.lit(1).cast("bigint"))).collect()
    assert sorted(tuple(r) for r in done) == [
        (1, 0, "K", "user", "B."), (1, 1, "K", "assistant", "C"),
        (2, 0, "I", "user", ""), (2, 1, "K", "assistant", "A."),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_runs_against_single_turns(seed):
    """Powers of a run give what its turns one by one give, at any length."""
    pick = random.Random(seed)
    for _ in range(150):
        runs = []
        for _ in range(pick.randrange(1, 7)):
            symbol = pick.choice("suaoSUAOX")
            if not runs or runs[-1][0] != symbol:
                runs.append((symbol, pick.choice([1, 1, 2, 3, 5, 8, 21])))
        rows = [
            (0, 0, {"s": "system", "u": "user", "a": "assistant"}.get(x.lower(), "tool"), "t",
             "blank" if x == "X" else "truncated" if x.isupper() else "")
            for x, n in runs for _ in range(n)
        ]
        cost, audit, _ = repaired(rows)
        assert Machine().solve(runs) == (cost, audit)


def test_long_run_is_cheap():
    cost, audit = Machine().solve([("u", 3_000_001), ("X", 2_000_000), ("a", 1)])
    assert cost == 3_000_000 // 2 * 3 + 4 * 2_000_000
    assert len(audit) == 5_000_002 and audit.count("R") == 1_500_000
