"""Differences by subtrees, and the saved index of constructs, against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from treeframe.operators import construct_index, nodes, versions
from treeframe.functions import trees as T

OUTLINE = "file_id bigint, ast_text string"


def random_outline(pick, n):
    lines, depth = ["r"], 0
    for _ in range(n):
        depth = pick.randrange(1, depth + 2)
        lines.append("  " * depth + pick.choice("ab") + pick.choice(["", ": 'x'", ": 'y'"]))
    return "\n".join(lines)


def subtrees(tree):
    """(place, type, whole subtree) of each node."""
    out, above = [], []
    for i, n in enumerate(tree):
        above = above[: n.depth] + [n.node_type]
        stop = next((j for j in range(i + 1, len(tree)) if tree[j].depth <= n.depth), len(tree))
        whole = tuple((x.depth - n.depth, x.node_type, x.text) for x in tree[i:stop])
        out.append(("/".join(above[:-1]), n.node_type, whole))
    return out


def plain_diff(before, after):
    a, b = Counter(subtrees(before)), Counter(subtrees(after))
    kept = sum((a & b).values())
    a, b = a - b, b - a
    moved, left_a, left_b = 0, Counter(), Counter()
    for whole in {k[2] for k in (*a, *b)}:
        sides = [sorted((k[0], k[1], n) for k, n in side.items() if k[2] == whole) for side in (a, b)]
        moving = min(sum(n for *_, n in side) for side in sides)
        moved += moving
        for side, left in zip(sides, (left_a, left_b)):
            rest = moving
            for place, kind, n in side:
                left[place, kind] += n - min(n, rest)
                rest -= min(n, rest)
    changed = sum((left_a & left_b).values())
    return kept, moved, changed, sum(left_b.values()) - changed, sum(left_a.values()) - changed


def test_subtree_diff(spark):
    pick = random.Random(6)
    olds, news = [], []
    for i in range(60):
        old = random_outline(pick, pick.randrange(0, 40))
        lines = old.split("\n")
        for _ in range(pick.randrange(0, 4)):
            at = pick.randrange(1, len(lines) + 1)
            if pick.random() < 0.5 and len(lines) > 2:
                lines.append(lines.pop(min(at, len(lines) - 1)))
            else:
                lines.insert(at, "  " + pick.choice("abc"))
        olds.append((i, old))
        news.append((i, "\n".join(lines)))
    olds.append((100, "r\n  a"))
    news.append((101, "r\n  a"))
    trees = [nodes.outline_trees(spark.createDataFrame(rows, OUTLINE)).cache() for rows in (olds, news)]
    got = {r.file_id: tuple(r)[1:] for r in versions.subtree_diff(*trees).collect()}
    before, after = ({r.file_id: r.tree for r in t.collect()} for t in trees)
    assert got == {
        f: plain_diff(before.get(f, []), after.get(f, [])) for f in before.keys() | after.keys()
    }
    assert sum(g[1] for g in got.values()) > 0 and sum(g[2] for g in got.values()) > 0


def test_subtree_hashes_tell_subtrees_apart(spark):
    pick = random.Random(7)
    rows = [(i, random_outline(pick, 30)) for i in range(30)] + [(99, "r\n" + "".join(
        "  " * d + "a\n" for d in range(1, 300)))]
    df = nodes.outline_trees(spark.createDataFrame(rows, OUTLINE))
    seen = {}
    for r in df.select("tree", T.subtree_hashes(F.col("tree")).alias("h")).collect():
        for (_, _, whole), h in zip(subtrees(r.tree), r.h, strict=True):
            assert seen.setdefault(whole, h) == h
    assert len(set(seen.values())) == len(seen) > 100


def test_index_of_constructs(spark, tmp_path):
    pick = random.Random(3)
    path = str(tmp_path / "index")
    ids = [-70_000, -32_768, -1, 0, 1, 32_768, 32_769, 10**12] + pick.sample(range(2, 200_000), 60)
    files = {i: {t for t in "abcd" if pick.random() < 0.5} for i in ids}
    rows = [(i, "\n".join(["r", *(f"  {t}" for t in sorted(held))])) for i, held in files.items()]
    trees = nodes.outline_trees(spark.createDataFrame(rows, OUTLINE))
    bare = spark.createDataFrame([(5_000_000,)], "file_id bigint").select(
        "file_id", F.lit(None).cast(trees.schema["tree"].dataType).alias("tree"))
    construct_index.save_construct_index(trees.where("file_id % 2 = 0"), path)
    construct_index.save_construct_index(trees.where("file_id % 2 <> 0").unionByName(bare), path)
    held = {i: h | {"r"} for i, h in files.items()} | {5_000_000: set()}
    for how in ({}, {"all": ["a"]}, {"all": ["a", "b"], "none": ["c"]}, {"any": ["a", "d"]}, {"none": ["r"]},
                {"any": ["zz"]}, {"all": ["zz"]}, {"none": ["zz", "b"]}, {"all": ["r"], "any": ["a", "zz"], "none": ["d"]}):
        want = sorted(
            i for i, h in held.items()
            if set(how.get("all", ())) <= h and not set(how.get("none", ())) & h
            and (not how.get("any") or set(how["any"]) & h)
        )
        got = sorted(r.file_id for r in construct_index.files_where(spark, path, **how).collect())
        assert got == want, how
    assert construct_index.count_where(spark, path, all=["r"]) == len(files)


def test_index_reads_asked_types_only(spark, tmp_path):
    path = str(tmp_path / "index")
    trees = nodes.outline_trees(spark.createDataFrame([(1, "r\n  a")], OUTLINE))
    construct_index.save_construct_index(trees, path)
    plan = construct_index.files_where(spark, path, all=["a"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(node_type" in plan or "In(node_type, [,a])" in plan
