"""Call edges and recursive groups against plain graph searches."""

import random

from treeframe.operators import calls, nodes

OUTLINE = "file_id bigint, ast_text string"


def plain_groups(edges):
    """{name: (least name, size)} of the circles of one file."""
    def reached(start):
        seen, todo = set(), [b for a, b in edges if a == start]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += [b for a, b in edges if a == x]
        return seen

    reach = {a: reached(a) for a in {x for e in edges for x in e}}
    out = {}
    for a in reach:
        group = {b for b in reach[a] if a in reach[b]}
        if group:
            out[a] = (min(group), len(group))
    return out


def check(spark, files):
    rows = [(f, a, b) for f, edges in files.items() for a, b in edges]
    df = spark.createDataFrame(rows, "file_id bigint, caller string, callee string").repartition(3)
    got = {(r.file_id, r.name): (r.group_name, r.n_names) for r in calls.recursive_groups(df).collect()}
    assert got == {(f, n): g for f, edges in files.items() for n, g in plain_groups(set(edges)).items()}
    return got


def test_groups(spark):
    pick = random.Random(2)
    files = {
        1: [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d")],
        2: [("a", "b"), ("b", "c")],
        3: [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b"), ("z", "z")],
        # Two circles, one behind the other, and a way into both.
        4: [("m", "n"), ("n", "m"), ("n", "a"), ("a", "b"), ("b", "a"), ("q", "m"), ("b", "x")],
        5: [(f"n{i:02}", f"n{(i + 1) % 25:02}") for i in range(25)],
    }
    for f in range(6, 30):
        n = pick.randrange(3, 12)
        files[f] = [(f"v{pick.randrange(n)}", f"v{pick.randrange(n)}") for _ in range(pick.randrange(2, 2 * n))]
    got = check(spark, files)
    assert max(n for _, n in got.values()) == 25


def test_no_circles(spark):
    assert check(spark, {1: [("a", "b")]}) == {}
    empty = spark.createDataFrame([], "file_id bigint, caller string, callee string")
    assert calls.recursive_groups(empty).count() == 0


def test_edges(spark):
    """Calls count for the innermost declaration, and for names that the file declares."""
    outline = "\n".join([
        "module", "  function_definition", "    identifier: 'f'", "    block", "      call",
        "        identifier: 'g'", "      function_definition", "        identifier: 'g'",
        "        block", "          call", "            identifier: 'f'", "          call",
        "            identifier: 'print'", "      call", "        identifier: 'f'",
        "  call", "    identifier: 'f'", "  function_definition", "    block", "      call", "        identifier: 'g'",
    ])
    df = spark.createDataFrame([(1, outline), (2, "module")], OUTLINE)
    trees = nodes.outline_trees(df)
    edges = calls.call_edges(trees, "function_definition", "call", "identifier", within=1)
    assert sorted((r.file_id, r.caller, r.callee) for r in edges.collect()) == [
        (1, "f", "f"), (1, "f", "g"), (1, "g", "f")]
