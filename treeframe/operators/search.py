"""Finding nodes, files, names and patterns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe.functions import trees as T
from treeframe.functions.arrays import let, over, running


def match_nodes(
    nodes: DataFrame,
    node_type: str | None = None,
    parent_type: str | None = None,
    ancestor_type: str | None = None,
) -> DataFrame:
    """Node rows of a type, below a parent and an ancestor of given types."""
    if node_type is not None:
        nodes = nodes.where(F.col("node_type") == node_type)
    if parent_type is not None:
        nodes = nodes.where(F.get("path_types", F.size("path_types") - 1) == parent_type)
    if ancestor_type is not None:
        nodes = nodes.where(F.array_contains("path_types", ancestor_type))
    return nodes


# A step of a path pattern: how it hangs on the one before it, and its node type.
STEP = re.compile(r"(//|/|^)([^/]+)")
MOST_STEPS = 30


def path_steps(pattern: str) -> list[tuple[bool, str]]:
    """Steps of a pattern like ``nav//li/a``: (anywhere below, node type) of each.

    ``/`` is a child and ``//`` any node below; ``*`` is every type. A pattern that
    begins with ``/`` begins at the root, any other one anywhere.
    """
    steps = [(mark != "/", name) for mark, name in STEP.findall(pattern)]
    if not steps or len(steps) > MOST_STEPS or "".join(m + n for m, n in STEP.findall(pattern)) != pattern:
        raise ValueError(f"not a path pattern of 1 to {MOST_STEPS} steps: {pattern!r}")
    return steps


def match_paths(trees: DataFrame, pattern: str) -> DataFrame:
    """Nodes at the end of a path of types, as rows; other nodes never become rows.

    The pattern is an automaton. Its states at a node are two sets of bits: the steps
    that end at the node, and those that end at it or above it. They follow from
    those of the parent, so one walk through the tree finds all matches, in as many
    steps as it has nodes.
    """
    keep = [c for c in trees.columns if c != "tree"]
    found = over(_on_path, "tree", pattern=pattern)
    return trees.select(*keep, F.inline_outer(found)).where(F.col("ord").isNotNull())


def count_paths(trees: DataFrame, pattern: str) -> DataFrame:
    """Per file, how many nodes :func:`match_paths` finds."""
    keep = [c for c in trees.columns if c != "tree"]
    return trees.select(*keep, F.size(over(_on_path, "tree", pattern=pattern)).alias("matches"))


def _on_path(tree: Column, pattern: str) -> Column:
    steps = path_steps(pattern)
    bits = range(len(steps))
    # Steps whose next one is a child, or anywhere below; bit i is step i.
    child = sum(1 << i for i in bits if i + 1 < len(steps) and not steps[i + 1][0])
    below = sum(1 << i for i in bits if i + 1 < len(steps) and steps[i + 1][0])
    every = sum(1 << i for i in bits if steps[i][1] == "*")
    named: dict[str, int] = {}
    for i in bits:
        if steps[i][1] != "*":
            named[steps[i][1]] = named.get(steps[i][1], 0) | 1 << i

    def fits(node_type: Column) -> Column:
        chosen = F.lit(every)
        for name, mask in named.items():
            chosen = F.when(node_type == name, F.lit(mask | every)).otherwise(chosen)
        return chosen

    def found(nodes: Column) -> Column:
        def after(chain: Column, n: Column) -> Column:
            # State: (ends here, ends here or above) of each open node, from the root down.
            def opened(above: Column) -> Column:
                parent = F.get(above, F.size(above) - 1)
                here = F.coalesce(parent["here"], F.lit(0))
                around = F.coalesce(parent["around"], F.lit(0))
                first = F.lit(1) if steps[0][0] else F.when(F.size(above) == 0, 1).otherwise(0)
                open_ = F.shiftleft(
                    here.bitwiseAND(F.lit(child)).bitwiseOR(around.bitwiseAND(F.lit(below))), 1
                ).bitwiseOR(first)
                return let(
                    open_.bitwiseAND(n["fits"]),
                    lambda ends: F.array_append(above, F.struct(
                        ends.alias("here"), ends.bitwiseOR(around).alias("around")
                    )),
                )

            return let(F.slice(chain, F.lit(1), n["depth"]), opened)

        chains = running(
            F.transform(nodes, lambda n: F.struct(n["depth"].alias("depth"), fits(n["node_type"]).alias("fits"))),
            F.expr("cast(array() as array<struct<here:int,around:int>>)"), after,
        )
        last = 1 << (len(steps) - 1)
        hits = F.filter(
            F.arrays_zip(nodes.alias("node"), chains.alias("chain")),
            lambda z: F.element_at(z["chain"], -1)["here"].bitwiseAND(F.lit(last)) != 0,
        )
        return F.transform(hits, lambda z: F.struct(
            *[z["node"][f].alias(f) for f in ("ord", "depth", "node_type", "text")]
        ))

    return let(tree, found)


def skeleton(nodes: DataFrame, types: Iterable[str], max_depth: int | None = None) -> DataFrame:
    """Declarations only: node rows of the given types, down to a depth."""
    kept = nodes.where(F.col("node_type").isin(*types))
    return kept if max_depth is None else kept.where(F.col("depth") <= max_depth)


def nested_in_same(nodes: DataFrame, types: Iterable[str]) -> DataFrame:
    """Nodes of the given types inside another node of these types."""
    types = list(types)
    return nodes.where(
        F.col("node_type").isin(*types)
        & F.arrays_overlap("path_types", F.array(*[F.lit(t) for t in types]))
    )


def where_contains(trees: DataFrame, node_type: str, present: bool = True) -> DataFrame:
    """Files whose own tree holds (or lacks) a node of a type: no join.

    A file that gave no tree lacks every type.
    """
    holds = F.coalesce(T.contains_type(F.col("tree"), node_type), F.lit(False))
    return trees.where(holds if present else ~holds).drop("tree")


def files_with(files: DataFrame, nodes: DataFrame, node_type: str) -> DataFrame:
    """Files that hold a node of a type, with nodes kept in a table of their own."""
    return files.join(_holders(nodes, node_type), "file_id", "left_semi")


def files_without(files: DataFrame, nodes: DataFrame, node_type: str) -> DataFrame:
    return files.join(_holders(nodes, node_type), "file_id", "left_anti")


def _holders(nodes: DataFrame, node_type: str) -> DataFrame:
    # One row per file before the join, however many such nodes a file has.
    return nodes.where(F.col("node_type") == node_type).select("file_id").distinct()


def files_mentioning(results: DataFrame, text: str, present: bool = True) -> DataFrame:
    """Results whose outline text holds (or lacks) a substring."""
    hit = F.col("ast_text").contains(text)
    return results.where(hit if present else ~hit)


def extract_names(
    trees: DataFrame, decl_type: str, name_type: str, within: int = 4
) -> DataFrame:
    """Names of declarations: the first name node among the next ``within`` nodes."""
    keep = [c for c in trees.columns if c != "tree"]
    found = over(
        T.names, "tree", decl_type=decl_type, name_type=name_type, within=within
    )
    return trees.select(*keep, F.inline_outer(found)).where(F.col("name").isNotNull())


def recursive_decls(
    trees: DataFrame, decl_type: str, call_type: str, name_type: str, within: int = 4
) -> DataFrame:
    """Declarations whose subtree calls their own name."""
    keep = [c for c in trees.columns if c != "tree"]
    found = over(
        _recursive, "tree",
        decl_type=decl_type, call_type=call_type, name_type=name_type, within=within,
    )
    return trees.select(*keep, F.inline_outer(found)).where(F.col("name").isNotNull())


def _recursive(
    tree: Column, decl_type: str, call_type: str, name_type: str, within: int
) -> Column:
    """Walks with the open declarations and calls at hand, so the cost follows
    the tree's depth and not the number of equal names in a file."""

    def found(nodes: Column) -> Column:
        steps = F.transform(
            T.placed(nodes, decl_type, call_type),
            lambda p: F.struct(
                *[p["node"][f].alias(f) for f in ("ord", "depth", "node_type")],
                T.first_after(nodes, p["at"], name_type, within).alias("name"),
            ),
        )
        # State: declarations and calls enclosing this point, innermost last.
        chains = running(
            steps,
            F.expr("cast(array() as array<struct<ord:int,depth:int,node_type:string,name:string>>)"),
            lambda chain, n: F.array_append(
                F.filter(chain, lambda c: c["depth"] < n["depth"]), n
            ),
        )
        hits = F.flatten(
            F.transform(
                chains,
                lambda chain: let(
                    F.element_at(chain, -1),
                    lambda call: F.filter(
                        chain,
                        lambda c: (call["node_type"] == call_type)
                        & (c["node_type"] == decl_type)
                        & (c["name"] == call["name"]),
                    ),
                ),
            )
        )
        return F.transform(
            F.array_distinct(hits),
            lambda d: F.struct(d["ord"].alias("decl_ord"), d["name"].alias("name")),
        )

    return let(tree, found)
