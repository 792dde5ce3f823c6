"""Who calls whom in a file, and declarations that call each other in a circle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe.functions import trees as T
from treeframe.functions.arrays import let, over, running
from treeframe.session import scratch_dir


def call_edges(
    trees: DataFrame, decl_type: str, call_type: str, name_type: str, within: int = 4
) -> DataFrame:
    """Per file, the names of declarations and the names that their bodies call.

    A call counts for the innermost named declaration around it, and only if a
    declaration of the file has the called name; each edge comes once.
    """
    keep = [c for c in trees.columns if c != "tree"]
    found = over(
        _edges, "tree",
        decl_type=decl_type, call_type=call_type, name_type=name_type, within=within,
    )
    return trees.select(*keep, F.inline_outer(found)).where(F.col("caller").isNotNull())


def _edges(tree: Column, decl_type: str, call_type: str, name_type: str, within: int) -> Column:
    def found(nodes: Column) -> Column:
        steps = F.filter(
            F.transform(
                T.placed(nodes, decl_type, call_type),
                lambda p: F.struct(
                    p["node"]["depth"].alias("depth"),
                    (p["node"]["node_type"] == decl_type).alias("decl"),
                    T.first_after(nodes, p["at"], name_type, within).alias("name"),
                ),
            ),
            lambda s: s["name"].isNotNull(),
        )
        # State: the declarations around this point, innermost last.
        chains = running(
            steps, F.expr("cast(array() as array<struct<depth:int,decl:boolean,name:string>>)"),
            lambda chain, n: let(
                F.filter(chain, lambda c: c["depth"] < n["depth"]),
                lambda above: F.when(n["decl"], F.array_append(above, n)).otherwise(above),
            ),
        )

        def edges(named: Column) -> Column:
            declared = F.array_distinct(F.transform(
                F.filter(named, lambda z: z["step"]["decl"]), lambda z: z["step"]["name"]
            ))
            calls = F.filter(
                named, lambda z: ~z["step"]["decl"] & (F.size(z["chain"]) > 0)
            )
            pairs = F.array_distinct(F.transform(calls, lambda z: F.struct(
                F.element_at(z["chain"], -1)["name"].alias("caller"), z["step"]["name"].alias("callee")
            )))
            return let(declared, lambda d: F.filter(pairs, lambda p: F.array_contains(d, p["callee"])))

        return let(
            steps,
            lambda s: let(F.arrays_zip(s.alias("step"), chains.alias("chain")), edges),
        )

    return let(tree, found)


def _saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what an executor loses is read again."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _trimmed(edges: DataFrame) -> DataFrame:
    """Edges from names that are called to names that call; circles have no others."""
    called = edges.select("f", F.col("b").alias("a")).distinct()
    calling = edges.select("f", F.col("a").alias("b")).distinct()
    return edges.join(called, ["f", "a"], "left_semi").join(calling, ["f", "b"], "left_semi")


def _spread(edges: DataFrame, start: DataFrame, best) -> DataFrame:
    """Names (f, name, value) with the best value of all names from which edges lead to them.

    ``start`` has the names' own values. Only names whose value changed pass theirs on,
    so a round costs what it changes.
    """
    known, changed = start, start
    while not changed.isEmpty():
        passed = edges.join(
            changed.select("f", F.col("name").alias("a"), "value"), ["f", "a"]
        ).groupBy("f", F.col("b").alias("name")).agg(best("value").alias("new"))
        both = _saved(known.join(passed, ["f", "name"], "full").select(
            "f", "name", F.coalesce(_best_of(best, "value", "new"), "value", "new").alias("value"),
            (F.col("new").isNotNull() & ~F.col("value").eqNullSafe(_best_of(best, "value", "new")))
            .alias("is_new"),
        ), "calls-round")
        known = both.select("f", "name", "value")
        changed = both.where("is_new").select("f", "name", "value")
    return known


def _best_of(best, *values: str) -> Column:
    """The greatest or least of columns, null values aside."""
    return (F.greatest if best is F.max else F.least)(*values)


def recursive_groups(edges: DataFrame, file: str = "file_id") -> DataFrame:
    """Names that call each other in a circle, or themselves: strongly connected components.

    Rows: file, name, the least name of its group, and the group's size. ``edges``
    has the file, caller and callee. In each round, for all files at once:

    1. Trim: names that nothing calls or that call nothing are in no circle.
    2. Colour: each name takes the greatest name that leads to it. The names of a
       circle share a colour; a colour's greatest name is its root.
    3. What leads back to the root within its colour is the root's group. Roots and their
       groups are taken out, and the rest goes on.

    Edges and names are shuffled, no texts; every step is written, so a lost executor costs no
    more than that step.
    """
    named = edges.select(F.col(file).alias("f"), F.col("caller").alias("a"), F.col("callee").alias("b"))
    all_edges = _saved(named.distinct(), "calls-edges")
    own = all_edges.where("a = b").select("f", F.col("a").alias("name"), F.col("a").alias("root"))
    groups, left = None, _saved(_trimmed(_trimmed(all_edges.where("a <> b"))), "calls-left")
    while not left.isEmpty():
        names = left.select("f", F.explode(F.array("a", "b")).alias("name")).distinct()
        colours = _spread(left, _saved(names.withColumn("value", F.col("name")), "calls-names"), F.max)
        ends = [colours.select("f", F.col("name").alias(c), F.col("value").alias(f"c{c}")) for c in "ab"]
        inside = _saved(
            left.join(ends[0], ["f", "a"]).join(ends[1], ["f", "b"]).where("ca = cb")
            # Backwards: from what is called to what calls it.
            .select("f", F.col("b").alias("a"), F.col("a").alias("b")),
            "calls-inside",
        )
        roots = colours.where("name = value")
        found = _spread(inside, _saved(roots, "calls-roots"), F.max)
        done = _saved(found.select("f", "name", F.col("value").alias("root")), "calls-groups")
        groups = done if groups is None else groups.unionByName(done)
        out = done.select("f", "name")
        left = _saved(_trimmed(
            left.join(out.withColumnRenamed("name", "a"), ["f", "a"], "left_anti")
            .join(out.withColumnRenamed("name", "b"), ["f", "b"], "left_anti")
        ), "calls-left")
    if groups is not None:
        size = groups.groupBy("f", "root").agg(F.count("*").alias("n"))
        larger = groups.join(size.where("n > 1"), ["f", "root"]).select("f", "name", "root")
        # A name that calls itself may also be in a larger group.
        own = own.join(larger.select("f", "name"), ["f", "name"], "left_anti").unionByName(larger)
    least = own.groupBy("f", "root").agg(
        F.min("name").alias("group_name"), F.count("*").alias("n_names")
    )
    return own.join(least, ["f", "root"]).select(
        F.col("f").alias(file), "name", "group_name", "n_names"
    )
