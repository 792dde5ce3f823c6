import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tests import samples as S
from treeframe.functions import arrays, text as X
from treeframe.functions import trees as T
from treeframe.operators import metrics, nodes


@pytest.fixture(scope="module")
def markup(spark):
    df = spark.createDataFrame(S.MARKUP + [(10, S.nested(40))], "file_id long, content string")
    return nodes.markup_trees(df).cache()


def raw(tree):
    return [(n.depth, n.node_type, n.text) for n in tree]


def test_running_crosses_blocks(spark):
    b = arrays.BLOCK
    lengths = [0, 1, b - 1, b, b + 1, 3 * b + 7, b * b - 1, b * b, b * b + 1, 3 * b * b + 5 * b + 2]
    df = spark.createDataFrame([(list(range(n)),) for n in lengths], "a array<int>")
    got = df.select("a", arrays.running(F.col("a"), F.lit(0), lambda s, x: s + x).alias("r")).collect()
    assert len(got) == len(lengths)
    for row in got:
        assert list(row.r) == [i * (i + 1) // 2 for i in range(len(row.a))]


def test_run_lengths(spark):
    df = spark.createDataFrame([(["b", "a", "b", "b"],), ([],)], "a array<string>")
    got = [[tuple(x) for x in r.r] for r in df.select(arrays.run_lengths(F.col("a")).alias("r")).collect()]
    assert got == [[("a", 1), ("b", 3)], []]


def test_markup_shapes(markup):
    trees = {r.file_id: [(n.depth, n.node_type) for n in r.tree] for r in markup.collect()}
    assert trees[1] == [
        (0, "document"), (1, "declaration"), (1, "html"), (2, "body"), (3, "p"), (3, "text"),
        (3, "b"), (3, "text"),
    ]
    assert trees[2] == [(0, "document")]
    assert trees[3] == [(0, "document"), (1, "text"), (1, "text")]
    # Closing tags without an opening one do not pull later nodes up.
    assert trees[4][1:3] == [(1, "ul"), (2, "li")] and trees[4][-1][1] == "text"
    assert [t for _, t in trees[5]] == ["document", "div", "script", "style", "br"]
    assert trees[9][1] == (1, "script")
    assert max(d for d, _ in trees[10]) == 41


def test_markup_keeps_all_text(spark):
    df = spark.createDataFrame(S.MARKUP, "file_id long, content string")
    joined = df.select("content", F.array_join(F.transform(
        F.regexp_extract_all("content", F.lit(T.TOKEN), F.lit(0)), lambda t: t), "").alias("again"))
    for row in joined.collect():
        assert row.again == row.content


def test_paths_match_recursion(markup):
    rows = nodes.explode_nodes(markup).orderBy("file_id", "ord").collect()
    by_file = {}
    for row in rows:
        by_file.setdefault(row.file_id, []).append(row)
    for found in by_file.values():
        above = S.parents([r.depth for r in found])
        for row, chain in zip(found, above):
            assert row.path_ords == chain
            assert row.path_types == [found[o].node_type for o in chain]
            assert row.parent_ord == (chain[-1] if chain else None)


@pytest.mark.parametrize("part_nodes", [1, 2, 5, nodes.PART_NODES])
def test_paths_of_bare_node_rows(markup, part_nodes):
    full = nodes.explode_nodes(markup)
    bare = nodes.explode_nodes(markup, paths=False).repartition(7)
    key = lambda df: sorted(map(str, df.select(*sorted(full.columns)).collect()))
    assert key(nodes.with_tree_paths(bare, part_nodes)) == key(full)


@pytest.mark.parametrize("include,exclude", [
    (None, None), (("document", "html", "div"), None), (None, ("ul", "div")),
    (("document",), ("document",)), ((), ("li",)),
])
def test_outline_matches_recursion(markup, include, exclude):
    got = markup.select("tree", T.render(T.prune(F.col("tree"), include, exclude)).alias("o"))
    for row in got.collect():
        assert row.o == S.outline(raw(row.tree), include, exclude)


def test_pruning_rows_and_trees_agree(markup):
    rows = nodes.explode_nodes(markup)
    for by_rows, by_trees in (
        (nodes.prune_include(rows, ["document", "div"]),
         nodes.prune_trees(markup, include=["document", "div"])),
        (nodes.prune_exclude(rows, ["ul"]), nodes.prune_trees(markup, exclude=["ul"])),
    ):
        left = {(r.file_id, r.ord) for r in by_rows.collect()}
        right = {(r.file_id, r.ord) for r in nodes.explode_nodes(by_trees, paths=False).collect()}
        assert left == right


def test_types_outline(markup):
    for row in markup.select("tree", T.render_types(F.col("tree")).alias("o")).collect():
        assert row.o == "\n".join("  " * n.depth + n.node_type for n in row.tree)


def test_leaf_literal_equals_repr(spark):
    texts = ["", "it's", 'say "x"', "it's \"both\"", "back\\slash", "tab\tcr\rnl\n", "x" * 50,
             "x" * 51, "é" * 60, "\n" * 30, "a\u00a0b\u200b", "\x00\x7f\u2028", "😀'\U0010ffff"]
    draw = random.Random(7)
    pool = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    texts += ["".join(draw.choices(pool + ["'", '"', "\\"] * 200, k=draw.randrange(70)))
              for _ in range(500)]

    def expected(text):
        text = text.replace("\n", "\\n")
        return repr(text[:47] + "..." if len(text) > 50 else text)

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    # Characters newer than the runtime's Unicode tables count as unassigned there.
    known = df.where(~F.col("t").rlike(r"\p{Cn}"))
    rows = known.select("t", X.leaf_literal(F.col("t")).alias("q")).collect()
    assert len(rows) > 300
    for row in rows:
        assert row.q == expected(row.t)


def test_outline_round_trip(markup):
    outlines = nodes.render_outline(markup.select("file_id", "tree"))
    again = nodes.outline_trees(outlines.withColumn("first", F.col("ast_text")))
    both = again.join(markup.withColumnRenamed("tree", "was"), "file_id").collect()
    assert len(both) == len(S.MARKUP) + 1
    for row in both:
        assert [(n.depth, n.node_type) for n in row.tree] == [(n.depth, n.node_type) for n in row.was]
        # What an outline shows is unchanged when it is read and written again.
        assert S.outline(raw(row.tree)) == row.first


def test_outline_leaf_text(spark):
    line = "module\n  is not: 'is not'\n  :: ':'\n  string: \"it's\"\n  x: 'a\\\\nb\\t\\''"
    df = spark.createDataFrame([(1, line)], "file_id long, ast_text string")
    tree = nodes.outline_trees(df).first().tree
    assert [(n.node_type, n.text) for n in tree] == [
        ("module", None), ("is not", "is not"), (":", ":"), ("string", "it's"), ("x", "a\\nb\t'"),
    ]


def test_prose_tree(spark):
    df = spark.createDataFrame([(1, "One. Two!\n\nThree"), (2, "")], "file_id long, content string")
    trees = {r.file_id: raw(r.tree) for r in nodes.prose_trees(df).collect()}
    assert trees[1] == [
        (0, "document", None), (1, "line", None), (2, "sentence", "One."), (2, "sentence", "Two!"),
        (1, "line", ""), (1, "line", None), (2, "sentence", "Three"),
    ]
    assert trees[2] == [(0, "document", None), (1, "line", "")]


def test_metrics(markup):
    counts = {r.file_id: r.node_count for r in metrics.node_counts(markup).collect()}
    by_rows = {r.file_id: r.node_count for r in metrics.node_count(nodes.explode_nodes(markup)).collect()}
    assert counts == by_rows
    per_type = metrics.construct_counts(markup).groupBy("file_id").agg(F.sum("nodes").alias("n"))
    assert {r.file_id: r.n for r in per_type.collect()} == counts
    deep = {r.file_id: r for r in metrics.nesting_metrics(markup, ["ul", "div"]).collect()}
    assert deep[10].max_depth == 41 and deep[10].max_nesting == 40
    assert deep[4].max_nesting == 2 and deep[2].max_nesting == 0
    shares = {r.file_id: r for r in metrics.prune_ratio(markup, ["document"]).collect()}
    assert shares[10].raw_nodes == 42 and shares[10].shown_nodes == 2
    assert shares[2].removed == 0


def test_defects(spark):
    df = spark.createDataFrame(S.MARKUP, "file_id long, content string")
    got = {(r.file_id, r.node_type): (r.opened, r.closed, r.unmatched_closes, r.left_open)
           for r in metrics.defects(df).collect()}
    # Two closings of what was never open; list ends close the items in them.
    assert got[(4, "div")] == (0, 2, 2, 0)
    assert got[(4, "li")] == (3, 1, 2, 0)
    assert got[(7, "a")] == (3, 2, 0, 2)
    assert not any(file in (1, 2, 3, 5) for file, _ in got)


@pytest.mark.parametrize("content, types", [
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>x",
     "document ul .li ..text .li ..text ..ul ...li ....text .li ..text text"),
    ("<table><tr><td>a<td>b<tr><td>c</table>y",
     "document table .tr ..td ...text ..td ...text .tr ..td ...text text"),
    ("<div><span>a</div>b</span>c", "document div .span ..text text text"),
    ("</p></div>x</li>", "document text"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "document dl .dt ..text .dd ..text .dt ..text"),
    ("<div>a<!-- b <div>", "document div .text"), ("<p><script>x <b>", "document p script"),
])
def test_elements_close_by_name(spark, content, types):
    df = spark.createDataFrame([(1, content)], "file_id long, content string")
    got = nodes.render_types(nodes.markup_trees(df)).first().ast_text.split("\n")
    assert [g.removeprefix("  ").replace("  ", ".") for g in got] == types.split(" ")


def test_depth_is_bounded(spark):
    rows = [(1, "<div>x" * 3000), (2, "<li>x" * 3000)]
    df = spark.createDataFrame(rows, "file_id long, content string")
    deepest = nodes.markup_nodes(df).groupBy("file_id").max("depth").collect()
    assert {r[0]: r[1] for r in deepest} == {1: 513, 2: 2}


@pytest.mark.parametrize("content, nodes_", [
    ('<a title="x > y">t</a>', [(1, "a", None), (2, "text", "t")]),
    ("<p id=5\">t", [(1, "p", '<p id=5">'), (1, "text", "t")]),
    ("<div a='1>0' b=\">\">t</div>u", [(1, "div", None), (2, "text", "t"), (1, "text", "u")]),
    ("<textarea><b>x</b> <!y</textarea><i>z</i>",
     [(1, "textarea", None), (2, "text", "<b>x</b> <!y"), (1, "i", None), (2, "text", "z")]),
    ("<Textarea>a<b>", [(1, "textarea", None), (2, "text", "a<b>")]),
    ("<title>a </textarea> b</TITLE >c",
     [(1, "title", None), (2, "text", "a </textarea> b"), (1, "text", "c")]),
    ("<title><!a</title>", [(1, "title", None), (2, "text", "<!a")]),
    ("<title>plain</title><titles><b></titles>",
     [(1, "title", None), (2, "text", "plain"), (1, "titles", None), (2, "b", "<b>")]),
    ("<a b=\"c<d>\">e", [(1, "a", None), (2, "text", 'b="c')]),
])
def test_values_and_text_only_elements(spark, content, nodes_):
    df = spark.createDataFrame([(1, content)], "file_id long, content string")
    tree = [(n.depth, n.node_type, n.text) for n in nodes.markup_trees(df).first().tree][1:]
    if 'c<d' in content:
        # A value does not reach over the next tag.
        assert [n[1] for n in tree][-2:] == ["d", "text"] and tree[-1][2] == '">e'
    else:
        assert tree == nodes_


def test_long_broken_markup_takes_linear_time(spark):
    import time

    def took(n):
        rows = [(i, part * (n // len(part))) for i, part in enumerate(
            ("<a ", '<a b="', "<a '", "<textarea", "<title>< ", "<title></", '"', "<t>", "<!a \"'")
        )]
        df = spark.createDataFrame(rows, "file_id long, content string").coalesce(1)
        began = time.perf_counter()
        df.select(F.size(T.markup_tokens(F.col("content")))).collect()
        return time.perf_counter() - began

    took(1000)
    assert took(200_000) < 10 * took(50_000) + 2
