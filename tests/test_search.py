import random

import pytest

from tests import samples as S
from treeframe.operators import code, nodes, search, versions
from treeframe.plans.parse import parse_corpus
from treeframe.registry import Language, Registry


FIB = """module
  function_definition
    def: 'def'
    identifier: 'fib'
    parameters
      identifier: 'n'
    block
      return_statement
        call
          identifier: 'fib'
        call
          identifier: 'other'
  class_definition
    identifier: 'Shop'
    block
      function_definition
        identifier: 'g'
        block
          call
            identifier: 'fib'
      function_definition
        decorator
          a: '1'
          b: '2'
          c: '3'
        identifier: 'far'
  for_statement
    while_statement
      if_statement
        for_statement: 'x'"""


@pytest.fixture(scope="module")
def trees(spark):
    df = spark.createDataFrame(
        [(1, FIB), (2, "module: ''"), (3, FIB.replace("'other'", "'g'"))], "file_id long, ast_text string")
    return nodes.outline_trees(df).cache()


def test_extract_names(trees):
    got = search.extract_names(trees, "function_definition", "identifier").where("file_id = 1")
    # The third function's name is out of reach.
    assert [r.name for r in got.orderBy("decl_ord").collect()] == ["fib", "g"]
    wide = search.extract_names(trees, "function_definition", "identifier", within=5)
    assert [r.name for r in wide.where("file_id = 1").orderBy("decl_ord").collect()] == ["fib", "g", "far"]


def test_recursive_decls(trees):
    got = search.recursive_decls(trees, "function_definition", "call", "identifier")
    assert sorted((r.file_id, r.name) for r in got.collect()) == [(1, "fib"), (3, "fib")]


def test_recursion_is_per_declaration(spark):
    # Many equal names: only the declaration that encloses the call counts.
    body = "module\n" + "\n".join(
        "  function_definition\n    identifier: 'f'\n    block" + ("\n      call\n        identifier: 'f'" if i % 2 else ": ''")
        for i in range(300))
    df = nodes.outline_trees(spark.createDataFrame([(1, body)], "file_id long, ast_text string"))
    got = search.recursive_decls(df, "function_definition", "call", "identifier").collect()
    assert len(got) == 150 and len({r.decl_ord for r in got}) == 150


def test_matches(trees):
    rows = nodes.explode_nodes(trees).where("file_id = 1").cache()
    assert search.match_nodes(rows, "identifier", "call").count() == 3
    assert search.match_nodes(rows, "identifier", "call", "class_definition").count() == 1
    assert search.match_nodes(rows, ancestor_type="for_statement").count() == 3
    assert search.match_nodes(rows, "module", "call").count() == 0
    nested = search.nested_in_same(rows, ["for_statement", "while_statement"])
    assert sorted(r.node_type for r in nested.collect()) == ["for_statement", "while_statement"]
    shape = search.skeleton(rows, ["function_definition", "class_definition"], 1)
    assert [r.node_type for r in shape.orderBy("ord").collect()] == ["function_definition", "class_definition"]
    assert search.skeleton(rows, ["function_definition"]).count() == 3


def test_files_with(trees):
    rows = nodes.explode_nodes(trees)
    files = trees.select("file_id")
    for present, joined in ((True, search.files_with), (False, search.files_without)):
        direct = {r.file_id for r in search.where_contains(trees, "class_definition", present).collect()}
        assert direct == {r.file_id for r in joined(files, rows, "class_definition").collect()}
        assert direct == ({1, 3} if present else {2})
    texts = nodes.render_outline(trees)
    assert {r.file_id for r in search.files_mentioning(texts, "class_def").collect()} == {1, 3}
    assert {r.file_id for r in search.files_mentioning(texts, "class_def", False).collect()} == {2}


def test_line_decls(spark):
    df = spark.createDataFrame(S.CODE, "file_id long, path string, content string, language string")
    got = {}
    for r in code.line_decls(df).orderBy("file_id", "line_no").collect():
        got.setdefault(r.language, []).append((r.line_no, r.depth, r.node_type, r.name))
    assert got["python"] == [
        (1, 0, "import_statement", "os"), (2, 0, "import_from_statement", "pathlib"),
        (4, 0, "class_definition", "Shop"), (5, 1, "function_definition", "price"),
        (10, 0, "function_definition", "main")]
    assert got["javascript"] == [
        (1, 0, "import_statement", "./tools"), (2, 0, "class_declaration", "Cart"),
        (5, 0, "arrow_function", "twice"), (6, 0, "function_declaration", "outer"),
        (7, 1, "function_declaration", "inner")]
    assert [(t, n) for _, _, t, n in got["typescript"]] == [
        ("interface_declaration", "Item"), ("type_alias_declaration", "Id"),
        ("enum_declaration", "Size"), ("class_declaration", "Box")]
    assert [(t, n) for _, _, t, n in got["go"]] == [
        ("package_clause", "main"), ("import_declaration", "fmt"), ("struct_type", "Cart"),
        ("interface_type", "Buyer"), ("method_declaration", "Add"), ("function_declaration", "main")]
    assert got["cpp"] == [
        (1, 0, "namespace_definition", "shop"), (2, 1, "class_specifier", "Cart"),
        (4, 2, "function_definition", "total")]
    assert "text" not in got


def test_hashes_and_duplicates(spark):
    # Fixed value: SHA-256 of the empty text.
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    df = spark.createDataFrame(
        [(1, ""), (2, "a"), (3, "a"), (4, "a "), (5, "é" * 500000), (6, "a")], "file_id long, content string")
    hashes = [r.content_hash for r in versions.with_content_hash(df).orderBy("file_id").collect()]
    assert hashes[0] == empty and len(set(hashes)) == 4
    groups = versions.duplicate_groups(df).collect()
    assert [(r.files, r.first_file_id) for r in groups] == [(3, 2)]


FILES = "file_id long, path string, content string, language string, read_error string"


def test_incremental_with_repeated_ids(spark):
    """A file is its id and content: what is done does not come back with another file's id."""
    rows = [(1, "a"), (1, "b"), (2, "c"), (2, "c2"), (3, "a"), (None, "d"), (4, None), (4, None)]
    for kind in ("bigint", "string"):
        df = spark.createDataFrame(rows, "file_id bigint, content string").selectExpr(
            f"cast(file_id as {kind}) file_id", "content", "'en' language")
        new = versions.with_key(df, "prose", "1")
        done = new.where("content in ('b', 'c2')").select("key")
        got = sorted(((r.file_id, r.content) for r in versions.incremental(new, done).collect()), key=str)
        want = [(1, "a"), (2, "c"), (None, "d"), (4, None), (4, None)]
        if kind == "string":
            want = [(i and str(i), c) for i, c in want]
        assert got == sorted(want, key=str)


def test_incremental_reads_each_side_once_for_contents(spark):
    df = spark.createDataFrame([(1, "a", "en")], "file_id bigint, content string, language string")
    new = versions.with_key(df, "prose", "1")
    plan = versions.incremental(new, new.select("key"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 3


def test_incremental(spark):
    def keyed(rows, version="1", parser="prose"):
        full = [(i, f"p{i}", c, lang, None if c is not None else "gone") for i, c, lang in rows]
        return versions.with_key(spark.createDataFrame(full, FILES), parser, version)
    ids = lambda df: sorted(r.file_id for r in df.collect())
    rows = [(1, "a", "x"), (2, "a", "X"), (3, "a", "y"), (4, "b", "x"), (5, "c", "x"),
            (6, None, "x"), (7, None, "x")]
    done = [(9, "b", "x"), (8, "b", "x")]
    new = keyed(rows)
    assert ids(versions.incremental(new, keyed(done))) == [1, 3, 5, 6, 7]
    assert ids(versions.incremental(new, keyed(done, "2"))) == [1, 3, 4, 5, 6, 7]
    assert ids(versions.incremental(new, keyed(done, parser="markup"))) == [1, 3, 4, 5, 6, 7]
    assert ids(versions.incremental(new, new)) == [6, 7]
    registry = Registry([Language("x", producer="prose"), Language("y", producer="prose")])
    parse = lambda df: parse_corpus(df, registry, keep=["key"])
    merged = versions.merge_results(
        new, parse(keyed(done)), parse(versions.incremental(new, keyed(done)))
    ).collect()
    assert {r.file_id: r.error for r in merged} == {
        1: None, 2: None, 3: None, 4: None, 5: None, 6: "gone", 7: "gone"}
    assert len(merged) == 7 and all(r.success for r in merged if r.file_id < 6)


PRUNED = "<div><h1>title</h1><p>x</p></div><nav><ul><li>a</li></ul></nav><div><h1>two</h1></div>"


@pytest.mark.parametrize("lists", [{"include": ("document", "div", "h1")}, {"exclude": ("nav",)}])
def test_pruned_trees_keep_places(spark, lists):
    whole = nodes.markup_trees(spark.createDataFrame([(1, PRUNED)], "file_id long, content string"))
    pruned = nodes.prune_trees(whole, **lists)
    names = lambda df: [(r.decl_ord, r.name) for r in search.extract_names(df, "h1", "text").collect()]
    assert names(pruned) == names(whole) and [n for _, n in names(whole)] == ["title", "two"]
    rows = {r.ord: r for r in nodes.explode_nodes(whole).collect()}
    got = nodes.explode_nodes(pruned).collect()
    assert 0 < len(got) < len(rows)
    for r in got:
        want = rows[r.ord]
        assert (r.parent_ord, r.path_types, r.path_ords) == (
            want.parent_ord, want.path_types, want.path_ords)


def test_recursion_on_a_pruned_tree(spark):
    outline = "\n".join([
        "module", "  class", "    name: 'k'", "  function", "    identifier: 'f'", "    block",
        "      call", "        identifier: 'f'"])
    trees = nodes.outline_trees(spark.createDataFrame([(1, outline)], "file_id long, ast_text string"))
    pruned = nodes.prune_trees(trees, exclude=("class",))
    found = lambda df: [tuple(r)[1:] for r in search.recursive_decls(
        df, "function", "call", "identifier").collect()]
    assert found(pruned) == found(trees) == [(3, "f")]


@pytest.mark.parametrize("language", ["python", "javascript", "typescript", "go", "cpp"])
def test_long_lines(spark, language):
    lines = ["int " * 250_000 + "f(x) {", "a::" * 300_000, "import " * 150_000, "x" * 1_000_000,
             "func (" + "a " * 400_000, "def " * 250_000]
    df = spark.createDataFrame([(1, language, "\n".join(lines))], "file_id long, language string, content string")
    assert code.line_decls(df).count() <= len(lines)


def test_broken_markup_is_linear(spark):
    import time

    def took(n, text):
        df = spark.createDataFrame([(1, text * n)], "file_id long, content string")
        started = time.perf_counter()
        nodes.markup_trees(df).selectExpr("size(tree)").collect()
        return time.perf_counter() - started

    for text in ("<!-- x ", "<script> ", "<style> ", "< "):
        took(10, text)
        assert took(40_000, text) < 20 * (took(4_000, text) + 0.2)


def test_outline_diff(spark):
    make = lambda rows: nodes.markup_nodes(spark.createDataFrame(rows, "file_id long, content string"))
    got = {(r.file_id, r.place, r.node_type): (r.kept, r.added, r.removed) for r in versions.outline_diff(
        make([(1, "<ul><li>a</li><li>b</li></ul>"), (2, "gone")]),
        make([(1, "<ul><li>a</li></ul><h1>t</h1>")])).collect()}
    assert got[(1, "document", "ul")] == (1, 0, 0)
    assert got[(1, "document/ul", "li")] == (1, 0, 1)
    assert got[(1, "document", "h1")] == (0, 1, 0)
    assert got[(2, "document", "text")] == (0, 0, 1)


def plain_paths(tree, pattern):
    """Ords whose path of types fits, by a regular expression over the path."""
    import re

    regex = "^" if pattern.startswith("/") and not pattern.startswith("//") else "^(.*/)?"
    for i, (anywhere, name) in enumerate(search.path_steps(pattern)):
        regex += ("" if i == 0 else "/(.*/)?" if anywhere else "/") + ("[^/]+" if name == "*" else name)
    above, out = [], []
    for n in tree:
        above = above[: n.depth] + [n.node_type]
        if re.search(regex + "$", "/".join(above)):
            out.append(n.ord)
    return out


def test_match_paths(spark):
    pick = random.Random(8)
    outlines = []
    for i in range(40):
        lines, depth = ["a"], 0
        for _ in range(pick.randrange(0, 60)):
            depth = pick.randrange(1, depth + 2)
            lines.append("  " * depth + pick.choice("abcd"))
        outlines.append((i, "\n".join(lines)))
    trees = nodes.outline_trees(
        spark.createDataFrame(outlines, "file_id long, ast_text string")
    ).cache()
    whole = {r.file_id: r.tree for r in trees.collect()}
    for pattern in ("b", "/a", "/b", "//a", "a/b", "a//b", "a//b/c", "/a/*/b", "*//a", "a/a//a", "*/*/*", "/*//d//*/a",
                    "a//a//a//b//c/d"):
        got = {}
        for r in search.match_paths(trees, pattern).collect():
            got.setdefault(r.file_id, []).append(r.ord)
        assert got == {f: want for f, t in whole.items() if (want := plain_paths(t, pattern))}, pattern
        counts = {r.file_id: r.matches for r in search.count_paths(trees, pattern).collect()}
        assert counts == {f: len(plain_paths(t, pattern)) for f, t in whole.items()}


@pytest.mark.parametrize("pattern", ["", "/", "a//", "a///b", "/".join("a" * 31)])
def test_wrong_path_patterns(pattern):
    with pytest.raises(ValueError):
        search.path_steps(pattern)
