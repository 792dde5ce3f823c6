import ast
import sys
from dataclasses import dataclass, field

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tests import samples as S
from treeframe import (
    CODE_LANGUAGES, MARKUP, Language, NativeProducer, Producers, Registry, default_producers,
    pandas_producer, parse_code, parse_corpus, walk_nodes,
)
from treeframe import schemas
from treeframe.functions import trees as T
from treeframe.operators import results as R
from treeframe.plans.producers import PandasProducer

# Workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REGISTRY = CODE_LANGUAGES.add(MARKUP, Language("prose", producer="prose"))


def files(spark, rows):
    return spark.createDataFrame(rows, schemas.FILES)


def row(id, path=None, content="", language=None, read_error=None):
    return (id, path, content, language, "utf-8", read_error)


def python_nodes(content, language):
    """Sample parser: types of the standard library's syntax tree."""
    def walk(node, depth):
        children = list(ast.iter_child_nodes(node))
        yield depth, type(node).__name__, None if children else ast.unparse(node)
        for child in children:
            yield from walk(child, depth + 1)
    yield from walk(ast.parse(content), 0)


def test_one_result_per_file(spark):
    rows = [
        row(1, "a.html", "<p>x</p>"), row(2, "b.html", ""), row(3, "c.unknown", "x"),
        row(4, None, "x", "sql"), row(5, None, "x = 1", "python"), row(6, None, "One.", "PROSE"),
        row(7, "gone.html", None, None, "Error reading file: gone"), row(8, "d.html", "<p>", ""),
    ]
    got = {r.file_id: r for r in parse_corpus(
        files(spark, rows), REGISTRY, extensions={".html": "html"}).collect()}
    assert sorted(got) == list(range(1, 9))
    assert got[1].ast_text == "document\n  p: '<p>'\n  text: 'x'" and got[1].success
    assert got[1].metadata.asDict() == {"parser": "markup", "node_count": 3, "parser_version": "1"}
    assert got[2].ast_text == "document: ''" and got[2].metadata.node_count == 1
    assert (got[3].language, got[3].error) == ("unknown", "Could not detect language from file extension")
    assert got[4].error == "Language sql not supported"
    assert got[5].error == "No producer available for language: python"
    assert got[6].language == "prose" and got[6].metadata.node_count == 3
    assert got[7].error == "Error reading file: gone" and got[7].language == "unknown"
    for r in got.values():
        assert r.success == (r.error is None)
        if not r.success:
            assert r.ast_text == "" and r.metadata.node_count is None and r.metadata.parser == "markup"


def test_python_producer(spark):
    producers = default_producers().with_producer(pandas_producer("stdlib", python_nodes, "3"))
    rows = [row(i, None, "def f(n):\n    return f(n - 1)\n", "python") for i in range(200)]
    rows += [row(900, None, "def broken(:", "python"), row(901, None, "<p>", "html"),
             row(902, None, "", "python"), row(903, None, "x", "nope")]
    reg = REGISTRY.with_producer("stdlib", "python")
    got = {r.file_id: r for r in parse_corpus(files(spark, rows), reg, producers, pruned=False).collect()}
    assert len(got) == 204
    tree = list(python_nodes("def f(n):\n    return f(n - 1)\n", "python"))
    assert got[7].metadata.node_count == len(tree)
    assert got[7].metadata.parser == "stdlib" and got[7].metadata.parser_version == "3"
    assert got[7].ast_text == S.outline(tree)
    assert got[900].error.startswith("Failed to parse: ") and not got[900].success
    assert got[901].metadata.parser == "markup" and got[901].success
    assert got[902].ast_text == "Module: ''"
    assert got[903].error == "Language nope not supported"


def test_python_producer_prunes_and_checks_depths(spark):
    trees = {"good": [(0, "a", None), (1, "b", None), (2, "c", "x")], "deep": [(0, "a", None), (2, "b", "")],
             "two roots": [(0, "a", None), (0, "b", "")], "none": []}
    fixed = pandas_producer("fixed", lambda content, language: trees[content])
    producers = Producers().with_producer(fixed).by_default("fixed")
    reg = Registry([Language("x", include_types=("a",))])
    got = {r.path: r for r in parse_corpus(
        files(spark, [row(i, k, k, "x") for i, k in enumerate(trees)]), reg, producers,
        parser="fixed").collect()}
    assert got["good"].ast_text == "a\n  b" and got["good"].metadata.node_count == 3
    assert got["deep"].error == "Failed to parse: node 1 has depth 2"
    assert got["two roots"].error == "Failed to parse: node 1 has depth 0"
    assert got["none"].error == "Failed to parse: no nodes"


def test_parser_that_cannot_start(spark):
    def make():
        raise RuntimeError("grammar missing")
    producers = default_producers().with_producer(PandasProducer("bad", make))
    got = parse_corpus(files(spark, [row(1, None, "x", "go")]), REGISTRY, producers, parser="bad").first()
    assert got.error == "Failed to parse: grammar missing"


def test_parse_code_and_parser_choice(spark):
    df = spark.createDataFrame([(1, "<p>a.b", "html")], "n long, body string, lang string")
    assert parse_code(df, "n", "body", "lang", REGISTRY).first().metadata.parser == "markup"
    got = parse_code(df, "n", "body", "lang", REGISTRY, parser="prose", pruned=False).first()
    assert got.metadata.parser == "prose" and "line" in got.ast_text
    with pytest.raises(ValueError, match="Parser 'zz' not found"):
        parse_code(df, "n", "body", "lang", REGISTRY, parser="zz")


def test_producer_registry():
    none = Producers()
    with pytest.raises(ValueError, match="No default parser set"):
        none.choose()
    with pytest.raises(ValueError, match="Parser 'x' not registered"):
        none.by_default("x")
    mine = NativeProducer("x", T.prose_tree)
    one = none.with_producer(mine).by_default("x")
    assert one.choose() is mine and one.choose("x") is mine and one.names() == ["x"]
    assert none.names() == []
    newer = NativeProducer("x", T.prose_tree, "2")
    assert one.with_producer(newer).choose() is newer
    with pytest.raises(ValueError, match="Parser 'y' not found"):
        one.choose("y")
    assert default_producers().names() == ["markup", "prose", "outline"]


def test_null_content_is_an_error(spark):
    producers = default_producers().with_producer(
        pandas_producer("fixed", lambda content, language: [(0, "a", content)]))
    rows = files(spark, [row(1, "a", None, "html"), row(2, "b", "x", "html")])
    for parser in (None, "fixed"):
        got = {r.path: r for r in parse_corpus(rows, REGISTRY, producers, parser=parser).collect()}
        assert got["b"].success and not got["a"].success
        assert (got["a"].error, got["a"].ast_text) == ("No content to parse", "")
        assert got["a"].metadata.node_count is None


def test_python_and_native_producers_in_one_scan(spark, tmp_path):
    files(spark, [row(1, "a", "<p>x", "html"), row(2, "b", "x", "go")]).write.parquet(str(tmp_path / "f"))
    producers = default_producers().with_producer(
        pandas_producer("fixed", lambda content, language: [(0, "a", content)]))
    reg = REGISTRY.with_producer("fixed", "go")
    parsed = parse_corpus(spark.read.parquet(str(tmp_path / "f")), reg, producers)
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert {r.path: r.metadata.node_count for r in parsed.collect()} == {"a": 3, "b": 1}


@dataclass
class Node:
    type: str
    start_byte: int
    end_byte: int
    children: list = field(default_factory=list)


def test_walk_nodes_slices_bytes():
    source = "é = ñ".encode()
    root = Node("module", 0, 7, [Node("identifier", 0, 2), Node("=", 3, 4), Node("identifier", 5, 7)])
    assert list(walk_nodes(root, source)) == [
        (0, "module", None), (1, "identifier", "é"), (1, "=", "="), (1, "identifier", "ñ")]
    deep = Node("n", 0, 0)
    for _ in range(5000):
        deep = Node("n", 0, 0, [deep])
    assert max(d for d, _, _ in walk_nodes(deep, b"")) == 5000


def test_results_reports(spark):
    parsed = parse_corpus(files(spark, [row(1, "a.html", "<p>x", "html"), row(2, "b", "x", "sql")]), REGISTRY)
    reports = {r.file_id: r.report for r in R.format_report(parsed).collect()}
    assert reports[1] == "Language: html\nFile: a.html\n" + "-" * 40 + "\ndocument\n  p: '<p>'\n  text: 'x'"
    assert reports[2] == "Error parsing file: Language sql not supported"
    assert [r.file_id for r in R.successes(parsed).collect()] == [1]
    assert [r.file_id for r in R.failures(parsed).collect()] == [2]
    total = R.corpus_summary(parsed).first()
    assert tuple(total) == (1, 2, 3)
    by = {r.language: tuple(r)[1:] for r in R.corpus_summary(parsed, by="language").collect()}
    assert by == {"html": (1, 1, 3), "sql": (0, 1, 0), None: (1, 2, 3)}
    assert [tuple(r) for r in R.error_breakdown(parsed).collect()] == [("sql", "Language sql not supported", 1)]


def test_summary_of_nothing(spark):
    assert tuple(R.corpus_summary(parse_corpus(files(spark, []), REGISTRY)).first()) == (0, 0, 0)


def test_text_columns(spark):
    lines = "\n".join(f"line {i}" for i in range(25))
    df = spark.createDataFrame([(lines,), ("a\n b\nc",), ("",)], "ast_text string")
    got = R.outline_stats(R.preview_lines(df)).collect()
    assert got[0].preview == "\n".join(lines.split("\n")[:20]) + "\n... (truncated)"
    assert got[1].preview == "a\n b\nc" and (got[1].n_lines, got[1].n_top_level) == (3, 2)
    assert R.preview(df, chars=4).first().preview == "line"
    assert [r.occurrences for r in R.text_occurrences(df, "line").collect()] == [25, 0, 0]
    over = spark.createDataFrame([("aaaaa",)], "ast_text string")
    assert R.text_occurrences(over, "aa").first().occurrences == "aaaaa".count("aa")
    ratio = R.size_ratio(df.withColumn("content", F.lit(""))).first()
    assert ratio.size_ratio is None


def test_counts_do_not_render(spark):
    parsed = parse_corpus(files(spark, [row(1, "a.html", "<p>x", "html")]), REGISTRY)
    plan = R.corpus_summary(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" not in plan


def test_native_parse_has_no_shuffle(spark):
    parsed = parse_corpus(files(spark, [row(1, "a.html", "<p>x", "html")]), REGISTRY)
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan


def hanging(content, language):
    """A parser whose native code may crash, hang or raise."""
    import os
    import time

    if content == "crash":
        os._exit(3)
    if content == "hang":
        time.sleep(600)
    if content == "raise":
        raise ValueError("no")
    return [(0, "file", None), (1, "line", content)]


def test_guarded_parser(spark):
    """A file that hangs or ends the parser's process is an error; all others have results."""
    import time

    producers = default_producers().with_producer(pandas_producer("wild", hanging, deadline=2.0))
    contents = ["one", "crash", "two", "hang", "raise", "three" * 100_000, None, "crash", "four"]
    rows = [row(i, None, c, "go") for i, c in enumerate(contents)]
    began = time.monotonic()
    parsed = parse_corpus(files(spark, rows).coalesce(1), REGISTRY, producers, parser="wild")
    got = {r.file_id: (r.success, r.error) for r in parsed.collect()}
    assert time.monotonic() - began < 100
    assert [i for i, (ok, _) in got.items() if ok] == [0, 2, 5, 8]
    assert got[1][1] == got[7][1] == "Failed to parse: parser process ended (3)"
    assert got[3][1] == "Failed to parse: parser took longer than 2 s"
    assert got[4][1] == "Failed to parse: no" and got[6][0] is False


def test_guarded_parser_that_cannot_be_made(spark):
    def make():
        raise ImportError("no grammar")

    producers = default_producers().with_producer(PandasProducer("none", make, deadline=5.0))
    parsed = parse_corpus(files(spark, [row(1, None, "x", "go")] * 2), REGISTRY, producers, parser="none")
    assert {r.error for r in parsed.collect()} == {"Failed to parse: no grammar"}
