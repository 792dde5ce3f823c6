import pytest
from pyspark.sql import functions as F

from tests import samples as S
from treeframe.functions import languages as L
from treeframe.operators import languages as ops
from treeframe.registry import (
    CODE_LANGUAGES, EXTENSIONS, Language, Registry,
)


def test_detect_language(spark):
    df = spark.createDataFrame(S.PATHS, "path string, expected string")
    for row in ops.detect_language(df).collect():
        assert row.detected == row.expected, row.path


def test_url_suffix(spark):
    df = spark.createDataFrame(
        [("http://a.example/x.HTML?q=a.py",), ("http://a.example/x.js#t.go",)], "u string")
    got = [r.s for r in df.select(L.suffix(L.url_path(F.col("u"))).alias("s")).collect()]
    assert got == [".html", ".js"]


def test_by_extension(spark):
    df = spark.createDataFrame([("py",), (".PYW",), ("h",), (".mjs",), ("c",), ("",)], "e string")
    got = [r.l for r in df.select(L.by_extension(F.col("e"), CODE_LANGUAGES).alias("l")).collect()]
    assert got == ["python", "python", "cpp", "javascript", None, None]


def test_first_language_wins_an_extension():
    reg = Registry([Language("B", (".x",)), Language("a", (".x", ".y"))])
    assert reg.by_extension() == {".x": "b", ".y": "a"}
    assert "A" in reg and reg.get("B").name == "b" and len(reg) == 2


def test_compare_detectors(spark):
    paths = spark.createDataFrame(
        [(f"f{e}",) for e in (*EXTENSIONS, *CODE_LANGUAGES.by_extension())] + [("none",)], "path string")
    got = {r.ext: (r.by_path, r.by_registry) for r in ops.compare_detectors(paths, CODE_LANGUAGES).collect()}
    assert got == {
        ".c": ("c", None), ".h": ("c", "cpp"),
        ".mjs": (None, "javascript"), ".pyw": (None, "python"),
    }


def test_resolve_language(spark):
    df = spark.createDataFrame(
        [("a.py", None, None), ("a.py", "Go", None), ("a.py", "", None), ("Makefile", None, None),
         ("gone.py", None, "Error reading file: x"), ("gone", "go", "Error reading file: y")],
        "path string, language string, read_error string")
    got = [(r.language, r.error) for r in ops.resolve_language(df).collect()]
    assert got == [
        ("python", None), ("go", None), ("python", None), ("unknown", ops.NOT_DETECTED),
        ("unknown", "Error reading file: x"), ("go", "Error reading file: y"),
    ]


def test_check_supported_and_languages(spark):
    reg = CODE_LANGUAGES.with_producer("mine", "python")
    df = spark.createDataFrame([("python",), ("go",), ("brainfuck",)], "language string")
    got = {r.language: r.error for r in ops.check_supported(df, reg).collect()}
    assert got == {
        "python": None, "go": "No producer available for language: go",
        "brainfuck": "Language brainfuck not supported",
    }
    asked = {r.language: tuple(r)[1:] for r in ops.check_languages(df, reg).collect()}
    assert asked == {
        "python": (True, True, "Language python is supported"),
        "go": (True, False, "Language go is supported"),
        "brainfuck": (False, False, "Language brainfuck is not supported"),
    }


def test_list_languages(spark):
    rows = ops.list_languages(CODE_LANGUAGES.to_df(spark)).collect()
    assert [r.language for r in rows] == ["cpp", "go", "javascript", "python", "typescript"]
    assert {r["count"] for r in rows} == {5}


def test_registry_tables(spark):
    rows = CODE_LANGUAGES.to_df(spark).orderBy("registry_pos").collect()
    assert [r.language for r in rows] == CODE_LANGUAGES.names()
    assert "module" in rows[0].include_types and rows[0].exclude_types is None


def test_large_tables(spark):
    many = {f".e{i}": f"l{i}" for i in range(3000)}
    df = spark.createDataFrame([("a.E2999",), ("a.none",)], "path string")
    assert [r.l for r in df.select(L.detect(F.col("path"), many).alias("l")).collect()] == ["l2999", None]
    registry = Registry(Language(f"l{i}", producer="markup") for i in range(20_000))
    asked = spark.createDataFrame([("L19999",), ("x",)], "language string")
    got = {r.language: r.registry_pos for r in ops.with_language_config(asked, registry).collect()}
    assert got == {"L19999": 19_999, "x": None}


def test_long_path(spark):
    df = spark.createDataFrame([("x" * 100_000,), ("." * 50_000 + "a" * 50_000 + ".py",)], "p string")
    assert [r.s for r in df.select(L.suffix(F.col("p")).alias("s")).collect()] == ["", ".py"]


def test_short_and_long_registries_agree(spark):
    df = spark.createDataFrame([("python",), ("GO",), ("none",), (None,)], "language string")
    long = CODE_LANGUAGES.add(*[Language(f"extra{i}") for i in range(ops.INLINE_LANGUAGES)])
    key = lambda reg: sorted(str(r) for r in ops.with_language_config(df, reg).collect())
    assert key(CODE_LANGUAGES) == key(long)
    plan = ops.with_language_config(df, CODE_LANGUAGES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "from_json" not in plan
