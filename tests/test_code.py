"""Comments and strings are not code, in any of the languages."""

import time

import pytest
from pyspark.sql import functions as F

from treeframe.functions.lexer import TOKENS, code_only
from treeframe.operators import code

# Texts in pieces: code as it is, comments after #, strings after $.
CASES = {
    "python": [
        ["a = ", '$"x # y"', " ", "# z"],
        ["a = ", "$'it\\'s'", " + ", '$"#"'],
        ['$"""one\n# two "" \\"""\nthree"""', " + 1"],
        ["it", "$'s", "\nb = 1 ", "# c"],
        ["$\'\'\'open\ndef f():"],
        ["x = ", "$''"],
    ],
    "javascript": [
        ["a ", "#/* { \n } */", " b ", "#// {"],
        ["$`a ${'}'}\n{`", " + ", '$"{\\"{"', " + ", "$'{'"],
        ["a / b / c"],
        ["#/* open {\n{"],
    ],
    "go": [["r := ", "$'{'", "; s := ", "$`\\`", "; ", "#// }"]],
    "cpp": [
        ["int n = 1'000'000; f(", "$'{'", ");"],
        ["R", '$"x({ )" )x"', " + ", '$"}"'],
        ["#// a \\\n{", "\n}"],
        ["PAIR(a) FOR(b)"],
    ],
    "typescript": [["let a: string = ", "$'{'", " ", "#// b"]],
    "brainfuck": [["'#' // {"]],
}


def masked(piece, language):
    if piece.startswith("$"):
        text = piece[1:]
        last = text[-1] if text[-1] in "\"'`" else "\n" if text[-1] == "\n" else " "
        return text[0] + "".join(c if c == "\n" else " " for c in text[1:-1]) + last
    if piece.startswith("#"):
        text = piece if language == "python" else piece[1:]
        return "".join(c if c == "\n" else " " for c in text)
    return piece


def plain(piece, language):
    return piece if piece.startswith("#") and language == "python" else piece.lstrip("$#")


@pytest.mark.parametrize("language", sorted(CASES))
def test_masks(spark, language):
    texts = ["".join(plain(p, language) for p in pieces) for pieces in CASES[language]]
    df = spark.createDataFrame(
        [(i, language, t) for i, t in enumerate(texts)], "i int, language string, content string"
    )
    got = df.select("i", code_only(F.col("language"), F.col("content"))["code"].alias("code"))
    for r in got.collect():
        want = "".join(masked(p, language) for p in CASES[language][r.i])
        # The mark of a raw string is part of it, so its first quote is a space too.
        assert r.code == want.replace('R"', "R ") and len(r.code) == len(texts[r.i])


def test_levels_and_names(spark):
    go = 'package p\nfunc a() {\n\ts := "{{" // {{\n\tr := \'}\'\n}\nfunc b() int { return 1 }\nimport "fmt" // "no"\n'
    cpp = "namespace n {\n/* class Ghost\n{ */\nint f(int x)\n{ return 1'000; }\n}\nstruct S\n{\n};\n"
    js = "import a from './m' // 'x'\n/* import 'y' */\nfunction f() { return `function g() {` }\nclass C { }\n"
    df = spark.createDataFrame(
        [(1, "go", go), (2, "cpp", cpp), (3, "javascript", js), (4, "none", go)],
        "file_id bigint, language string, content string",
    )
    got = {tuple(r)[0:1] + tuple(r)[2:] for r in code.line_decls(df).collect()}
    assert got == {
        (1, 1, 0, "package_clause", "p"), (1, 2, 0, "function_declaration", "a"),
        (1, 6, 0, "function_declaration", "b"), (1, 7, 0, "import_declaration", "fmt"),
        (2, 1, 0, "namespace_definition", "n"), (2, 4, 1, "function_definition", "f"),
        (2, 7, 0, "struct_specifier", "S"),
        (3, 1, 0, "import_statement", "./m"), (3, 3, 0, "function_declaration", "f"),
        (3, 4, 0, "class_declaration", "C"),
    }


def test_null_and_empty(spark):
    df = spark.createDataFrame(
        [(1, "go", None), (2, "python", ""), (3, None, "def f():")],
        "file_id bigint, language string, content string",
    )
    assert code.line_decls(df).count() == 0


@pytest.mark.parametrize("language", sorted(TOKENS))
def test_long_lines_take_linear_time(spark, language):
    """Megabytes of quotes, openings and escapes on one line: no stack, no growth."""
    def took(n):
        texts = [mark * n for mark in ('"', "'", "\\", "/", "/*", "`", "#", "R\"(", '"""', "a", "'a", '\\"')]
        df = spark.createDataFrame(
            [(i, language, "{" + t) for i, t in enumerate(texts)], "file_id bigint, language string, content string"
        ).coalesce(1)
        began = time.perf_counter()
        lengths = df.select(
            F.length(code_only(F.col("language"), F.col("content"))["code"]).alias("n"), F.length("content").alias("m")
        ).collect()
        assert all(r.n == r.m for r in lengths)
        return time.perf_counter() - began

    took(1000)
    assert took(200_000) < 10 * took(50_000) + 2
