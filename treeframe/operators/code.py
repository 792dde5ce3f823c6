"""Declarations in source lines, by rule: approximate, but for any corpus size.

Rules and braces are looked for in code alone: comments and the insides of
strings are spaces by then, on the same lines and places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeframe.functions.arrays import let, over, running
from treeframe.functions.lexer import code_only

# (language, node type, pattern with the name as group 1); the first match wins.
# Only character classes repeat: a repeated group recurses once per round in the JVM,
# and a long line of data would end the executor.
DECL_RULES: tuple[tuple[str, str, str], ...] = (
    ("python", "class_definition", r"^\s*class\s+(\w+)"),
    ("python", "function_definition", r"^\s*(?:async\s+)?def\s+(\w+)"),
    ("python", "import_from_statement", r"^\s*from\s+([\w.]+)\s+import\b"),
    ("python", "import_statement", r"^\s*import\s+([\w.]+)"),
    ("javascript", "import_statement", r"^\s*import\b.*?['\"]([^'\"]+)['\"]"),
    ("javascript", "class_declaration", r"^\s*(?:export\s+)?(?:default\s+)?class\s+(\w+)"),
    ("javascript", "function_declaration",
     r"^\s*(?:export\s+)?(?:default\s+)?(?:async\s+)?function\s*\*?\s*(\w+)"),
    ("javascript", "arrow_function",
     r"^\s*(?:export\s+)?(?:const|let|var)\s+(\w+)\s*=\s*(?:async\s*)?(?:\([^()]*\)|\w+)\s*=>"),
    ("typescript", "import_statement", r"^\s*import\b.*?['\"]([^'\"]+)['\"]"),
    ("typescript", "interface_declaration", r"^\s*(?:export\s+)?interface\s+(\w+)"),
    ("typescript", "type_alias_declaration", r"^\s*(?:export\s+)?type\s+(\w+)[^=]*="),
    ("typescript", "enum_declaration", r"^\s*(?:export\s+)?(?:const\s+)?enum\s+(\w+)"),
    ("typescript", "class_declaration",
     r"^\s*(?:export\s+)?(?:default\s+)?(?:abstract\s+)?class\s+(\w+)"),
    ("typescript", "function_declaration",
     r"^\s*(?:export\s+)?(?:default\s+)?(?:async\s+)?function\s*\*?\s*(\w+)"),
    ("go", "package_clause", r"^\s*package\s+(\w+)"),
    ("go", "import_declaration", r"^\s*import\s+(?:\w+\s+)?\"([^\"]+)\""),
    ("go", "method_declaration", r"^\s*func\s*\([^)]*\)\s*(\w+)"),
    ("go", "function_declaration", r"^\s*func\s+(\w+)"),
    ("go", "struct_type", r"^\s*type\s+(\w+)\s+struct\b"),
    ("go", "interface_type", r"^\s*type\s+(\w+)\s+interface\b"),
    ("cpp", "namespace_definition", r"^\s*namespace\s+(\w+)"),
    ("cpp", "class_specifier", r"^\s*class\s+(\w+)[^;]*$"),
    ("cpp", "struct_specifier", r"^\s*struct\s+(\w+)[^;]*$"),
    ("cpp", "function_definition",
     r"^\s*[\w:&*<>,~][\w:&*<>,~\s]*[\s*&](~?\w[\w:~]*)\s*\([^;]*$"),
)

# Words that look like a C++ function to the rule above but are statements.
CPP_STATEMENTS = ("if", "for", "while", "switch", "catch", "return", "else", "do")
BY_INDENT = ("python",)
INDENT = 4


# Rules whose name stands in a string.
QUOTED_NAMES = ("import_statement", "import_declaration")


def _decl(language: Column, line: Column, strings: Column) -> Column:
    """``struct<node_type, name>`` of the first rule that fits, else NULL.

    ``line`` has no insides of strings; ``strings`` has them.
    """
    chosen = None
    for lang, node_type, pattern in DECL_RULES:
        fits = (language == lang) & line.rlike(pattern)
        if node_type == "function_definition" and lang == "cpp":
            words = "|".join(CPP_STATEMENTS)
            fits = fits & ~line.rlike(rf"^\s*\}}?\s*(?:{words})\b")
        value = F.struct(
            F.lit(node_type).alias("node_type"),
            F.regexp_extract(strings if node_type in QUOTED_NAMES else line, pattern, 1).alias("name"),
        )
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen


def _braces(line: Column) -> Column:
    count = lambda mark: F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))
    return count("{") - count("}")


def _line_depths(language: Column, lines: Column) -> Column:
    """Level of each line: by indentation, or by the braces open before it."""
    indented = F.transform(
        lines,
        lambda l: F.floor(
            F.length(F.replace(F.regexp_extract(l, r"^([ \t]*)", 1), F.lit("\t"), F.lit(" " * INDENT)))
            / INDENT
        ).cast("int"),
    )
    after = running(
        F.transform(lines, _braces), F.lit(0), lambda level, d: F.greatest(level + d, F.lit(0))
    )
    before = F.slice(F.concat(F.array(F.lit(0)), after), F.lit(1), F.size(lines))
    return F.when(language.isin(*BY_INDENT), indented).otherwise(before)


def line_decls(files: DataFrame, content: str = "content") -> DataFrame:
    """Declarations by line: number, level, type and name.

    ``language`` selects the rules; a file in another language gives no rows.
    """
    rows = files.select("file_id", "language", F.inline_outer(over(_numbered, content, "language")))
    return (
        rows.withColumn("decl", over(_decl, "language", "line", "strings"))
        .where(F.col("decl").isNotNull())
        .select("file_id", "language", "line_no", "depth", "decl.node_type", "decl.name")
    )


def _numbered(content: Column, language: Column) -> Column:
    def lines_of(code: Column) -> Column:
        lines = F.split(code["code"], "\n")
        zipped = F.arrays_zip(
            lines.alias("line"), F.split(code["strings"], "\n").alias("strings"),
            _line_depths(language, lines).alias("depth"),
        )
        return F.transform(
            zipped,
            lambda z, i: F.struct(
                (i + 1).alias("line_no"), z["depth"].alias("depth"), z["line"].alias("line"),
                z["strings"].alias("strings"),
            ),
        )

    return let(code_only(language, content), lines_of)
