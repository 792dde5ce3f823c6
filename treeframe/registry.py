"""Language registry and path-extension table.

Both live on the driver as plain Python values; what is long is joined instead of
being inlined into a plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Language:
    """One language: how to spot it, how to prune its trees, what parses it."""

    name: str
    extensions: tuple[str, ...] = ()
    include_types: tuple[str, ...] | None = None
    exclude_types: tuple[str, ...] | None = None
    producer: str | None = None


class Registry:
    """Ordered, immutable set of languages; names are kept in lower case."""

    def __init__(self, languages: Iterable[Language] = ()):
        self._items = {
            lang.name.lower(): replace(lang, name=lang.name.lower()) for lang in languages
        }

    def __iter__(self) -> Iterator[Language]:
        return iter(self._items.values())

    def __len__(self) -> int:
        return len(self._items)

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._items

    def get(self, name: str) -> Language | None:
        return self._items.get(name.lower())

    def names(self) -> list[str]:
        return list(self._items)

    def add(self, *languages: Language) -> Registry:
        return Registry([*self, *languages])

    def with_producer(self, producer: str | None, *names: str) -> Registry:
        """Same registry with the named languages parsed by ``producer``."""
        wanted = {n.lower() for n in names}
        return Registry(
            replace(lang, producer=producer) if lang.name in wanted else lang for lang in self
        )

    def by_extension(self) -> dict[str, str]:
        """Extension to the first language, in registry order, that lists it."""
        found: dict[str, str] = {}
        for lang in self:
            for ext in lang.extensions:
                found.setdefault(ext, lang.name)
        return found

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The registry as the ``languages`` table (a local relation)."""
        text = pa.string()
        rows = list(self)
        return spark.createDataFrame(pa.table({
            "registry_pos": pa.array(range(len(rows)), pa.int32()),
            "language": pa.array([r.name for r in rows], text),
            "extensions": pa.array([list(r.extensions) for r in rows], pa.list_(text)),
            "include_types": pa.array(
                [None if r.include_types is None else list(r.include_types) for r in rows],
                pa.list_(text)),
            "exclude_types": pa.array(
                [None if r.exclude_types is None else list(r.exclude_types) for r in rows],
                pa.list_(text)),
            "producer": pa.array([r.producer for r in rows], text),
        }))


# Extension table of the path detector.
EXTENSIONS = {
    ".py": "python",
    ".js": "javascript",
    ".jsx": "javascript",
    ".ts": "typescript",
    ".tsx": "typescript",
    ".go": "go",
    ".c": "c",
    ".cc": "cpp",
    ".cpp": "cpp",
    ".cxx": "cpp",
    ".h": "c",
    ".hpp": "cpp",
    ".hxx": "cpp",
}

# The five code languages with their extensions and the node
# types whose children an outline shows.
CODE_LANGUAGES = Registry([
    Language(
        "python",
        (".py", ".pyw"),
        (
            "module", "class_definition", "function_definition",
            "decorated_definition", "if_statement", "for_statement",
            "while_statement", "try_statement", "with_statement",
            "import_statement", "import_from_statement", "assignment",
            "call", "binary_operator", "unary_operator", "comparison_operator",
            "list", "dictionary", "tuple", "set", "list_comprehension",
            "dictionary_comprehension", "generator_expression",
        ),
    ),
    Language(
        "javascript",
        (".js", ".jsx", ".mjs"),
        (
            "program", "function_declaration", "function_expression",
            "arrow_function", "class_declaration", "method_definition",
            "if_statement", "for_statement", "while_statement",
            "do_statement", "switch_statement", "try_statement",
            "variable_declaration", "assignment_expression", "call_expression",
            "member_expression", "array", "object", "template_string",
            "import_statement", "export_statement",
        ),
    ),
    Language(
        "typescript",
        (".ts", ".tsx"),
        (
            "program", "function_declaration", "function_expression",
            "arrow_function", "class_declaration", "method_definition",
            "interface_declaration", "type_alias_declaration",
            "enum_declaration", "if_statement", "for_statement",
            "while_statement", "switch_statement", "try_statement",
            "variable_declaration", "assignment_expression", "call_expression",
            "type_annotation", "generic_type", "union_type", "intersection_type",
        ),
    ),
    Language(
        "go",
        (".go",),
        (
            "source_file", "package_clause", "import_declaration",
            "function_declaration", "method_declaration", "struct_type",
            "interface_type", "if_statement", "for_statement",
            "switch_statement", "select_statement", "go_statement",
            "defer_statement", "var_declaration", "const_declaration",
            "assignment_statement", "call_expression", "selector_expression",
            "composite_literal", "func_literal",
        ),
    ),
    Language(
        "cpp",
        (".cpp", ".cc", ".cxx", ".hpp", ".h", ".hxx"),
        (
            "translation_unit", "function_definition", "class_specifier",
            "struct_specifier", "namespace_definition", "template_declaration",
            "if_statement", "for_statement", "while_statement",
            "switch_statement", "try_statement", "declaration",
            "assignment_expression", "call_expression", "field_expression",
            "lambda_expression", "new_expression", "delete_expression",
        ),
    ),
])

# Our own additions, for corpora the native producers can read.
MARKUP = Language(
    "html",
    (".html", ".htm"),
    ("document", "html", "body", "article", "nav", "ul", "div"),
    producer="markup",
)
