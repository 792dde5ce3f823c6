"""Corpora derived from the given tables, for operators that need source code,
outlines, raw bytes, requests or paths."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeframe.functions.languages import url_path
from treeframe.registry import CODE_LANGUAGES, MARKUP, Language, Registry
from treeframe.sources.corpus import corpus_from_table, spread

PAGE_LANGUAGES = CODE_LANGUAGES.add(MARKUP)
PROSE_LANGUAGES = Registry([
    Language("en", producer="prose", include_types=("document", "line")),
    Language("fr", producer="prose", include_types=("document",)),
    Language("de"),
])
WEB_EXTENSIONS = {".html": "html", ".htm": "html"}

# Written language of a document to the code language made from it.
CODE_OF = {"en": "python", "fr": "javascript", "de": "go", "es": "cpp"}
PATH_EXTENSIONS = (".py", ".pyw", ".mjs", ".h", ".c", ".JS", ".tsx", ".hxx", ".txt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A text table about to be parsed, over all cores."""
    return spread(table(spark, sf_dir, name).select(*columns))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files of a given language."""
    return corpus_from_table(
        texts(spark, sf_dir, "pages", "page_id", "html", "url"),
        "page_id", "html", F.lit("html"), url_path(F.col("url")),
    )


def found_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files whose language is left to the path."""
    return corpus_from_table(
        texts(spark, sf_dir, "pages", "page_id", "html", "url"),
        "page_id", "html", None, url_path(F.col("url")),
    )


def varied_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files; every third has its heading on the second level."""
    second = F.replace(F.replace("html", F.lit("<h1>"), F.lit("<h2>")), F.lit("</h1>"), F.lit("</h2>"))
    return corpus_from_table(
        texts(spark, sf_dir, "pages", "page_id", "html", "url"), "page_id",
        F.when(F.col("page_id") % 3 == 0, second).otherwise(F.col("html")), None,
        url_path(F.col("url")),
    )


# Put before each article: values that hold >, and elements whose text looks like markup.
LOOKS_LIKE_TAGS = (
    "<section title=\"a > b\" data-x='1>0' id=5\">here</section>"
    "<textarea rows='2>1'>one <b>two</b> <li> <!-- three --> </title></textarea>"
    "<TITLE><!four <ul></TITLE>"
)


def tagged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with :data:`LOOKS_LIKE_TAGS` before each article."""
    pages = page_files(spark, sf_dir)
    put = F.replace("content", F.lit("<article>"), F.lit(LOOKS_LIKE_TAGS + "<article>"))
    return pages.withColumn("content", put)


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("file_id"), url_path(F.col("url")).alias("path")
    )


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, about to be parsed."""
    return _documents(texts(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def document_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files for work that is as cheap as the scan itself."""
    return _documents(table(spark, sf_dir, "documents"))


def _documents(documents: DataFrame) -> DataFrame:
    return corpus_from_table(
        documents, "doc_id", "text", "lang",
        F.concat_ws("/", F.col("source"), F.col("doc_id").cast("string")),
    )


def _first_word(line: Column) -> Column:
    return F.concat(F.lit("f_"), F.lower(F.regexp_extract(line, "([A-Za-z]+)", 1)))


def _last_word(line: Column) -> Column:
    words = F.regexp_extract_all(line, F.lit("[A-Za-z]+"), F.lit(0))
    return F.concat(F.lit("f_"), F.lower(F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit(""))))


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source code made of documents: each line becomes a function.

    The function is named by the line's first word and calls its last one.
    """
    doc = F.col("doc_id").cast("string")
    lines = F.split("text", "\n")

    def functions(template) -> Column:
        return F.array_join(
            F.transform(lines, lambda l: template(_first_word(l), _last_word(l))), "\n"
        )

    code = (
        F.when(F.col("lang") == "en", _joined(
            "class Doc", doc, ":\n",
            functions(lambda a, b: _joined("    def ", a, "(x):\n        return ", b, "(x)"))))
        .when(F.col("lang") == "fr", _joined(
            "function doc", doc, "() {\n",
            functions(lambda a, b: _joined("  function ", a, "(x) {\n    return ", b, "(x);\n  }")),
            "\n}"))
        .when(F.col("lang") == "de", _joined(
            "package doc", doc, "\n",
            functions(lambda a, b: _joined("func ", a, "(x int) int {\n\treturn ", b, "(x)\n}"))))
        .otherwise(_joined(
            "namespace doc", doc, " {\n",
            functions(lambda a, b: _joined("int ", a, "(int x) {\n  return ", b, "(x);\n}")),
            "\n}"))
    )
    language = F.lit("cpp")
    for lang, name in CODE_OF.items():
        language = F.when(F.col("lang") == lang, F.lit(name)).otherwise(language)
    documents = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return corpus_from_table(documents, "doc_id", code, language)


# Lines put before each function: strings and comments that look like code.
LOOKS_LIKE_CODE = {
    "python": (
        "    # def hidden(x): class Ghost: {\n"
        '    """Text.\n    def ghost(x):\n        class Ghost:\n\'\'\' "# \\\\""" # "\n'
        "    text = 'def ghost(x): \\\\'  # \\\' not open\n"
    ),
    "javascript": (
        "  // function hidden() { `\n"
        "  /* function ghost() {\n  function ghost() {\n class Ghost { */\n"
        "  let a = '{', b = \"\\\\\", c = `\n  function ghost() { ${1} \\`\n class Ghost {`;\n"
    ),
    "go": (
        "// func hidden() {\n/* func ghost() {\nfunc ghost() { */\n"
        'var a, b, c = "{{", \'{\', `\nfunc ghost() {\n\\`\n'
    ),
    "cpp": (
        "// int hidden(int x) { \\\nint ghost(int x) {\n/* struct Ghost {\nint ghost(int x) { */\n"
        "char a = '{', b = '\\'', c = '\"'; int n = 1'000'000;\n"
        'auto r = R"x(\nint ghost(int x) { ")\n)x"; auto s = "{\\"{";\n'
    ),
}


def noisy_code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`code_files` with comments and strings before each function that look like code."""
    files = code_files(spark, sf_dir)
    lines = F.split("content", "\n")
    noise = F.lit("")
    for name, text in LOOKS_LIKE_CODE.items():
        noise = F.when(F.col("language") == name, F.lit(text)).otherwise(noise)
    starts = F.when(F.col("language") == "python", F.lit("    def ")).when(
        F.col("language") == "javascript", F.lit("  function ")
    ).when(F.col("language") == "go", F.lit("func ")).otherwise(F.lit("int "))
    return files.withColumn("content", F.array_join(
        F.transform(lines, lambda l: F.when(l.startswith(starts), F.concat(noise, l)).otherwise(l)), "\n"
    ))


def code_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of the same functions, as a code parser would print them."""
    quoted = lambda w: _joined("'", w, "'")
    one = lambda l: _joined(
        "  function_definition\n    identifier: ", quoted(_first_word(l)),
        "\n    block\n      call\n        identifier: ", quoted(_last_word(l)),
    )
    return texts(spark, sf_dir, "documents", "doc_id", "text").select(
        F.col("doc_id").alias("file_id"),
        _joined("module\n", F.array_join(F.transform(F.split("text", "\n"), one), "\n"))
        .alias("ast_text"),
    )


def code_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths with a mix of suffixes, one per document."""
    suffixes = F.array(*[F.lit(e) for e in PATH_EXTENSIONS])
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"),
        F.concat(
            F.col("source"), F.lit("/doc."), F.col("doc_id").cast("string"),
            F.get(suffixes, (F.col("doc_id") % len(PATH_EXTENSIONS)).cast("int")),
        ).alias("path"),
    )


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bytes: Latin-1 with CRLF line ends, UTF-8 with a mark, or plain UTF-8."""
    western = F.col("lang").isin("fr", "de") & F.col("text").rlike(r"^[\x00-\xff]*$")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"),
        F.when(western, F.encode(F.replace("text", F.lit("\n"), F.lit("\r\n")), "ISO-8859-1"))
        .when(F.col("lang") == "es", F.encode(F.concat(F.lit("﻿"), "text"), "UTF-8"))
        .otherwise(F.encode("text", "UTF-8")).alias("raw"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of every kind and fault, from documents and events."""
    docs = table(spark, sf_dir, "documents")
    whole = F.to_json(F.struct(F.col("text").alias("content"), F.col("lang").alias("language")))
    unnamed = F.to_json(F.struct(F.col("text").alias("content"), F.lit("").alias("language")))
    from_docs = docs.withColumn("w", whole).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("request_id"),
        F.when(F.col("lang") == "es", F.lit("parse-file")).otherwise(F.lit("parse")).alias("kind"),
        F.when(F.col("lang") == "fr", unnamed)
        .when(F.col("lang") == "de", F.expr("substring(w, 1, length(w) - 1)"))
        .otherwise(F.col("w")).alias("body"),
    )
    event = F.col("event_type")
    from_events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("request_id"),
        F.when(event == "click", F.lit("parse")).when(event == "signup", F.lit("parse-file"))
        .when(event == "purchase", F.lit("check-language")).otherwise(F.lit("other")).alias("kind"),
        F.when(event == "error", F.lit("")).otherwise(F.col("props")).alias("body"),
    )
    return from_docs.unionByName(from_events)


def indent_tree(content: str, language: str) -> Iterator[tuple[int, str, str | None]]:
    """Sample user parser: one node per line, nested by four-space indents."""
    yield 0, "file", None
    last = 0
    for number, line in enumerate(content.split("\n"), 1):
        if "\t" in line:
            raise ValueError(f"tab in line {number}")
        if line.strip():
            last = min((len(line) - len(line.lstrip())) // 4, last) + 1
            yield last, "line", line.strip()


# Where a document's file stands and what it is called, by its number.
FILE_NAMES = ("{}.txt", "_{}.txt", ".{}.txt", "a/b/{}.txt", ".hidden/{}.txt", "_x/__init__{}.txt", "{}.md")


def write_files(documents: DataFrame, folder: str) -> None:
    """One file per document, in tasks; every eleventh is empty."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                path = f"{base}/{FILE_NAMES[doc_id % len(FILE_NAMES)].format(doc_id)}"
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(path) as out:
                    out.write(b"" if doc_id % 11 == 0 else text.encode())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    rows = documents.select("doc_id", "text").mapInArrow(run, "n bigint")
    rows.agg(F.sum("n")).collect()
