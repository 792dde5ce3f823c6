"""Named queries: each operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeframe.catalog import derive as D
from treeframe.operators import calls, code, construct_index, languages, metrics, nodes, requests, results, search, versions
from treeframe.plans.outline_udtf import register_outline_lines
from treeframe.plans.parse import parse_corpus, parse_trees
from treeframe.plans.producers import default_producers, pandas_producer
from treeframe.registry import CODE_LANGUAGES
from treeframe.session import scratch_dir
from treeframe.sources import corpus, datasource, store
from treeframe.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INCLUDE = ("document", "html", "body", "article", "nav", "ul", "div")
EXCLUDE = ("head", "ul", "article")
CONTROL = ("nav", "ul", "li", "article")
LISTS = ("nav", "ul", "li")
WORD = "sentence"
VERSION = "1"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _page_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.markup_trees(D.page_files(spark, sf_dir).select("file_id", "content"))


def _page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.explode_nodes(_page_trees(spark, sf_dir))


def _flat_nodes(df: DataFrame) -> DataFrame:
    """Ancestor lists as text, so that any engine can compare them."""
    return df.select(
        "file_id", "ord", "depth", "node_type", "text", "is_leaf", "parent_ord",
        F.array_join("path_types", "/").alias("place"),
        F.array_join(F.col("path_ords").cast("array<string>"), "/").alias("place_ords"),
    )


def _page_results(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return parse_corpus(D.page_files(spark, sf_dir), D.PAGE_LANGUAGES, keep=keep)


def _prose_results(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return parse_corpus(D.document_files(spark, sf_dir), D.PROSE_LANGUAGES, keep=keep)


def _flat_results(df: DataFrame) -> DataFrame:
    return df.select(
        "file_id", "path", "language", "success", "ast_text",
        F.col("metadata.parser").alias("parser"),
        F.col("metadata.node_count").alias("node_count"),
        F.col("metadata.parser_version").alias("parser_version"),
        "error",
    )


# --- trees -----------------------------------------------------------------


@query
def markup_nodes(spark, sf_dir):
    return _flat_nodes(_page_nodes(spark, sf_dir))


@query
def text_nodes(spark, sf_dir):
    return _flat_nodes(nodes.text_nodes(D.document_files(spark, sf_dir)))


@query
def conversation_nodes(spark, sf_dir):
    turns = D.table(spark, sf_dir, "conversations")
    files = turns.select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("file_id"),
        F.col("text").alias("content"),
    )
    return _flat_nodes(nodes.text_nodes(files))


@query
def outline_nodes(spark, sf_dir):
    return _flat_nodes(nodes.outline_nodes(D.code_outlines(spark, sf_dir)))


@query
def markup_tags(spark, sf_dir):
    """Nodes of pages with > in values and with text that looks like markup."""
    trees = nodes.markup_trees(D.tagged_pages(spark, sf_dir).select("file_id", "content"))
    return metrics.construct_counts(trees)


@query
def tree_paths(spark, sf_dir):
    """Ancestors of node rows that come without them."""
    bare = nodes.explode_nodes(_page_trees(spark, sf_dir), paths=False)
    return _flat_nodes(nodes.with_tree_paths(bare))


@query
def node_counts(spark, sf_dir):
    return metrics.node_counts(_page_trees(spark, sf_dir))


@query
def construct_counts(spark, sf_dir):
    return metrics.construct_counts(_page_trees(spark, sf_dir))


@query
def corpus_constructs(spark, sf_dir):
    return metrics.corpus_constructs(_page_trees(spark, sf_dir))


@query
def pivot_constructs(spark, sf_dir):
    return metrics.pivot_constructs(_page_trees(spark, sf_dir), ("p", "li", "a", "text"))


@query
def nesting_metrics(spark, sf_dir):
    out = metrics.nesting_metrics(_page_trees(spark, sf_dir), CONTROL)
    return out.withColumn("mean_depth", F.round("mean_depth", 6))


@query
def outline_include(spark, sf_dir):
    return nodes.render_outline(nodes.prune_trees(_page_trees(spark, sf_dir), include=INCLUDE))


@query
def outline_exclude(spark, sf_dir):
    return nodes.render_outline(nodes.prune_trees(_page_trees(spark, sf_dir), exclude=EXCLUDE))


@query
def outline_full(spark, sf_dir):
    return nodes.render_outline(_page_trees(spark, sf_dir))


@query
def outline_types(spark, sf_dir):
    return nodes.render_types(_page_trees(spark, sf_dir))


@query
def prune_nodes(spark, sf_dir):
    """Pruning of node rows by the registry's lists."""
    rows = _page_nodes(spark, sf_dir).withColumn("language", F.lit("html"))
    return nodes.prune_by_language(rows, D.PAGE_LANGUAGES).select("file_id", "ord", "node_type")


@query
def prune_ratio(spark, sf_dir):
    out = metrics.prune_ratio(_page_trees(spark, sf_dir), include=INCLUDE)
    return out.withColumn("removed", F.round("removed", 6))


@query
def defects(spark, sf_dir):
    return metrics.defects(D.page_files(spark, sf_dir))


# --- whole parse -----------------------------------------------------------


@query
def parse_envelope(spark, sf_dir):
    return _flat_results(_page_results(spark, sf_dir))


@query
def parse_detected(spark, sf_dir):
    """Language by path: pages without a known suffix become error rows."""
    return _flat_results(parse_corpus(
        D.found_pages(spark, sf_dir), D.PAGE_LANGUAGES, extensions=D.WEB_EXTENSIONS
    ))


@query
def parse_documents(spark, sf_dir):
    return _flat_results(_prose_results(spark, sf_dir))


@query
def size_ratio(spark, sf_dir):
    out = results.size_ratio(_page_results(spark, sf_dir, keep=["content"]))
    return out.select("file_id", F.round("size_ratio", 6).alias("size_ratio"))


@query
def outline_stats(spark, sf_dir):
    return results.outline_stats(_page_results(spark, sf_dir)).select(
        "file_id", "n_lines", "n_top_level"
    )


@query
def text_occurrences(spark, sf_dir):
    return results.text_occurrences(_prose_results(spark, sf_dir), WORD).select(
        "file_id", "occurrences"
    )


@query
def preview(spark, sf_dir):
    return results.preview(D.document_table(spark, sf_dir), "content").select("file_id", "preview")


@query
def preview_lines(spark, sf_dir):
    return results.preview_lines(_page_results(spark, sf_dir)).select("file_id", "preview")


@query
def corpus_summary(spark, sf_dir):
    return results.corpus_summary(_prose_results(spark, sf_dir))


@query
def corpus_summary_by_language(spark, sf_dir):
    return results.corpus_summary(_prose_results(spark, sf_dir), by="language")


@query
def successes(spark, sf_dir):
    return results.successes(_prose_results(spark, sf_dir)).select(
        "file_id", "language", F.col("metadata.node_count").alias("node_count")
    )


@query
def failures(spark, sf_dir):
    return results.failures(_prose_results(spark, sf_dir)).select("file_id", "language", "error")


@query
def error_breakdown(spark, sf_dir):
    return results.error_breakdown(_prose_results(spark, sf_dir))


@query
def format_report(spark, sf_dir):
    return results.format_report(_prose_results(spark, sf_dir)).select("file_id", "report")


# --- languages -------------------------------------------------------------


@query
def detect_language(spark, sf_dir):
    paths = D.page_paths(spark, sf_dir)
    return languages.detect_language(paths, extensions=D.WEB_EXTENSIONS)


@query
def detect_code_language(spark, sf_dir):
    return languages.detect_language(D.code_paths(spark, sf_dir))


@query
def resolve_language(spark, sf_dir):
    files = D.page_paths(spark, sf_dir).withColumn(
        "language", F.when(F.col("path").startswith("https:"), F.lit("HTML")).otherwise(F.lit(""))
    )
    return languages.resolve_language(files, D.WEB_EXTENSIONS).select(
        "file_id", "language", "error"
    )


@query
def compare_detectors(spark, sf_dir):
    return languages.compare_detectors(D.code_paths(spark, sf_dir), CODE_LANGUAGES)


@query
def language_config(spark, sf_dir):
    files = D.document_table(spark, sf_dir).select("file_id", "language")
    return languages.with_language_config(files, D.PROSE_LANGUAGES).select(
        "file_id", "language", "registry_pos", "producer",
        F.array_join("include_types", ",").alias("include_types"),
    )


@query
def check_supported(spark, sf_dir):
    files = D.document_table(spark, sf_dir).select("file_id", "language")
    return languages.check_supported(files, D.PROSE_LANGUAGES).select(
        "file_id", "language", "error"
    )


@query
def check_languages(spark, sf_dir):
    asked = D.document_table(spark, sf_dir).select("language").distinct()
    return languages.check_languages(asked, D.PROSE_LANGUAGES)


@query
def list_languages(spark, sf_dir):
    return languages.supported_in(D.document_table(spark, sf_dir), D.PROSE_LANGUAGES)


# --- sources, requests, stores ---------------------------------------------


@query
def read_corpus(spark, sf_dir):
    """Documents written as files of all kinds of names, some empty, then read back."""
    folder = scratch_dir(spark, "corpus")
    D.write_files(D.table(spark, sf_dir, "documents"), folder)
    files = corpus.read_corpus(spark, folder, "*.txt")
    return files.select(
        F.regexp_extract("path", "/corpus-[^/]+/(.*)$", 1).alias("path"),
        F.sha2("content", 256).alias("content_hash"), "encoding", "read_error",
    )


@query
def corpora_union(spark, sf_dir):
    """Documents of a table by text ids, together with documents read from files."""
    folder = scratch_dir(spark, "corpus")
    documents = D.table(spark, sf_dir, "documents")
    D.write_files(documents.where("doc_id % 3 = 0"), folder)
    rest = documents.where("doc_id % 3 > 0")
    tables = [
        corpus.corpus_from_table(
            rest.where("doc_id % 3 = 1"), F.concat_ws("/", "source", F.col("doc_id").cast("string")), "text"
        ),
        corpus.corpus_from_table(rest.where("doc_id % 3 = 2"), "doc_id", "text"),
        corpus.read_corpus(spark, folder),
    ]
    files = corpus.union_corpora(*tables)
    return files.select(
        F.when(F.col("path").isNull(), F.col("file_id")).alias("file_id"),
        F.regexp_extract("path", r"([0-9]+)\.[a-z]+$", 1).alias("number"),
        F.sha2("content", 256).alias("content_hash"), "read_error",
    )


@query
def load_files(spark, sf_dir):
    """Documents written as files of all kinds of names, read by the data source."""
    folder = scratch_dir(spark, "corpus")
    D.write_files(D.table(spark, sf_dir, "documents"), folder)
    return _read_files(datasource.load_files(spark, folder, "*.txt"))


@query
def stream_files(spark, sf_dir):
    """The same files as a stream that is stopped and goes on: each comes once."""
    folder = scratch_dir(spark, "corpus")
    documents = D.table(spark, sf_dir, "documents")
    for part in (0, 1):
        D.write_files(documents.where(F.col("doc_id") % 2 == part), f"{folder}/files")
        files = datasource.stream_files(spark, f"{folder}/files", "*.txt")
        started = (
            files.writeStream.format("parquet").option("path", f"{folder}/rows")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        started.awaitTermination()
    return _read_files(spark.read.parquet(f"{folder}/rows"))


def _read_files(files: DataFrame) -> DataFrame:
    return files.select(
        F.regexp_extract("path", "/corpus-[^/]+/(?:files/)?(.*)$", 1).alias("path"),
        F.sha2("content", 256).alias("content_hash"), "encoding", "read_error",
    )


@query
def decode_text(spark, sf_dir):
    return corpus.decode_text(D.raw_documents(spark, sf_dir))


@query
def read_errors(spark, sf_dir):
    """Documents asked for by path; only the labelled ones can be read."""
    files = D.document_table(spark, sf_dir)
    labelled = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id")).distinct()
    found = files.join(labelled, "file_id", "left_semi")
    out = corpus.with_read_errors(files.select("path"), found)
    return out.select("path", "content", "language", "read_error")


@query
def validate_requests(spark, sf_dir):
    return requests.validate_requests(D.requests(spark, sf_dir)).select(
        "request_id", "kind", F.length("content").alias("content_chars"), "language", "error"
    )


@query
def results_json(spark, sf_dir):
    """Results written as JSON and read back."""
    folder = scratch_dir(spark, "json")
    store.write_results_json(_prose_results(spark, sf_dir), folder)
    return (
        spark.read.schema(
            "file string, language string, success boolean, ast string, "
            "metadata struct<parser:string,node_count:bigint,parser_version:string>, error string"
        )
        .json(folder)
        .select(
            "file", "language", "success", "ast", F.col("metadata.parser").alias("parser"),
            F.col("metadata.node_count").alias("node_count"), "error",
        )
    )


def _saved(spark, sf_dir) -> str:
    folder = scratch_dir(spark, "results")
    files = versions.with_content_hash(D.document_files(spark, sf_dir))
    parsed = parse_corpus(files, D.PROSE_LANGUAGES, keep=["content_hash"])
    store.save_results(store.with_result_id(parsed), folder)
    return folder


@query
def fetch_result(spark, sf_dir):
    """Results saved, then those of the greatest id fetched."""
    folder = _saved(spark, sf_dir)
    greatest = spark.read.parquet(folder).agg(F.max("id")).first()[0]
    return store.fetch_result(spark, folder, greatest).select(
        "id", "file_id", "language", "ast_text", "error"
    )


@query
def fetch_results(spark, sf_dir):
    """Results saved, then those of all labelled documents fetched by id."""
    folder = _saved(spark, sf_dir)
    labelled = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id")).distinct()
    ids = (
        versions.with_content_hash(D.document_table(spark, sf_dir))
        .join(labelled, "file_id", "left_semi")
        .withColumn("parser", F.when(F.col("language").isin("en", "fr"), "prose").otherwise("markup"))
        .withColumn("version", F.when(F.col("parser") == "prose", VERSION))
        .select(
            store.result_id(
                F.col("content_hash"), F.col("language"), F.col("parser"), F.col("version")
            ).alias("id")
        )
    )
    return store.fetch_results(spark, folder, ids).select("id", "file_id", "language", "success")


@query
def stored_results(spark, sf_dir):
    """A store after two commits and a compaction: the later result of an id counts."""
    folder = scratch_dir(spark, "store")
    files = versions.with_content_hash(D.document_files(spark, sf_dir))
    parsed = store.with_result_id(parse_corpus(files, D.PROSE_LANGUAGES, keep=["content_hash"]))
    store.commit_results(parsed, folder)
    labelled = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id")).distinct()
    again = parsed.join(labelled, "file_id", "left_semi").withColumn("error", F.lit("again"))
    store.commit_results(again, folder)
    store.compact_results(spark, folder)
    return store.stored_results(spark, folder).select("id", "language", "error")


@query
def store_look_up(spark, sf_dir):
    """Results of the labelled documents, looked up by id in a store of two commits."""
    folder = scratch_dir(spark, "store")
    files = versions.with_content_hash(D.document_files(spark, sf_dir))
    parsed = store.with_result_id(parse_corpus(files, D.PROSE_LANGUAGES, keep=["content_hash"]))
    for part in (0, 1):
        store.commit_results(parsed.where(F.col("file_id") % 2 == part), folder)
    labelled = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id")).distinct()
    ids = parsed.join(labelled, "file_id", "left_semi").select("id")
    return store.look_up_all(spark, folder, ids).select("id", "language", "success")


# --- versions --------------------------------------------------------------


@query
def content_hash_of(spark, sf_dir):
    return versions.with_content_hash(D.document_table(spark, sf_dir)).select(
        "file_id", "content_hash"
    )


@query
def duplicate_groups(spark, sf_dir):
    return versions.duplicate_groups(D.document_table(spark, sf_dir))


def _keyed(files: DataFrame) -> DataFrame:
    return versions.with_key(files, "prose", VERSION)


@query
def incremental(spark, sf_dir):
    """Documents still to parse when the labelled ones are done."""
    files = _keyed(D.document_table(spark, sf_dir))
    labelled = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id")).distinct()
    done = files.join(labelled, "file_id", "left_semi")
    return versions.incremental(files, done).select("file_id", "content_hash", "language")


@query
def incremental_merge(spark, sf_dir):
    """A result for every document, those of the labelled ones being there already."""
    files = _keyed(D.document_files(spark, sf_dir))
    labelled = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id")).distinct()
    done = files.join(labelled, "file_id", "left_semi")
    parse = lambda df: parse_corpus(df, D.PROSE_LANGUAGES, keep=["key"])
    merged = _flat_results(
        versions.merge_results(files, parse(done), parse(versions.incremental(files, done)))
    )
    return merged.select("file_id", "language", "node_count", "error")


@query
def outline_diff(spark, sf_dir):
    """Pages against the same pages without list items and with an extra heading."""
    files = D.page_files(spark, sf_dir).select("file_id", "content")
    edited = files.withColumn(
        "content",
        F.regexp_replace(F.regexp_replace("content", "(?s)<li>.*?</li>", ""), "<h1>", "<h2></h2><h1>"),
    )
    return versions.outline_diff(nodes.markup_nodes(files), nodes.markup_nodes(edited))


@query
def subtree_diff(spark, sf_dir):
    """Pages against the same pages with the navigation at the end and another heading."""
    files = D.page_files(spark, sf_dir).select("file_id", "content")
    moved = F.regexp_replace("content", "(?s)^(.*?)(<nav>.*?</nav>)(.*)$", "$1$3$2")
    edited = files.withColumn("content", F.regexp_replace(moved, "<h1>", "<h1>New: "))
    return versions.subtree_diff(nodes.markup_trees(files), nodes.markup_trees(edited))


# --- search ----------------------------------------------------------------


@query
def extract_names(spark, sf_dir):
    return search.extract_names(_page_trees(spark, sf_dir), "h1", "text")


@query
def extract_names_pruned(spark, sf_dir):
    pruned = nodes.outline_trees(
        nodes.render_outline(nodes.prune_trees(_page_trees(spark, sf_dir), include=INCLUDE))
    )
    return search.extract_names(pruned, "div", "text")


@query
def names_after_prune(spark, sf_dir):
    """Names found in trees that were pruned but not printed."""
    pruned = nodes.prune_trees(_page_trees(spark, sf_dir), include=INCLUDE)
    return search.extract_names(pruned, "h1", "text")


@query
def paths_after_prune(spark, sf_dir):
    """Parents and ancestors of the nodes that pruning leaves."""
    pruned = nodes.prune_trees(_page_trees(spark, sf_dir), exclude=EXCLUDE)
    return _flat_nodes(nodes.explode_nodes(pruned))


@query
def extract_functions(spark, sf_dir):
    trees = nodes.outline_trees(D.code_outlines(spark, sf_dir))
    return search.extract_names(trees, "function_definition", "identifier")


def _found_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of the pages whose language the path tells; none for the others."""
    return parse_trees(
        D.varied_pages(spark, sf_dir), D.PAGE_LANGUAGES, extensions=D.WEB_EXTENSIONS
    ).select("file_id", "path", "tree")


@query
def files_with(spark, sf_dir):
    return search.where_contains(_found_trees(spark, sf_dir), "h2")


@query
def files_without(spark, sf_dir):
    return search.where_contains(_found_trees(spark, sf_dir), "h2", present=False)


@query
def files_with_join(spark, sf_dir):
    files = D.code_files(spark, sf_dir).select("file_id", "language")
    return search.files_with(files, code.line_decls(D.code_files(spark, sf_dir)), "class_definition")


@query
def files_without_join(spark, sf_dir):
    files = D.code_files(spark, sf_dir).select("file_id", "language")
    decls = code.line_decls(D.code_files(spark, sf_dir))
    return search.files_without(files, decls, "class_definition")


@query
def files_where(spark, sf_dir):
    """Files by the types they hold and lack, from a saved index that was written in two parts."""
    folder = scratch_dir(spark, "index")
    trees = nodes.markup_trees(D.varied_pages(spark, sf_dir).select("file_id", "content"))
    for part in (0, 1):
        construct_index.save_construct_index(trees.where(F.col("file_id") % 2 == part), folder)
    asked = {
        "both": {"all": ("h2", "footer")}, "neither": {"none": ("h2", "footer")},
        "mixed": {"all": ("nav",), "any": ("h1", "footer"), "none": ("h2", "unknown")},
    }
    found = [
        construct_index.files_where(spark, folder, **how).withColumn("asked", F.lit(name))
        for name, how in asked.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def files_mentioning(spark, sf_dir):
    pages = D.varied_pages(spark, sf_dir).withColumn("language", F.lit("html"))
    # A line of its own that ends with the type: a leaf's line ends with a quote.
    return search.files_mentioning(parse_corpus(pages, D.PAGE_LANGUAGES), " h2\n").select("file_id")


@query
def match_nodes(spark, sf_dir):
    found = search.match_nodes(_page_nodes(spark, sf_dir), "a", "li", "nav")
    return found.select("file_id", "ord", "parent_ord", "depth")


@query
def match_paths(spark, sf_dir):
    """Links that are children of list items somewhere in a navigation."""
    return search.match_paths(_page_trees(spark, sf_dir), "nav//li/a")


@query
def match_paths_counts(spark, sf_dir):
    """Nodes two levels below the root, and texts below an article's children, per file."""
    trees = _page_trees(spark, sf_dir)
    top = search.count_paths(trees, "/document/*/*").withColumnRenamed("matches", "top")
    deep = search.count_paths(trees, "body//article/*//text").withColumnRenamed("matches", "deep")
    return top.join(deep, "file_id")


@query
def skeleton(spark, sf_dir):
    found = search.skeleton(_page_nodes(spark, sf_dir), ("body", "nav", "article", "h1", "footer"), 4)
    return found.select("file_id", "ord", "depth", "node_type")


@query
def nested_in_same(spark, sf_dir):
    found = search.nested_in_same(_page_nodes(spark, sf_dir), LISTS)
    return found.select("file_id", "ord", "node_type")


@query
def recursive_decls(spark, sf_dir):
    trees = nodes.outline_trees(D.code_outlines(spark, sf_dir))
    return search.recursive_decls(trees, "function_definition", "call", "identifier")


@query
def recursion_after_prune(spark, sf_dir):
    """Recursion in pruned trees: a call has lost its name, and takes the next one in reach."""
    trees = nodes.outline_trees(D.code_outlines(spark, sf_dir))
    pruned = nodes.prune_trees(trees, include=("module", "function_definition", "block"))
    return search.recursive_decls(pruned, "function_definition", "call", "identifier")


@query
def call_edges(spark, sf_dir):
    trees = nodes.outline_trees(D.code_outlines(spark, sf_dir))
    return calls.call_edges(trees, "function_definition", "call", "identifier")


@query
def recursive_groups(spark, sf_dir):
    """Functions that call each other in a circle, or themselves."""
    trees = nodes.outline_trees(D.code_outlines(spark, sf_dir))
    return calls.recursive_groups(
        calls.call_edges(trees, "function_definition", "call", "identifier")
    )


@query
def line_decls(spark, sf_dir):
    return code.line_decls(D.code_files(spark, sf_dir))


@query
def line_decls_in_code(spark, sf_dir):
    """Declarations of files with comments and strings that look like declarations."""
    return code.line_decls(D.noisy_code_files(spark, sf_dir))


@query
def outline_roundtrip(spark, sf_dir):
    """Outlines read back into trees and printed by type."""
    outlines = nodes.render_outline(_page_trees(spark, sf_dir))
    return nodes.render_types(nodes.outline_trees(outlines))


@query
def outline_lines_udtf(spark, sf_dir):
    register_outline_lines(spark)
    nodes.render_outline(_page_trees(spark, sf_dir)).createOrReplaceTempView("page_outlines")
    return spark.sql(
        "SELECT p.file_id, o.ord, o.depth, o.node_type, o.literal "
        "FROM page_outlines p, LATERAL outline_lines(p.ast_text) o"
    )


# --- Python producers and streams ------------------------------------------


@query
def pandas_producer_results(spark, sf_dir):
    producers = default_producers().with_producer(pandas_producer("indent", D.indent_tree))
    parsed = parse_corpus(
        D.code_files(spark, sf_dir), CODE_LANGUAGES, producers, parser="indent", pruned=False
    )
    return _flat_results(parsed).select(
        "file_id", "language", "success", "node_count", "parser", "error",
        F.sha2("ast_text", 256).alias("outline_hash"),
    )


@query
def stream_results(spark, sf_dir):
    """Pages parsed as a stream; the same rows as the batch query."""
    pages = D.table(spark, sf_dir, "pages")
    stream = spark.readStream.schema(pages.schema).parquet(f"{sf_dir}/pages*.parquet")
    files = corpus.corpus_from_table(
        stream, "page_id", "html", F.lit("html"), D.url_path(F.col("url"))
    )
    out = scratch_dir(spark, "stream")
    started = streams.stream_results(
        files, f"{out}/rows", f"{out}/checkpoint", D.PAGE_LANGUAGES
    )
    started.awaitTermination()
    return _flat_results(spark.read.parquet(f"{out}/rows"))


@query
def dedup_stream(spark, sf_dir):
    """Event payloads as arriving content; each content comes through."""
    events = D.table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events*.parquet")
    deduped = streams.dedup_stream(stream.select("ts", F.col("props").alias("content")))
    out = scratch_dir(spark, "dedup")
    started = (
        deduped.select("ts", "content_hash").writeStream.format("parquet")
        .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("content_hash").distinct()
