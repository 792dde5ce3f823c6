"""Structural analysis of large text and code corpora on Spark."""

from treeframe.plans.outline_udtf import register_outline_lines
from treeframe.plans.parse import parse_code, parse_corpus, parse_trees
from treeframe.plans.producers import (
    NativeProducer,
    PandasProducer,
    Producers,
    default_producers,
    pandas_producer,
    walk_nodes,
)
from treeframe.registry import CODE_LANGUAGES, EXTENSIONS, MARKUP, Language, Registry
from treeframe.sources.corpus import (
    corpus_from_table,
    decode_text,
    read_corpus,
    read_requested,
    with_read_errors,
)
from treeframe.sources.store import (
    fetch_result,
    fetch_results,
    save_results,
    with_result_id,
    write_reports,
    write_results_json,
)
from treeframe.streaming.streams import dedup_stream, stream_results

__all__ = [
    "CODE_LANGUAGES", "EXTENSIONS", "MARKUP", "Language", "NativeProducer", "PandasProducer",
    "Producers", "Registry", "corpus_from_table", "decode_text", "dedup_stream",
    "default_producers", "fetch_result", "fetch_results", "pandas_producer", "parse_code",
    "parse_corpus", "parse_trees", "read_corpus", "read_requested",
    "register_outline_lines", "save_results",
    "stream_results", "walk_nodes", "with_read_errors", "with_result_id", "write_reports",
    "write_results_json",
]
