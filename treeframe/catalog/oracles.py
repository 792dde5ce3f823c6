"""Plain SQL for the named queries, written independently of the Spark plans:
windows and joins over rows instead of array columns."""

from __future__ import annotations

LEVELS = 12  # deeper than any tree of the test tables
INCLUDE = "['document','html','body','article','nav','ul','div']"
EXCLUDE = "['head','ul','article']"
FLAT = ("'area','b','base','br','col','embed','hr','img','input','link',"
        "'meta','p','source','track','wbr'")
# Written for these checks: raw elements by name in one group, open ends as text ends.
RAW_END = r"</(?:script|style)\s*>"
TOKEN = (
    r"(?is)<!--(?:.*?-->|.*$)"
    r"|<(?:script|style)\b[^<>]*>(?:.*?" + RAW_END + r"|.*$)"
    r"|</?[a-z][^<>]*>|<[!?][a-z][^<>]*>"
    r"|<[^<]*|[^<]+"
)
PAGES = "SELECT page_id AS file_id, html AS content FROM pages"
URL = r"regexp_replace(url, '[?#].*$', '')"
SUFFIX = r"(?:^|/)[.]*[^/.][^/]*([.][^./]+)/*$"


def tokens(prefix: str, source: str) -> str:
    """CTEs ``{prefix}tok``: tokens with tag, direction and weight."""
    return f"""
{prefix}src AS ({source}),
{prefix}raw AS (
  SELECT file_id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos
  FROM (SELECT file_id, regexp_extract_all(content, '{TOKEN}') AS t FROM {prefix}src)),
{prefix}tag AS (
  SELECT file_id, pos, tok,
    CASE WHEN starts_with(tok, '<')
      THEN lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) ELSE '' END AS tag
  FROM {prefix}raw
  WHERE NOT starts_with(tok, '<!--')
    AND regexp_matches(tok, '[^ \\t\\r\\n\\f]')),
{prefix}tok AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY pos) AS i, tag <> '' AND starts_with(tok, '</') AS closing,
    CASE WHEN tag = '' OR tag IN ({FLAT}) THEN 0
      WHEN starts_with(tok, '</') THEN -1
      WHEN ends_with(tok, '/>') THEN 0
      WHEN tag IN ('script', 'style') THEN 0
      ELSE 1 END AS w
  FROM {prefix}tag)"""


def numbered(prefix: str, entries: str) -> str:
    """CTEs from ``entries`` (file_id, pos, depth, node_type, text) to ``{prefix}nodes``."""
    ords = ", ".join(
        f"max(CASE WHEN depth = {k} THEN ord END) OVER w AS a{k}, "
        f"last_value(CASE WHEN depth = {k} THEN node_type END IGNORE NULLS) OVER w AS t{k}"
        for k in range(LEVELS)
    )
    list_ords = ", ".join(f"a{k}" for k in range(LEVELS))
    list_types = ", ".join(f"t{k}" for k in range(LEVELS))
    return f"""
{prefix}ent AS ({entries}),
{prefix}num AS (
  SELECT file_id, CAST(row_number() OVER w - 1 AS INTEGER) AS ord,
    CAST(depth AS INTEGER) AS depth, node_type,
    coalesce(lead(depth) OVER w, -1) <= depth AS is_leaf, text
  FROM {prefix}ent WINDOW w AS (PARTITION BY file_id ORDER BY pos)),
{prefix}anc AS (
  SELECT file_id, ord, depth, node_type, is_leaf,
    CASE WHEN is_leaf THEN text END AS text, {ords}
  FROM {prefix}num WINDOW w AS (PARTITION BY file_id ORDER BY ord)),
{prefix}nodes AS (
  SELECT file_id, ord, depth, node_type, text, is_leaf,
    ([{list_ords}])[1:depth] AS path_ords, ([{list_types}])[1:depth] AS path_types
  FROM {prefix}anc)"""


FAR = 1_000_000
# What an opening tag closes, and what keeps it from that.
ENDS = {
    "['li']": ("['li']", "['ul', 'ol', 'menu']"), "['dt', 'dd']": ("['dt', 'dd']", "['dl']"),
    "['td', 'th']": ("['td', 'th']", "['tr', 'table']"),
    "['tr']": ("['tr']", "['table', 'thead', 'tbody', 'tfoot']"),
    "['thead', 'tbody', 'tfoot']": ("['thead', 'tbody', 'tfoot']", "['table']"),
    "['option']": ("['option']", "['select', 'optgroup', 'datalist']"),
}


def nearest(names: str) -> str:
    """How far from the end of the list of open elements the nearest of these is."""
    return (f"coalesce(list_min(list_filter(list_transform({names}, lambda n: "
            f"coalesce(list_position(list_reverse(stack), n), 0)), lambda p: p > 0)), {FAR})")


def walked(prefix: str, source: str) -> str:
    """CTE ``{prefix}walk``: the open elements after each token, token by token."""
    implied = " ".join(
        f"WHEN list_contains({tags}, tag) AND {nearest(ends)} < {nearest(unless)} "
        f"THEN stack[1:len(stack) - {nearest(ends)}]"
        for tags, (ends, unless) in ENDS.items()
    )
    return f"""{tokens(prefix, source)},
{prefix}walk AS (
  SELECT file_id, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS stack FROM {prefix}src
  UNION ALL
  SELECT t.file_id, t.i, CASE WHEN w = 0 THEN stack
    WHEN closing AND {nearest('[tag]')} < {FAR} THEN stack[1:len(stack) - {nearest('[tag]')}]
    WHEN closing THEN stack
    ELSE list_append(CASE {implied} ELSE stack END, tag) END
  FROM {prefix}walk s JOIN {prefix}tok t ON t.file_id = s.file_id AND t.i = s.i + 1)"""


def markup(prefix: str = "", source: str = PAGES) -> str:
    return f"""{walked(prefix, source)},
{prefix}lev AS (
  SELECT t.*, len(stack) AS level FROM {prefix}tok t JOIN {prefix}walk USING (file_id, i)),{numbered(prefix, f'''
  SELECT file_id, pos, level + CASE WHEN w = 1 THEN 0 ELSE 1 END AS depth,
    CASE WHEN starts_with(tok, '<!') THEN 'declaration'
      WHEN tag = '' THEN 'text' ELSE tag END AS node_type, tok AS text
  FROM {prefix}lev WHERE NOT closing
  UNION ALL SELECT file_id, 0, 0, 'document', '' FROM {prefix}src''')}"""


def subtrees(prefix: str) -> str:
    """CTE ``{prefix}whole``: each node's place and the text of all that is in it."""
    return f"""
{prefix}end AS (
  SELECT n.file_id, n.ord, n.depth, n.node_type, array_to_string(n.path_types, '/') AS place,
    coalesce(min(x.ord), 1000000) AS stop
  FROM {prefix}nodes n LEFT JOIN {prefix}nodes x
    ON x.file_id = n.file_id AND x.ord > n.ord AND x.depth <= n.depth GROUP BY ALL),
{prefix}whole AS (
  SELECT n.file_id, n.place, n.node_type, string_agg((x.depth - n.depth) || ':' || x.node_type || ':' ||
    coalesce(x.text, ''), chr(1) ORDER BY x.ord) AS whole
  FROM {prefix}end n JOIN {prefix}nodes x ON x.file_id = n.file_id AND x.ord >= n.ord AND x.ord < n.stop
  GROUP BY n.file_id, n.ord, n.place, n.node_type)"""


def prose(source: str) -> str:
    return f"""
src AS ({source}),
lin AS (
  SELECT file_id, unnest(l) AS line, generate_subscripts(l, 1) AS n
  FROM (SELECT file_id, string_split(content, chr(10)) AS l FROM src)),
sen AS (
  SELECT file_id, n, trim(unnest(s), ' ') AS sentence, generate_subscripts(s, 1) AS m
  FROM (SELECT file_id, n, regexp_extract_all(line, '[^.!?]+[.!?]*|[.!?]+') AS s FROM lin)),
{numbered('', '''
  SELECT file_id, [0, 0] AS pos, 0 AS depth, 'document' AS node_type, '' AS text FROM src
  UNION ALL SELECT file_id, [n, 0], 1, 'line', line FROM lin
  UNION ALL SELECT file_id, [n, m], 2, 'sentence', sentence FROM sen WHERE sentence <> \'\'''')}"""


DOCS = "SELECT doc_id AS file_id, text AS content FROM documents"
FLAT_NODES = """
SELECT file_id, ord, depth, node_type, text, is_leaf,
  path_ords[depth] AS parent_ord, array_to_string(path_types, '/') AS place,
  array_to_string(path_ords, '/') AS place_ords FROM nodes"""


def shortened(text: str) -> str:
    escaped = f"replace({text}, chr(10), '\\n')"
    return (f"CASE WHEN length({escaped}) > 50 THEN substr({escaped}, 1, 47) || '...' "
            f"ELSE {escaped} END")


def quoted(text: str) -> str:
    """Outline literal of a leaf text (no text of the tables holds other controls)."""
    short = shortened(text)
    body = (f"replace(replace(replace({short}, '\\', '\\\\'), chr(9), '\\t'), chr(13), '\\r')")
    return (f"CASE WHEN contains({short}, chr(39)) AND NOT contains({short}, '\"') "
            f"THEN '\"' || {body} || '\"' "
            f"ELSE chr(39) || replace({body}, chr(39), '\\' || chr(39)) || chr(39) END")


def outlines(nodes: str = "nodes", where: str = "true") -> str:
    return f"""
SELECT file_id, string_agg(repeat('  ', depth) || node_type ||
  CASE WHEN is_leaf THEN ': ' || {quoted('text')} ELSE '' END, chr(10) ORDER BY ord) AS ast_text,
  count(*) AS shown
FROM {nodes} WHERE {where} GROUP BY file_id"""


INCLUDED = f"len(list_filter(path_types, lambda x: NOT list_contains({INCLUDE}, x))) = 0"
NOT_EXCLUDED = f"len(list_filter(path_types, lambda x: list_contains({EXCLUDE}, x))) = 0"

# Page results: every page has a language and parses.
PAGE_RESULTS = f"""{markup()},
page_outlines AS ({outlines(where=INCLUDED)}),
page_counts AS (SELECT file_id, count(*) AS node_count FROM nodes GROUP BY file_id),
results AS (
  SELECT p.page_id AS file_id, {URL} AS path, 'html' AS language, true AS success,
    ast_text, 'markup' AS parser, node_count, '1' AS parser_version,
    CAST(NULL AS VARCHAR) AS error
  FROM pages p JOIN page_outlines o ON o.file_id = p.page_id
  JOIN page_counts c ON c.file_id = p.page_id)"""

# Document results: English shows lines, French only the root's children,
# German has no producer, Spanish is not in the registry.
PROSE_SHOWN = ("lang_of.lang = 'en' AND depth <= 2 OR lang_of.lang = 'fr' AND depth <= 1")
PROSE_RESULTS = f"""{prose(DOCS)},
shown AS (
  SELECT n.*, lang FROM nodes n JOIN documents d ON d.doc_id = n.file_id
  WHERE lang = 'en' OR lang = 'fr' AND depth <= 1),
doc_outlines AS ({outlines('shown')}),
doc_counts AS (SELECT file_id, count(*) AS node_count FROM nodes GROUP BY file_id),
results AS (
  SELECT doc_id AS file_id, source || '/' || doc_id AS path, lang AS language,
    lang IN ('en', 'fr') AS success,
    CASE WHEN lang IN ('en', 'fr') THEN ast_text ELSE '' END AS ast_text,
    CASE WHEN lang IN ('en', 'fr') THEN 'prose' ELSE 'markup' END AS parser,
    CASE WHEN lang IN ('en', 'fr') THEN node_count END AS node_count,
    CASE WHEN lang IN ('en', 'fr') THEN '1' END AS parser_version,
    CASE WHEN lang = 'de' THEN 'No producer available for language: de'
      WHEN lang = 'es' THEN 'Language es not supported' END AS error
  FROM documents d JOIN doc_counts c ON c.file_id = d.doc_id
  LEFT JOIN doc_outlines o ON o.file_id = d.doc_id)"""
RESULT_COLUMNS = ("file_id, path, language, success, ast_text, parser, node_count, "
                  "parser_version, error")

# Lines of documents with the function names made of them.
WORD_LINES = """
lin AS (
  SELECT doc_id, lang, unnest(l) AS line, generate_subscripts(l, 1) AS n
  FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS l FROM documents)),
words AS (
  SELECT doc_id, lang, n,
    'f_' || lower(regexp_extract(line, '([A-Za-z]+)', 1)) AS a,
    'f_' || lower(regexp_extract(line, '([A-Za-z]+)[^A-Za-z]*$', 1)) AS b
  FROM lin)"""
CODE_LANGUAGE = ("CASE lang WHEN 'en' THEN 'python' WHEN 'fr' THEN 'javascript' "
                 "WHEN 'de' THEN 'go' ELSE 'cpp' END")
CODE_PATHS = """
paths AS (
  SELECT doc_id AS file_id, source || '/doc.' || doc_id ||
    (['.py','.pyw','.mjs','.h','.c','.JS','.tsx','.hxx','.txt'])[doc_id % 9 + 1] AS path
  FROM documents)"""
LABELLED = "(SELECT doc_id FROM labels)"
HASH = "sha256(text)"


def result_ids() -> str:
    return (f"SELECT doc_id, lang, sha256({HASH} || '|' || lang || '|' || "
            "CASE WHEN lang IN ('en', 'fr') THEN 'prose|1' ELSE 'markup' END) AS id FROM documents")


def page_query(select: str) -> str:
    return f"WITH RECURSIVE {markup()} {select}"


READ_FILES = """SELECT CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN '_' WHEN 2 THEN '.'
    WHEN 3 THEN 'a/b/' WHEN 4 THEN '.hidden/' ELSE '_x/__init__' END || doc_id || '.txt' AS path,
  sha256(CASE WHEN doc_id % 11 = 0 THEN '' ELSE text END) AS content_hash, 'utf-8' AS encoding,
  CAST(NULL AS VARCHAR) AS read_error FROM documents WHERE doc_id % 7 < 6"""

ORACLES: dict[str, str] = {
    # trees
    "markup_nodes": page_query(FLAT_NODES),
    "tree_paths": page_query(FLAT_NODES),
    "text_nodes": f"WITH {prose(DOCS)} {FLAT_NODES}",
    "conversation_nodes": "WITH " + prose(
        "SELECT conv_id || '/' || turn AS file_id, text AS content FROM conversations"
    ) + FLAT_NODES,
    "outline_nodes": f"""WITH {WORD_LINES},{numbered('', '''
  SELECT doc_id AS file_id, [0, 0] AS pos, 0 AS depth, 'module' AS node_type, NULL AS text
    FROM documents
  UNION ALL SELECT doc_id, [n, 1], 1, 'function_definition', NULL FROM words
  UNION ALL SELECT doc_id, [n, 2], 2, 'identifier', a FROM words
  UNION ALL SELECT doc_id, [n, 3], 2, 'block', NULL FROM words
  UNION ALL SELECT doc_id, [n, 4], 3, 'call', NULL FROM words
  UNION ALL SELECT doc_id, [n, 5], 4, 'identifier', b FROM words''')} {FLAT_NODES}""",
    "node_counts": page_query(
        "SELECT file_id, count(*) AS node_count FROM nodes GROUP BY file_id"),
    "construct_counts": page_query(
        "SELECT file_id, node_type, count(*) AS nodes FROM nodes GROUP BY ALL"),
    # What is put in, added to the nodes of the pages as they are.
    "markup_tags": page_query("""
, put AS (
  SELECT page_id AS file_id, (length(html) - length(replace(html, '<article>', ''))) // 9 AS n FROM pages),
more AS (
  SELECT node_type, k FROM (VALUES ('section', 1), ('textarea', 1), ('title', 1), ('text', 3)) AS t(node_type, k))
SELECT file_id, node_type, CAST(sum(nodes) AS BIGINT) AS nodes FROM (
  SELECT file_id, node_type, count(*) AS nodes FROM nodes GROUP BY ALL
  UNION ALL SELECT file_id, node_type, n * k FROM put, more WHERE n > 0)
GROUP BY ALL"""),
    "corpus_constructs": page_query(
        "SELECT node_type, count(*) AS nodes, count(DISTINCT file_id) AS files "
        "FROM nodes GROUP BY node_type"),
    "pivot_constructs": page_query(
        "SELECT file_id, " + ", ".join(
            f"count(*) FILTER (node_type = '{t}') AS {t}" for t in ("p", "li", "a", "text"))
        + " FROM nodes GROUP BY file_id"),
    "nesting_metrics": page_query(
        "SELECT file_id, max(depth) AS max_depth, round(avg(depth), 6) AS mean_depth, "
        "CAST(max(len(list_filter(path_types, lambda x: "
        "list_contains(['nav','ul','li','article'], x)))) AS INTEGER) AS max_nesting "
        "FROM nodes GROUP BY file_id"),
    "outline_include": page_query(
        f"SELECT file_id, ast_text FROM ({outlines(where=INCLUDED)})"),
    "outline_exclude": page_query(
        f"SELECT file_id, ast_text FROM ({outlines(where=NOT_EXCLUDED)})"),
    "outline_full": page_query(f"SELECT file_id, ast_text FROM ({outlines()})"),
    "outline_types": page_query(
        "SELECT file_id, string_agg(repeat('  ', depth) || node_type, chr(10) ORDER BY ord) "
        "AS ast_text FROM nodes GROUP BY file_id"),
    "outline_roundtrip": page_query(
        "SELECT file_id, string_agg(repeat('  ', depth) || node_type, chr(10) ORDER BY ord) "
        "AS ast_text FROM nodes GROUP BY file_id"),
    "prune_nodes": page_query(f"SELECT file_id, ord, node_type FROM nodes WHERE {INCLUDED}"),
    "prune_ratio": page_query(
        f"SELECT file_id, count(*) AS raw_nodes, count(*) FILTER ({INCLUDED}) AS shown_nodes, "
        f"round(1 - count(*) FILTER ({INCLUDED}) / count(*), 6) AS removed "
        "FROM nodes GROUP BY file_id"),
    "defects": f"""WITH RECURSIVE {walked('', PAGES)},
size AS (
  SELECT file_id, i, len(stack) AS n,
    len(stack) - lag(len(stack)) OVER (PARTITION BY file_id ORDER BY i) AS change FROM walk),
file AS (
  SELECT file_id, count(*) FILTER (w = -1 AND change = 0) AS unmatched_closes,
    CAST(max_by(n, i) AS BIGINT) AS left_open
  FROM size LEFT JOIN tok USING (file_id, i) GROUP BY file_id),
tags AS (
  SELECT file_id, tag AS node_type, count(*) FILTER (w = 1) AS opened,
    count(*) FILTER (w = -1) AS closed FROM tok WHERE w <> 0 GROUP BY ALL)
SELECT file_id, node_type, opened, closed, unmatched_closes, left_open
FROM tags JOIN file USING (file_id) WHERE opened <> closed""",
    # whole parse
    "parse_envelope": f"WITH RECURSIVE {PAGE_RESULTS} SELECT {RESULT_COLUMNS} FROM results",
    "stream_results": f"WITH RECURSIVE {PAGE_RESULTS} SELECT {RESULT_COLUMNS} FROM results",
    "parse_detected": f"""WITH RECURSIVE {PAGE_RESULTS},
det AS (
  SELECT *, lower(regexp_extract(path, '{SUFFIX}', 1)) IN ('.html', '.htm') AS ok FROM results)
SELECT file_id, path, CASE WHEN ok THEN language ELSE 'unknown' END AS language, ok AS success,
  CASE WHEN ok THEN ast_text ELSE '' END AS ast_text, parser,
  CASE WHEN ok THEN node_count END AS node_count,
  CASE WHEN ok THEN parser_version END AS parser_version,
  CASE WHEN NOT ok THEN 'Could not detect language from file extension' END AS error
FROM det""",
    "parse_documents": f"WITH {PROSE_RESULTS} SELECT {RESULT_COLUMNS} FROM results",
    "size_ratio": f"""WITH RECURSIVE {PAGE_RESULTS}
SELECT file_id, round(length(ast_text) / length(html), 6) AS size_ratio
FROM results JOIN pages ON page_id = file_id""",
    "outline_stats": f"""WITH RECURSIVE {PAGE_RESULTS}
SELECT file_id, CAST(len(string_split(ast_text, chr(10))) AS BIGINT) AS n_lines,
  CAST(len(list_filter(string_split(ast_text, chr(10)), lambda x: NOT starts_with(x, ' ')))
    AS BIGINT) AS n_top_level FROM results""",
    "text_occurrences": f"""WITH {PROSE_RESULTS}
SELECT file_id, CAST((length(ast_text) - length(replace(ast_text, 'sentence', ''))) // 8
  AS BIGINT) AS occurrences FROM results""",
    "preview": "SELECT doc_id AS file_id, substr(text, 1, 500) AS preview FROM documents",
    "preview_lines": f"""WITH RECURSIVE {PAGE_RESULTS},
cut AS (SELECT file_id, string_split(ast_text, chr(10)) AS l FROM results)
SELECT file_id, array_to_string(l[1:20], chr(10)) ||
  CASE WHEN len(l) > 20 THEN chr(10) || '... (truncated)' ELSE '' END AS preview FROM cut""",
    "corpus_summary": f"""WITH {PROSE_RESULTS}
SELECT count(*) FILTER (success) AS successful, count(*) AS total,
  CAST(coalesce(sum(node_count), 0) AS BIGINT) AS total_nodes FROM results""",
    "corpus_summary_by_language": f"""WITH {PROSE_RESULTS}
SELECT language, count(*) FILTER (success) AS successful, count(*) AS total,
  CAST(coalesce(sum(node_count), 0) AS BIGINT) AS total_nodes
FROM results GROUP BY ROLLUP (language)""",
    "successes": f"""WITH {PROSE_RESULTS}
SELECT file_id, language, node_count FROM results WHERE error IS NULL""",
    "failures": f"""WITH {PROSE_RESULTS}
SELECT file_id, language, error FROM results WHERE error IS NOT NULL""",
    "error_breakdown": f"""WITH {PROSE_RESULTS}
SELECT language, error, count(*) AS files FROM results WHERE error IS NOT NULL GROUP BY ALL""",
    "format_report": f"""WITH {PROSE_RESULTS}
SELECT file_id, CASE WHEN success
  THEN 'Language: ' || language || chr(10) || 'File: ' || path || chr(10)
    || repeat('-', 40) || chr(10) || ast_text
  ELSE 'Error parsing file: ' || error END AS report FROM results""",
    # languages
    "detect_language": f"""SELECT page_id AS file_id, {URL} AS path,
  CASE WHEN lower(regexp_extract({URL}, '{SUFFIX}', 1)) IN ('.html', '.htm') THEN 'html' END
    AS detected FROM pages""",
    "detect_code_language": f"""WITH {CODE_PATHS}
SELECT file_id, path, CASE lower(regexp_extract(path, '(\\.[^./]+)$', 1))
  WHEN '.py' THEN 'python' WHEN '.js' THEN 'javascript' WHEN '.tsx' THEN 'typescript'
  WHEN '.h' THEN 'c' WHEN '.c' THEN 'c' WHEN '.hxx' THEN 'cpp' END AS detected FROM paths""",
    "resolve_language": f"""SELECT page_id AS file_id,
  CASE WHEN starts_with(url, 'https:')
      OR lower(regexp_extract({URL}, '{SUFFIX}', 1)) IN ('.html', '.htm')
    THEN 'html' ELSE 'unknown' END AS language,
  CASE WHEN NOT (starts_with(url, 'https:')
      OR lower(regexp_extract({URL}, '{SUFFIX}', 1)) IN ('.html', '.htm'))
    THEN 'Could not detect language from file extension' END AS error FROM pages""",
    "compare_detectors": f"""WITH {CODE_PATHS},
ext AS (
  SELECT lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS ext, count(*) AS files
  FROM paths GROUP BY 1)
SELECT ext, CASE WHEN ext = '.h' THEN 'c' WHEN ext = '.c' THEN 'c' END AS by_path,
  CASE ext WHEN '.h' THEN 'cpp' WHEN '.pyw' THEN 'python' WHEN '.mjs' THEN 'javascript' END
    AS by_registry, files
FROM ext WHERE ext IN ('.h', '.c', '.pyw', '.mjs')""",
    "language_config": """SELECT doc_id AS file_id, lang AS language,
  CAST(CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 END AS INTEGER)
    AS registry_pos,
  CASE WHEN lang IN ('en', 'fr') THEN 'prose' END AS producer,
  CASE lang WHEN 'en' THEN 'document,line' WHEN 'fr' THEN 'document' END AS include_types
FROM documents""",
    "check_supported": """SELECT doc_id AS file_id, lang AS language,
  CASE WHEN lang = 'de' THEN 'No producer available for language: de'
    WHEN lang NOT IN ('en', 'fr') THEN 'Language ' || lang || ' not supported' END AS error
FROM documents""",
    "check_languages": """SELECT DISTINCT lang AS language, lang IN ('en', 'fr', 'de') AS supported,
  lang IN ('en', 'fr') AS grammar_available, 'Language ' || lang ||
    CASE WHEN lang IN ('en', 'fr', 'de') THEN ' is supported' ELSE ' is not supported' END
    AS message FROM documents""",
    "list_languages": """SELECT DISTINCT lang AS language,
  (SELECT count(DISTINCT lang) FROM documents WHERE lang IN ('en', 'fr', 'de')) AS count
FROM documents WHERE lang IN ('en', 'fr', 'de') ORDER BY language""",
    # sources, requests, stores
    "read_corpus": READ_FILES,
    "load_files": READ_FILES,
    "stream_files": READ_FILES,
    "corpora_union": """SELECT
  CASE doc_id % 3 WHEN 1 THEN source || '/' || doc_id WHEN 2 THEN CAST(doc_id AS VARCHAR) END AS file_id,
  CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS VARCHAR) END AS number,
  sha256(CASE WHEN doc_id % 33 = 0 THEN '' ELSE text END) AS content_hash,
  CAST(NULL AS VARCHAR) AS read_error FROM documents""",
    "decode_text": """SELECT doc_id AS file_id,
  CASE WHEN lang = 'es' THEN chr(65279) || text ELSE text END AS content,
  CASE WHEN lang IN ('fr', 'de') AND regexp_matches(text, '[^\\x00-\\x7f]')
    THEN 'latin-1' ELSE 'utf-8' END AS encoding FROM documents""",
    "read_errors": f"""SELECT source || '/' || doc_id AS path,
  CASE WHEN doc_id IN {LABELLED} THEN text END AS content,
  CASE WHEN doc_id IN {LABELLED} THEN lang ELSE 'unknown' END AS language,
  CASE WHEN doc_id NOT IN {LABELLED} THEN 'Error reading file: No such file or directory: '
    || chr(39) || source || '/' || doc_id || chr(39) END AS read_error FROM documents""",
    "validate_requests": """
SELECT 'd' || doc_id AS request_id,
  CASE WHEN lang = 'es' THEN 'parse-file' ELSE 'parse' END AS kind,
  CASE WHEN lang <> 'de' THEN length(text) END AS content_chars,
  CASE WHEN lang = 'fr' THEN '' WHEN lang <> 'de' THEN lang END AS language,
  CASE lang WHEN 'fr' THEN 'Missing required fields: content, language'
    WHEN 'de' THEN 'Invalid JSON'
    WHEN 'es' THEN 'Missing required field: file_path' END AS error
FROM documents
UNION ALL
SELECT 'e' || event_id, CASE event_type WHEN 'click' THEN 'parse' WHEN 'signup' THEN 'parse-file'
    WHEN 'purchase' THEN 'check-language' ELSE 'other' END, NULL, NULL,
  CASE event_type WHEN 'click' THEN 'Missing required fields: content, language'
    WHEN 'signup' THEN 'Missing required field: file_path'
    WHEN 'purchase' THEN 'Missing required field: language'
    WHEN 'error' THEN 'No request body' ELSE 'Not found' END
FROM events""",
    "results_json": f"""WITH {PROSE_RESULTS}
SELECT path AS file, language, success, ast_text AS ast, parser, node_count, error
FROM results""",
    "fetch_result": f"""WITH {PROSE_RESULTS}, ids AS ({result_ids()})
SELECT id, file_id, language, ast_text, error FROM results JOIN ids ON doc_id = file_id
WHERE id = (SELECT max(id) FROM ids)""",
    "fetch_results": f"""WITH ids AS ({result_ids()})
SELECT id, doc_id AS file_id, lang AS language, lang IN ('en', 'fr') AS success
FROM ids WHERE id IN (SELECT id FROM ids WHERE doc_id IN {LABELLED})""",
    "stored_results": f"""WITH ids AS ({result_ids()})
SELECT id, lang AS language, CASE WHEN bool_or(doc_id IN {LABELLED}) THEN 'again'
  WHEN lang = 'de' THEN 'No producer available for language: de'
  WHEN lang = 'es' THEN 'Language es not supported' END AS error
FROM ids GROUP BY id, lang""",
    "store_look_up": f"""WITH ids AS ({result_ids()})
SELECT DISTINCT id, lang AS language, lang IN ('en', 'fr') AS success
FROM ids WHERE id IN (SELECT id FROM ids WHERE doc_id IN {LABELLED})""",
    # versions
    "content_hash_of": f"SELECT doc_id AS file_id, {HASH} AS content_hash FROM documents",
    "duplicate_groups": f"""SELECT {HASH} AS content_hash, count(*) AS files,
  min(doc_id) AS first_file_id FROM documents GROUP BY 1 HAVING count(*) > 1""",
    "incremental": f"""SELECT min(doc_id) AS file_id, {HASH} AS content_hash, lang AS language
FROM documents GROUP BY text, lang
HAVING count(*) FILTER (doc_id IN {LABELLED}) = 0""",
    "incremental_merge": f"""WITH {PROSE_RESULTS}
SELECT file_id, language, node_count, error FROM results""",
    "outline_diff": f"""WITH RECURSIVE {markup('x')}, {markup('y', '''
SELECT page_id AS file_id, replace(regexp_replace(html, '(?s)<li>.*?</li>', '', 'g'),
  '<h1>', '<h2></h2><h1>') AS content FROM pages''')},
a AS (SELECT file_id, array_to_string(path_types, '/') AS place, node_type, count(*) AS n
  FROM xnodes GROUP BY ALL),
b AS (SELECT file_id, array_to_string(path_types, '/') AS place, node_type, count(*) AS n
  FROM ynodes GROUP BY ALL)
SELECT file_id, place, node_type,
  least(coalesce(a.n, 0), coalesce(b.n, 0)) AS kept,
  greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS added,
  greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS removed
FROM a FULL JOIN b USING (file_id, place, node_type)""",
    "subtree_diff": f"""WITH RECURSIVE {markup('x')}, {markup('y', """
SELECT page_id AS file_id, regexp_replace(regexp_replace(html, '(?s)^(.*?)(<nav>.*?</nav>)(.*)$', '\\1\\3\\2'),
  '<h1>', '<h1>New: ', 'g') AS content FROM pages""")},
{subtrees('x')}, {subtrees('y')},
g AS (
  SELECT file_id, place, node_type, whole, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb
  FROM (SELECT file_id, place, node_type, whole, count(*) AS n FROM xwhole GROUP BY ALL) a
  FULL JOIN (SELECT file_id, place, node_type, whole, count(*) AS n FROM ywhole GROUP BY ALL) b
  USING (file_id, place, node_type, whole)),
k AS (SELECT *, least(na, nb) AS kept, na - least(na, nb) AS ra, nb - least(na, nb) AS rb FROM g),
w AS (
  SELECT *, least(sum(ra) OVER s, sum(rb) OVER s) AS moving,
    sum(ra) OVER o - ra AS ahead_a, sum(rb) OVER o - rb AS ahead_b
  FROM k WINDOW s AS (PARTITION BY file_id, whole),
    o AS (PARTITION BY file_id, whole ORDER BY place, node_type ROWS UNBOUNDED PRECEDING)),
m AS (
  SELECT *, greatest(0, least(ra, moving - ahead_a)) AS ma, greatest(0, least(rb, moving - ahead_b)) AS mb FROM w),
p AS (
  SELECT file_id, sum(kept) AS kept, sum(mb) AS moved, sum(ra - ma) AS left_a, sum(rb - mb) AS left_b
  FROM m GROUP BY file_id, place, node_type)
SELECT file_id, CAST(sum(kept) AS BIGINT) AS kept, CAST(sum(moved) AS BIGINT) AS moved,
  CAST(sum(least(left_a, left_b)) AS BIGINT) AS changed,
  CAST(sum(left_b - least(left_a, left_b)) AS BIGINT) AS added,
  CAST(sum(left_a - least(left_a, left_b)) AS BIGINT) AS removed
FROM p GROUP BY file_id""",
    # search
    "extract_names": page_query("""
SELECT d.file_id, d.ord AS decl_ord, (
  SELECT min_by(n.text, n.ord) FROM nodes n WHERE n.file_id = d.file_id
    AND n.ord BETWEEN d.ord + 1 AND d.ord + 4 AND n.node_type = 'text') AS name
FROM nodes d WHERE d.node_type = 'h1'"""),
    "extract_names_pruned": page_query(f"""
, shown AS (
  SELECT file_id, node_type, row_number() OVER (PARTITION BY file_id ORDER BY ord) - 1 AS ord,
    {shortened('text')} AS text FROM nodes WHERE {INCLUDED})
SELECT file_id, decl_ord, name FROM (
  SELECT d.file_id, CAST(d.ord AS INTEGER) AS decl_ord, (
    SELECT min_by(n.text, n.ord) FROM shown n WHERE n.file_id = d.file_id
      AND n.ord BETWEEN d.ord + 1 AND d.ord + 4 AND n.node_type = 'text') AS name
  FROM shown d WHERE d.node_type = 'div') WHERE name IS NOT NULL"""),
    "names_after_prune": page_query(f"""
, shown AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY ord) AS n FROM nodes
  WHERE {INCLUDED})
SELECT file_id, decl_ord, name FROM (
  SELECT d.file_id, d.ord AS decl_ord, (
    SELECT min_by(x.text, x.n) FROM shown x WHERE x.file_id = d.file_id
      AND x.n BETWEEN d.n + 1 AND d.n + 4 AND x.node_type = 'text') AS name
  FROM shown d WHERE d.node_type = 'h1') WHERE name IS NOT NULL"""),
    "paths_after_prune": page_query(f"{FLAT_NODES} WHERE {NOT_EXCLUDED}"),
    "extract_functions": f"""WITH {WORD_LINES}
SELECT doc_id AS file_id, CAST(1 + 5 * (n - 1) AS INTEGER) AS decl_ord, a AS name FROM words""",
    "files_with": f"""SELECT page_id AS file_id, {URL} AS path FROM pages
WHERE contains(html, '<h1>') AND page_id % 3 = 0
  AND regexp_matches({URL}, '/[^/]*[^/.][^/]*\\.html?$')""",
    "files_without": f"""SELECT page_id AS file_id, {URL} AS path FROM pages
WHERE NOT (contains(html, '<h1>') AND page_id % 3 = 0
  AND regexp_matches({URL}, '/[^/]*[^/.][^/]*\\.html?$'))""",
    "files_with_join": f"""SELECT doc_id AS file_id, {CODE_LANGUAGE} AS language
FROM documents WHERE lang = 'en'""",
    "files_without_join": f"""SELECT doc_id AS file_id, {CODE_LANGUAGE} AS language
FROM documents WHERE lang <> 'en'""",
    "files_where": page_query("""
, held AS (
  SELECT file_id, bool_or(node_type = 'h1') AND file_id % 3 <> 0 AS h1, bool_or(node_type = 'h1') AND file_id % 3 = 0 AS h2,
    bool_or(node_type = 'footer') AS footer, bool_or(node_type = 'nav') AS nav
  FROM nodes GROUP BY file_id)
SELECT file_id, 'both' AS asked FROM held WHERE h2 AND footer
UNION ALL SELECT file_id, 'neither' FROM held WHERE NOT h2 AND NOT footer
UNION ALL SELECT file_id, 'mixed' FROM held WHERE nav AND (h1 OR footer) AND NOT h2"""),
    "files_mentioning": """SELECT page_id AS file_id FROM pages
WHERE contains(html, '<h1>') AND page_id % 3 = 0""",
    "match_nodes": page_query("""
SELECT file_id, ord, path_ords[depth] AS parent_ord, depth FROM nodes
WHERE node_type = 'a' AND path_types[depth] = 'li' AND list_contains(path_types, 'nav')"""),
    "match_paths": page_query("""
SELECT file_id, ord, depth, node_type, text FROM nodes
WHERE regexp_matches(array_to_string(path_types, '/') || '/' || node_type, '(^|/)nav/(.*/)?li/a$')"""),
    "match_paths_counts": page_query("""
SELECT file_id, CAST(count(*) FILTER (depth = 2) AS INTEGER) AS top,
  CAST(count(*) FILTER (regexp_matches(array_to_string(path_types, '/') || '/' || node_type,
    '(^|/)body/(.*/)?article/[^/]+/(.*/)?text$')) AS INTEGER) AS deep
FROM nodes GROUP BY file_id"""),
    "skeleton": page_query("""
SELECT file_id, ord, depth, node_type FROM nodes
WHERE node_type IN ('body', 'nav', 'article', 'h1', 'footer') AND depth <= 4"""),
    "nested_in_same": page_query("""
SELECT file_id, ord, node_type FROM nodes WHERE node_type IN ('nav', 'ul', 'li')
  AND (list_contains(path_types, 'nav') OR list_contains(path_types, 'ul')
    OR list_contains(path_types, 'li'))"""),
    "recursive_decls": f"""WITH {WORD_LINES}
SELECT doc_id AS file_id, CAST(1 + 5 * (n - 1) AS INTEGER) AS decl_ord, a AS name
FROM words WHERE a = b""",
    # Without its own, a call's name is that of the next function.
    "recursion_after_prune": f"""WITH {WORD_LINES}
SELECT doc_id AS file_id, CAST(1 + 5 * (n - 1) AS INTEGER) AS decl_ord, a AS name
FROM (SELECT *, lead(a) OVER (PARTITION BY doc_id ORDER BY n) AS next FROM words) WHERE a = next""",
    "call_edges": f"""WITH {WORD_LINES}
SELECT DISTINCT doc_id AS file_id, a AS caller, b AS callee FROM words
WHERE (doc_id, b) IN (SELECT (doc_id, a) FROM words)""",
    "recursive_groups": f"""WITH RECURSIVE {WORD_LINES},
edge AS (
  SELECT DISTINCT doc_id, a, b FROM words WHERE (doc_id, b) IN (SELECT (doc_id, a) FROM words)),
reach AS (
  SELECT doc_id, a, b FROM edge
  UNION SELECT r.doc_id, r.a, e.b FROM reach r JOIN edge e ON e.doc_id = r.doc_id AND e.a = r.b),
mutual AS (
  SELECT x.doc_id, x.a, x.b FROM reach x JOIN reach y
    ON y.doc_id = x.doc_id AND y.a = x.b AND y.b = x.a)
SELECT doc_id AS file_id, a AS name, min(b) AS group_name, count(*) AS n_names
FROM mutual GROUP BY doc_id, a""",
    "line_decls": f"""WITH {WORD_LINES}
SELECT doc_id AS file_id, {CODE_LANGUAGE} AS language, CAST(1 AS INTEGER) AS line_no, 0 AS depth,
  CASE lang WHEN 'en' THEN 'class_definition' WHEN 'fr' THEN 'function_declaration'
    WHEN 'de' THEN 'package_clause' ELSE 'namespace_definition' END AS node_type,
  CASE lang WHEN 'en' THEN 'Doc' ELSE 'doc' END || doc_id AS name
FROM documents
UNION ALL
SELECT doc_id, {CODE_LANGUAGE},
  CAST(CASE WHEN lang = 'en' THEN 2 * n ELSE 3 * n - 1 END AS INTEGER),
  CASE WHEN lang = 'de' THEN 0 ELSE 1 END,
  CASE WHEN lang IN ('en', 'es') THEN 'function_definition' ELSE 'function_declaration' END, a
FROM words""",
    "line_decls_in_code": f"""WITH {WORD_LINES}
SELECT doc_id AS file_id, {CODE_LANGUAGE} AS language, CAST(1 AS INTEGER) AS line_no, 0 AS depth,
  CASE lang WHEN 'en' THEN 'class_definition' WHEN 'fr' THEN 'function_declaration'
    WHEN 'de' THEN 'package_clause' ELSE 'namespace_definition' END AS node_type,
  CASE lang WHEN 'en' THEN 'Doc' ELSE 'doc' END || doc_id AS name
FROM documents
UNION ALL
-- so many lines stand before each function, itself included, and so many it has
SELECT doc_id, {CODE_LANGUAGE}, CAST(1 + CASE lang WHEN 'en' THEN 7 + 8 * (n - 1)
    WHEN 'fr' THEN 8 + 10 * (n - 1) WHEN 'de' THEN 7 + 9 * (n - 1) ELSE 9 + 11 * (n - 1) END AS INTEGER),
  CASE WHEN lang = 'de' THEN 0 ELSE 1 END,
  CASE WHEN lang IN ('en', 'es') THEN 'function_definition' ELSE 'function_declaration' END, a
FROM words""",
    "outline_lines_udtf": page_query(f"""
SELECT file_id, ord, depth, node_type, CASE WHEN is_leaf THEN {quoted('text')} END AS literal
FROM nodes"""),
    "pandas_producer_results": f"""WITH {WORD_LINES},
body AS (
  SELECT doc_id, count(*) AS n, string_agg(CASE lang
      WHEN 'en' THEN '    line' || chr(10) || '      line: ' || {quoted("('return ' || b || '(x)')")}
      WHEN 'fr' THEN '  line' || chr(10) || '    line: ' || {quoted("('return ' || b || '(x);')")}
        || chr(10) || '  line: ' || chr(39) || '}}' || chr(39)
      ELSE '  line: ' || {quoted("('int ' || a || '(int x) {')")} || chr(10)
        || '  line: ' || {quoted("('return ' || b || '(x);')")}
        || chr(10) || '  line: ' || chr(39) || '}}' || chr(39) END,
    chr(10) ORDER BY n) AS functions
  FROM words GROUP BY doc_id),
whole AS (
  SELECT doc_id AS file_id, {CODE_LANGUAGE} AS language, lang <> 'de' AS success,
    CASE lang WHEN 'en' THEN 2 + 2 * n WHEN 'de' THEN NULL ELSE 3 + 3 * n END AS node_count,
    'file' || chr(10) || CASE lang WHEN 'en' THEN '  line'
      WHEN 'fr' THEN '  line: ' || {quoted("('function doc' || doc_id || '() {')")}
      ELSE '  line: ' || {quoted("('namespace doc' || doc_id || ' {')")} END
    || chr(10) || functions || CASE WHEN lang = 'en' THEN ''
      ELSE chr(10) || '  line: ' || chr(39) || '}}' || chr(39) END AS outline
  FROM body JOIN documents USING (doc_id))
SELECT file_id, language, success, node_count, 'indent' AS parser,
  CASE WHEN NOT success THEN 'Failed to parse: tab in line 3' END AS error,
  sha256(CASE WHEN success THEN outline ELSE '' END) AS outline_hash FROM whole""",
    "dedup_stream": "SELECT DISTINCT sha256(props) AS content_hash FROM events",
}
