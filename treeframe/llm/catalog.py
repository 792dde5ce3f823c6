"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeframe.llm import (
    conversations,
    decontaminate,
    exact_dedup,
    extract,
    filter_audit,
    licenses,
    mixing,
    near_dedup,
    pii,
    quality,
    substring_dedup,
    toxicity,
    warc,
)
from treeframe.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_decontaminate(spark, sf_dir):
    found = decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found


ORACLES["op1_decontaminate"] = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark
), d AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM t
), s AS (
  SELECT DISTINCT kind, id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM d, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS g(i) WHERE len(words) > 0
), n AS (SELECT id, count(*) AS n_shingles FROM s WHERE kind = 'b' GROUP BY id
), p AS (
  SELECT a.id AS doc_id, b.id AS item_id, count(*) AS n_shared
  FROM s a JOIN s b ON a.shingle = b.shingle WHERE a.kind = 'd' AND b.kind = 'b' GROUP BY ALL
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM p JOIN n ON n.id = p.item_id WHERE n_shared >= 0.8 * n_shingles
"""


@query
def op2_near_dedup(spark, sf_dir):
    judged = near_dedup.near_duplicates(
        table(spark, sf_dir, "documents"), width=3, threshold=0.85
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return judged.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


ORACLES["op2_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM d, unnest(generate_series(1, greatest(len(words) - 2, 1))) AS g(i) WHERE len(words) > 0
), n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * both_have >= 85 * (x.size + y.size - both_have)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.doc_id, coalesce(n.size, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""


@query
def op3_pii(spark, sf_dir):
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def of(kind):
        n = F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind)))
        return n.cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", of("email"), of("ip"), of("card"), of("phone"),
        F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


@query
def op4_licenses(spark, sf_dir):
    return licenses.license_report(table(spark, sf_dir, "documents"))


@query
def op5_substring_dedup(spark, sf_dir):
    cut = substring_dedup.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLES["op5_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS passage
  FROM d, unnest(generate_series(1, len(words) - 12)) AS g(i)
), r AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY passage) AS least FROM w)
  WHERE doc_id > least
), c AS (SELECT DISTINCT doc_id, i + k AS place FROM r, unnest(generate_series(0, 12)) AS g(k)
), u AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM d
), p AS (
  SELECT u.doc_id, u.place, u.word, c.place IS NOT NULL AS gone
  FROM u LEFT JOIN c ON c.doc_id = u.doc_id AND c.place = u.place
), s AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS kept
  FROM p GROUP BY doc_id
)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""


@query
def op6_mixing(spark, sf_dir):
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op6_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS DOUBLE) * 2 AS cap
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM s
), b AS (SELECT CAST(sum(source_size) AS DOUBLE) * 1.5 AS budget, sum(weight) AS total FROM w
), l AS (
  SELECT *, coalesce(sum(cap) OVER o, 0) AS caps_before, coalesce(sum(weight) OVER o, 0) AS weights_before
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT l.*, cap <= (budget - caps_before) / (total - weights_before) * weight AS capped, budget, total
  FROM l, b
), f AS (
  SELECT coalesce(sum(cap) FILTER (capped), 0) AS caps, coalesce(sum(weight) FILTER (capped), 0) AS weights FROM c
), t AS (
  SELECT source, source_size, CASE WHEN capped THEN cap ELSE weight * ((budget - caps) / (total - weights)) END AS target
  FROM c, f
), p AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || doc_id), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
    + greatest(0, least(budget % source_size - before, size)) END AS BIGINT) AS taken
FROM p
"""


@query
def op7_exact_dedup(spark, sf_dir):
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("full_hash")).alias("text_sha256")
    )


ORACLES["op7_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


@query
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op9_html_text(spark, sf_dir):
    out = extract.extract_text(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op10_warc(spark, sf_dir):
    folder = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, payloads=False).drop("url", "payload")


ORACLES["op10_warc"] = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
    octet_length(encode(coalesce(html, ''))) AS payload_bytes
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
    ELSE page_id END AS first
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""


@query
def op11_conversation_repair(spark, sf_dir):
    turns = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair_report(turns)


# The cheapest way to each state (p0: nothing yet, p1: after s, p2: u, p3: a) as a struct of
# cost, edits and repaired turns; the least struct is the cheapest, then first in ASCII.
def _then(state: str, cost: str, edit: str, turn: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {state}.t || {turn}}}"


def _inserted(rows: str, more: str) -> str:
    """``rows`` with states in which up to two turns were inserted last."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    for _ in range(2):
        into2 = ", ".join(_then(p, "3", "I", user) for p in ("p0", "p1", "p3"))
        rows = (f"SELECT {more}, p0, p1, list_min([p2, {into2}]) AS p2, "
                f"list_min([p3, {_then('p2', '3', 'I', assistant)}]) AS p3 FROM ({rows})")
    return rows


def _judged() -> str:
    """States after one more turn."""
    def keep(p: str, initial: str) -> str:
        cost = f"CASE WHEN NOT gone AND initial = '{initial}' THEN more ELSE 1000000000 END"
        return _then(p, cost, "K", "chr(10) || role || ':' || text")

    def rerole(p: str, role: str) -> str:
        cost = "CASE WHEN NOT gone THEN more + 3 ELSE 1000000000 END"
        return _then(p, cost, "R", f"chr(10) || '{role}:' || text")

    ways = {p: [_then(p, "4", "D", "''")] for p in ("p0", "p1", "p2", "p3")}
    ways["p1"] += [keep("p0", "s")]
    for p in ("p0", "p1", "p3"):
        ways["p2"] += [keep(p, "u"), rerole(p, "user")]
    ways["p3"] += [keep("p2", "a"), rerole("p2", "assistant")]
    before = _inserted(
        "SELECT w.conv, w.k, n.role, n.text, n.initial, n.gone, n.more, p0, p1, p2, p3 "
        "FROM w JOIN n ON n.conv = w.conv AND n.k = w.k + 1",
        "conv, k, role, text, initial, gone, more",
    )
    return "SELECT conv, k + 1 AS k, " + ", ".join(
        f"list_min([{', '.join(v)}]) AS {p}" for p, v in ways.items()
    ) + f" FROM ({before})"


_NOWHERE = "{'c': 1000000000, 'a': '', 't': ''}"
ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE c AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, conv_id, turn,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS key
  FROM conversations
), x AS (
  SELECT * EXCLUDE (key), xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(key,
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384)
      ELSE crc // 2 END), 4294967295) % 20 AS what
  FROM c
), m AS (
  SELECT conv, turn, CASE what WHEN 4 THEN 'user' ELSE role END AS role,
    CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(generate_series(1, CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM x
), f AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS k,
    role[1:1] AS initial
  FROM m
), g AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' END AS fault,
    lag(initial) OVER (PARTITION BY conv ORDER BY k) || initial AS pair
  FROM f
), n AS (
  SELECT *, coalesce(fault IN ('b', 'd'), false) AS gone, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS more FROM g
), w AS (
  SELECT DISTINCT conv, 0::BIGINT AS k, {{'c': 0, 'a': '', 't': ''}} AS p0, {_NOWHERE} AS p1,
    {_NOWHERE} AS p2, {_NOWHERE} AS p3
  FROM c
  UNION ALL {_judged()}
), e AS (SELECT conv, max(k) AS k FROM w GROUP BY conv
), z AS ({_inserted("SELECT conv, p0, p1, p2, p3 FROM w JOIN e USING (conv, k)", "conv")}
), s AS (SELECT conv, list_min([p0, p3]) AS best FROM z
), t AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM g GROUP BY conv
), o AS (SELECT DISTINCT conv, conv_id FROM c
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
  sha256(best.t[2:]) AS repaired_sha256
FROM o JOIN s USING (conv) LEFT JOIN t USING (conv)
"""


@query
def op12_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


ORACLES["op13_filter_audit"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), d AS (
  SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) IS TRUE AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) IS TRUE AS toxic
  FROM t
), m AS (
  SELECT part, map(['A', 'B', 'C', 'D', 'E'], [a, b, c, d, e]) AS fails, count(*) AS n,
    count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM d GROUP BY ALL
), l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), s AS (
  SELECT part, filter_order, step, filter_order[step] AS f, n, good, toxic,
    fails[filter_order[step]] AS own,
    len(list_filter(string_split(filter_order[1:step - 1], ''), lambda x: fails[x])) > 0 AS earlier,
    len(list_filter(map_keys(fails), lambda x: fails[x])) AS n_fails
  FROM m, o, generate_series(1, 5) AS g(step)
), r AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN own OR earlier THEN 0 ELSE n END) AS kept,
    sum(CASE WHEN own AND NOT earlier THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN own AND earlier THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN own AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN own AND NOT earlier THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN own AND NOT earlier THEN toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""
