"""The operators' queries against SQL, or against plain versions, at the smallest scale."""

import hashlib

import pytest

from tests.llm import brute
from treeframe.llm import licenses, pii
from treeframe.llm.catalog import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())
    assert got == want and got


def test_pii_base(spark, texts):
    rows = QUERIES["op3_pii"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute.base_spans(texts[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for _, k, _ in want) for kind in range(4)
        ]
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))


def test_license_base(spark, texts):
    rows = QUERIES["op4_licenses"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, starts, labels = brute.phrases(texts[r.doc_id], licenses.PHRASES)
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(starts), ",".join(labels))
        assert (r.first_word, r.last_word) == ((starts[0], starts[-1]) if starts else (None, None))
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op8_toxicity"](spark, folder).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic]
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_html_text_of_the_article(spark, db):
    """On these pages the text is that of the article element."""
    import html
    import re

    pages = dict(db.execute("SELECT page_id, html FROM pages").fetchall())
    rows = QUERIES["op9_html_text"](spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?p>|</?h1>|<br>", article)
        want = [html.unescape(re.sub("<[^>]*>", "", p)) for p in parts]
        want = "\n".join(" ".join(brute.SPACED.findall(p)) for p in want if p.strip())
        assert r.text == want and r.n_chars == len(want)
