"""Every named query against its SQL at the smallest scale."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from treeframe.catalog.oracles import ORACLES
from treeframe.catalog.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "events", "labels", "conversations")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())
    assert got == want
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() == 50


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",)])
def test_queries_without_the_subpackage(tmp_path, left):
    """The library and its queries stand without ``llm``, with the pipeline's file or not."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "treeframe", tmp_path / "treeframe",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *left):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], done.stderr
