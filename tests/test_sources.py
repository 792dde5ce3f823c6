import json

import pytest
from pyspark.sql import functions as F

from treeframe import (
    Language, MARKUP, Registry, corpus_from_table, decode_text, dedup_stream, fetch_result,
    fetch_results, parse_corpus, read_corpus, register_outline_lines, save_results,
    stream_results, with_read_errors, with_result_id, write_reports, write_results_json,
)
from treeframe import schemas, session
from treeframe.operators import requests, versions
from treeframe.sources import corpus
from treeframe.sources.corpus import read_requested, spread
from treeframe.streaming.streams import drop_known

REGISTRY = Registry([MARKUP, Language("prose", producer="prose")])


def test_read_and_decode(spark, tmp_path):
    raw = {
        "utf8.py": "é = 1\n".encode(), "latin1.py": "é = 1\n".encode("latin-1"),
        "ascii.py": b"x\r\ny\rz\n", "bom.py": "﻿x".encode(),
        "mixed.py": b"\xff\xfe\x00ok", "skip.txt": b"no",
    }
    (tmp_path / "sub").mkdir()
    for i, (name, data) in enumerate(raw.items()):
        (tmp_path / ("sub" if i % 2 else ".") / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[1]: r for r in read_corpus(spark, str(tmp_path), "*.py").collect()}
    assert set(got) == set(raw) - {"skip.txt"}
    assert (got["utf8.py"].content, got["utf8.py"].encoding) == ("é = 1\n", "utf-8")
    assert (got["latin1.py"].content, got["latin1.py"].encoding) == ("é = 1\n", "latin-1")
    assert got["ascii.py"].content == "x\ny\nz\n"
    assert got["bom.py"].content == "﻿x"
    assert got["mixed.py"].content == raw["mixed.py"].decode("latin-1")
    assert len({r.file_id for r in got.values()}) == 5


def test_no_file_is_lost(spark, tmp_path):
    names = ["__init__.py", "_priv.py", ".eslintrc.js", "a.py", "empty.py", ".hid/b.py", "_x/y/c.py", "no suffix"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "empty" in name else name.encode())
    got = {r.path.removeprefix(f"{tmp_path}/"): r for r in read_corpus(spark, str(tmp_path)).collect()}
    assert set(got) == set(names)
    assert all(got[n].content == ("" if "empty" in n else n) for n in names)
    assert all(r.read_error is None and len(r.file_id) == 32 for r in got.values())
    top = {r.path.rsplit("/", 1)[1] for r in read_corpus(spark, str(tmp_path), "*.py", False).collect()}
    assert top == {"__init__.py", "_priv.py", "a.py", "empty.py"}
    one = read_corpus(spark, [str(tmp_path / ".hid"), str(tmp_path / "a.py"), str(tmp_path / "gone")])
    rows = {r.path.removeprefix(f"{tmp_path}/"): r.read_error for r in one.collect()}
    assert rows[".hid/b.py"] is None and rows["a.py"] is None
    assert rows["gone"].startswith("Error reading file: ") and "No such file" in rows["gone"]


def test_read_requested(spark, tmp_path):
    (tmp_path / "_empty.html").write_bytes(b"")
    (tmp_path / "d").mkdir()
    asked = spark.createDataFrame(
        [(str(tmp_path / n), lang) for n, lang in (("_empty.html", None), ("gone", ""), ("d", "html"))],
        "path string, language string")
    rows = {r.path.rsplit("/", 1)[1]: r for r in read_requested(asked).collect()}
    assert rows["_empty.html"].content == "" and rows["_empty.html"].read_error is None
    assert "No such file" in rows["gone"].read_error and rows["gone"].language == "unknown"
    assert rows["d"].read_error.startswith("Error reading file: ") and rows["d"].language == "html"
    assert "No such file" not in rows["d"].read_error


def test_decode_null(spark):
    df = spark.createDataFrame([(1, None)], "id long, raw binary")
    assert tuple(decode_text(df).first()) == (1, None, None)


def test_corpus_schema(spark):
    df = spark.createDataFrame([(1, "x")], "n int, body string")
    out = corpus_from_table(df, "n", "body", F.lit("html"))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.FILES]


def test_read_errors(spark):
    found = spark.createDataFrame([(1, "a.html", "<p>", None, "utf-8", None), (2, "x.html", "", None, "utf-8", None)], schemas.FILES)
    asked = spark.createDataFrame([("a.html", None), ("b.html", "html"), ("c.html", "")], "path string, language string")
    rows = {r.path: r for r in with_read_errors(asked, found).collect()}
    assert set(rows) == {"a.html", "b.html", "c.html"}
    assert rows["a.html"].content == "<p>" and rows["a.html"].read_error is None
    assert rows["b.html"].language == "html" and rows["c.html"].language == "unknown"
    parsed = parse_corpus(with_read_errors(asked, found), REGISTRY, extensions={".html": "html"})
    errors = {r.path: r.error for r in parsed.collect()}
    assert errors["a.html"] is None and errors["b.html"].startswith("Error reading file: ")
    assert with_read_errors(asked.select("path"), found).count() == 3


def test_spread(spark):
    small = spark.range(100).coalesce(1)
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100).repartition(64)
    assert spread(wide) is wide


def parsed(spark):
    files = spark.createDataFrame(
        [(1, "a", "<p>é", "html", "utf-8", None), (2, "b", "One.", "prose", "utf-8", None),
         (3, "c", "x", "sql", "utf-8", None)], schemas.FILES)
    return parse_corpus(versions.with_content_hash(files), REGISTRY, keep=["content_hash"])


def test_json_and_reports(spark, tmp_path):
    write_results_json(parsed(spark), str(tmp_path / "json"))
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "json")).collect()]
    by_file = {r["file"]: r for r in rows}
    assert set(by_file["a"]) == {"file", "language", "success", "ast", "metadata", "error"}
    assert by_file["a"]["success"] and by_file["a"]["error"] is None and "é" in by_file["a"]["ast"]
    assert by_file["a"]["metadata"]["node_count"] == 3
    assert by_file["c"]["error"] == "Language sql not supported" and by_file["c"]["ast"] == ""
    write_reports(parsed(spark), str(tmp_path / "text"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "text")).collect())
    assert "Language: html" in text and "Error parsing file: Language sql not supported" in text


def test_save_and_fetch(spark, tmp_path):
    path = str(tmp_path / "saved")
    results = with_result_id(parsed(spark))
    save_results(results, path)
    row = results.where("file_id = 1").first()
    got = fetch_result(spark, path, row.id).collect()
    assert [(r.file_id, r.ast_text) for r in got] == [(1, row.ast_text)]
    assert fetch_result(spark, path, row.id, "html").count() == 1
    assert fetch_result(spark, path, row.id, "prose").count() == 0
    assert fetch_result(spark, path, "absent").count() == 0
    assert fetch_results(spark, path, results.select("id")).count() == 3
    plan = fetch_result(spark, path, row.id, "html")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id," in plan and "PartitionFilters: [isnotnull(language" in plan


def test_validate_requests(spark):
    cases = [
        ("parse", '{"content": "x", "language": "go"}', None),
        ("parse", '{"content": "", "language": "go"}', "Missing required fields: content, language"),
        ("parse", '{"content": "x"}', "Missing required fields: content, language"),
        ("parse", '{"content": null, "language": "go"}', "Missing required fields: content, language"),
        ("parse", '{"content": " ", "language": "go"}', None),
        ("parse-file", '{"language": "go"}', "Missing required field: file_path"),
        ("parse-file", '{"file_path": "a.go"}', None),
        ("check-language", "{}", "Missing required field: language"),
        ("check-language", '{"language": "go"}', None),
        ("parse", "not json", "Invalid JSON"), ("parse", '{"content": ', "Invalid JSON"),
        ("parse", '{"content": "x", "language": "go"} x', "Invalid JSON"),
        ("parse", '{"content": "x"}, {"language": "go"}', "Invalid JSON"),
        ("parse", '{"content": "x"} {"language": "go"}', "Invalid JSON"),
        ("parse", "{'content': 'x', 'language': 'go'}", "Invalid JSON"),
        ("parse", '["content", "language"]', "Invalid JSON"), ("parse", "7", "Invalid JSON"),
        ("parse", ' {"content": "[]}", "language": "go", "more": {"a": [1]}}\n', None),
        ("unknown", "not json", "Invalid JSON"), ("unknown", "{}", "Not found"),
        *[("parse", f'{{"content": {v}, "language": "go"}}', "Missing required fields: content, language")
          for v in ("0", "0.0", "-0", "false", "[]", "{}", "[ ]")],
        *[("parse", f'{{"content": {v}, "language": "go"}}', None)
          for v in ('"0"', '"false"', '"[]"', "1", "true", "[0]", '"null"')],
        ("parse-file", '{"file_path": []}', "Missing required field: file_path"),
        ("parse", "", "No request body"), ("parse", None, "No request body"),
    ]
    df = spark.createDataFrame(cases, "kind string, body string, expected string")
    for r in requests.validate_requests(df).collect():
        assert r.error == r.expected, r.body


def test_outline_lines_sql(spark):
    register_outline_lines(spark)
    spark.createDataFrame([(1, "a\n  b: 'x: y'\n  c"), (2, None)], "id int, o string").createOrReplaceTempView("outl")
    rows = spark.sql("SELECT id, l.* FROM outl, LATERAL outline_lines(o) l ORDER BY ord").collect()
    assert [tuple(r) for r in rows] == [
        (1, 0, 0, "a", None), (1, 1, 1, "b", "'x: y'"), (1, 2, 1, "c", None)]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(i, f"p{i}.html", f"<p>{i}", None, "utf-8", None) for i in range(20)]
    start = lambda: stream_results(
        spark.readStream.schema(schemas.FILES).parquet(source), str(tmp_path / "out"),
        str(tmp_path / "check"), REGISTRY, extensions={".html": "html"})
    spark.createDataFrame(rows[:12], schemas.FILES).write.parquet(source)
    start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12
    spark.createDataFrame(rows[12:], schemas.FILES).write.mode("append").parquet(source)
    start().awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = parse_corpus(spark.createDataFrame(rows, schemas.FILES), REGISTRY, extensions={".html": "html"})
    key = lambda df: sorted(str(r.asDict(True)) for r in df.collect())
    assert key(streamed) == key(batch)


def test_dedup_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "b")],
        "ts string, content string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(source)
    stream = dedup_stream(spark.readStream.schema(df.schema).parquet(source))
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.content for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_drop_known(spark):
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None), (6, "c")]
    files = spark.createDataFrame(rows, "file_id long, content string")
    known = versions.with_content_hash(spark.createDataFrame([("b",)], "content string"))
    assert sorted(r.file_id for r in drop_known(files, known).collect()) == [1, 4, 5, 6]


def test_drop_known_with_repeated_ids(spark):
    rows = [(1, "a"), (1, "b"), (None, "c"), (2, "b"), (2, None)]
    files = spark.createDataFrame(rows, "file_id long, content string")
    known = versions.with_content_hash(spark.createDataFrame([("b",)], "content string"))
    got = {(r.file_id, r.content) for r in drop_known(files, known).collect()}
    assert got == {(1, "a"), (None, "c"), (2, None)}


def test_text_ids(spark):
    """Ids of a table keep their type; corpora with different ones meet as text."""
    df = spark.createDataFrame([("a/b", "one", 7)], "name string, body string, n int")
    text = corpus.corpus_from_table(df, "name", "body", path="name")
    number = corpus.corpus_from_table(df, "n", "body")
    assert text.first().file_id == "a/b" and number.first().file_id == 7
    both = corpus.union_corpora(text, number, text)
    assert sorted(r.file_id for r in both.collect()) == ["7", "a/b", "a/b"]
    assert corpus.union_corpora(number, number).schema["file_id"].dataType.simpleString() == "bigint"
    errors = corpus.with_read_errors(spark.createDataFrame([("x",), ("a/b",)], "path string"), text)
    assert sorted(r.read_error is None for r in errors.collect()) == [False, True]


def test_store(spark, tmp_path):
    """Later results win, a look-up reads one bucket, compaction changes no result."""
    from treeframe.sources import store

    path = str(tmp_path / "store")

    def rows(numbers, value):
        return spark.createDataFrame(
            [(f"{i * 2654435761 % 2**32:08x}", i, value) for i in numbers], "id string, n int, value string")

    with pytest.raises(ValueError):
        store.stored_results(spark, path)
    assert store.commit_results(rows(range(300), "a"), path) == 1
    assert store.commit_results(rows([*range(100), *range(100)], "b"), path) == 2
    assert store.commit_results(rows(range(290, 310), "c").withColumn("more", F.lit(1)), path, files=2) == 3
    want = {i: "c" if i >= 290 else "b" if i < 100 else "a" for i in range(310)}
    got = store.stored_results(spark, path).collect()
    assert {r.n: r.value for r in got} == want and len(got) == 310
    id = rows([5], "")
    one = store.look_up(spark, path, id.first().id)
    assert [(r.n, r.value) for r in one.collect()] == [(5, "b")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(bucket") == plan.count("FileScan parquet") > 0
    assert store.look_up(spark, path, "00zz").count() == 0
    many = store.look_up_all(spark, path, rows([5, 200, 300, 1000], "").unionByName(id))
    assert {r.n: r.value for r in many.collect()} == {5: "b", 200: "a", 300: "c"}
    assert store.compact_results(spark, path) == 4
    assert store._latest(spark, path)[0] == 4 and len(store._latest(spark, path)[1]) == 1
    assert {r.n: r.value for r in store.stored_results(spark, path).collect()} == want
    with pytest.raises(Exception, match="already exists"):
        store._publish(spark, path, 4, ["x"])


class Conf:
    """A session whose settings are the given ones."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_dir(spark):
    a, b = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert a != b
    shared = Conf(spark_checkpoint_dir="/shared/place/", spark_master="yarn")
    assert session.scratch_dir(shared, "x").startswith("/shared/place/x-")
    with pytest.raises(ValueError):
        session.scratch_dir(Conf(spark_master="yarn"), "x")
    with pytest.raises(ValueError):
        session.scratch_dir(Conf(), "x")


def test_files_data_source(spark, tmp_path):
    """Names and sizes of all kinds, in a batch and in a stream that goes on after a stop."""
    import os
    import time

    from treeframe.sources.datasource import load_files, stream_files

    root = tmp_path / "in"
    names = ["a.txt", "_b.txt", ".c.txt", "d/e.txt", ".f/_g.txt", "h.md", "i j#%.txt"]
    for i, name in enumerate(names):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if i == 1 else f"text {i}".encode())

    def under(df):
        return sorted((os.path.relpath(r.path, root), r.content, r.read_error) for r in df.collect())

    want = sorted((n, "" if i == 1 else f"text {i}", None) for i, n in enumerate(names) if n != "h.md")
    assert under(load_files(spark, str(root), "*.txt")) == want
    assert [n for n, *_ in under(load_files(spark, str(root), "*.txt", recursive=False))] == sorted(
        n for n in names if "/" not in n and n != "h.md")
    assert load_files(spark, str(root), "*.none").count() == 0
    with pytest.raises(Exception, match="No such file"):
        load_files(spark, str(root / "missing")).collect()

    def run():
        query = (stream_files(spark, str(root), "*.txt").writeStream.format("parquet")
                 .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return under(spark.read.parquet(str(tmp_path / "out")))

    assert run() == want
    assert run() == want
    time.sleep(0.01)
    (root / "_new.txt").write_text("later")
    (root / "h2.md").write_text("not asked for")
    assert run() == sorted([*want, ("_new.txt", "later", None)])
