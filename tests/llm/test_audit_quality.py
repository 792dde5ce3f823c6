"""Filter audit and quality scores against plain versions, and their edge cases."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from treeframe.llm import filter_audit, quality
from treeframe.llm.catalog import QUERIES

DOCS = "doc_id bigint, text string, lang string, part string, mask int, n bigint, good int, step int, _id int"
LABELS = "doc_id bigint, quality int, toxic int, text string, n int"


def docs_of(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "p", 1, 2, 3, 4, 5) for r in rows], DOCS).repartition(parts)


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, "t", 1) for r in rows], LABELS)


def plain_audit(rows, labels):
    """{(part, order, step): counts} by running every order over every document."""
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    judged = []
    for i, t, lang in rows:
        t = t or ""
        words = brute.SPACED.findall(t)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and least[t] < i,
        }
        judged.append((lang or "", fails, i in good, i in toxic))
    out, shapley = {}, {}
    for order in map("".join, permutations("ABCDE")):
        for part in {j[0] for j in judged}:
            left = [j for j in judged if j[0] == part]
            every = left
            for step, f in enumerate(order, 1):
                gone = [j for j in left if j[1][f]]
                left = [j for j in left if not j[1][f]]
                out[part, order, step] = [
                    len(left), len(gone), sum(j[1][f] for j in every) - len(gone),
                    sum(j[1][f] and sum(j[1].values()) == 1 for j in every),
                    sum(j[2] for j in gone), sum(j[3] for j in gone),
                ]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(docs, labels):
    rows = filter_audit.filter_audit(docs, labels).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_audit(spark):
    """Nulls, empty and long texts, copies, repeated rows and labels, null ids."""
    long = " ".join(f"w{i}" for i in range(20_000))
    texts = [None, "", "Plain small words", "A B C", "x#y", "a " * 300, long, " \t", "é " * 250 + "|"]
    rows = [(i, texts[i % len(texts)], [None, "", "en", "de"][i % 4]) for i in range(120)]
    rows += [(5, texts[5], "en")] * 3 + [(None, long, "en"), (None, "A B C", None)] * 2
    labels = [(i, i % 2, (i % 5 == 0) + 0) for i in range(60)]
    labels += [(1, 0, 1), (7, None, 1), (8, 1, None), (None, 1, 1)]
    got = audited(docs_of(spark, rows), labels_of(spark, labels))
    assert got == plain_audit(rows, labels) and len(got) == 3 * 600


def test_audit_hot_text(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"t{i}", "en") for i in range(900)]
    got = audited(docs_of(spark, rows), labels_of(spark, [(0, 1, 1)]))
    assert got["en", "EABCD", 1] == (601, 299, 0, 0, 0, 0, got["en", "EABCD", 1][-1])
    assert got == plain_audit(rows, [(0, 1, 1)])


def test_audit_empty(spark):
    assert audited(docs_of(spark, [], 1), labels_of(spark, [(1, 1, 1)])) == {}
    got = audited(docs_of(spark, [(1, "x", "en")], 1), labels_of(spark, []))
    assert got == plain_audit([(1, "x", "en")], [])


def test_potential_is_the_shapley_value(spark):
    """The recursion against the mean over orders, for a game that is no sum of parts."""
    v = np.random.default_rng(1).integers(0, 1000, 32)
    v[0] = 0
    df = spark.createDataFrame([([int(x) for x in v],)], "v array<bigint>")
    q = df.select(filter_audit.potential(F.col("v"))).first()[0]
    for i in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += v[before | 1 << i] - v[before]
        assert q[31] - 5 * q[31 - (1 << i)] == total


@pytest.fixture(scope="module")
def corpus(spark):
    folder = "/root/testdata/sf0.01"
    return (spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op12_quality"](spark, folder).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert len(good) > 500 and len(bad) > 80
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(r.predicted for r in bad) <= 0.1 * len(bad)


def test_quality_votes_are_exact(spark, corpus):
    """Scores against a plain search for each document's nearest labelled vectors."""
    docs, labels = corpus
    model = quality.fit(docs, labels)
    assert len(model.vectors) <= quality.SAMPLE and model.axes.shape[1] == quality.DIMENSIONS
    rows = docs.filter("doc_id % 7 = 0").select("doc_id", "text").collect()
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(got) == docs.count()
    import pyarrow as pa

    space = quality._Space(model.terms, model.kinds, model.idf)
    for r in rows:
        _, block = next(space.blocks(pa.array([r.text])))
        point = (block @ model.axes)[0]
        norm = np.linalg.norm(point)
        if norm < 1e-6:
            assert got[r.doc_id] == round(model.share, 4)
            continue
        near = sorted(((float(v @ point) / norm, y) for v, y in zip(model.vectors, model.labels)),
                      key=lambda x: -x[0])
        last = near[quality.NEIGHBOURS - 1][0]
        votes = [(s, y) for s, y in near if s > last + 1e-3]
        edge = [(s, y) for s, y in near if abs(s - last) <= 1e-3]
        bounds = [
            sum(s * y for s, y in votes + e) / max(sum(s for s, _ in votes + e), 1e-9)
            for e in ([x for x in edge if x[1] == 0], [x for x in edge if x[1] > 0], edge)
        ]
        assert min(bounds) - 0.02 <= got[r.doc_id] <= max(bounds) + 0.02


def test_quality_edges(spark, corpus):
    docs, labels = corpus
    model = quality.fit(docs, labels)
    long = "Some words. " * 100_000
    odd = docs_of(spark, [(1, None, "a"), (2, "", "a"), (3, " \n", "a"), (4, long, "a"), (4, long, "a"),
                          (None, "x", "a"), (5, "é" * 30_000, "b")])
    rows = quality.score(odd, model).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {round(model.share, 4)}
    assert quality.score(docs_of(spark, [], 1), model).count() == 0


@pytest.mark.parametrize("rows", [
    [], [(1, 1, 0)], [(1, 0, 0), (2, 0, 0)], [(None, 1, 0), (1, None, 0)],
    [(1, 1, 0), (1, 0, 0), (2, 0, 1)],
])
def test_quality_few_labels(spark, rows):
    docs = docs_of(spark, [(1, "one two. Three", "a"), (1, "other", "a"), (2, None, "b"), (3, "one", "c")])
    scores = {r.score for r in quality.score(docs, quality.fit(docs, labels_of(spark, rows))).collect()}
    assert all(0 <= s <= 1 for s in scores)
    if not any(q for i, q, _ in rows if i is not None):
        assert scores == {0.0}


def test_quality_hot_id(spark):
    """An id that a third of all rows have is one sample row."""
    rows = [(1, f"text {i} of one", "a") for i in range(300)] + [(i, f"w{i}", "a") for i in range(2, 600)]
    docs = docs_of(spark, rows)
    model = quality.fit(docs, labels_of(spark, [(i, i % 2, 0) for i in range(40)]))
    assert len(model.vectors) <= 40
    assert quality.score(docs, model).count() == len(rows)
