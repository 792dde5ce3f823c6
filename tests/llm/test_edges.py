"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import random

import pytest

import corpus_pipeline
from tests.llm import brute
from treeframe.llm import (
    decontaminate,
    exact_dedup,
    extract,
    licenses,
    mixing,
    near_dedup,
    pii,
    substring_dedup,
    toxicity,
    warc,
)
from treeframe.session import scratch_dir

# Names that operators use inside; as further columns they must not matter.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, "
    "key string, label string, size bigint, mark int, row int, score string, _text string"
)


def documents(spark, rows):
    full = [(i, t, "en", s, None, 1, "k", "l", 2, 3, 4, "s", "x") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def words(seed, n, of=5000):
    pick = random.Random(seed)
    return [f"w{pick.randrange(of)}" for _ in range(n)]


LONG = " ".join(words(1, 60_000))
BASE = words(2, 400)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, repeated, case variants, long."""
    return documents(spark, [
        (0, None, "a"), (1, "", "a"), (2, " \t\n", None), (3, "One two", "b"), (4, "one TWO", "b"),
        (5, "Äpfel one", "b"), (6, "äpfel one", ""), (7, "x", "a"), (7, "x", "a"), (8, LONG, "b"),
        (9, LONG.upper(), "c"), (None, "one two", "a"), (10, "a b", None),
    ])


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, []).coalesce(1)


def test_exact(spark, odd, none):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == 13
    keep = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows}
    assert keep[0] == keep[1][:2] + (False,) and keep[1] == (1, 2, True)
    assert keep[2] == (2, 1, True)
    assert keep[3] == (4, 3, False) and keep[4] == (4, 3, True) and keep[None] == (4, 3, False)
    assert keep[5] == (5, 1, True) and keep[6] == (6, 1, True)
    assert keep[7] == (7, 2, True) and keep[8] == (9, 2, False)
    left = exact_dedup.drop_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4, 5, 6, 7, 9, 10]
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.drop_duplicates(none).count() == 0


def test_exact_hot_group(spark):
    rows = documents(spark, [(i, "same" if i % 3 == 0 else f"t{i}", "a") for i in range(900)])
    left = {r.doc_id for r in exact_dedup.drop_duplicates(rows).collect()}
    assert left == {i for i in range(900) if i % 3} | {897}


def test_exact_repeated_and_null_ids(spark):
    """One row for each id and text, whatever other texts the id has."""
    rows = [(5, "x", "a"), (5, "x", "a"), (5, "y", "a"), (5, "y", "a"), (6, "ABC", "a"),
            (6, "abc", "a"), (6, "abc", "a"), (1, "y", "a")]
    rows += [(None, f"t{i % 20}", "a") for i in range(60)] + [(None, "Q", "a"), (None, "q", "a")]
    left = [(r.doc_id, brute.lower(r.text)) for r in
            exact_dedup.drop_duplicates(documents(spark, rows)).collect()]
    want = [(5, "x"), (5, "y"), (6, "abc"), (None, "q"), *((None, f"t{i}") for i in range(20))]
    assert sorted(left, key=str) == sorted(want, key=str)


def test_near(spark, odd, none):
    rows = near_dedup.near_duplicates(odd, width=3, threshold=0.85).collect()
    assert len(rows) == 13
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got[0] == (0, 0, True) and got[1] == (0, 1, True) and got[2] == (0, 2, True)
    assert got[3] == (1, 3, True) and got[4] == (1, 3, False) and got[None] == (1, 3, False)
    assert got[7] == (1, 7, True) and got[8][1:] == (8, True) and got[9][1:] == (8, False)
    left = near_dedup.drop_near_duplicates(odd)
    assert left.columns == odd.columns and left.count() == 10
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_group_of_many_variants(spark):
    """Links that the centre of a bucket does not give, in a large group, are found too."""
    pick = random.Random(3)
    rows = []
    for i in range(300):
        text = list(BASE)
        for _ in range(pick.randrange(0, 26)):
            text[pick.randrange(len(text))] = f"v{pick.randrange(10**6)}"
        rows.append((1000 - i, " ".join(text), "a"))
    rows += [(2000 + i, " ".join(words(50 + i, 120)), "b") for i in range(40)]
    got = near_dedup.near_duplicates(documents(spark, rows), width=3, threshold=0.85).collect()
    want = brute.near([(i, t) for i, t, _ in rows], 3, 85)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) > 41


def test_near_repeated_and_null_ids(spark):
    """One text of each component stays, also if its ids are all null or all the same."""
    def variants(seed):
        text = words(seed, 200)
        return [" ".join(text[:k] + [f"v{k}"] + text[k + 1 :]) for k in (10, 90, 150)]

    nulls, same, mixed = variants(71), variants(72), variants(73)
    rows = [(None, t, "a") for t in nulls] + [(5, t, "a") for t in same]
    rows += [(None, mixed[0], "a"), (9, mixed[1], "a"), (8, mixed[2], "a")]
    rows += [(None, " ".join(words(74, 50)), "a"), (5, " ".join(words(75, 50)), "a")]
    left = [r.text for r in near_dedup.drop_near_duplicates(documents(spark, rows)).collect()]
    assert len(left) == 5 and {mixed[2], rows[-2][1], rows[-1][1]} <= set(left)
    assert len(set(left) & set(nulls)) == len(set(left) & set(same)) == 1


def test_sequential_test_bounds():
    least = [near_dedup.least_agreements(n, 0.8) for n in (28, 84, 196)]
    assert least == sorted(least) and 0 < least[0] < 0.8 * 28 and 0.6 * 196 < least[2] < 0.8 * 196
    assert (1 - 0.8 ** near_dedup.rows_per_band(0.8)) ** near_dedup.BANDS <= near_dedup.BAND_MISS


def test_substrings(spark, odd, none):
    rows = {r.doc_id: r for r in substring_dedup.remove_repeated_passages(odd).collect()}
    assert rows[0].n_words == 0 and rows[0].kept_text == "" and rows[0].intervals == []
    assert rows[3].kept_text == "One two" and rows[10].n_words == 1
    assert rows[8].n_removed == 0 and rows[9].n_removed == 0
    assert substring_dedup.remove_repeated_passages(none).count() == 0


def test_substring_hot_window(spark):
    """A window that all texts share asks once for each slice, not once for each place."""
    import pyarrow as pa

    texts = ["same " * 20_000 + f"end{i} " * 20 + " ".join(words(i, 30)) for i in range(12)]
    batch = pa.RecordBatch.from_pydict({
        "last": pa.array(range(12), pa.int64()), "mark": pa.array(range(12), pa.int32()), "text": texts,
    })
    entries = {}
    for out in substring_dedup._blocks(13, 8)([batch]):
        for bucket, hashes in zip(out["bucket"].to_pylist(), out["hashes"].to_pylist()):
            entries[bucket] = entries.get(bucket, 0) + len(hashes) // 8
    # 12 texts of some 40 distinct windows each, of which one is in all of them.
    assert sum(entries.values()) < 12 * 80 and max(entries.values()) < 12 * 20
    assert sum(n for b, n in entries.items() if b < 0) == 11
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in substring_dedup.remove_repeated_passages(docs, bucket_bytes=2000).collect()}
    assert got[0].n_removed == 0 and all(got[i].n_removed == 20_000 for i in range(1, 12))
    assert got[3].kept_text == ("end3 " * 20 + " ".join(words(3, 30)))


def test_substring_many_rows_of_one_id(spark):
    """Texts of one id, or of none, lose to smaller ids alone."""
    passage = " ".join(words(19, 30))
    for id in (None, 9):
        rows = [(id, f"{i} {passage}", "a") for i in range(40)] + [(id, f"1 {passage}", "a")] * 5
        got = substring_dedup.remove_repeated_passages(documents(spark, rows), bucket_bytes=500)
        assert {r.n_removed for r in got.collect()} == {0}
        got = substring_dedup.remove_repeated_passages(
            documents(spark, rows + [(3, f"x {passage} y", "a")]), bucket_bytes=500)
        assert sorted(r.n_removed for r in got.collect()) == [0] + [30] * 45


def test_substring_intervals(spark):
    passage = " ".join(words(9, 60))
    docs = documents(spark, [
        (5, f"a {passage} b", "x"), (6, f"c d {passage}", "x"), (6, f"{passage} e", "x"),
        (None, passage, "x"), (7, " ".join(words(9, 12)), "x"),
    ])
    got = substring_dedup.remove_repeated_passages(docs, bucket_bytes=200).collect()
    cut = sorted((r.kept_text, r.n_removed, tuple((s.start, s.end) for s in r.intervals)) for r in got)
    assert cut == sorted([
        (f"a {passage} b", 0, ()), ("c d", 60, ((2, 62),)), ("e", 60, ((0, 60),)),
        ("", 60, ((0, 60),)), (" ".join(words(9, 12)), 0, ()),
    ])


def test_decontamination(spark, odd, none):
    items = [(1, " ".join(words(21, 9))), (2, " ".join(words(22, 70))), (3, None), (4, "one two"),
             (5, " ".join(words(23, 300)))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    long = words(1, 30_000)
    rows = [
        (20, " ".join(long[:7777] + words(21, 9) + long[7777:]), "a"),
        (21, " ".join(words(22, 70)[:62]).upper() + ".", "a"), (22, " ".join(words(22, 70)[:40]), "a"),
        (23, "; ".join(words(23, 300)), "b"), (24, None, "b"), (25, "One two", None),
    ]
    docs = odd.unionByName(documents(spark, rows))
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    for size in (decontaminate.ITEMS, 2):
        found = decontaminate.contaminated(docs, benchmark, items_per_pass=size)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == brute.leaks(plain, items)
    left = decontaminate.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert {20, 21, 23, 25}.isdisjoint(r.doc_id for r in left.collect())
    assert decontaminate.contaminated(none, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


def test_decontamination_short_items_in_long_documents(spark):
    """Items of one shingle and more, among many others."""
    items = [(k, " ".join(f"b{k}x{j}" for j in range(5 + k % 8))) for k in range(4000)]
    rows = []
    for d in range(100):
        parts = [" ".join(words(1000 + 40 * d + k, 37)) + " " + items[40 * d + k][1] for k in range(40)]
        rows.append((d, " ".join(parts) + " the end of it all", "a"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(documents(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k // 40, k) for k in range(4000)}


def test_decontamination_keeps_clean_rows_of_an_id(spark):
    item = " ".join(words(81, 30))
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(i, f"{t} {k}", "a") for k in range(3) for i in (None, 7, k) for t in (item, "clean")]
    docs = documents(spark, rows)
    left = decontaminate.drop_contaminated(docs, benchmark)
    want = [(i, t) for i, t, _ in rows if t.startswith("clean")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)
    assert left.columns == docs.columns


def test_mixing(spark, odd, none):
    mixed = mixing.mix_sources(odd).collect()
    assert len(mixed) == 13
    by = {}
    for r in mixed:
        assert 0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size
        by.setdefault(r.source, [0, r.target])[0] += r.taken
    assert set(by) == {None, "", "a", "b", "c"}
    assert all(abs(taken - target) < 1 for taken, target in by.values())
    assert sorted(map(str, mixed)) == sorted(map(str, mixing.mix_sources(odd.repartition(5)).collect()))
    assert mixing.mix_sources(none).count() == 0


def test_pii(spark, odd, none):
    rows = [
        (30, "a@b.c, 1.2.3.4.5.6.7.8 x@y 1.2.3.256 a.b@c-d.e.f_g@h.i", "a"),
        (31, "4111 1111 1111 1111 and 4111-1111-1111-1112 +1 (948) 555-4042 +12 é 0000.1.1.1", "a"),
        (32, "9" * 50_000 + " " + "a" * 50_000 + "@" + ".b" * 5000, "a"),
        (33, "ü a@b.c.", "a"),
    ]
    found = pii.personal_data(odd.unionByName(documents(spark, rows))).collect()
    assert len(found) == 17
    for r in found:
        text = next((t for i, t, _ in rows if i == r.doc_id), "")
        assert [tuple(s) for s in r.base] == brute.base_spans(text)
    assert pii.personal_data(none).count() == 0


def test_pii_second_generation(spark):
    """Identifiers that one frame gives away make another frame known, which gives away more."""
    cards = ["AB-1201", "AB-1202", "AB-1203", "AB-1204", "AB-1205"]
    texts = [f"please write to reach{i}@mail.example if you can, thanks" for i in range(20)]
    texts += [f"please write to {c} if you can, thanks" for c in cards[:4]]
    texts += [f"the member card number {c} was sent to them" for c in cards]
    texts += ["one 4111111111 and 1,204 then AB-1201 stands here", "the year 2001-02 was good", None, ""]
    texts += ["numbers 123456 234567 345678 456789 all in a row 567890"] * 2
    got = pii.personal_data(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()
    want = brute.bootstrap(texts, pii)
    for r in got:
        assert {(s.start, s.end) for s in r.spans if pii.KINDS[s.kind] == "context"} == want[r.doc_id]
    # The fifth card stands in the second frame alone; the first one's other place is found too.
    assert want[28] and want[29] and not want[30]


def test_pii_rounds_against_plain_ones(spark):
    pick = random.Random(9)
    frames = ["mail {} today please", "call {} now or never", "id {} of the user", "order {} came in late",
              "{} was seen", "see {} and {} there", "it is {}"]
    values = [f"u{i}@x.example" for i in range(12)] + [f"+49 30 12345{i:03}" for i in range(9)]
    values += [f"N{i:05}" for i in range(40)]
    texts = []
    for i in range(300):
        parts = []
        for _ in range(pick.randrange(1, 6)):
            frame = pick.choice(frames)
            parts.append(frame.format(*[values[min(int(pick.expovariate(0.06)), 60)] for _ in range(2)]))
        texts.append(" ".join(parts) + pick.choice(["", " " * 80, " " + "y" * 90]))
    got = pii.personal_data(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()
    want = brute.bootstrap(texts, pii)
    assert sum(map(len, want.values())) > 20
    for r in got:
        assert {(s.start, s.end) for s in r.spans if pii.KINDS[s.kind] == "context"} == want[r.doc_id]


def test_pii_contexts(spark):
    """Identifiers that no pattern knows, in a context that seeds have shown."""
    seeds = [(i, f"please write to agent{i}@mail.example.com for help {i}", "a") for i in range(6)]
    unseen = [(9, "please write to agent#77x for help", "a"), (10, "nothing to agent#78x see", "a")]
    found = {r.doc_id: r for r in pii.personal_data(documents(spark, seeds + unseen)).collect()}
    kinds = {i: {pii.KINDS[s.kind] for s in r.spans} for i, r in found.items()}
    assert kinds[9] == {"context"} and kinds[10] == set()
    text = unseen[0][1]
    assert [text[s.start : s.end] for s in found[9].spans] == ["agent#77x"]


def test_licenses(spark, odd, none):
    mit = licenses.TEMPLATES[2][1]
    changed = mit.replace("free of charge", "at no charge at all").replace("and/or sell", "or sell")
    rows = [(40, f"foo {changed} bar", "a"), (41, "CC-BY cc by. All  rights\nreserved cc", "a"),
            (42, "general public", "a"), (43, mit[:60], "a"),
            (44, "licensed under the GNU general public license version 3", "a")]
    got = {r.doc_id: r for r in licenses.license_report(
        odd.unionByName(documents(spark, rows))).collect()}
    assert got[40].labels == "mit" and 0.7 <= got[40].score < 1
    assert (got[41].n_base, got[41].first_word, got[41].last_word) == (3, 0, 4)
    assert got[41].base_labels == "cc-by,reserved"
    assert got[42].labels == got[43].labels == "" and got[42].score == 0
    assert got[44].labels == "gpl,gpl-3.0"
    assert (got[0].n_words, got[2].n_words, got[8].n_words) == (0, 0, 60_000)
    assert licenses.license_report(none).count() == 0


def test_toxicity(spark, odd, none):
    rows = [(i, ("awful " if i % 4 == 0 else "fine ") + " ".join(words(i, 30, 40))
             + (" women" if i % 4 == 0 else ""), "a") for i in range(400)]
    docs = odd.unionByName(documents(spark, rows).filter("doc_id > 10"))
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(11, 400)] + [(12, 0), (None, 1), (99_999, 1), (13, None)],
        "doc_id bigint, toxic int",
    )
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((scores[i] >= 0.5) == (i % 4 == 0) for i in range(11, 400))
    assert scores[0] == scores[1] < 0.5
    # The word that names a group goes with the label here, but is not held against a text.
    neutral = documents(spark, [(1, "fine women here", "a"), (2, "women", "a")])
    assert all(r.score < 0.5 for r in toxicity.score(neutral, model).collect())
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    assert not [r for r in left.collect() if r.doc_id and r.doc_id > 10 and r.doc_id % 4 == 0]
    for few in (labels.limit(0), labels.filter("toxic = 0")):
        assert all(r.score < 0.5 for r in toxicity.score(docs, toxicity.fit(docs, few)).collect())
    assert toxicity.drop_toxic(none, labels).count() == 0


def test_html(spark):
    pages = [
        (1, "u", None, 5), (2, "u", "", 5), (3, None, "<p>", 5),
        (4, "u", "<article><h1>A &amp; B</h1><p>One\n two<b>x</b><p>Three<script>var a='</p>';", 5),
        (5, "u", "<div class='Side-Bar comments'><p>" + "no " * 50 + "</div><main><p>Yes.", 5),
        (6, "u", "<!-- " * 20_000 + "<a title=\"" * 20_000, 5),
        (4, "u", "<article><p>again</article>", 5),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text int")
    got = sorted((r.page_id, r.text) for r in extract.extract_text(df).collect())
    assert got == [(1, ""), (2, ""), (3, ""), (4, "A & B\nOne twox\nThree"), (4, "again"),
                   (5, "Yes."), (6, "")]
    assert extract.extract_text(df.limit(0)).count() == 0


def test_html_broken_pages_take_linear_time():
    """Cut tags, quotes, openings that nothing closes, closings that nothing opened."""
    import time

    tree = extract.train()
    start = "<article><p>Text of it.<p>"
    pages = [start + "<a " + " ".join(f'a{i}="v{i}" b{i}=\'w\'' for i in range(200)) + ' c="']
    for part in ("<a ", '"', "'", "<!", "<a \"'", "<?", "</a ", "<p class='", "<div id=\"", "<svg ", "&am", "<a b='\">"):
        pages += [start + part * (1_000_000 // len(part)), start + "<a " + part * (1_000_000 // len(part))]
    pages += [start + "<div>" * 100_000 + "</section>" * 50_000, start + "<select>" * 100_000 + "</svg>" * 50_000]
    for page in pages:
        began = time.process_time()
        assert extract.main_text(page, tree).startswith("Text of it.")
        assert time.process_time() - began < 4, page[:60]


def test_html_embedded_elements_end():
    """Self-closed and unclosed ones leave the rest of the article."""
    tree = extract.train()
    for page, want in (
        ("<p>One <svg class=i/> two<p>Three", "One two\nThree"),
        ("<p>One <math/><p>Two<p>Three", "One\nTwo\nThree"),
        ("<p>One <select><option>A<option>B<p>Two<p>Three", "One\nTwo\nThree"),
        ("<p>One <object data=x> no<p>Two <canvas><p>Three", "One\nTwo\nThree"),
        ("<p>One <svg class=i><p>Two <svg><svg/><p>no</p></svg>end", "One\nTwo end"),
        ("<p>One <iframe src=http://x/>no</iframe>end<p>Two", "One end\nTwo"),
        ("<p>One<script/>no<p>no", "One"),
    ):
        assert extract.main_text(f"<article>{page}</article>", tree) == want


def test_html_names_around_and_inside_the_main_part():
    tree = extract.train()
    text = "<article><p>One</p><p>Two</p></article>"
    for page, want in (
        (f"<div class='content has-sidebar'>{text}</div>", "One\nTwo"),
        (f"<div id=no-ads-layout><div class='search author'>{text}</div></div>", "One\nTwo"),
        (f"<div class='legal'><main>{text}</main></div>", "One\nTwo"),
        ("<article><header class='entry-header'><h1>Top</h1></header><p>One</article>", "Top\nOne"),
        (f"<aside>{text}</aside><article><p>Three</article>", "Three"),
        ("<article><p>One<div class=related><article><p>no</article></div></article>", "One"),
        (f"{text}<div class=comments><article class=comment><p>no</article></div>", "One\nTwo"),
    ):
        assert extract.main_text(f"<body>{page}", tree) == want


def test_tree_fits_its_labelled_pages():
    tree = extract.train()
    for page in extract.LABELLED:
        want = [b[0] for b in extract.blocks_of(page) if b[0].startswith("*")]
        assert extract.main_text(page, tree).split("\n") == want


def test_warc(spark):
    body = "é" * 60
    pages = [
        (3, "http://x/ y", body, 1), (1, None, body, 1), (2, "http://z", body + "!", 1),
        (5, "u", "short", 1), (6, "u", "short", 1), (7, "u", None, 1), (None, "u", body, 1),
        (8, "u", "b" * 5000, 1), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 20, 1), (1, "again", body, 1),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, digest int")
    digests = []
    for parts in (1, 4):
        folder = scratch_dir(spark, "warc-test")
        manifest = warc.write_archives(df.repartition(parts), folder, range_bytes=300, roll_bytes=200)
        digests.append(sorted((r.file, r.sha256, r.n_records) for r in manifest.collect()))
        rows = warc.read_archives(spark, folder).collect()
        got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
        assert got == [
            (0, "revisit", 1, 120), (1, "response", None, 120), (1, "response", None, 120),
            (2, "response", None, 121), (3, "revisit", 1, 120), (5, "response", None, 5),
            (6, "response", None, 5), (7, "response", None, 0), (8, "response", None, 5000),
            (9, "response", None, 280),
        ]
        sent = {(i, (t or "").encode()) for i, _, t, _ in pages}
        assert all((r.page_id, bytes(r.payload)) in sent for r in rows if r.payload is not None)
        assert {r.url for r in rows if r.page_id == 3} == {"http://x/%20y"}
    assert digests[0] == digests[1] and len(digests[0]) > 3
    folder = scratch_dir(spark, "warc-test")
    assert warc.write_archives(df.limit(0), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0


def test_warc_missing_file(spark):
    import os

    pages = [(i, "u", f"{i} " + "x" * 500, 1) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, digest int")
    folder = scratch_dir(spark, "warc-test")
    files = warc.write_archives(df, folder, range_bytes=4000, roll_bytes=200).collect()
    assert len(files) > 5 and warc.read_archives(spark, folder).count() == 40
    os.rename(f"{folder}/data/{files[2].file}", f"{folder}/tmp/{files[2].file}")
    with pytest.raises(FileNotFoundError):
        warc.read_archives(spark, folder)


def test_warc_one_id_for_all(spark):
    """Pages without an id, or with one, are dealt to many ranges by their contents."""
    for id in (None, 7):
        pages = [(id, f"u{i % 50}", f"{i % 150} " + "x" * 300, 1) for i in range(300)]
        df = spark.createDataFrame(pages, "page_id bigint, url string, html string, digest int")
        sums = []
        for parts in (2, 5):
            folder = scratch_dir(spark, "warc-test")
            files = warc.write_archives(df.repartition(parts), folder, range_bytes=5000).collect()
            assert len({f.range for f in files}) > 10
            sums.append(sorted(f.sha256 for f in files))
            rows = warc.read_archives(spark, folder).collect()
            assert len(rows) == 300 and {r.record_type for r in rows} == {"response"}
            assert len({bytes(r.payload) for r in rows}) == 150
        assert sums[0] == sums[1]


def test_warc_reading_is_linear():
    import gzip
    import time

    def took(n):
        one = [gzip.compress(warc.record(i, "u", f"{i}".encode() * 500, warc._digest(f"{i}".encode() * 500), None, False))
               for i in range(n)]
        data = b"".join(one)
        began = time.process_time()
        assert [r[0] for r in warc.parse_records(data)] == list(range(n))
        return time.process_time() - began

    took(500)
    assert took(20_000) < 8 * took(5_000)
    whole = gzip.compress(warc.record(1, "u", b"x" * 5000, warc._digest(b"x" * 5000), None, False))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_records(whole + whole[:-20]))


def test_pipeline(spark):
    """Every stage against its own rule, on what the stage before it kept."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, folder)
        after = {r.doc_id: r.text for r in docs.collect()}
        kept[name] = (before, after)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after.items() <= before.items()
    model = toxicity.fit(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    )
    scores = toxicity.score(spark.read.parquet(f"{folder}/documents.parquet"), model).collect()
    assert set(kept["toxicity"][1]) == {r.doc_id for r in scores if r.score < 0.5}
    before, after = kept["exact_dedup"]
    last = {}
    for i, t in sorted(before.items()):
        last[brute.lower(t)] = i
    assert set(after) == set(last.values())
    before, after = kept["near_dedup"]
    assert set(after) == {i for i, c in brute.near(before.items(), 5, 80).items() if i == c}
    before, after = kept["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert set(after) == set(before) - {i for i, _ in brute.leaks(before.items(), items)}
    mixed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in mixed} <= set(after) and all(r.taken > 0 for r in mixed)


def test_short_tables_are_few_files(spark, tmp_path, monkeypatch):
    """Written steps follow the rows, not the shuffle partitions, and the rows are the same."""
    rows = [(i, " ".join(words(i % 60, 30)) + (" more" if i % 7 == 0 else ""), "abc"[i % 3])
            for i in range(600)]
    steps = {
        "exact": lambda docs: exact_dedup.drop_duplicates(docs).select("doc_id"),
        "near": lambda docs: near_dedup.near_duplicates(docs).drop("mark", "node"),
        "mix": lambda docs: mixing.mix_sources(docs),
    }
    docs = documents(spark, rows)
    want = {name: sorted(map(repr, step(docs).collect())) for name, step in steps.items()}
    monkeypatch.setattr(
        "treeframe.llm.rows.scratch_dir",
        lambda _, purpose: str(tmp_path / f"{purpose}-{len(list(tmp_path.iterdir()))}"),
    )
    held = {"spark.sql.shuffle.partitions": "40",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        for name, step in steps.items():
            assert sorted(map(repr, step(docs).collect())) == want[name]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in tmp_path.iterdir()}
    assert {name.split("-")[0] for name in files} >= {"exact", "near", "links", "mix"}
    # Sources are few rows, and come from no step whose rows are known.
    files = {k: n for k, n in files.items() if not k.startswith(("mix-sources", "mix-levels", "mix-targets"))}
    assert max(files.values()) <= 4, files
