"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import itertools
import textwrap
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.llm import (byte_convnet, content_sort, dealing, licences, ngram_join, packing, page_text, positional_index,
                         repeats, signature_tree, string_kernel, suffix_sort, textblocks, url_reputation)
from daybook.llm.components import components
from daybook.llm.registry import vocabulary
from tests.llm.test_queries import check_packing, near_components, repeated


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, None), (11, 0), (12, 1), (12, 1)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "BROWN fox jumps"), (2, None), (3, "..."), (None, "one two"), (20, "word3x3 word4x4")],
                                 "item_id long, text string")


def one(rows, key="doc_id"):
    return {getattr(r, key): r for r in rows if getattr(r, key) is not None}


def test_copies(awkward, nothing):
    rows = content_sort.copies(awkward).collect()
    assert len(rows) == awkward.count()
    r = one(rows)
    assert r[1].group_size == 1 and r[2].group_size == 2 and r[2].kept
    assert (r[3].keep_id, r[5].keep_id, r[3].group_size) == (5, 5, 4)  # most code points first
    assert r[12].keep_id == 12 and r[12].group_size == 1
    assert content_sort.copies(nothing).count() == 0
    kept = content_sort.keep_first(awkward)
    assert kept.columns == awkward.columns


def test_copies_over_many_partitions(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, concat('same text', repeat(' ', int(id % 2))), concat('t', id)) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = content_sort.copies(docs.repartition(7)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    same = [r for r in rows if r.doc_id % 3 == 0]
    assert {(r.keep_id, r.group_size) for r in same} == {(3, 1667)} and sum(r.kept for r in same) == 1
    assert all(r.kept and r.group_size == 1 for r in rows if r.doc_id % 3)


def test_near_copies(spark, awkward, nothing):
    rows = ngram_join.join(awkward).collect()
    want = near_components({r.doc_id: r.text for r in awkward.where("doc_id is not null").collect()})
    assert {d: (r.n_shingles, r.component_id) for d, r in one(rows).items()} == want
    assert len(rows) == awkward.count() and ngram_join.join(nothing).count() == 0
    assert ngram_join.keep_first(awkward).columns == awkward.columns


def test_near_copies_in_blocks(spark):
    """A family cut into many blocks, and sets that link to one member of it only."""
    r = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    docs = {}
    for i in range(120):
        w = list(base)
        for k in r.integers(0, 80, r.integers(0, 3)):
            w[k] = f"x{i}"
        docs[i] = " ".join(w[:len(w) - int(r.integers(0, 8))])
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    for tokens in (300, 100_000):
        rows = ngram_join.join(df, tokens=tokens).collect()
        assert {x.doc_id: (x.n_shingles, x.component_id) for x in rows} == near_components(docs)


@pytest.mark.parametrize("least", [200, 1 << 20])
def test_repeats(awkward, nothing, monkeypatch, least):
    monkeypatch.setattr(dealing, "LEAST_BYTES", least)  # many buckets, and one
    assert dealing.buckets_of(awkward) == (16 if least == 200 else 1) and dealing.buckets_of(nothing) == 1
    rows = repeats.remove(awkward).collect()
    want = repeated({r.doc_id: r.text for r in awkward.where("doc_id is not null").collect()})
    assert {d: tuple(r)[1:] for d, r in one(rows).items()} == want
    assert len(rows) == awkward.count() and repeats.remove(nothing).count() == 0


def test_repeats_of_frequent_strings(spark, monkeypatch):
    monkeypatch.setattr(dealing, "LEAST_BYTES", 1000)
    r = np.random.default_rng(2)
    text = lambda n: "".join(r.choice(list("abcdefgh "), n))
    passage = text(160)
    docs = {i: text(int(r.integers(0, 90))) + passage[:int(r.integers(60, 160))] + text(int(r.integers(0, 200))) + ("ab" * 80 if i % 9 == 0 else "")
            for i in range(150)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    for frequent in (4, 4096):
        rows = repeats.remove(df, with_text=True, frequent=frequent).collect()
        assert {x.doc_id: tuple(x)[1:5] for x in rows} == repeated(docs)
        assert all(len(x.kept) == x.n_bytes - x.n_removed for x in rows)


def test_edges_of_frequent_strings_do_not_meet(spark):
    r = np.random.default_rng(3)
    text = lambda n: "".join(r.choice(list("abcdefgh "), n))
    passage, width, buckets = text(130), 100, 8
    df = spark.createDataFrame([(i, text(150) + passage + text(150)) for i in range(600)], "doc_id long, text string")
    slim = df.withColumn("cid", F.xxhash64("text", F.octet_length("text"))).repartition(3)
    _, found = repeats._found(slim, buckets, width, 64)
    held = {}
    for row in found.where("bucket >= 0").collect():
        for k, n in zip(np.frombuffer(row["keys"], np.uint64).tolist(), np.frombuffer(row["counts"], np.int64).tolist()):
            held[k] = held.get(k, 0) + n + width - 1
    # of a frequent anchor's windows one a bucket, of others fewer than 64 stretches
    assert len(held) >= 31 and max(held.values()) <= max(buckets * width, 64 * 2 * width)
    rows = repeats.remove(df, frequent=64).collect()
    assert {x.doc_id: tuple(x)[1:] for x in rows} == repeated({x.doc_id: x.text for x in df.collect()})


def test_decontamination(awkward, nothing, bench):
    rows = positional_index.matches(awkward, bench).collect()
    r = one(rows)
    assert len(rows) == awkward.count()
    assert [tuple(s) for s in r[1].spans] == [(2, 4)] and r[1].items == ["1"] and r[3].n_words == 0
    assert [tuple(s) for s in r[13].spans] == [(0, 1)] and r[13].items == []  # an item without an id
    assert r[6].items == ["20"]
    near = one(positional_index.matches(awkward, bench, slack=3).collect())
    assert near[1].items == ["1"]
    assert positional_index.matches(nothing, bench).count() == 0
    assert {tuple(x.spans) for x in positional_index.matches(awkward, bench.limit(0)).collect()} == {()}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x y beta"), (2, "beta alpha"), (3, "alpha beta"), (4, "alpha x x x beta")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")
    hits = {r.doc_id: [tuple(s) for s in r.spans] for r in positional_index.matches(docs, bench, slack=2).collect()}
    assert hits == {1: [(0, 3)], 2: [], 3: [(0, 1)], 4: []}


def test_proximity_of_repeated_words(spark):
    r = np.random.default_rng(4)
    texts = ["a b b x c", *(" ".join(r.choice(list("abcdx"), int(r.integers(0, 14)))) for _ in range(60))]
    windows = [("a", "b", "c"), ("b", "a", "b"), ("d", "c", "a"), ("a", "a", "d")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(windows)], "item_id long, text string")
    for slack in (1, 3):
        for row in positional_index.matches(docs, bench, slack=slack).collect():
            words = texts[row.doc_id].split()
            hits = {(i, p) for i, w in enumerate(windows) for p in itertools.combinations(range(len(words)), 3)
                    if all(words[a] == b for a, b in zip(p, w)) and all(b - a - 1 <= slack for a, b in zip(p, p[1:]))}
            assert row["items"] == sorted({str(i) for i, _ in hits})
            covered = {x for _, p in hits for x in range(p[0], p[-1] + 1)}
            assert {x for s in row.spans for x in range(s["first"], s["last"] + 1)} == covered


def test_benchmark_in_parts(awkward, bench, monkeypatch):
    whole = sorted(map(str, positional_index.matches(awkward, bench).collect()))
    monkeypatch.setattr(positional_index, "PART_WORDS", 1)
    assert sorted(map(str, positional_index.matches(awkward, bench).collect())) == whole


def test_packing(awkward, nothing):
    docs = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(packing.pieces(docs, vocabulary()).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert packing.pieces(nothing, vocabulary()).count() == 0
    assert {r.doc_id for r in packing.pieces(awkward, vocabulary()).collect()} == {r.doc_id for r in awkward.collect()}


def test_quality(awkward, nothing, labels):
    model = byte_convnet.fit(awkward, labels)
    rows = byte_convnet.scores(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert byte_convnet.scores(nothing, model).count() == 0
    assert {r.score for r in byte_convnet.scores(awkward, byte_convnet.fit(awkward, labels.limit(0))).collect()} == {1.0}
    assert byte_convnet.keep_good(awkward, labels).columns == awkward.columns


def test_network_features_by_hand():
    net = byte_convnet.Network()
    pairs = [(net.filters[k][:, None] + net.filters[k + 1][None, :]).reshape(65536, -1) for k in range(0, byte_convnet.WIDTH, 2)]
    texts = [b"", b"a", b"xyz" * 200, bytes(range(256)) * 5]
    data, offsets = textblocks.byte_view(pa.array(texts))
    got = byte_convnet.features(net, data, offsets, pairs)
    for t, row in zip(texts, got):
        raw = t + bytes(byte_convnet.WIDTH)
        response = np.array([sum(net.filters[k][raw[p + k]] for k in range(byte_convnet.WIDTH)) for p in range(max(len(t), 1))])
        starts = range(0, max(len(t) - byte_convnet.STEP, 1), byte_convnet.STEP)
        pooled = np.array([np.maximum(response[s:s + 2 * byte_convnet.STEP].max(0), 0) for s in starts])
        assert np.allclose(row, np.concatenate([pooled.mean(0), pooled.max(0)]), atol=1e-4)


def test_languages(awkward, nothing):
    model = string_kernel.fit(awkward)
    rows = string_kernel.predict(awkward, model).collect()
    r = one(rows)
    assert len(rows) == awkward.count()
    assert all(r[d].lang_pred == "und" and r[d].score == 0 for d in (3, 4, 5, 10)) and r[1].lang_pred in ("en", "de", "fr", "es")
    assert string_kernel.fit(nothing) is None
    assert {x.lang_pred for x in string_kernel.predict(awkward, None).collect()} == {"und"}


def test_urls(spark):
    urls = [(1, "http://A.Example.org/es/x"), (2, "https://example.org/en/12?q"), (3, "ftp://b.org/"), (4, "x.org/"), (5, None),
            (6, "http://z.com/fr/"), (7, "http://z.com/de/"), (8, "http://notexample.org/es/"), (9, "http://b.org"), (10, "http://")]
    pages = spark.createDataFrame([(i, u, "n") for i, u in urls], "page_id long, url string, n string")
    rows = one(url_reputation.verdicts(pages, spark.createDataFrame([(3, 0)] * 2, "page_id long, good int")).collect(), "page_id")
    assert [(rows[i].rule, rows[i].verdict) for i in (1, 2, 3, 6, 7, 8)] == [
        ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), ("com/fr/", "allow"), ("com/de/", "block"), ("org/", "allow")]
    assert (rows[4].host, rows[5].host, rows[5].path, rows[9].path, rows[9].rule) == ("", "", "", "", None)
    assert url_reputation.verdicts(pages.limit(0), pages.limit(0).selectExpr("page_id", "1 as good")).count() == 0


def test_bad_hosts_are_blocked(spark):
    pages = spark.range(400).selectExpr("id as page_id", "concat('http://', if(id % 4 = 0, 'bad', 'good'), '.site.net/', id) as url")
    rows = url_reputation.verdicts(pages, pages.selectExpr("page_id", "int(page_id % 4 <> 0) as good")).collect()
    assert {(r.host, r.verdict) for r in rows} == {("bad.site.net", "block"), ("good.site.net", "allow")}


WEIGHT = {"word": 1.0, "p": -0.05, "/p": -0.05, ".sidebar": -3.0, ".comments": -3.0, ".ad": -3.0}


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("just  text &amp; more", "just text & more"),
    ("<nav>a b c</nav><article><header><h1>T</h1></header><p>x <b>y</b>z</p><aside>no no</aside><p>w</p></article>", "T\nx yz\nw"),
    ("<div class='sidebar left'>a b</div><div id=main><p>c d e</p></div><div class=comments><p>f g h i</p></div>", "c d e"),
    ("<article><p>1 &lt; 2<br>3</p><script>var a='</p>'</script><form>x</form></article><footer>y", "1 < 2 3"),
    ("<form><p>never closed <article><p>kept text</p></article>", "kept text"),
    # an element that frames the page is no form beside the article
    ("<body><form action='/x'><h1>Head</h1><p>a b c d</p><p>e f g</p></form><footer>z</footer></body>", "Head\na b c d\ne f g"),
    ("<form><p>q</p><main><p>a b c d</p></main></form>", "a b c d"),
    # names that no labelled page has as something else than text say nothing
    ("<div class='share-price-table'><h1>Head</h1><p>a b c</p></div>", "Head\na b c"),
    ("<div class='search-results main'><p>a b c</p></div>", "a b c"),
    ("<article><p>a b</p><section id='related-work'><p>c d</p></section><p class='notice'>e f</p></article>", "a b\nc d\ne f"),
    ("<article><div class='article-header'><h1>T u</h1><p>lead a</p></div><p>b c</p></article>", "T u\nlead a\nb c"),
    ("<article><p>a b</p><div class='ad'>buy now</div><p>c d</p></article>", "a b\nc d"),
    ("<div class='ad'>buy<p>a b c", "a b c"),
    ("<aside><article><p>teaser x</p></article></aside><main><p>a b c</p></main>", "a b c"),
    ("<a href=x title='a > b'>link</a> if a < b <!-- <p> --> and c", "link if a < b and c"),
])
def test_page_text(page, text):
    assert page_text.extract(page, WEIGHT) == text


@pytest.mark.parametrize("piece", [
    "<div class='ad'>x", "<a \"' x", "<a b=\"' x", "<! x", "<script></script", "<nav><p>x</nav>", "</p><b>", "<", "<a b='x "])
def test_long_odd_pages(piece):
    begin = time.monotonic()
    page_text.extract(piece * (5_000_000 // len(piece)), WEIGHT)
    assert time.monotonic() - begin < 60


def test_marks_are_learned(spark):
    words = "one two three four five six seven eight nine ten"
    html = ("<div class='top-7 x'>buy this thing today</div><div class='text'><p>{0}</p><p class='aside-like'>{1}</p>"
            "<div id='r2'>more from our shop</div><p>{0} end</p></div>")
    pages = spark.createDataFrame([(i, "u", html.format(f"{words} {i}", f"and {words}")) for i in range(30)],
                                  "page_id long, url string, html string")
    known = spark.createDataFrame([(i, f"{words} {i}\nand {words}\n{words} {i} end") for i in range(30)], "page_id long, text string")
    weight = page_text.fit(pages, known)
    assert weight[".top"] < -3 and weight[".r"] < -3 and weight[".text"] == weight[".aside-like"] == 0
    assert one(page_text.texts(pages, weight).collect(), "page_id")[3].text == f"{words} 3\nand {words}\n{words} 3 end"


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a b</p>"), (1, "u", "<p>a b</p>"), (None, None, None)], "page_id long, url string, html string")
    weight = page_text.fit(pages, spark.createDataFrame([(1, "a b")], "page_id long, text string"))
    assert sorted(r.text for r in page_text.texts(pages, weight).collect()) == ["", "a b", "a b"]
    assert page_text.texts(pages.limit(0), weight).count() == 0


def test_licences(spark, nothing):
    files = spark.createDataFrame([
        ("/a/LICENSE", "Released under the MIT License.", 1), ("/a/b/c/x.py", "print", 2), ("/a/b/y.py", "p\n# Licensed under CC BY-NC 4.0.\n" + "q " * 50, 3),
        ("/z/w.py", None, 4), (None, "", 5), ("/a/b/LICENSE", "Licensed under the Apache License, Version 2.0.", 6), ("/a/v.py", "no licence here", 7)],
        "path string, text string, h long")
    rows = {r.h: (r.licence, r.origin, r.licence_dir) for r in licences.scan(files).collect()}
    assert rows == {1: ("MIT", "notice", None), 2: ("Apache-2.0", "directory", "/a/b"), 3: ("CC-BY-NC-4.0", "notice", None),
                    4: (None, None, None), 5: (None, None, None), 6: ("Apache-2.0", "notice", None), 7: ("MIT", "directory", "/a")}
    assert licences.scan(files.limit(0)).count() == 0


def test_wrapped_licences_and_full_texts(spark):
    wrap = lambda text, mark: "\n".join(textwrap.wrap(text, 60, initial_indent=mark, subsequent_indent=mark))
    gpl, bsd = (next(t for n, t in reversed(licences.TEMPLATES) if n == k) for k in ("GPL-3.0", "BSD-3-Clause"))
    code = "import os\n" + "\n".join(f"value{i} = os.path.join(root, 'n{i}')" for i in range(80))
    full = dict(t for t in licences.full_texts() if len(t[1]) > 700)
    files = {"/g/x.py": wrap(gpl, "# ") + "\n" + code, "/b/x.c": "/*\n" + wrap(bsd, " * ") + "\n */\n" + code,
             "/c/x.c": "/* Copyright 2001 A. Person */\n" + wrap(bsd, "// ") + "\n" + code,
             "/w/NOTE": wrap(bsd, ""), "/w/x.py": code, "/no/x.py": code + "\n# no licence here\n",
             "/agpl/x.py": wrap(dict(licences.HEADERS)["AGPL-3.0"], "# ") + "\n" + code,
             "/blank/x.py": "\n" * 50000 + wrap(gpl, "# ") + "\n" * 50000 + code}
    files |= {f"/full/{k}/COPYING": "Copyright (c) 2020 A. Person\n\n" + v for k, v in full.items()}
    files |= {f"/full/{k}/x.py": code for k in full}
    rows = {r.path: (r.licence, r.origin) for r in licences.scan(
        spark.createDataFrame(list(files.items()), "path string, text string")).collect()}
    want = {"/g/x.py": ("GPL-3.0", "notice"), "/b/x.c": ("BSD-3-Clause", "notice"), "/c/x.c": ("BSD-3-Clause", "notice"),
            "/w/NOTE": ("BSD-3-Clause", "notice"), "/w/x.py": ("BSD-3-Clause", "directory"), "/no/x.py": (None, None),
            "/agpl/x.py": ("AGPL-3.0", "notice"), "/blank/x.py": ("GPL-3.0", "notice")}
    want |= {f"/full/{k}/COPYING": (k, "notice") for k in full} | {f"/full/{k}/x.py": (k, "directory") for k in full}
    assert rows == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 3), (5, 5), (101, 100)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=200).map(lambda b: bytes(x % 3 + 97 for x in b) + b"\xff"))
def test_suffix_arrays(raw):
    text = np.frombuffer(raw, np.uint8)
    words = suffix_sort.words_at(text, 208)
    array = suffix_sort.suffix_array(text, words, 208)
    assert array.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = suffix_sort.common_prefixes(array, words, 100)
    for a, b, n in zip(array[:-1], array[1:], shared[1:]):
        x, y = raw[a:].ljust(300, b"\xff"), raw[b:].ljust(300, b"\xff")
        assert n == min(100, next((i for i in range(300) if x[i] != y[i]), 300))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=12), min_size=1, max_size=40))
def test_signature_trees(sets):
    parent = list(range(len(sets)))

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    tokens = np.array([t for s in sets for t in s], np.uint64)
    label = signature_tree.links(tokens, np.array([len(s) for s in sets]))
    want = [top(i) for i in range(len(sets))]
    assert len(set(zip(want, label.tolist()))) == len(set(want)) == len(set(label.tolist()))


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), min_size=1, max_size=5), st.integers(1, 90))
def test_bin_slack(counts, room):
    order = sorted(counts.items(), reverse=True)
    sums = {0}
    for k, n in order:
        sums = {s + i * k for s in sums for i in range(n + 1) if s + i * k <= room}
    best, taken = packing.fill(order, room)
    assert best == max(sums) == sum(k * n for k, n in taken.items()) and all(n <= counts[k] for k, n in taken.items())


def test_trees_take_many_pairs_at_once(monkeypatch):
    """Sets that share too little to be linked: every pair of nodes used to be a step of its own."""
    rng = np.random.default_rng(5)
    common = np.arange(30, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, rng.integers(100, 400, 12).astype(np.uint64)])) for _ in range(600)]
    steps, step = [], signature_tree.Tree._step
    monkeypatch.setattr(signature_tree.Tree, "_step", lambda self, *args: steps.append(1) or step(self, *args))
    label = signature_tree.links(np.concatenate(sets), np.array([len(s) for s in sets]))
    linked = [(i, j) for i in range(600) for j in range(i) if signature_tree.linked(
        len(np.intersect1d(sets[i], sets[j], assume_unique=True)), len(sets[i]), len(sets[j]))]
    assert all(label[i] == label[j] for i, j in linked) and len(set(label)) > 100
    assert 0 < len(steps) < 1000
