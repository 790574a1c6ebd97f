"""Every query of the subpackage against SQL or a plain computation over the same tables."""

import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from checks.compare import differences
from daybook.llm import registry
from daybook.llm.tables import stored


def near_components(texts: dict) -> dict:
    """(number of shingles, smallest linked id) of each document, by comparing all pairs that share a shingle."""
    sets, holders = {}, defaultdict(list)
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        for s in sets[d]:
            holders[s].append(d)
    parent = {d: d for d in texts}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {d: (len(sets[d]), top(d)) for d in texts}


def repeated(texts: dict, width: int = 100) -> dict:
    seen, out = set(), {}
    for d in sorted(texts):
        raw = (texts[d] or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - width + 1):
            if raw[i:i + width] in seen:
                gone[i:i + width] = True
            seen.add(raw[i:i + width])
        rest = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[d] = (len(raw), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(rest).hexdigest())
    return out


def check_packing(rows, texts: dict) -> None:
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(registry.vocabulary())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for d, t in texts.items():
        ids, at = np.array(encoder.encode(t or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and (at & (at - 1)) == 0  # full, or a power of two: no padding


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql(spark, con, folder, name):
    assert differences(registry.QUERIES[name](spark, folder), con, registry.ORACLE[name]) == []


def test_native_plan(spark, folder):
    plan = registry.QUERIES["op1_licences"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_suffix_array(spark, folder, texts):
    found = {r[0]: tuple(r)[1:] for r in registry.QUERIES["op2_suffix_array"](spark, folder).collect()}
    assert found == repeated(texts)


def test_signature_tree(spark, folder, texts):
    found = {r[0]: tuple(r)[1:] for r in registry.QUERIES["op5_signature_tree"](spark, folder).collect()}
    assert found == near_components(texts)


def test_packing(spark, folder, texts):
    check_packing(registry.QUERIES["op10_min_bin_slack"](spark, folder).collect(), texts)


def test_pages(spark, folder, texts):
    for r in registry.QUERIES["op8_scored_regions"](spark, folder).join(
            spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html"), "page_id").collect():
        shown = int(re.search(r"/(\d+)", r.url.split("://")[1])[1])
        title = " ".join(html.unescape(re.search("<h1>(.*?)</h1>", r.html, re.S)[1]).split())
        lines = [" ".join(x.split()) for x in texts[shown].split("\n") if x.strip()]
        assert r.text == "\n".join(([title] if title else []) + lines)
        assert r.n_chars == len(r.text)


def _auc(label, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = registry.QUERIES["op4_byte_convnet"](spark, folder).join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    label, score = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert _auc(label, score) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_languages_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = registry.QUERIES["op9_string_kernel"](spark, folder).join(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r.lang == r.lang_pred for r in rows if r.held_out and r.lang]
    assert np.mean(held) > 0.97


def test_pipeline_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.dtypes
    benchmark = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[i:i + 10]) for w in map(words, benchmark) if w for i in range(max(1, len(w) - 9))}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, folder), name)
        if name == "pack":
            check_packing(docs.collect(), before)
            continue
        assert docs.dtypes == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.items() <= before.items()
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
            kept = Counter((labels[d], d in after) for d in before if d in labels)
            assert kept[1, True] > 20 * kept[1, False] and kept[0, False] > kept[0, True]
        if name == "exact_dedup":
            group = defaultdict(list)
            for d, t in before.items():
                group[re.sub(r"[\x20\x09-\x0D]+", "", t or "")].append((-len(t or ""), d))
            assert set(after) == {min(g)[1] for g in group.values()}
        if name == "near_dedup":
            assert set(after) == {d for d, (_, c) in near_components(before).items() if d == c}
        if name == "decontaminate":
            assert set(after) == {d for d, t in before.items()
                                  if not any(tuple(w[i:i + n]) in windows for w in [words(t)] for n in range(1, 11)
                                             for i in range(len(w) - n + 1))}


def test_run_is_the_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
