"""Prefix trie, repeated windows of words and whitening against plain computations."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import doubling, prefix_trie, registry, whitening

WORDS = r"[^\x20\x09-\x0D]+"


def rebuild(turns: list[tuple]) -> dict[int, list[tuple]]:
    """conv_id -> rebuilt (role, text) turns, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, k, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[c].append(((k is not None, k or 0), digest, role, text))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def trie(convs: dict[int, list[tuple]]) -> Counter:
    """All nodes by their whole prefixes."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        own = (len(cs) - 1) * len(re.findall(WORDS, p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += not children[p]
    return Counter((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, cs in members.items())


TURNS = "conv_id long, turn long, role string, text string, key string, part int, words int, depth long"


def turns_of(spark, turns):
    return spark.createDataFrame([(*t, "k", 1, 2, 3) for t in turns], TURNS)


@pytest.fixture
def many_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_over_many_partitions(spark, many_parts, seed):
    draw = random.Random(seed)
    turns = []
    for c in range(-40, 400):
        # few texts, so prefixes of all depths are shared; a third of all are one conversation
        n = draw.choice([1, 2, 3, 4, 9])
        texts = ["same words here", "again"] if c % 3 == 0 else [draw.choice(["a b", "c", "", "dé e\tf"]) for _ in range(n)]
        turns += [(c, k if k else None, draw.choice(["user", None]) if c % 3 else "user", t) for k, t in enumerate(texts)]
    draw.shuffle(turns)
    found = prefix_trie.nodes(prefix_trie.rebuilt(turns_of(spark, turns))).collect()
    assert Counter(map(tuple, found)) == trie(rebuild(turns))


def test_trie_of_odd_rows(spark):
    turns = [(None, 1, "user", "x"), (20, None, None, None), (20, 1, "user", "a"), (20, 1, "user", "a"), (27, 5, "user", None),
             (29, 1, "user", "b"), (2 ** 40, 1, "user", "w " * 300_000), (60, 2, "r", ""), (60, 2, None, "r")]
    turns += [(41, k, "user", f"t{k}") for k in range(150)] + [(42, k, "user", f"t{k}") for k in range(140)]
    found = prefix_trie.nodes(prefix_trie.rebuilt(turns_of(spark, turns))).collect()
    assert Counter(map(tuple, found)) == trie(rebuild(turns))
    assert prefix_trie.nodes(prefix_trie.rebuilt(turns_of(spark, [(None, 1, "a", "b")]))).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=5).map(tuple), min_size=1, max_size=25))
def test_forest(paths):
    items = sorted(set(paths))
    count = Counter(paths)
    words = [np.array([w + 1 for w in p], np.int64) for p in items]
    shared = [next((d for d, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(items, items[1:])]
    forest = prefix_trie.Forest([len(p) for p in items], [count[p] for p in items], list(range(len(items))), words)
    root = forest.grow(shared)
    nodes = {p[:d] for p in items for d in range(len(p) + 1)}
    inner = {p for p in nodes if p in items or p == () or len({q for q in nodes if q[:-1] == p and q}) > 1}
    assert len(forest.depth) == len(inner)
    assert forest.n[root] == len(paths)
    assert forest.leaves[root] == sum(not any(q[:-1] == p for q in nodes if q) for p in nodes)
    assert forest.saved[root] == sum((sum(c for q, c in count.items() if q[:len(p)] == p) - 1) * (p[-1] + 1) for p in nodes if p)


def without_windows(rows: list[tuple], width: int) -> Counter:
    split = [(i, re.findall(WORDS, t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        for k in range(len(w) - width + 1):
            if i is not None:
                x = tuple(w[k:k + width])
                least[x] = min(least.get(x, i), i)
    out = Counter()
    for i, w in split:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - width + 1):
            first = least.get(tuple(w[k:k + width]))
            if first is not None and (i is None or first < i):
                gone[k:k + width] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i, len(w), int(gone.sum()), int((gone & ~np.concatenate([[False], gone])[:-1]).sum()), kept] += 1
    return out


@pytest.mark.parametrize("width", [13, 4, 1])
def test_windows_over_many_blocks(spark, many_parts, width):
    draw = random.Random(width)
    passages = [[draw.choice(["x", "y", "Zé", "w1"]) for _ in range(draw.choice([5, 13, 40]))] for _ in range(12)]
    rows = []
    for i in range(300):
        words = [w for _ in range(draw.randrange(4)) for w in
                 (draw.choice(passages) if draw.random() < 0.5 else [f"u{draw.randrange(40)}" for _ in range(draw.randrange(15))])]
        rows.append((None if i % 50 == 7 else i // 2 * 2 if i % 9 == 0 else i, draw.choice([" ", "\n", " \t "]).join(words)))
    rows += [(400 + i, " ".join(passages[0] * 3)) for i in range(150)]  # a third are one text
    docs = spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id long, text string, block string, name long")
    found = doubling.remove(docs.repartition(7), width, block=2000).collect()
    assert Counter(map(tuple, found)) == without_windows(rows, width)


def test_windows_of_the_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: (r[1], r[2], hashlib.sha256(r[4].encode()).hexdigest(), r[3]) for r in without_windows(rows, 13)}
    assert {r[0]: tuple(r)[1:] for r in registry.QUERIES["op12_doubling"](spark, folder).collect()} == want


def test_windows_of_odd_texts(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert Counter(map(tuple, doubling.remove(awkward).collect())) == without_windows(rows, 13)
    assert doubling.remove(nothing).collect() == []
    long = " ".join(f"w{i}" for i in range(400_000))  # 2.7 MB, and one word of 3 MB
    rows = [(1, long), (2, "v " + long), (3, "z" * 3_000_000 + " tail " * 20), (4, "z" * 3_000_000 + " tail " * 20)]
    found = {r.doc_id: (r.n_words, r.n_removed) for r in doubling.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (400_000, 0), 2: (400_001, 400_000), 3: (21, 0), 4: (21, 21)}


def whitened(vectors: np.ndarray, components: int = 32):
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    y = (n * x - s) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    return ((n * x - s) ** 2).sum(1), y @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


def check_whitened(rows, ids, deviation, z, explained):
    at = {i: k for k, i in enumerate(ids)}
    got = np.zeros_like(z)
    for r in rows:
        assert (r.n, r.deviation) == (len(ids), deviation[at[r.vec_id]])
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        got[at[r.vec_id], r.component - 1] = r.whitened
    assert len(rows) == z.size
    sign = np.sign((got * z).sum(0))
    assert np.abs(got * sign - z).max() < 1e-6


def test_whitening_of_the_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    check_whitened(registry.QUERIES["op13_block_whitening"](spark, folder).collect(), [r.vec_id for r in rows],
                   *whitened(np.array([r.embedding for r in rows])))


VECTORS = "vec_id long, embedding array<float>, index long, part int"


def test_whitening_of_odd_rows(spark):
    draw = np.random.default_rng(3)
    fine = draw.normal(size=(3000, 5)) * [1000, 30, 3, 1, 1] + [0, 5e4, 0, 0, -7]
    fine[1000:2000] = fine[0]  # a third of all rows are one vector
    fine = fine.astype(np.float32)
    rows = [(i, v.tolist(), 5, 6) for i, v in enumerate(fine)]
    odd = [(-1, None, 1, 1), (-2, [1.0, None, 1.0, 1.0, 1.0], 1, 1), (-3, [float("nan")] * 5, 1, 1),
           (-4, [float("inf")] * 5, 1, 1), (-5, [], 1, 1), (-6, [1.0, 2.0], 1, 1)]
    df = spark.createDataFrame(rows + odd, VECTORS).repartition(5)
    check_whitened(whitening.whiten(df).collect(), list(range(3000)), *whitened(fine))
    none = spark.createDataFrame(odd[:5], VECTORS)
    assert whitening.whiten(none).collect() == [] and whitening.whiten(none.limit(0)).columns == whitening.whiten(df).columns
    same = spark.createDataFrame([(1, [2.0, 3.0], 1, 1), (2, [2.0, 3.0], 1, 1)], VECTORS)
    assert whitening.whiten(same).collect() == []
    flat = spark.createDataFrame([(i % 4, [float(i % 7), 2.0 * (i % 7)], 1, 1) for i in range(70)], VECTORS)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1} and whitening.whiten(flat).count() == 70


def test_deviation_beyond_64_bits(spark):
    big = spark.createDataFrame([(i, [float(i) * 2.0 ** 40, 1.0], 1, 1) for i in range(4)], VECTORS)
    assert {r.deviation for r in whitening.whiten(big).collect()} == {None}
