"""Kernel, ridge regression and pieces against plain computations; long and noisy texts."""

import random
import zlib

import numpy as np
import pytest

from daybook.llm import string_kernel as sk

WORDS = {"en": "the quick brown fox jumps over lazy dogs while seven wizards think about bread",
         "de": "der schnelle braune fuchs springt über faule hunde während sieben zauberer denken",
         "xx": "zo qua li mu nar teb zoo lum qir nab tuz lam qen bur zin mol"}


def text_of(lang, n, seed, noise=0.0):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) if draw.random() < noise
                    else draw.choice(WORDS[lang].split()) for _ in range(n))


def grams(raw: bytes) -> set:
    quiet = bytes(sk._QUIET[b] for b in raw)
    return {quiet[i:i + k] for k in sk.ORDERS for i in range(len(quiet) - k + 1)}


@pytest.fixture(scope="module")
def training():
    return [(text_of(lang, 60, seed).encode(), lang) for lang in WORDS for seed in range(9)]


@pytest.fixture(scope="module")
def model(training):
    return sk.Model([t for t, _ in training], [v for _, v in training])


def test_presence_is_exact(model):
    texts = [b"", b"a", "Über FAULE hunde 12 \xff".encode(), text_of("xx", 500, 3).encode()]
    x = model.vocabulary.presence(*sk._joined(texts))
    names = [int(c & np.uint64(0xFFFFFFFF)).to_bytes(int(c) >> 32, "big") for c in model.vocabulary.known]
    for row, t in zip(x, texts):
        assert {names[i] for i in np.flatnonzero(row)} == grams(t) & set(names)


def test_kernel_and_ridge(model, training):
    every = [grams(t) for t, _ in training]
    picked = [i for lang in sorted(WORDS) for i in [k for k, (_, v) in enumerate(training) if v == lang][:sk.LANDMARKS]]
    known = {g for g in set.union(*every) if sum(g in every[i] for i in picked) >= sk.SHARED}
    sets = [e & known for e in every]
    kernel = np.array([[len(a & sets[z]) / np.sqrt(len(a) * len(sets[z])) for z in picked] for a in sets])
    values, vectors = np.linalg.eigh(kernel[picked])
    good = values > 1e-6 * values.max()
    phi = np.hstack([kernel @ vectors[:, good] / np.sqrt(values[good]), np.ones((len(sets), 1))])
    target = np.array([[1.0 if v == lang else -1.0 for lang in sorted(WORDS)] for _, v in training])
    weight = np.full((len(sets), 1), 1 / 9)
    beta = np.linalg.solve((phi * weight).T @ phi + sk.RIDGE * np.eye(phi.shape[1]), (phi * weight).T @ target)
    assert np.abs(model.margins(*sk._joined([t for t, _ in training])) - phi @ beta).max() < 1e-3


def test_pieces_cover_whole_texts(model):
    lengths = [0, 1, sk.PIECE, sk.PIECE + 1, 5 * sk.PIECE - 7, 0]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    cuts, owner = sk.pieces(offsets)
    assert np.bincount(owner).tolist() == [1, 1, 1, 2, 5, 1] and np.diff(cuts).max() <= sk.PIECE
    assert np.bincount(owner, weights=np.diff(cuts)).tolist() == lengths
    raw = text_of("de", 4000, 1).encode()
    whole = model.margins(*sk._joined([raw]))[0]
    parts = [raw[i:i + sk.PIECE] for i in range(0, len(raw), sk.PIECE)]
    each = np.array([model.margins(*sk._joined([p]))[0] for p in parts])
    assert np.abs(whole - np.average(each, 0, [len(p) for p in parts])).max() < 1e-6


@pytest.mark.parametrize("n", [15_000, 150_000, 750_000])  # about 0.1, 1 and 5 MB
def test_long_noisy_texts(model, n):
    texts = [text_of(lang, n, 7, noise=0.1).encode() for lang in sorted(WORDS)]
    best, score = model.decide(*sk._joined(texts))
    assert [model.langs[b] for b in best] == sorted(WORDS) and score.min() > 0.5


def test_many_languages_and_a_hot_one(spark):
    rows = [(i, text_of("en" if i % 3 else "de", 30, i), "en" if i % 3 else f"l{i % 40}") for i in range(3000)]
    found = sk.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert found.langs == sorted({v for i, _, v in rows if zlib.crc32(str(i).encode()) % 5})
