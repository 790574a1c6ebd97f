"""Language identification by a string kernel with Nyström landmarks and ridge regression.

Two pieces of text are compared by the n-grams of one to four bytes that occur in both (presence,
blended spectrum), over the root of the product of their numbers of n-grams. Only n-grams count
that several landmarks have; each has a number of its own, none share one. Landmark pieces span the
feature space: K(x, landmarks) times the inverse root of the landmarks' own kernel matrix. On these
features one ridge regression per language separates it from the rest.

In a long text nearly every n-gram occurs somewhere, so presence says little of it. Every text is
therefore read as pieces of one size, all of them, and its margins are the mean of theirs. A block
of pieces is scored by two matrix products: its presence matrix with the landmarks', and that
kernel block with the regression's coefficients.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb
from daybook.llm.tables import held_out, small

ORDERS = (1, 2, 3, 4)
#: Bytes of a piece; landmarks and training texts of each language, and pieces of each of these
#: texts, spread evenly over the whole of it.
PIECE = 4096
LANDMARKS = 24
SAMPLE_DOCS = 400
SAMPLE_PIECES = 3
RIDGE = 1e-2
BATCH_PIECES = 128
SLICE_BYTES = 1 << 20
#: Landmarks that must have an n-gram for it to count.
SHARED = 2
_SLOTS = 20
_FOUND = "doc_id long, held_out boolean, lang_pred string, score double"
_QUIET = np.arange(256, dtype=np.uint8)  # letters in lower case, other ASCII as a blank
_QUIET[:0x80] = 0x20
_QUIET[0x61:0x7B] = np.arange(0x61, 0x7B)
_QUIET[0x41:0x5B] = np.arange(0x61, 0x7B)


def codes(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text index and exact number of all n-grams, one order after the other."""
    low = _QUIET[data].astype(np.uint64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    code = np.zeros(len(low), np.uint64)
    for k in ORDERS:
        m = len(low) - k + 1
        if m <= 0:
            break
        code = code[:m] << tb.U64(8) | low[k - 1:k - 1 + m]
        own = row[:m] == row[k - 1:k - 1 + m]
        yield row[:m][own], code[own] | tb.U64(k << 32)


class Vocabulary:
    """Places of known n-grams, found by tables of slots; those whose slot is taken are in the next one."""

    def __init__(self, known: np.ndarray):
        self.known, self.tables = known, []
        rest = np.arange(len(known))
        while len(rest):
            slot = self._slot(known[rest], len(self.tables))
            table = np.full(1 << _SLOTS, -1, np.int32)
            table[slot[::-1]] = rest[::-1]
            self.tables.append(table)
            rest = rest[table[slot] != rest]

    def _slot(self, code: np.ndarray, turn: int) -> np.ndarray:
        return (code * tb.U64(0x9E3779B97F4A7C15 + 2 * turn) >> tb.U64(64 - _SLOTS)).astype(np.int64)

    def presence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row of 0 and 1 per text: the known n-grams it has."""
        out = np.zeros((len(offsets) - 1, len(self.known)), np.uint8)
        for row, code in codes(data, offsets):
            for turn, table in enumerate(self.tables):
                place = table[self._slot(code, turn)]
                hit = place >= 0
                hit[hit] = self.known[place[hit]] == code[hit]
                out[row[hit], place[hit]] = 1
                if turn + 1 < len(self.tables):
                    row, code = row[~hit], code[~hit]
        return out


def pieces(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the pieces that texts are read in, and the text of each; an empty text is one piece."""
    n = np.maximum(-(-np.diff(offsets) // PIECE), 1)
    owner = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return np.append(offsets[owner] + within * PIECE, offsets[-1]), owner


class Model:
    """Known n-grams, landmarks' presence (n-grams by landmarks) and coefficients (landmarks by languages)."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.langs = sorted(set(langs))
        label = np.array([self.langs.index(v) for v in langs])
        picked = np.concatenate([np.flatnonzero(label == k)[:LANDMARKS] for k in range(len(self.langs))])
        grams = [np.unique(np.concatenate([c for _, c in codes(*_joined([texts[i]]))] or [np.zeros(0, np.uint64)])) for i in picked]
        known, times = np.unique(np.concatenate(grams), return_counts=True)
        self.vocabulary = Vocabulary(known[times >= min(SHARED, len(picked))])
        x = self.vocabulary.presence(*_joined(texts))
        self.landmarks = np.ascontiguousarray(x[picked].T.astype(np.float32))
        self.norms = x[picked].sum(1).astype(np.float32)
        own = self.kernel(x[picked])
        values, vectors = np.linalg.eigh(own.astype(np.float64))
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        phi = self.kernel(x).astype(np.float64) @ root
        phi1 = np.hstack([phi, np.ones((len(phi), 1))])
        weight = 1 / np.bincount(label)[label]  # languages count alike
        target = np.where(label[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        gram = (phi1 * weight[:, None]).T @ phi1 + RIDGE * np.eye(phi1.shape[1])
        beta = np.linalg.solve(gram, (phi1 * weight[:, None]).T @ target)
        self.coefficients, self.bias = (root @ beta[:-1]).astype(np.float32), beta[-1].astype(np.float32)

    def kernel(self, x: np.ndarray) -> np.ndarray:
        """Kernel block of pieces (rows of presence) and landmarks, by one matrix product."""
        shared = x.astype(np.float32) @ self.landmarks
        size = np.maximum(x.sum(1, dtype=np.int64), 1).astype(np.float32)
        return shared / np.sqrt(size[:, None] * np.maximum(self.norms, 1)[None, :])

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean margins of each text's pieces, weighted by their lengths."""
        cuts, owner = pieces(offsets)
        out, total = np.zeros((len(offsets) - 1, len(self.langs))), np.zeros(len(offsets) - 1)
        for at in range(0, len(owner), BATCH_PIECES):
            own, cut = owner[at:at + BATCH_PIECES], cuts[at:at + BATCH_PIECES + 1]
            margin = self.kernel(self.vocabulary.presence(data[cut[0]:cut[-1]], cut - cut[0])) @ self.coefficients + self.bias
            weight = np.maximum(np.diff(cut), 1)
            np.add.at(out, own, margin * weight[:, None])
            np.add.at(total, own, weight)
        return out / np.maximum(total, 1)[:, None]

    def decide(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margin = self.margins(data, offsets)
        e = np.exp(4.0 * (margin - margin.max(1, keepdims=True)))
        p = e / e.sum(1, keepdims=True)
        best = p.argmax(1)
        return best, p[np.arange(len(p)), best]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), ends


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of sampled texts, the first and the last among them."""
    for batch in batches:
        for lang, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text"))):
            raw = text.encode("utf-8", "replace")
            starts = range(0, max(len(raw) - PIECE, 0) + PIECE, PIECE)
            n = min(SAMPLE_PIECES, len(starts))
            picked = [starts[round(i * (len(starts) - 1) / max(n - 1, 1))] for i in range(n)]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * n), pa.array([h] * n), pa.array(range(n), pa.int32()),
                pa.array([raw[a:a + PIECE] for a in picked], pa.binary())], names=["lang", "h", "at", "piece"])


def fit(docs: DataFrame) -> Model | None:
    """Learns from documents with an id and a language that are not held out; None if there are none.

    Of each language, however many there are, the ``SAMPLE_DOCS`` texts with the lowest hashed ids
    are learned from, each by at most ``SAMPLE_PIECES`` pieces from all over it. The first pieces of
    the first ``LANDMARKS`` texts are the landmarks.
    """
    h = F.xxhash64(F.col("doc_id").cast("string"))
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
                       & F.col("text").rlike(r"\p{L}")).withColumn("h", h)
    # keys first, cut by hash to about twice the sample, so that no language is sorted as a whole
    share = F.least(F.lit(1.0), 2.0 * SAMPLE_DOCS / F.col("n"))
    low = F.shiftrightunsigned("h", 11) < share * 2.0 ** 53
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    keys = known.select("doc_id", "lang", "h").join(small(counts), "lang").where(low).select("doc_id", "lang", "h").distinct()
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = keys.withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLE_DOCS).select("doc_id", "lang")
    rows = (known.select("doc_id", "lang", "h", "text").join(small(picked), ["doc_id", "lang"])
            .select("lang", "h", "text").mapInArrow(tb.tidy(_spread), "lang string, h long, at int, piece binary").distinct().collect())
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r["at"], r.h & (2 ** 64 - 1), bytes(r.piece)))
    return Model([bytes(r.piece) for r in rows], [r.lang for r in rows])


def _predictor(model: Model) -> Callable:
    def predictor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tb.slices(batch, "text", SLICE_BYTES):
                best, score = model.decide(*tb.byte_view(piece.column("text")))
                mute = ~piece.column("spoken").to_numpy(zero_copy_only=False)
                lang = [None if m else model.langs[b] for m, b in zip(mute.tolist(), best.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("held_out"),
                     pa.array([v or "und" for v in lang], pa.string()), pa.array(np.where(mute, 0.0, score))],
                    names=["doc_id", "held_out", "lang_pred", "score"])
    return predictor


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    The whole text is read. Null texts, texts without a letter and, without a model, all texts are
    ``und`` with score 0. Rows without an id are not held out. Other columns are not looked at.
    """
    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       spoken.alias("spoken"), "text")
    if model is None:
        return slim.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return slim.mapInArrow(tb.tidy(_predictor(model)), _FOUND)
