"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: one stored row per block of documents holds the block's
postings, the ascending positions of each term in the block. A gap between documents keeps matches
inside them. Benchmark windows are then answered block by block: candidates come from the rarest
term of a window in that block, and the postings of its other terms, moved back by their offsets,
are intersected one after another in order of rarity. The executors make and store the windows in
parts of a bounded size; these travel to the blocks round by round, one bounded round at a time in
the driver. No document text or posting is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb
from daybook.llm.tables import by_row, narrow, stored, without_rows

BLOCK_BYTES = 512 << 10
#: Benchmark windows that the executors are sent at once (about 70 bytes each); a larger benchmark
#: goes in several rounds.
PART_WORDS = 500_000
_INDEX = "ids binary, nulls binary, lengths binary, terms binary, counts binary, positions binary"
_PARTS = "size int, n long, items array<string>, vocabulary binary, matrix binary, owner binary, owners binary"


def _tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and words per text."""
    data, offsets = tb.byte_view(text)
    starts, ends, doc = tb.words(data, offsets, tb.NOT_WORD)
    return tb.word_hashes(data, starts, ends), np.bincount(doc, minlength=len(text))


def _build(gap: int) -> Callable:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(batches, "text", BLOCK_BYTES):
            hashes, lengths = _tokens(block.column("text"))
            base = np.cumsum(lengths + gap) - (lengths + gap)
            where = tb.ranges(base, lengths).astype(np.uint32)
            order = np.argsort(hashes, kind="stable")
            terms, first, counts = np.unique(hashes[order], return_index=True, return_counts=True)
            ids = block.column("doc_id")
            fields = (ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                      ids.is_null().to_numpy(zero_copy_only=False), lengths.astype(np.int64),
                      terms, counts.astype(np.uint32), where[order])
            yield pa.RecordBatch.from_arrays(
                [pa.array([f.tobytes()], pa.binary()) for f in fields],
                names=[f.split()[0] for f in _INDEX.split(", ")])
    return build


def index(docs: DataFrame, gap: int) -> DataFrame:
    """Stores the postings of all words of all documents, one row per block of documents."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = slim.mapInArrow(tb.tidy(_build(gap)), _INDEX)
    return stored(blocks.withColumn("block", F.monotonically_increasing_id()), "postings")


class Windows:
    """A part of the benchmark: its distinct windows of equal length, as places in a sorted vocabulary, and their items."""

    def __init__(self, row: dict):
        self.items = row["items"]
        self.vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        self.matrix = np.frombuffer(row["matrix"], np.uint32).reshape(-1, row["size"])
        self.owner, self.owners = np.frombuffer(row["owner"], np.int64), np.frombuffer(row["owners"], np.int64)


def _cutter(size: int, most: int) -> Callable:
    """Items to the rows of ``_PARTS``, of about ``most`` windows each; a long item is cut."""
    def part(items: list, held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for n, chunks in held.items():
            keys, window = np.unique(np.concatenate([c for c, _ in chunks]), axis=0, return_inverse=True)
            item = np.repeat([k for _, k in chunks], [len(c) for c, _ in chunks])
            pairs = np.unique(np.stack([window.reshape(-1), item], 1), axis=0)
            vocabulary, matrix = np.unique(keys, return_inverse=True)
            fields = vocabulary, matrix.astype(np.uint32), pairs[:, 1], np.bincount(pairs[:, 0], minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([items], pa.list_(pa.string())),
                 *(pa.array([x.tobytes()], pa.binary()) for x in fields)],
                names=[x.split()[0] for x in _PARTS.split(", ")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, held, total = [], {}, 0
        for batch in batches:
            for name, text in zip(batch.column("item_id").to_pylist(), batch.column("text")):
                hashes, _ = _tokens(pa.array([text.as_py()], pa.string()))
                if not len(hashes):
                    continue
                n = min(size, len(hashes))
                view = np.lib.stride_tricks.sliding_window_view(hashes, n)
                for at in range(0, len(view), most):
                    if not at or not items:
                        items.append(name)
                    held.setdefault(n, []).append((view[at:at + most], len(items) - 1))
                    total += len(held[n][-1][0])
                    if total >= most:
                        yield from part(items, held)
                        items, held, total = [], {}, 0
        if total:
            yield from part(items, held)
    return cut


def windows(bench: DataFrame, size: int) -> DataFrame:
    """Stores the benchmark's windows in parts of at most about ``PART_WORDS``, made by the executors."""
    slim = bench.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    held = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a word and what follows it take two bytes or more
    dealt = slim.repartition(1 + held // (2 * PART_WORDS), F.xxhash64("item_id", "text"))
    parts = dealt.mapInArrow(tb.tidy(_cutter(size, PART_WORDS)), _PARTS)
    return stored(parts.withColumn("part", F.monotonically_increasing_id()), "windows")


def _rounds(parts: DataFrame) -> list[list[int]]:
    """Numbers of parts that go out together: at most ``PART_WORDS`` windows, or one part."""
    rounds, total = [], 0
    for part, n in sorted(map(tuple, parts.select("part", "n").collect())):
        if not rounds or total + n > PART_WORDS:
            rounds.append([])
            total = 0
        rounds[-1].append(part)
        total += n
    return rounds


class Postings:
    """The inverted index of one block."""

    def __init__(self, row: pd.Series):
        self.terms = np.frombuffer(row.terms, np.uint64)
        self.counts = np.frombuffer(row.counts, np.uint32).astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        positions = np.frombuffer(row.positions, np.uint32).astype(np.int64)
        # postings of all terms in one ascending array, so that a lookup is one binary search
        self.keys = (np.repeat(np.arange(len(self.terms)), self.counts) << 33) | positions
        self.positions = positions

    def find(self, words: np.ndarray) -> np.ndarray:
        """Term numbers of words, -1 where the block does not have them."""
        at = np.minimum(np.searchsorted(self.terms, words), max(len(self.terms) - 1, 0))
        return np.where(self.terms[at] == words, at, -1) if len(self.terms) else np.full(words.shape, -1)

    def search(self, part: Windows, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window numbers, first and last positions of their occurrences.

        With ``slack`` 0 the words stand next to each other. Otherwise they stand in order, and
        each at most ``slack`` positions further on than right after its predecessor.
        """
        known = self.find(part.vocabulary)
        window = np.flatnonzero((known >= 0)[part.matrix].all(axis=1))
        ids = known[part.matrix[window]]
        rows, size = np.arange(len(window)), part.matrix.shape[1]
        if slack:
            return self._near(window, ids, slack)
        order = np.argsort(self.counts[ids], axis=1, kind="stable")  # rarest first
        rarest = ids[rows, order[:, 0]] if len(window) else np.zeros(0, np.int64)
        n = self.counts[rarest]
        row = np.repeat(rows, n)
        start = self.positions[tb.ranges(self.first[rarest], n)] - order[row, 0]
        for k in range(1, size):
            offset = order[row, k]
            keep = self._has(ids[row, offset], start + offset)
            row, start = row[keep], start[keep]
        return window[row], start, start + size - 1

    def _has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (term << 33) | np.maximum(position, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (position >= 0)

    def _near(self, window, ids, slack):
        """All reachable places of a window's words, spread in both directions from its rarest word."""
        rows, size = np.arange(len(window)), ids.shape[1]
        rare = self.counts[ids].argmin(axis=1) if len(window) else np.zeros(0, np.int64)
        n = self.counts[ids[rows, rare]] if len(window) else np.zeros(0, np.int64)
        row = np.repeat(rows, n)
        start = self.positions[tb.ranges(self.first[ids[rows, rare]], n)] if len(window) else np.zeros(0, np.int64)
        end = start
        for k in range(1, size):  # the words after the rarest, then those before it
            go = rare[row] + k < size
            on = self._within(ids[row[go], rare[row[go]] + k], end[go] + 1, end[go] + 1 + slack)
            row, start, end = self._distinct(row, start, end, go, on, forward=True)
        for k in range(1, size):
            go = rare[row] - k >= 0
            on = self._within(ids[row[go], rare[row[go]] - k], start[go] - 1 - slack, start[go] - 1)
            row, start, end = self._distinct(row, start, end, go, on, forward=False)
        return window[row], start, end

    def _within(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of terms from ``low`` to ``high``, and how many each has."""
        first = np.searchsorted(self.keys, (term << 33) | np.maximum(low, 0))
        n = np.where(high >= 0, np.searchsorted(self.keys, (term << 33) | np.maximum(high, 0), "right") - first, 0)
        return self.positions[tb.ranges(first, n)], n

    @staticmethod
    def _distinct(row, start, end, go, on, forward: bool):
        """The rows not to ``go`` further and the others moved to the places ``on``, each once."""
        place, n = on
        moved = [np.repeat(x[go], n) for x in (row, start, end)]
        moved[2 if forward else 1] = place
        found = np.stack([np.concatenate([x[~go], y]) for x, y in zip((row, start, end), moved)], 1)
        return tuple(np.unique(found, axis=0).T) if len(found) else (found[:, 0],) * 3


def _answer(sent, gap: int, slack: int) -> Callable:
    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [Windows(row) for row in sent.value]
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield _block(row, parts, gap, slack)
    return answer


def _block(row, parts: list[Windows], gap: int, slack: int) -> pd.DataFrame:
    tb.trim()
    ids, nulls = np.frombuffer(row.ids, np.int64), np.frombuffer(row.nulls, bool)
    lengths = np.frombuffer(row.lengths, np.int64)
    base = np.cumsum(lengths + gap) - (lengths + gap)
    postings = Postings(row)
    found, owner, label, names = [], [], [], []
    for part in parts:
        window, start, end = postings.search(part, slack)
        doc = np.searchsorted(base, start, "right") - 1
        found.append(np.stack([doc, start - base[doc], end - base[doc]], 1))
        n = part.owners[window]
        first = np.cumsum(part.owners) - part.owners
        owner.append(np.repeat(doc, n))
        label.append(part.owner[tb.ranges(first[window], n)] + len(names))
        names += part.items
    hits, owner, label = (np.concatenate(x) if x else np.zeros((0, 3), np.int64) for x in (found, owner, label))
    spans = [[] for _ in ids]
    items = [[] for _ in ids]
    for d, a, b in np.unique(hits, axis=0).tolist():
        last = spans[d][-1] if spans[d] else None
        if last and a <= last[1] + 1:
            last[1] = max(last[1], b)
        else:
            spans[d].append([a, b])
    if len(owner):
        for d, k in np.unique(np.stack([owner, label], 1), axis=0).tolist():
            if names[k] is not None:
                items[d].append(names[k])
    return pd.DataFrame({"block": row.block, "place": np.arange(len(ids)), "doc_id": pd.Series(ids, dtype="Int64").mask(nulls), "n_words": lengths,
                         "spans": [[{"first": a, "last": b} for a, b in s] for s in spans],
                         "items": [sorted(set(x)) for x in items]})


_MATCHES = "block long, place long, doc_id long, n_words long, spans array<struct<first:long,last:long>>, items array<string>"


def matches(docs: DataFrame, bench: DataFrame, size: int = 10, slack: int = 0) -> DataFrame:
    """One row per document: doc_id, n_words, spans, items.

    ``spans`` are the maximal runs of word positions (from 0) inside occurrences of benchmark
    windows of ``size`` words; ``items`` the sorted ids of the items they come from. An item of
    fewer words is one window; items without words and null texts match nothing. Items without an
    id give spans and no entry in ``items``. With ``slack`` above 0 a window also matches where its
    words stand in order with at most so many other words between two of them. Copies of a row
    are judged each for itself.
    """
    gap = slack + 1
    postings, parts = index(docs, gap), windows(bench, size)
    rounds = _rounds(parts) or [[]]
    first = _round(postings, parts, rounds[0], gap, slack)
    if len(rounds) == 1:
        return first.drop("block", "place")
    # each round's answer is stored before the next one's windows are read
    answers = [stored(first, "answer")]
    for numbers in rounds[1:]:
        answers.append(stored(_round(postings, parts, numbers, gap, slack).where(F.size("spans") > 0), "answer"))
    return _merged(answers)


def _round(postings: DataFrame, parts: DataFrame, numbers: list[int], gap: int, slack: int) -> DataFrame:
    """The matches of some parts; what is broadcast is bounded by how ``_rounds`` puts them together."""
    picked = parts.where(F.col("part").isin(numbers)).orderBy("part").collect() if numbers else []
    sent = postings.sparkSession.sparkContext.broadcast([r.asDict() for r in picked])
    return postings.mapInPandas(_answer(sent, gap, slack), _MATCHES)


def _merged(answers: list[DataFrame]) -> DataFrame:
    """Answers of several rounds as one: spans united, items joined.

    The first has a row for every document, the others for those that they match; a row is known by
    its block and place.
    """
    every = answers[0]
    for a in answers[1:]:
        every = every.unionByName(a)
    united = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.expr("cast(array() as array<struct<first:long,last:long>>)"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["last"] >= s["first"] - 1),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["first"].alias("first"),
                                  F.greatest(F.element_at(acc, -1)["last"], s["last"]).alias("last")))))
        .otherwise(F.concat(acc, F.array(s))))
    return every.groupBy("block", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), united.alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("block", "place")


def digest(found: DataFrame) -> DataFrame:
    """Counts and fingerprints of ``matches``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select("doc_id", "n_words", hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, bench: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` without those in which a benchmark window occurs.

    Decided row by row, so a row that shares its id with a contaminated one, or has none, stays or
    goes for its own text. Null and empty texts stay.
    """
    rows = by_row(docs)
    return without_rows(rows, matches(narrow(rows), bench, size).where(F.size("spans") > 0))
