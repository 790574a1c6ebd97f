"""Substring dedup on words by level-wise doubling.

What is looked for are windows of ``width`` words that also start in a document with a smaller id.
A window can only repeat if the shorter windows in it repeat. So the first level asks only for
windows of half the width, and of these only for the least by hash in each full window: equal
windows choose the same one, at the same place. Full windows are formed, at the second level, only
where the chosen half repeats in another document; what repeats there is removed. Doubling once
more would not change what is removed, so the levels end at the width. Documents that equal an
earlier one are known by a digest of the whole and form no windows.

Documents are kept in compressed blocks, a stored table. A level sends the names of its windows
(64-bit hashes, at the last level 96 bits) to be compared with those of all other blocks, and gets
back per block the names that repeat. A task first compares its own blocks with each other, so of
a passage that is everywhere only one name a task travels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb
from daybook.llm.tables import bounded, stored

WIDTH = 13
#: Bytes of text in a block (a longer document is a block of its own), names compared in a task
#: before they are sent, and names that meet in one task.
BLOCK, LOT, MEET = 2 << 20, 1_000_000, 2_000_000
#: A word longer than this is named by a digest.
LONG_WORD = 1 << 16
_LAST = np.iinfo(np.int64).max
_BLOCKS = "block long, ids binary, known binary, offsets binary, wholes binary, n_words long, text binary"
_STEP, _CHECK = tb.U64(0x5851F42D4C957F2D), tb.U64(0xD1342543DE82EF95)


def _names_of_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every word, worked out over bounded stretches of the text."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        if ends[at] - starts[at] > LONG_WORD:
            word = hashlib.blake2b(data[starts[at]:ends[at]].tobytes(), digest_size=8).digest()
            out[at] = np.frombuffer(word, np.uint64)[0]
            at += 1
            continue
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, "right")))
        long = np.flatnonzero(ends[at:stop] - starts[at:stop] > LONG_WORD)
        stop = at + int(long[0]) if len(long) else stop
        base = starts[at]
        out[at:stop] = tb.word_hashes(data[base:ends[stop - 1]], starts[at:stop] - base, ends[at:stop] - base, lower=False)
        at = stop
    return out


def _to_blocks(most: int) -> Callable:
    """Documents packed into blocks of about ``most`` bytes."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, press = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3)
        for k, batch in enumerate(tb.blocks(batches, "text", most)):
            data, offsets = tb.byte_view(batch.column("text"))
            ids = batch.column("doc_id")
            n = len(ids)
            # one blank behind every document: no word and no gather ever crosses a border
            apart = np.full(len(data) + n, 32, np.uint8)
            apart[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
            inside = ~tb.SPACE[apart]
            words = int((inside[1:] & ~inside[:-1]).sum() + inside[:1].sum())
            raw = memoryview(data)
            wholes = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
            yield pa.RecordBatch.from_arrays([
                pa.array([part << 33 | k], pa.int64()),
                pa.array([ids.fill_null(_LAST).to_numpy().astype(np.int64).tobytes()], pa.binary()),
                pa.array([ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary()),
                pa.array([(offsets + np.arange(n + 1)).astype(np.int64).tobytes()], pa.binary()),
                pa.array([wholes], pa.binary()), pa.array([words], pa.int64()), pa.array([press.compress(apart.tobytes())], pa.binary())],
                names=[f.split()[0] for f in _BLOCKS.split(", ")])
    return pack


class Block:
    """Words of the documents of one block: ``owner`` is the place of a word's document in it."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], np.uint8).astype(bool)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8)
        self.starts, self.ends, self.owner = tb.words(self.data, self.offsets, tb.SPACE, lower=False)
        self.words = _names_of_words(self.data, self.starts, self.ends)
        self.again = np.unique(np.array(row.get("names") or [], np.int64).view(np.uint64))
        self.copy = copies(self.ids, np.frombuffer(row["wholes"], np.uint64), row.get("copied") or [])

    def windows(self, n: int, step: np.uint64 = _STEP) -> np.ndarray:
        """Hashes of all runs of ``n`` words, whether or not they cross a border."""
        total = len(self.words) - n + 1
        if total <= 0:
            return np.zeros(0, np.uint64)
        out = np.zeros(total, np.uint64)
        for k in range(n):
            out = out * step + self.words[k:k + total]
        return tb.mix(out)

    def whole(self, n: int) -> np.ndarray:
        """Which runs of ``n`` words lie within one document."""
        total = max(0, len(self.words) - n + 1)
        return self.owner[:total] == self.owner[n - 1:n - 1 + total]

    def chosen(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of all full windows, the half that each of them chooses, names of halves."""
        half = (width + 1) // 2
        names = self.windows(half)
        first = np.flatnonzero(self.whole(width))
        place, best = first.copy(), names[first]
        for k in range(1, width - half + 1):
            other = names[first + k]
            less = other < best
            place[less], best[less] = first[less] + k, other[less]
        return first, place, names

    def candidates(self, width: int) -> np.ndarray:
        """First words of the full windows whose chosen half repeats, here or in another block."""
        first, place, names = self.chosen(width)
        if not len(first):
            return first
        at = np.unique(place)
        order = np.lexsort((self.owner[at], names[at]))
        name, owner = names[at][order], self.owner[at][order]
        same = name[1:] == name[:-1]
        twice = np.unique(name[1:][same & (owner[1:] != owner[:-1])])
        repeats = _among(names[place], self.again) | _among(names[place], twice)
        return first[repeats & ~self.copy[self.owner[first]]]  # all that a copy has, its original has too


def copies(ids: np.ndarray, wholes: np.ndarray, told: list[int]) -> np.ndarray:
    """Which documents of a block equal one with a smaller id, here or (``told``) in another block."""
    name, check = wholes[::2], wholes[1::2]
    order = np.lexsort((ids, check, name))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (name[order][1:] != name[order][:-1]) | (check[order][1:] != check[order][:-1])
    out = np.zeros(len(order), bool)
    out[order] = ids[order] > ids[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    return out | _among(name, np.unique(np.array(told, np.int64).view(np.uint64)))


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(values), bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            tb.trim()


#: What is sent; the number of a block that is told what it sent repeats is given as -1 - number.
_HALF, _FULL = "name long, block long", "name long, block long, check int, doc long"


def _sent(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    kinds = {"check": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int32) if n == "check" else c.view(np.int64), kinds.get(n, pa.int64()))
                                       for n, c in zip(names, columns)], names=names)


def _compared(held: list[tuple], either: bool) -> Iterator[pa.RecordBatch]:
    """The names of one task's blocks, compared with each other.

    Of each name the entries with the least document are sent on to meet those of other tasks. The
    others are known to repeat it: their blocks are told so directly, with ``either`` also the first.
    """
    name, check, doc, block = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((doc, check, name))
    name, check, doc, block = name[order], check[order], doc[order], block[order]
    fresh = np.ones(len(name), bool)
    fresh[1:] = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
    group, at = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
    told = doc > doc[at][group]
    if either and len(at):  # the first of several: it goes on and is told as well
        also = at[np.logical_or.reduceat(told, at)]
        name, check, doc, block = (np.concatenate([x, x[also]]) for x in (name, check, doc, block))
        told = np.concatenate([told, np.ones(len(also), bool)])
    block = np.where(told, -1 - block, block)
    columns = (name, block) if either else (name, block, check, doc)
    for at in range(0, len(name), 100_000):
        yield _sent(["name", "block", "check", "doc"][:len(columns)], *(c[at:at + 100_000] for c in columns))


def _level(entries: Callable[[dict], tuple], either: bool) -> Callable:
    """Sends names of blocks on; with ``either`` it does not matter which of two blocks is the first."""
    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for row in _rows(batches):
            name, check, doc = entries(row)
            held.append((name, check, doc, np.full(len(name), row["block"])))
            total += len(name)
            if total >= LOT:
                yield from _compared(held, either)
                held, total = [], 0
        if held:
            yield from _compared(held, either)
    return level


def _least(name: np.ndarray, check: np.ndarray, doc: np.ndarray) -> tuple:
    """Each name once, with its least document."""
    order = np.lexsort((doc, check, name))
    name, check, doc = name[order], check[order], doc[order]
    fresh = np.ones(len(name), bool)
    fresh[1:] = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
    return name[fresh], check[fresh], doc[fresh]


def _whole(row: dict) -> tuple:
    """Digests of a block's documents, with the least document of each."""
    wholes = np.frombuffer(row["wholes"], np.uint64)
    return _least(wholes[::2], (wholes[1::2] >> tb.U64(32)).astype(np.uint32), np.frombuffer(row["ids"], np.int64))


def _halves(width: int) -> Callable:
    def halves(row: dict) -> tuple:
        """Names of the chosen halves of a block, whose number stands for a document."""
        _, place, names = Block(row).chosen(width)
        name = np.unique(names[place])
        return name, np.zeros(len(name), np.uint32), np.full(len(name), row["block"])
    return halves


def _full(width: int) -> Callable:
    def full(row: dict) -> tuple:
        """Names of the full windows of a block that may repeat, with the least document of each."""
        block = Block(row)
        first = block.candidates(width)
        if not len(first):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        name, check = block.windows(width)[first], _checks(block, width)[first]
        doc = block.ids[block.owner[first]]
        return _least(name, check, doc)
    return full


def _checks(block: Block, width: int) -> np.ndarray:
    return (block.windows(width, _CHECK) >> tb.U64(32)).astype(np.uint32)


def _meet(either: bool) -> Callable:
    """Names of one partition: those with several documents are told to the blocks that sent them.

    With ``either`` all blocks are told, otherwise all but those with the least document.
    """
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        name, block = table["name"].to_numpy(), table["block"].to_numpy()
        check = np.zeros(len(name), np.int32) if either else table["check"].to_numpy()
        doc = block if either else table["doc"].to_numpy()
        told = block < 0
        block = np.where(told, -1 - block, block)
        # the told ones are dealt out anywhere; only the others meet by name
        own = np.flatnonzero(~told)
        order = own[np.lexsort((doc[own], check[own], name[own]))]
        n, c, d = name[order], check[order], doc[order]
        fresh = np.ones(len(n), bool)
        fresh[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1])
        at = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        if either:
            ends = np.append(at[1:], len(n)) - 1
            tell = (d[ends] > d[at])[group]
        else:
            tell = d > d[at][group]
        rows = np.concatenate([order[tell], np.flatnonzero(told)])
        for k in range(0, len(rows), 100_000):
            r = rows[k:k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(block[r]), pa.array(name[r])], names=["block", "name"])
    return meet


def _told(sent: DataFrame, either: bool, most: int, label: str) -> DataFrame:
    """Per block the names that repeat; ``most`` bounds the entries sent."""
    # of a name that is everywhere one entry a task meets the others; what is told goes by its block
    deal = F.when(F.col("block") < 0, F.xxhash64("block", "name")).otherwise(F.col("name"))
    met = sent.repartition(max(1, -(-most // MEET)), deal).mapInArrow(tb.tidy(_meet(either)), "block long, name long")
    return met.groupBy("block").agg(F.collect_list("name").alias(label))


_KEPT = "doc_id long, n_words long, n_removed long, n_spans long, kept string"


def _remove(width: int) -> Callable:
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield _without(Block(row), width)
    return remove


def _without(block: Block, width: int) -> pa.RecordBatch:
    """The documents of a block without the words of windows that repeat an earlier document's."""
    words = len(block.words)
    gone = np.zeros(words, bool)
    first = np.flatnonzero(block.whole(width))
    if len(first):
        name, check = block.windows(width)[first], _checks(block, width)[first]
        doc = block.ids[block.owner[first]]
        order = np.lexsort((doc, check, name))
        n, c, d = name[order], check[order], doc[order]
        fresh = np.ones(len(n), bool)
        fresh[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1])
        again = np.zeros(len(first), bool)
        again[order] = d > d[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        again |= _among(name, block.again)
        change = np.bincount(first[again], minlength=words + 1) - np.bincount(first[again] + width, minlength=words + 1)
        gone = np.cumsum(change)[:-1] > 0
        long = np.bincount(block.owner, minlength=len(block.ids)) >= width
        gone |= (block.copy & long)[block.owner]
    docs = len(block.ids)
    n_words = np.bincount(block.owner, minlength=docs)
    n_gone = np.bincount(block.owner[gone], minlength=docs)
    begins = gone.copy()
    begins[1:] &= ~(gone[:-1] & (block.owner[1:] == block.owner[:-1]))
    spans = np.bincount(block.owner[begins], minlength=docs)
    blank = np.where(tb.SPACE[block.data], np.uint8(32), block.data)
    keep = np.flatnonzero(~gone)
    length = block.ends[keep] - block.starts[keep] + 1  # each word with the blank behind it
    text = blank[tb.ranges(block.starts[keep], length)]
    size = np.bincount(block.owner[keep], weights=length, minlength=docs).astype(np.int64)
    ends = np.cumsum(size)
    raw = text.tobytes()
    kept = [raw[e - s:max(e - 1, e - s)] for e, s in zip(ends.tolist(), size.tolist())]
    return pa.RecordBatch.from_arrays([
        pa.array(np.where(block.known, block.ids, 0), pa.int64(), mask=~block.known),
        pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(spans, pa.int64()),
        pa.array(kept, pa.binary()).cast(pa.string())], names=[f.split()[0] for f in _KEPT.split(", ")])


def remove(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Documents without the words of windows that also start in a document with a smaller id.

    One row per row of ``docs``: doc_id, n_words, n_removed, n_spans (runs of removed words) and
    kept, the remaining words joined by one blank. Words are runs of bytes other than ASCII white
    space; null has none. Windows are judged on the input. A null id comes after all others and
    rows that share an id (or have none) leave each other alone, as neither has the smaller one.
    Texts shorter than a window stay whole. Columns other than doc_id and text are ignored.
    ``block`` is the size of the blocks in bytes.
    """
    bounded(docs.sparkSession)
    blocks = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
                    .mapInArrow(tb.tidy(_to_blocks(block)), _BLOCKS), "word-blocks")
    size = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"), F.coalesce(F.sum(F.length("ids")), F.lit(0)).alias("ids")).first()
    copied = _told(blocks.select("block", "ids", "wholes").mapInArrow(tb.tidy(_level(_whole, False)), _FULL), False, size["ids"] // 8, "copied")
    halves = _told(blocks.mapInArrow(tb.tidy(_level(_halves(width), True)), _HALF), True, size["words"] // 3, "names")
    copied = stored(copied, "copied")
    known = blocks.join(halves, "block", "left").join(copied, "block", "left")
    full = _told(known.mapInArrow(tb.tidy(_level(_full(width), False)), _FULL), False, size["words"], "names")
    return (blocks.join(full, "block", "left").join(copied, "block", "left")
            .mapInArrow(tb.tidy(_remove(width)), _KEPT))
