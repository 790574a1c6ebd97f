"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``width`` bytes that covers it also starts earlier. Each such string (a
window) has an anchor, the ``GRAM`` bytes in it with the lowest hash; equal windows have equal
anchors at equal places. Only windows whose anchor occurs in another text or twice in one can
repeat. The stretches of text around such anchors are dealt out by anchor; in each bucket a suffix
array is built by two-stage sorting, and adjacent common prefixes of ``width`` bytes or more show
which windows are equal; the earliest of them stays.

Equal texts are one class, known by a 64-bit hash, and enter once, as the copy with the smallest
id; equal stretches of one anchor enter the suffix array once, too. The windows of an anchor in very
many texts are dealt out one by one: first their hashes, then of those that repeat the text, once a
task, so that what meets of one window does not grow with the texts that hold it. No row of the documents is sent to a place by source or
language, and none is gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import suffix_sort
from daybook.llm import textblocks as tb
from daybook.llm.dealing import DEALT, buckets_of, deal, dealer_of, dealt, flat, frequencies, numbers, packed
from daybook.llm.tables import stored

GRAM = 50
#: Texts with one anchor from which on its windows are dealt out one by one.
FREQUENT = 4096
BLOCK_BYTES = 1 << 20
PACK_BYTES = 4 << 20
#: Bytes of text of one suffix array.
SORT_BYTES = 1 << 20
LAST_ID = (1 << 63) - 1  # stands for a missing id: after all others
_SEPARATOR = 255  # never a byte of UTF-8


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tb._powers(n), tb._inverse(n)


class Anchors:
    """Anchors of the windows of a block of texts: hash, place, and the window starts they serve."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, gram: int = GRAM):
        n, reach = len(data), width - gram + 1
        self.hash, self.place, self.first, self.last = (np.zeros(0, k) for k in (np.uint64, np.int64, np.int64, np.int64))
        if n < width:
            self.text = self.place
            return
        power, self.back = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tb._CODES[data] * power[:-1], out=self.sums[1:])
        h = self.string(np.arange(n - gram + 1), gram)
        # the lowest hash wins, the first of equal ones; the low bits hold the place
        low = (h & ~tb.U64(0xFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= reach:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < reach:
            low = np.minimum(low[:len(low) - (reach - span)], low[reach - span:])
        place = (low & tb.U64(0xFFFFFFF)).astype(np.int64)
        lengths = np.diff(offsets)
        whole = np.maximum(lengths - width + 1, 0)
        start = tb.ranges(offsets[:-1], whole)  # windows within one text
        place = place[start]
        text = np.repeat(np.arange(len(lengths)), whole)
        cut = np.ones(len(start), bool)
        cut[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(cut)
        self.first, self.last = start[at], start[np.append(at[1:], len(start)) - 1] if len(at) else start[at]
        self.place, self.text = place[at], text[at]
        self.hash = h[self.place]

    def string(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of the strings of ``length`` bytes at ``start``."""
        return tb.mix((self.sums[start + length] - self.sums[start]) * self.back[start])


def _dealer(buckets: int, width: int, frequent: int) -> Callable:
    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice: list[tuple[np.ndarray, np.ndarray]] = []
        collect = dealer_of(buckets, frequent)

        def rows() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in tb.slices(batch, "text", BLOCK_BYTES):
                    a = Anchors(*tb.byte_view(part.column("text")), width)
                    if not len(a.hash):
                        continue
                    order = np.lexsort((a.hash, a.text))
                    h, t = a.hash[order], a.text[order]
                    fresh = np.ones(len(h), bool)
                    fresh[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
                    cid = part.column("cid").to_numpy().astype(np.int64)
                    if not fresh.all():  # an anchor twice in one text
                        twice.append((h[~fresh], cid[t[~fresh]].view(np.uint64)))
                    n = np.bincount(t[fresh], minlength=part.num_rows)
                    yield pa.RecordBatch.from_arrays([part.column("cid"), packed(h[fresh], n)], names=["cid", "region"])

        for out in collect(rows()):
            yield out
            if twice:
                yield known(twice)
                twice.clear()
        if twice:
            yield known(twice)

    def known(twice) -> pa.RecordBatch:
        h, c = (np.concatenate(x) for x in zip(*twice))
        return dealt(-1 - (c % tb.U64(buckets)).astype(np.int64), h, c, np.full(len(h), 2))

    return regions


_PACKS = "bucket int, cids binary, ids binary, lengths binary, texts binary"


def _packer(buckets: int) -> Callable:
    """Texts dealt out by class, compressed, each class of a block once."""
    def packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for block in tb.blocks(batches, "text", PACK_BYTES):
            data, offsets = tb.byte_view(block.column("text"))
            cid = block.column("cid").to_numpy().astype(np.int64)
            ids = block.column("doc_id").fill_null(LAST_ID).to_numpy().astype(np.int64)
            order = np.lexsort((ids, cid))
            fresh = np.ones(len(order), bool)
            fresh[1:] = cid[order][1:] != cid[order][:-1]
            pick = order[fresh]
            bucket = (cid[pick].view(np.uint64) % tb.U64(buckets)).astype(np.int64)
            rows = []
            for b in np.unique(bucket).tolist():
                own = pick[bucket == b]
                n = offsets[own + 1] - offsets[own]
                raw = data[tb.ranges(offsets[own], n)].tobytes()
                rows.append((-1 - b, cid[own].tobytes(), ids[own].tobytes(), n.tobytes(), press.compress(raw)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))],
                    names=[f.split()[0] for f in _PACKS.split(", ")])
    return packer


def _unpacked(table: pa.Table):
    """Classes of a bucket, each once: cid, smallest id, offsets and bytes."""
    tb.trim()
    cid, ids, n = ((numbers(table[c])[0].view(np.int64)) for c in ("cids", "ids", "lengths"))
    raw = b"".join(zstandard.ZstdDecompressor().decompress(x) for x in table["texts"].to_pylist())
    data, start = np.frombuffer(raw, np.uint8), np.cumsum(n) - n
    order = np.lexsort((ids, cid))
    fresh = np.ones(len(order), bool)
    fresh[1:] = cid[order][1:] != cid[order][:-1]
    pick = order[fresh]
    offsets = np.concatenate([[0], np.cumsum(n[pick])])
    return cid[pick], ids[pick], offsets, data[tb.ranges(start[pick], n[pick])]


def _each_window(a: Anchors, text, first, last, width: int):
    """Hash, text and start of each window of some stretches."""
    n = last - first + 1
    start = tb.ranges(first, n)
    return a.string(start, width), np.repeat(text, n), start


def _blocks_of(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``BLOCK_BYTES``."""
    texts = len(offsets) - 1
    block = np.searchsorted(offsets, np.arange(0, offsets[-1] + BLOCK_BYTES, BLOCK_BYTES), "left")
    for lo, hi in zip(block[:-1].tolist(), block[1:].tolist()):
        if lo < min(hi, texts):
            yield lo, min(hi, texts)


def _windows(buckets: int, width: int, frequent: int) -> Callable:
    """The windows of frequent anchors by hash and class, dealt out by hash.

    Two classes of a task and hash are enough to count; more than two are known to repeat.
    """
    def windows(key, packs: pa.Table, shared: pa.Table) -> pa.Table:
        none = dealt(*(np.zeros(0, k) for k in (np.int64, np.uint64, np.uint64, np.int64)))
        if not packs.num_rows or not shared.num_rows:
            return pa.Table.from_batches([none])
        hashes, owner, df = flat(shared)
        hot = df >= frequent
        frequents = np.unique(hashes[hot])
        if not len(frequents):
            return pa.Table.from_batches([none])
        cid, _, offsets, data = _unpacked(packs)
        own = np.flatnonzero(np.isin(cid, np.unique(owner[hot]).view(np.int64)))
        n = np.diff(offsets)[own]
        data, cid, offsets = data[tb.ranges(offsets[own], n)], cid[own], np.concatenate([[0], np.cumsum(n)])
        held: dict[int, np.ndarray] = {}
        twice = []
        for lo, hi in _blocks_of(offsets):
            a = Anchors(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], width)
            keep = np.isin(a.hash, frequents)
            if not keep.any():
                continue
            h, text, _ = _each_window(a, a.text[keep], a.first[keep], a.last[keep], width)
            order = np.lexsort((h, text))
            h, text = h[order], text[order] + lo
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            twice.append((h[~fresh], cid[text[~fresh]].view(np.uint64)))
            h, text = h[fresh], text[fresh]
            cuts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            held.update(zip(cid[text[cuts]].tolist(), np.split(h, cuts[1:])))
        if not held:
            return pa.Table.from_batches([none])
        h, c = (np.concatenate(x) for x in zip(*twice))
        return pa.Table.from_batches([deal(held, buckets, 2), dealt(
            -1 - (c % tb.U64(buckets)).astype(np.int64), h, c, np.full(len(h), 2))])
    return windows


_STRETCHES = "bucket int, keys binary, cids binary, ids binary, starts binary, counts binary, texts binary"


def _stretches(buckets: int, width: int, frequent: int) -> Callable:
    """The text around anchors that repeat, dealt out by anchor."""
    def stretches(key, packs: pa.Table, shared: pa.Table) -> pa.Table:
        rows = []
        if packs.num_rows and shared.num_rows:
            rows = list(cut(*_unpacked(packs), *flat(shared)))
        return pa.table({f.split()[0]: pa.array([r[i] for r in rows], pa.int32() if not i else pa.binary())
                         for i, f in enumerate(_STRETCHES.split(", "))})

    def cut(cid, ids, offsets, data, hashes, owner, df):
        single = df < 0  # windows of frequent anchors
        again = np.unique(hashes[single])
        hashes, df = hashes[~single], df[~single]
        if not len(hashes):
            return
        repeated, at = np.unique(hashes, return_inverse=True)
        top = np.zeros(len(repeated), np.int64)
        np.maximum.at(top, at, df)
        found = []
        for lo, hi in _blocks_of(offsets):
            part, base = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            a = Anchors(part, base, width)
            place = np.minimum(np.searchsorted(repeated, a.hash), len(repeated) - 1)
            keep = repeated[place] == a.hash
            key, text, first, last = a.hash[keep], a.text[keep], a.first[keep], a.last[keep]
            hot = top[place[keep]] >= frequent
            if hot.any():
                key, text, first, last = split(a, key, text, first, last, hot, again)
            found.append((key, text + lo, first + offsets[lo], last - first + 1))
        key, text, first, count = (np.concatenate(x) for x in zip(*found))
        length = count + width - 1
        # equal stretches of one key: one of them stands for all, the first in order of (id, start)
        digest = np.array([hash(data[f:f + n].tobytes()) for f, n in zip(first.tolist(), length.tolist())], np.int64)
        order = np.lexsort((first, ids[text], digest, key))
        k, d = key[order], digest[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        head = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        same = np.array([data[f:f + n].tobytes() == data[g:g + n].tobytes() and n == m for f, n, g, m in zip(
            first[order].tolist(), length[order].tolist(), first[head].tolist(), length[head].tolist())], bool)
        fresh |= ~same
        go, stay = order[fresh], order[~fresh]
        press = zstandard.ZstdCompressor(level=3)
        start = first - offsets[text]
        # windows that stand next to each other in one text go on as one run
        stay = stay[np.lexsort((start[stay], text[stay]))]
        if len(stay):
            run = np.concatenate([[True], (text[stay][1:] != text[stay][:-1])
                                  | (start[stay][1:] != start[stay][:-1] + count[stay][:-1])])
            total = np.add.reduceat(count[stay], np.flatnonzero(run))
            stay = stay[run]
            count[stay] = total
        for rows, b, send in ((go, (key[go] % tb.U64(buckets)).astype(np.int64), True),
                              (stay, -1 - (cid[text[stay]].view(np.uint64) % tb.U64(buckets)).astype(np.int64), False)):
            by = np.argsort(b, kind="stable")
            for own in np.split(rows[by], np.flatnonzero(np.diff(b[by])) + 1) if len(rows) else []:
                number = (int(key[own[0]] % tb.U64(buckets)) if send
                          else -1 - int(cid[text[own[:1]]].view(np.uint64)[0] % tb.U64(buckets)))
                raw = press.compress(data[tb.ranges(first[own], length[own])].tobytes()) if send else b""
                yield (number, key[own].tobytes() if send else b"", cid[text[own]].tobytes(), ids[text[own]].tobytes(),
                       start[own].tobytes(), count[own].tobytes(), raw)

    def split(a: Anchors, key, text, first, last, hot, again):
        """Stretches of frequent anchors cut into the windows that repeat, each known by its own hash."""
        h, t, start = _each_window(a, text[hot], first[hot], last[hot], width)
        some = np.isin(h, again)
        h, t, start = h[some], t[some], start[some]
        return (np.concatenate([key[~hot], h]), np.concatenate([text[~hot], t]),
                np.concatenate([first[~hot], start]), np.concatenate([last[~hot], start]))

    return stretches


_REPEATS = "bucket int, cids binary, starts binary, counts binary"


def _sorter(buckets: int, width: int) -> Callable:
    """Windows of a bucket that repeat an earlier one."""
    def sorter(table: pa.Table) -> pa.Table:
        cid, ids, start, count = (numbers(table[c])[0].view(np.int64) for c in ("cids", "ids", "starts", "counts"))
        if table["bucket"][0].as_py() < 0:
            return rows(cid, start, count)
        key = numbers(table["keys"])[0]
        raw = b"".join(zstandard.ZstdDecompressor().decompress(x) for x in table["texts"].to_pylist())
        data, length = np.frombuffer(raw, np.uint8), count + width - 1
        at = np.cumsum(length) - length
        digest = np.array([hash(raw[a:a + n]) for a, n in zip(at.tolist(), length.tolist())], np.int64)
        order = np.lexsort((start, ids, digest, key))
        k, d = key[order], digest[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        head = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        fresh |= np.array([raw[a:a + n] != raw[b:b + m] for a, n, b, m in zip(
            at[order].tolist(), length[order].tolist(), at[head].tolist(), length[head].tolist())], bool)
        gone = order[~fresh]
        out = [(cid[gone], start[gone], count[gone])]
        own = order[fresh]
        # a stretch alone with its key can still repeat within itself
        cuts = np.flatnonzero(key[own][1:] != key[own][:-1]) + 1
        group = np.repeat(np.arange(len(cuts) + 1), np.diff(np.concatenate([[0], cuts, [len(own)]])))
        size = np.bincount(group, weights=length[own] + 1)
        batch = (np.cumsum(size) // SORT_BYTES).astype(np.int64)[group]
        for part in np.split(own, np.flatnonzero(np.diff(batch)) + 1):
            out.append(sort(part, cid, ids, start, count, length, at, data))
        return rows(*(np.concatenate(x) for x in zip(*out)))

    def sort(own, cid, ids, start, count, length, at, data):
        base = np.cumsum(length[own] + 1) - (length[own] + 1)
        text = np.full(int((length[own] + 1).sum()), _SEPARATOR, np.uint8)
        text[tb.ranges(base, length[own])] = data[tb.ranges(at[own], length[own])]
        words = suffix_sort.words_at(text, width)
        array = suffix_sort.suffix_array(text, words, width)
        new = suffix_sort.common_prefixes(array, words, width) < width
        stretch = np.full(len(text), -1, np.int64)
        stretch[tb.ranges(base, count[own])] = np.repeat(np.arange(len(own)), count[own])
        row = stretch[array]
        is_window = row >= 0
        cls, place, row = np.cumsum(new)[is_window], array[is_window], row[is_window]
        begin = start[own][row] + place - base[row]
        order = np.lexsort((begin, ids[own][row], cls))
        cls, row, begin = cls[order], row[order], begin[order]
        who = ids[own][row]
        # windows at the first place of their class stay, also where rows share an id
        first = np.concatenate([[True], cls[1:] != cls[:-1]])
        lead = np.maximum.accumulate(np.where(first, np.arange(len(cls)), 0))
        again = (who != who[lead]) | (begin != begin[lead])
        return cid[own][row][again], begin[again], np.ones(int(again.sum()), np.int64)

    def rows(cid, start, count) -> pa.Table:
        b = -1 - (cid.view(np.uint64) % tb.U64(buckets)).astype(np.int64)
        by = np.argsort(b, kind="stable")
        out = [(int(b[own[0]]), cid[own].tobytes(), start[own].tobytes(), count[own].tobytes())
               for own in (np.split(by, np.flatnonzero(np.diff(b[by])) + 1) if len(by) else [])]
        return pa.table({f.split()[0]: pa.array([r[i] for r in out], pa.int32() if not i else pa.binary())
                         for i, f in enumerate(_REPEATS.split(", "))})

    return sorter


_CLASSES = "cid long, head long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cleaner(width: int, with_text: bool = False) -> Callable:
    """What is left of each class of a bucket."""
    def cleaner(key, packs: pa.Table, repeats: pa.Table) -> pa.Table:
        out = []
        if packs.num_rows:
            cid, ids, offsets, data = _unpacked(packs)
            r_cid, start, count = (numbers(repeats[c])[0].view(np.int64) for c in ("cids", "starts", "counts"))
            order = np.lexsort((start, r_cid))
            r_cid, start, count = r_cid[order], start[order], count[order]
            low, high = np.searchsorted(r_cid, cid), np.searchsorted(r_cid, cid, "right")
            for i, c in enumerate(cid.tolist()):
                text = data[offsets[i]:offsets[i + 1]]
                keep = np.ones(len(text) + 1, np.int32)
                if low[i] < high[i]:
                    a = start[low[i]:high[i]]
                    b = a + count[low[i]:high[i]] - 1 + width
                    cover = np.zeros(len(text) + 1, np.int32)
                    np.add.at(cover, a, 1)
                    np.add.at(cover, b, -1)
                    keep = np.cumsum(cover) <= 0
                gone = ~keep[:-1].astype(bool)
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rest = text[~gone].tobytes()
                out.append((c, int(ids[i]), len(text), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest())
                           + ((rest,) if with_text else ()))
        names = [f.split()[0] for f in _CLASSES.split(", ")] + ["kept"] * with_text
        kinds = [pa.int64()] * 5 + [pa.string()] + [pa.binary()] * with_text
        return pa.table({n: pa.array([r[i] for r in out], k) for i, (n, k) in enumerate(zip(names, kinds))})
    return cleaner


def _found(slim: DataFrame, buckets: int, width: int, frequent: int) -> tuple[DataFrame, DataFrame]:
    """The texts packed by class, and the stretches that can repeat."""
    dealt_out = slim.select("cid", "text").mapInArrow(tb.tidy(_dealer(buckets, width, frequent)), DEALT)
    shared = dealt_out.groupBy("bucket").applyInArrow(frequencies(buckets, frequent), DEALT)
    packs = slim.mapInArrow(tb.tidy(_packer(buckets)), _PACKS)
    single = (packs.groupBy("bucket").cogroup(shared.groupBy("bucket"))
              .applyInArrow(_windows(buckets, width, frequent), DEALT)
              .groupBy("bucket").applyInArrow(frequencies(buckets, 2), DEALT).withColumn("df", -F.col("df")))
    found = (packs.groupBy("bucket").cogroup(shared.unionByName(single).groupBy("bucket"))
             .applyInArrow(_stretches(buckets, width, frequent), _STRETCHES))
    return packs, found


def remove(docs: DataFrame, width: int = 100, with_text: bool = False, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left).

    Removed is each byte covered by a string of ``width`` bytes that also starts earlier: in a
    document with a smaller id, or further ahead in the same one. Strings lie within one document
    and are judged on the input. Null texts are empty. Documents without an id come after all
    others, and strings at one place of rows that share an id (or have none) count as one.
    Other columns are not looked at.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = buckets_of(slim)
    slim = slim.withColumn("cid", F.xxhash64("text", F.octet_length("text")))
    packs, found = _found(slim, buckets, width, frequent)
    repeats = stored(found.groupBy("bucket").applyInArrow(_sorter(buckets, width), _REPEATS), "repeats")
    schema = _CLASSES + (", kept binary" if with_text else "")
    classes = stored(packs.groupBy("bucket").cogroup(repeats.groupBy("bucket"))
                     .applyInArrow(_cleaner(width, with_text), schema), "classes")
    # copies of a class other than the first go as a whole, if they are long enough
    head = F.coalesce("doc_id", F.lit(LAST_ID)) == F.col("head")
    stays = head | (F.col("n_bytes") < width)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    out = slim.select("doc_id", "cid").join(classes, "cid").select(
        "doc_id", "n_bytes", F.when(stays, F.col("n_removed")).otherwise(F.col("n_bytes")).alias("n_removed"),
        F.when(stays, F.col("n_spans")).otherwise(F.lit(1).cast("long")).alias("n_spans"),
        F.when(stays, F.col("kept_sha256")).otherwise(empty).alias("kept_sha256"),
        *([F.when(stays, F.col("kept")).otherwise(F.lit("").cast("binary")).alias("kept")] if with_text else []))
    return out
