"""Packing of documents into token sequences by minimum bin slack.

Whole windows are cut off long documents first. What remains of the documents is a multiset of
lengths below the window; each window takes the largest and then the sub-multiset whose sum comes
closest to the room left, found by subset sums held as the bits of one integer and traced back to
counts. Every task packs the documents it reads, block by block: nothing is shuffled, and a block
ends without padding, since its last window is cut into powers of two.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb

BLOCK_BYTES = 512 << 10
#: Distinct words whose ids a worker keeps.
CACHE_WORDS = 300_000
#: New words that are encoded at once.
ENCODE_WORDS = 5_000
_LETTER = tb.byte_class((0x41, 0x5A), (0x61, 0x7A))
_MARK = np.isin(np.arange(256), np.frombuffer(b".,;:!?*#%$&)", np.uint8))
_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long")


class WordIds:
    """Token ids of words, kept between the blocks of a worker.

    The vocabulary splits at white space and between a letter and a mark, so the ids of a text are
    those of such words one after another, and each distinct word is encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.keys, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, text: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end``, and their numbers."""
        data, offsets = tb.byte_view(text)
        breaks = np.zeros(len(data), bool)
        breaks[1:] = _LETTER[data[:-1]] & _MARK[data[1:]]
        starts, ends, doc = tb.words(data, offsets, tb.SPACE, lower=False, breaks=breaks)
        unique, at, back = np.unique(tb.word_hashes(data, starts, ends, lower=False),
                                     return_index=True, return_inverse=True)
        place = self._places(unique, data, starts[at], ends[at])[back]
        counts = self.counts[place]
        lengths = np.bincount(doc, weights=counts, minlength=len(text)).astype(np.int64) + 1
        out = np.full(int(lengths.sum()), end, np.uint32)
        out[tb.ranges(np.cumsum(counts) - counts + doc, counts)] = self.ids[tb.ranges(self.first[place], counts)]
        return out, lengths

    def _places(self, unique, data, starts, ends) -> np.ndarray:
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        new = self.keys[at] != unique if len(self.keys) else np.ones(len(unique), bool)
        if not new.any():
            return at
        raw = data.tobytes()
        strings = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist())]
        sizes, flats = [], []
        for i in range(0, len(strings), ENCODE_WORDS):
            found = [x.ids for x in self.encoder.encode_batch_fast(strings[i:i + ENCODE_WORDS], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            flats.append(np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes[-1].sum())))
        counts, flat = np.concatenate(sizes), np.concatenate(flats)
        keys = np.concatenate([self.keys, unique[new]])
        order = np.argsort(keys, kind="stable")
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(counts) - counts])[order]
        self.counts = np.concatenate([self.counts, counts])[order]
        self.ids, self.keys = np.concatenate([self.ids, flat]), keys[order]
        return np.searchsorted(self.keys, unique)


_WORDS: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def fill(lengths: list[tuple[int, int]], room: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to ``room`` of a multiset of (length, count), and how many of each it takes."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length, count in lengths:
        part = 1
        while count and not reach >> room & 1:
            part = min(part, count)
            if part * length > room:
                break
            steps.append((length, part, reach))
            reach |= (reach << part * length) & mask
            count, part = count - part, part * 2
        if count and part > 1 and not reach >> room & 1:
            # what doubling left out may still fit one by one
            for _ in range(min(count, room // length)):
                if reach >> room & 1:
                    break
                steps.append((length, 1, reach))
                reach |= (reach << length) & mask
        if reach >> room & 1:
            break
    best = left = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, part, before in reversed(steps):
        if not before >> left & 1:
            taken[length] = taken.get(length, 0) + part
            left -= part * length
    return best, taken


def pack(lengths: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a block of documents.

    All sequences hold ``window`` tokens; the tokens of the last one are dealt to sequences whose
    lengths are powers of two.
    """
    pieces, sequence = [], 0
    waiting: dict[int, list[tuple[int, int]]] = {}  # remaining length -> (document, start)
    for doc, n in enumerate(lengths.tolist()):
        for start in range(0, n - window + 1, window):
            pieces.append((doc, start, window, sequence, 0))
            sequence += 1
        if n % window:
            waiting.setdefault(n % window, []).append((doc, n - n % window))
    order = sorted(waiting, reverse=True)
    total = sum(k * len(v) for k, v in waiting.items())

    def put(length: int, offset: int, most: int | None = None) -> int:
        nonlocal total
        doc, start = waiting[length].pop()
        take = length if most is None else most
        pieces.append((doc, start, take, sequence, offset))
        if not waiting[length]:
            del waiting[length]
            order.remove(length)
        if take < length:  # the rest waits on
            rest = length - take
            if rest not in waiting:
                waiting[rest] = []
                order.insert(sum(k > rest for k in order), rest)
            waiting[rest].append((doc, start + take))
        total -= take
        return offset + take

    while total >= window:
        offset = put(order[0], 0)
        best, taken = fill([(k, len(waiting[k])) for k in order if k <= window - offset], window - offset)
        for length, count in taken.items():
            for _ in range(count):
                offset = put(length, offset)
        if offset < window:  # no sum fits: a longer rest is cut
            offset = put(next(k for k in reversed(order) if k > window - offset), offset, window - offset)
        sequence += 1
    size = 1 << max(total.bit_length() - 1, 0)
    while total:
        offset = 0
        while offset < size:
            offset = put(order[0], offset, min(order[0], size - offset))
        sequence += 1
        size = 1 << max(total.bit_length() - 1, 0)
    return pieces


def _packer(path: str, window: int, end: int) -> Callable:
    def packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, sequence = _word_ids(path), TaskContext.get().partitionId() << 36
        for block in tb.blocks(batches, "text", BLOCK_BYTES):
            ids, lengths = words.encode(block.column("text"), end)
            doc, start, length, number, offset = np.array(pack(lengths, window), np.int64).T
            raw, at = memoryview(ids.astype("<u4").tobytes()), (np.cumsum(lengths) - lengths)[doc] + start
            sums = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length),
                 pa.array(sums, pa.int64()), pa.array(lengths[doc]), pa.array(number + sequence),
                 pa.array(offset)], names=[f.split()[0] for f in _PIECES.split(", ")])
            sequence += int(number.max()) + 1
    return packer


def pieces(docs: DataFrame, vocabulary: str, window: int = 2048, end: int = 1) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``window`` tokens.

    A document's tokens are the ids of its text without special ones, then ``end``; null texts count
    as empty and have that one token. Columns: doc_id, start (the document's tokens before the
    piece), length, ids_crc32, doc_tokens, sequence_id, offset. Each row is packed by itself, also
    where rows repeat or have no id; an empty table gives no pieces. Other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(tb.tidy(_packer(vocabulary, window, end)), _PIECES)
