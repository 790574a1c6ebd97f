"""Hashes of documents dealt out to buckets as packed numbers, and counted there."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb

#: Hashes that a task deals out at once.
DEAL = 500_000
#: Buckets for each shuffle partition, and the least and most bytes of text that a bucket stands for.
BUCKETS, LEAST_BYTES, MOST_BYTES = 4, 1 << 20, 32 << 20


def buckets_of(texts: DataFrame, column: str = "text") -> int:
    """Number of buckets to deal the texts out to.

    A multiple of the shuffle partitions, within what the texts need: a task's rows for each bucket
    hold something to pack, and a bucket's share fits a worker, whatever the number of partitions.
    """
    total = texts.agg(F.sum(F.octet_length(column))).first()[0] or 0
    wanted = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")) * BUCKETS
    return max(1, -(-total // MOST_BYTES), min(wanted, -(-total // LEAST_BYTES)))


def packed(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of 64-bit numbers as binary values."""
    ends = np.concatenate([[0], np.cumsum(lengths)]) * 8
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int64)),
                                          pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def numbers(column) -> tuple[np.ndarray, np.ndarray]:
    """All 64-bit numbers of a binary column and their count in each value."""
    data, offsets = tb.byte_view(column)
    return np.frombuffer(data.tobytes(), np.uint64), np.diff(offsets) // 8


DEALT = "bucket int, hashes binary, cids binary, df int"


def dealt(bucket: np.ndarray, hashes: np.ndarray, cids: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    """Rows of one bucket and one frequency each."""
    order = np.lexsort((df, bucket))
    bucket, df = bucket[order], df[order]
    cut = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (df[1:] != df[:-1])])) if len(df) else np.zeros(0, np.int64)
    n = np.diff(np.append(cut, len(df)))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cut].astype(np.int32)), packed(hashes[order], n), packed(cids[order], n),
         pa.array(df[cut].astype(np.int32))], names=["bucket", "hashes", "cids", "df"])


def dealer_of(buckets: int, frequent: int) -> Callable:
    """Deals the hashes (``region``) of a task's classes (``cid``) out by hash.

    Of a hash with more than ``frequent`` classes in the task only so many go to its bucket; for
    the others the frequency is known already, and they go straight on (negative bucket numbers).
    """
    def dealer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = {}, 0
        for batch in batches:
            value, n = numbers(batch.column("region"))
            for cid, end, k in zip(batch.column("cid").to_pylist(), np.cumsum(n).tolist(), n.tolist()):
                if k and cid not in held:
                    held[cid] = value[end - k:end]
                    total += k
            if total >= DEAL:
                yield deal(held, buckets, frequent)
                held, total = {}, 0
        if held:
            yield deal(held, buckets, frequent)
    return dealer


def deal(cids: dict[int, np.ndarray], buckets: int, frequent: int) -> pa.RecordBatch:
    """Hashes of classes dealt out by hash, those beyond ``frequent`` of one hash straight to the class."""
    lengths = np.fromiter(map(len, cids.values()), np.int64, len(cids))
    hashes = np.concatenate(list(cids.values()))
    owner = np.repeat(np.fromiter(cids, np.int64, len(cids)).view(np.uint64), lengths)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    at = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    place = np.arange(len(hashes)) - np.repeat(at, np.diff(np.append(at, len(hashes))))
    on = place >= frequent
    bucket = (hashes % tb.U64(buckets)).astype(np.int64)
    bucket[on] = -1 - (owner[on] % tb.U64(buckets)).astype(np.int64)
    return dealt(bucket, hashes, owner, np.where(on, frequent, 0))


def flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    tb.trim()
    hashes, n = numbers(table["hashes"])
    return hashes, numbers(table["cids"])[0], np.repeat(table["df"].to_numpy(), n)


def frequencies(buckets: int, frequent: int) -> Callable:
    def count(table: pa.Table) -> pa.Table:
        if table["bucket"][0].as_py() < 0:  # known already
            return table
        hashes, cids, _ = flat(table)
        order = np.lexsort((cids, hashes))
        hashes, cids = hashes[order], cids[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (cids[1:] != cids[:-1])
        hashes, cids = hashes[fresh], cids[fresh]
        at = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        n = np.diff(np.append(at, len(hashes)))
        df = np.repeat(np.minimum(n, frequent), n)
        shared = df > 1
        return pa.Table.from_batches([dealt(-1 - (cids[shared] % tb.U64(buckets)).astype(np.int64),
                                             hashes[shared], cids[shared], df[shared])])
    return count
