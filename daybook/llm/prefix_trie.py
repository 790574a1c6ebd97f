"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours.

Each conversation is one row with a 16-byte digest per turn, so that byte order of the joined
digests is the order of the turn sequences and a prefix comes just before what it begins. Rows are
range-partitioned and sorted by that key and the conversation's id, so equal conversations, however
many, are split over partitions too. A partition joins neighbours by their common prefix, longest
first: two components that meet at depth d become children of one node at depth d, and the nodes
between are chains that have no other child.

A node that neither a partition's first nor its last conversation begins with lies in that
partition alone and is complete. The others, the two spines, are contracted to one row per node and
partition and merged across partitions by the digest of the prefix. What a spine node counts is a
sum over partitions once it is known how far a partition's first conversation agrees with the last
one before it, so merging is a grouping, and the number of its rows depends on partitions and
lengths of conversations only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb
from daybook.llm.tables import bounded, small, stored

#: Bytes of a turn's digest.
DIGEST = 16
#: Bytes of ids that travel as one value.
CHUNK = 1 << 20
_EMPTY = hashlib.sha256(b"").hexdigest()
_FIELDS = [
    ("kind", pa.string()),  # node, spine or ends
    ("part", pa.int32()), ("side", pa.int32()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("parent_side", pa.int32()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("prefix", pa.binary()), ("parent_prefix", pa.binary()),
    ("to_last", pa.bool_()), ("tip", pa.bool_()), ("words_above", pa.int64()), ("words", pa.int64()),
    ("seq", pa.int64()), ("chunk", pa.binary())]
_ROWS = ("kind string, part int, side int, depth long, conv_id long, parent_conv_id long, parent_side int, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, prefix binary, "
         "parent_prefix binary, to_last boolean, tip boolean, words_above long, words long, seq long, chunk binary")
_SCHEMA = pa.schema(_FIELDS)


class Forest:
    """The contracted trie of one partition.

    Items are its distinct conversations in order. A component is an interval of items with one top
    node; tops below the last merge are closed by attaching them to the branching node above.
    """

    def __init__(self, lengths: list[int], counts: list[int], first_ids: list[int], words: list[np.ndarray]):
        n = len(lengths)
        self.words = words
        self.depth, self.item = list(lengths), list(range(n))  # item: one below the node
        self.n, self.low = list(counts), list(first_ids)
        self.children, self.leaves, self.saved = [0] * n, [1] * n, [0] * n
        self.parent = [-1] * n
        self.left, self.right = list(range(n)), list(range(n))
        self.above = [np.concatenate([[0], np.cumsum(w)]) for w in words]  # words of the first d turns
        self._boss, self._top = list(range(n)), list(range(n))

    def _find(self, i: int) -> int:
        boss = self._boss
        while boss[i] != i:
            boss[i] = boss[boss[i]]
            i = boss[i]
        return i

    def _node(self, depth: int, item: int) -> int:
        for held, value in ((self.depth, depth), (self.item, item), (self.n, 0), (self.low, 0), (self.children, 0),
                            (self.leaves, 0), (self.saved, 0), (self.parent, -1), (self.left, item), (self.right, item)):
            held.append(value)
        return len(self.depth) - 1

    def _attach(self, child: int, node: int, fresh: bool) -> None:
        """``child``, complete now, becomes a child of ``node`` by way of the chain between them."""
        self.parent[child] = node
        above, again = self.above[self.item[child]], self.n[child] - 1
        self.saved[child] += again * int(above[self.depth[child]] - above[max(self.depth[child] - 1, 0)])
        chain = again * int(above[max(self.depth[child] - 1, 0)] - above[self.depth[node]])
        if not self.children[node] and not fresh:  # a conversation that ends here is no leaf any more
            self.leaves[node] = 0
        self.children[node] += 1
        self.leaves[node] += self.leaves[child]
        self.saved[node] += self.saved[child] + chain
        self.low[node] = self.low[child] if fresh and self.children[node] == 1 else min(self.low[node], self.low[child])
        self.n[node] += self.n[child]
        self.left[node] = min(self.left[node], self.left[child])
        self.right[node] = max(self.right[node], self.right[child])

    def grow(self, shared: list[int]) -> int:
        """Merges along ``shared``, the depths common to neighbours, deepest first; the root."""
        for i in sorted(range(len(shared)), key=lambda i: (-shared[i], i)):
            a, b = self._find(i), self._find(i + 1)
            node, right, depth = self._top[a], self._top[b], shared[i]
            if self.depth[node] > depth:
                left, node = node, self._node(depth, self.item[node])
                self._attach(left, node, True)
            self._attach(right, node, False)
            self._boss[b] = a
            self._top[a] = node
        top = self._top[self._find(0)]
        if self.depth[top] > 0:
            root = self._node(0, self.item[top])
            self._attach(top, root, True)
            top = root
        return top


def _prefixes(key: bytes, most: int) -> list[bytes]:
    """Digests of the first 0, 1, ... turns of a key, each made from the one before."""
    at = hashlib.sha256()
    out = [at.digest()]
    for d in range(most):
        at.update(key[DIGEST * d:DIGEST * (d + 1)])
        out.append(at.copy().digest())
    return out


def _common(a: bytes, b: bytes) -> int:
    """Turns that two keys share at their beginning."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // DIGEST
    low, high = 0, most // DIGEST  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        mid = (low + high) // 2
        if a[DIGEST * low:DIGEST * mid] == b[DIGEST * low:DIGEST * mid]:
            low = mid
        else:
            high = mid
    return low


class _Ends:
    """The ids of equal conversations, hashed as they come; those that may go on elsewhere also as text."""

    def __init__(self):
        self.sha, self.text, self.seq, self.first = hashlib.sha256(), bytearray(), 0, True

    def add(self, conv: int, keep: bool) -> Iterator[tuple[int, bytes]]:
        text = str(conv).encode() if self.first else b",%d" % conv
        self.first = False
        self.sha.update(text)
        if keep:
            self.text += text
            if len(self.text) >= CHUNK:
                yield from self.rest()

    def rest(self) -> Iterator[tuple[int, bytes]]:
        if self.text:
            yield self.seq, bytes(self.text)
            self.seq, self.text = self.seq + 1, bytearray()


def _partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All nodes of one sorted partition, spine nodes marked as such."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    lengths, counts, lows, words, shared, hashes = [], [], [], [], [], []
    first = last = None
    ends, last_ends = None, []

    def chunks(key: bytes, rows) -> Iterator[pa.RecordBatch]:
        name = hashlib.sha256(key).digest()
        for seq, chunk in rows:
            yield _batch(kind="ends", part=part, prefix=name, seq=seq, chunk=chunk)

    for batch in batches:
        for conv, key, count in zip(batch.column("conv_id").to_pylist(), batch.column("key").to_pylist(),
                                    batch.column("words")):
            if key != last:
                if last is not None:
                    hashes.append(ends.sha.hexdigest())
                    shared.append(_common(last, key))
                    if last == first:
                        yield from chunks(first, ends.rest())
                ends, first, last = _Ends(), key if first is None else first, key
                lengths.append(len(key) // DIGEST)
                counts.append(0)
                lows.append(conv)
                words.append(count.values.to_numpy(zero_copy_only=False).astype(np.int64) if len(key) else np.zeros(0, np.int64))
                last_ends = []
            counts[-1] += 1
            lows[-1] = min(lows[-1], conv)
            # of the first and of the last conversation there may be copies in other partitions
            made = list(ends.add(conv, True))
            if key == first:
                yield from chunks(first, made)
            else:
                last_ends += made
    if last is None:
        return
    hashes.append(ends.sha.hexdigest())
    yield from chunks(last, [*last_ends, *ends.rest()])
    yield from _emitted(part, Forest(lengths, counts, lows, words), shared, hashes, first, last)


def _batch(**values) -> pa.RecordBatch:
    """One batch from arrays and scalars; what is not given is null."""
    n = max((len(v) for v in values.values() if isinstance(v, (np.ndarray, list, pa.Array))), default=1)
    columns = []
    for name, kind in _FIELDS:
        v = values.get(name)
        if isinstance(v, pa.Array):
            columns.append(v)
        elif isinstance(v, np.ndarray):
            columns.append(pa.array(v, kind))
        else:
            columns.append(pa.array(v if isinstance(v, list) else [v] * n, kind))
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _emitted(part: int, forest: Forest, shared: list[int], hashes: list[str], first: bytes, last: bytes
             ) -> Iterator[pa.RecordBatch]:
    root = forest.grow(shared)
    items = len(hashes)
    node = np.arange(len(forest.depth))
    depth, parent = np.array(forest.depth), np.array(forest.parent)
    above_depth = np.where(parent >= 0, depth[parent], -1)
    length = depth - above_depth  # the node and the chain above it, up to its parent
    on_left = np.array(forest.left) == 0
    spine = on_left | (np.array(forest.right) == items - 1)
    offsets = np.cumsum([0] + [len(a) for a in forest.above])
    above = np.concatenate(forest.above)
    start = offsets[np.array(forest.item)]
    n, low = np.array(forest.n), np.array(forest.low)
    side = np.where(on_left, 0, 1)
    children, leaves, saved = (np.array(x) for x in (forest.children, forest.leaves, forest.saved))
    ends = np.array(hashes + [_EMPTY], object)[np.where(node < items, node, items)]

    def rows(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(which, length[which]), tb.ranges(above_depth[which] + 1, length[which])

    def columns(own: np.ndarray, d: np.ndarray) -> dict:
        tip = d == depth[own]
        bottom = np.maximum(depth[own] - 1, 0)
        chain = np.where(tip, 0, (n[own] - 1) * (above[start[own] + bottom] - above[start[own] + np.maximum(d - 1, 0)]))
        return {"part": part, "depth": d, "conv_id": low[own], "n_convs": n[own],
                "n_children": np.where(tip, children[own], 1), "n_leaves": leaves[own],
                "saved_tokens": saved[own] + chain, "ends_sha256": np.where(tip, ends[own], _EMPTY).tolist()}

    # nodes of this partition alone, a bounded number of rows at a time
    closed = node[~spine]
    cuts = np.searchsorted(np.cumsum(length[closed]), np.arange(50_000, length[closed].sum(), 50_000))
    for which in np.split(closed, np.unique(cuts)):
        own, d = rows(which)
        if not len(own):
            continue
        head = d == above_depth[own] + 1
        p = parent[own]
        known = ~head | ~spine[p]
        up = np.where(head, low[p], low[own])
        yield _batch(kind="node", side=np.where(known, -1, 0).astype(np.int32), parent_side=np.where(known, -1, side[p]).astype(np.int32),
                     parent_conv_id=pa.array(up, mask=~known), **columns(own, d))
    # the two spines
    own, d = rows(node[spine])
    prefix = (_prefixes(first, len(first) // DIGEST), _prefixes(last, len(last) // DIGEST))
    to_last = np.array(forest.right)[own] == items - 1
    on = np.where(on_left[own], 0, 1)
    # ids of the first and the last conversation come from the chunks
    values = columns(own, d)
    tip = d == depth[own]
    for i in np.flatnonzero(tip & ((own == 0) | (own == items - 1))).tolist():
        values["ends_sha256"][i] = None
    yield _batch(kind="spine", side=on.astype(np.int32), to_last=to_last,
                 tip=(d == len(last) // DIGEST) & to_last,
                 prefix=[prefix[s][k] for s, k in zip(on.tolist(), d.tolist())],
                 parent_prefix=[prefix[s][k - 1] if k else None for s, k in zip(on.tolist(), d.tolist())],
                 words_above=above[start[own] + d], words=above[start[own] + d] - above[start[own] + np.maximum(d - 1, 0)],
                 **values)


def _ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes the joined ids of each conversation, chunk by chunk in order."""
    name = sha = part = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["prefix"] != name:
                if name is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sha.hexdigest()])], names=["prefix", "sha"])
                name, sha, part = row["prefix"], hashlib.sha256(), row["part"]
            elif row["part"] != part:
                sha.update(b",")
                part = row["part"]
            sha.update(row["chunk"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sha.hexdigest()])], names=["prefix", "sha"])


def _spines(found: DataFrame) -> DataFrame:
    """Spine rows with what other partitions hold as well taken off: what is left adds up."""
    spine = found.where("kind = 'spine'")
    parts = spine.select("part").distinct()
    # one row per partition
    order = Window.orderBy("part")
    parts = parts.select("part", F.lag("part").over(order).alias("before"), F.lead("part").over(order).alias("after"))
    lasts = spine.where("to_last").select(F.col("part").alias("before"), "prefix")
    agree = (spine.where("side = 0").join(F.broadcast(parts.select("part", "before")), "part")
             .join(lasts, ["before", "prefix"])
             .groupBy("part").agg(F.max("depth").alias("agreed"), F.max_by("words_above", "depth").alias("agreed_words")))
    tips = spine.where("tip").select("part", F.col("depth").alias("tip_depth"))
    nexts = agree.select(F.col("part").alias("after"), F.col("agreed").alias("next_agreed"))
    known = (parts.join(agree, "part", "left").join(tips, "part", "left").join(nexts, "after", "left")
             .select("part", "agreed", "agreed_words",
                     F.coalesce(F.col("next_agreed") >= F.col("tip_depth"), F.lit(False)).alias("goes_on")))
    both = spine.join(small(known), "part")
    shared = F.coalesce((F.col("side") == 0) & (F.col("depth") <= F.col("agreed")), F.lit(False))
    return both.select(
        "part", "side", "depth", "prefix", "parent_prefix", "conv_id", "n_convs", "ends_sha256",
        (F.col("n_children") - (shared & (F.col("depth") < F.col("agreed"))).cast("long")).alias("n_children"),
        (F.col("n_leaves") - (F.col("goes_on") & F.col("to_last")).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + F.when(shared, F.col("agreed_words") - F.col("words_above") + F.col("words"))
         .otherwise(0)).alias("saved_tokens"))


def rebuilt(turns: DataFrame, shared: int = 4, family: int = 20) -> DataFrame:
    """(conv_id, key, words): conversations begin with the first turns of their family's first one.

    Conversation c takes the first h = crc32(c) % ``shared`` turns of c - c % ``family``, then its own
    after its first h. Turns are ordered by number, null first, equal numbers by their content.
    Null role and text are empty. Rows without conv_id belong to no conversation. A conversation's
    turns (24 bytes each) are one value.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST)
    words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")
    own = (turns.where("conv_id is not null")
           .select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
               F.col("turn"), digest.alias("digest"), words.alias("words")).alias("t"))
           .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own")))
    first = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, shared - 1).alias("lead"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    none = F.slice("own", 1, 0)
    built = (own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn("h", h)
             .join(first, "base", "left")
             .select("conv_id", F.concat(F.coalesce(F.slice("lead", F.lit(1), F.col("h")), none),
                                         F.slice("own", F.col("h") + 1, F.size("own"))).alias("turns")))
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    return built.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))


def nodes(conversations: DataFrame) -> DataFrame:
    """The prefix trie of rebuilt conversations (see ``rebuilt``), one row per node.

    Returns conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. Without conversations there is no root. Repeated rows are
    turns of their own.
    """
    bounded(conversations.sparkSession)
    ordered = stored(conversations, "conversations").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = stored(ordered.select("conv_id", "key", "words").mapInArrow(tb.tidy(_partition), _ROWS), "forest")
    spine = stored(_spines(found), "spines")
    ends = (found.where("kind = 'ends'").select("prefix", "part", "seq", "chunk").repartition("prefix")
            .sortWithinPartitions("prefix", "part", "seq").mapInArrow(_ends_of, "prefix binary, sha string"))
    merged = stored(
        spine.groupBy("prefix").agg(
            F.first("depth").alias("depth"), F.first("parent_prefix").alias("parent_prefix"),
            F.min("conv_id").alias("conv_id"), F.max(F.when(F.col("ends_sha256") != _EMPTY, F.col("ends_sha256"))).alias("ended"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
        .join(ends, "prefix", "left"), "merged")
    names = merged.select("prefix", F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = merged.join(names.withColumnRenamed("prefix", "parent_prefix"), "parent_prefix", "left").withColumn(
        "ends_sha256", F.coalesce("sha", "ended", F.lit(_EMPTY))).select(*columns)
    own = found.where("kind = 'node'")
    below = own.where("parent_side >= 0").drop("parent_conv_id").withColumn("above", F.col("depth") - 1)
    places = spine.join(names, "prefix").select("part", F.col("side").alias("parent_side"), F.col("depth").alias("above"), "parent_conv_id")
    return (own.where("parent_side < 0").select(*columns)
            .unionByName(below.join(small(places), ["part", "parent_side", "above"]).select(*columns))
            .unionByName(shared))
