"""Near-duplicate join on word shingles by signature trees.

Documents with equal shingle sets are one class. Classes that can have a partner are found by
counting: linked sets share a known part of their shingles with the lowest hashes (the region), so
a class whose region holds too few shared shingles stands alone. The others meet through the rarest
shared shingles of their regions; the components of that candidate graph are clusters, small as a
rule, and each cluster is joined by signature trees. A cluster above a bounded size is cut into
blocks: trees within blocks first, then among one set of each component, and then, block against
block, among the sets that can still have a link to another component.

Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import signature_tree as st
from daybook.llm import textblocks as tb
from daybook.llm.components import components
from daybook.llm.dealing import DEALT, dealer_of, flat, frequencies, numbers, packed
from daybook.llm.tables import by_row, narrow, small, stored, without_rows

SLICE_BYTES = 256 << 10
#: Frequencies from here on count as equal.
FREQUENT = 256
#: Shingles of a group that one task joins; larger clusters are cut into blocks.
GROUP_TOKENS = 2_000_000
_MIX = [int(x) for x in tb.mix(np.arange(11, 24, dtype=np.uint64))]


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, text after text, and their numbers.

    A text of fewer words than ``size`` has its whole sequence as one shingle.
    """
    starts, ends, doc = tb.words(data, offsets, tb.SPACE)
    h = tb.word_hashes(data, starts, ends)
    n = np.bincount(doc, minlength=len(offsets) - 1)
    full = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for k in range(size):
        full += h[k:k + len(full)] * tb.U64(_MIX[k % 13] ^ (k * 2 + 1))
    own = doc[:len(full)] == doc[size - 1:size - 1 + len(full)]
    short = np.flatnonzero((n > 0) & (n < size))
    value, owner = [tb.mix(full[own])], [doc[:len(full)][own]]
    if len(short):
        first = (np.cumsum(n) - n)[short]
        rows = tb.ranges(first, n[short])
        place = rows - np.repeat(first, n[short])
        part = h[rows] * tb.mix(place.astype(np.uint64) + tb.U64(77))
        sums = np.add.reduceat(part, np.cumsum(n[short]) - n[short]) + n[short].astype(np.uint64)
        value.append(tb.mix(sums ^ tb.U64(_MIX[12])))
        owner.append(short)
    value, owner = np.concatenate(value), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[fresh], np.bincount(owner[fresh], minlength=len(n))


_PROFILE = "doc_id long, n long, digest binary, cid long, region binary"


def _profiler(size: int) -> Callable:
    def profiler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, "text", SLICE_BYTES):
                value, n = shingles(*tb.byte_view(part.column("text")), size)
                ends = np.cumsum(n)
                digests = [hashlib.blake2b(value[e - k:e].data, digest_size=16).digest()
                           for e, k in zip(ends.tolist(), n.tolist())]
                cid = np.frombuffer(b"".join(digests), np.int64)[::2]
                keep = np.where(n > 0, n // 4 + 1, 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(digests, pa.binary()),
                     pa.array(cid), packed(value[tb.ranges(ends - n, keep)], keep)],
                    names=[f.split()[0] for f in _PROFILE.split(", ")])
    return profiler


def _candidates(shared: pa.Table, classes: pa.Table) -> pa.Table:
    """The rarest shared shingles of classes that share enough of their regions."""
    hashes, cids, df = flat(shared)
    order = np.lexsort((hashes, df, cids))
    hashes, cids = hashes[order], cids[order]
    # a shingle that was sent twice stands twice in one class with one frequency
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (cids[1:] != cids[:-1])
    hashes, cids = hashes[fresh], cids[fresh]
    own, size = classes["cid"].to_numpy().view(np.uint64), classes["n"].to_numpy()
    sort = np.argsort(own)
    own, size = own[sort], size[sort]
    at = np.flatnonzero(np.concatenate([[True], cids[1:] != cids[:-1]])) if len(cids) else np.zeros(0, np.int64)
    count = np.diff(np.append(at, len(cids)))
    n = size[np.searchsorted(own, cids[at])] if len(at) else np.zeros(0, np.int64)
    # partners have 0.8 n shingles or more, so at least n / 25 + 1/4 of either region are common
    least = np.maximum(-(-(4 * n + 25) // 100), 1)
    keep = np.where(count >= least, count - least + 1, 0)
    picked = tb.ranges(at, keep)
    return pa.table({"hash": hashes[picked].view(np.int64), "cid": cids[picked].view(np.int64)})


_SETS = "cluster long, doc_id long, n long, tokens binary"


def _setter(size: int) -> Callable:
    def setter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, "text", SLICE_BYTES):
                value, n = shingles(*tb.byte_view(part.column("text")), size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("cluster"), part.column("doc_id"), pa.array(n.astype(np.int64)), packed(value, n)],
                    names=["cluster", "doc_id", "n", "tokens"])
    return setter


def _tree_links(table: pa.Table) -> pa.Table:
    """Links (a, b) that join what the trees find to be one component."""
    tb.trim()
    tokens, n = numbers(table["tokens"])
    ids = table["doc_id"].to_numpy()
    known = table["comp"].to_numpy() if "comp" in table.column_names else None
    label = st.links(tokens, n, known)
    b = ids[label]
    differ = ids != b
    return pa.table({"a": ids[differ], "b": b[differ]})


_LINKS = "a long, b long"


def _joined(sets: DataFrame, keys: list[str]) -> DataFrame:
    return sets.groupBy(*keys).applyInArrow(_tree_links, _LINKS)


def _blocks(sets: DataFrame, tokens: int) -> DataFrame:
    """Adds ``blocks``, the number that a set's cluster is cut into; the sums combine before they move."""
    need = sets.groupBy("cluster").agg(F.ceil(F.sum("n") / tokens).alias("blocks"))
    return sets.join(need, "cluster")


def _links(sets: DataFrame, tokens: int) -> DataFrame:
    """Links between sets of the same cluster, enough to connect every component."""
    cut = _blocks(sets, tokens)
    spread = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    # small clusters share a group; a large one has a group for each block
    shares = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    one = F.col("blocks") <= 1
    keyed = cut.select("*", F.when(one, F.lit(-1)).otherwise(F.col("cluster")).alias("big"),
                       F.when(one, F.pmod(F.xxhash64("cluster"), F.lit(shares))).otherwise(spread).alias("block"))
    found = stored(_joined(keyed, ["big", "block"]), "links")
    large = stored(cut.where(~one).drop("blocks"), "large")
    if large.isEmpty():
        return found
    # second: one set of each component, until a round fits one block each or joins nothing
    while True:
        comp = components(found)
        known = stored(large.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                       .withColumn("comp", F.coalesce("root", "doc_id")).drop("root"), "known")
        heads = _blocks(known.where("comp = doc_id"), tokens)
        more = stored(_joined(heads.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("blocks"))),
                              ["cluster", "block"]), "links")
        if more.isEmpty():
            break
        found = stored(found.unionByName(more), "links")
    # last: sets with enough shingles that another component has as well, block against block
    token = known.select("cluster", "doc_id", "comp", "n", F.explode(_as_longs("tokens")).alias("token"))
    shared = (token.groupBy("cluster", "token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
              .where("lo < hi").select("cluster", "token"))
    alive = (token.join(shared, ["cluster", "token"], "left_semi").groupBy("cluster", "doc_id", "n")
             .count().where("100 * count >= 80 * n").select("cluster", "doc_id"))
    rest = _blocks(stored(known.join(alive, ["cluster", "doc_id"], "left_semi"), "rest"), max(tokens // 2, 1))
    mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    pairs = (rest.withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("p", F.least("mine", "other")).withColumn("q", F.greatest("mine", "other")))
    return found.unionByName(_joined(pairs.drop("blocks", "mine", "other"), ["cluster", "p", "q"]))


def _as_longs(column: str):
    """The 8-byte pieces of a binary column as numbers."""
    at = F.sequence(F.lit(1), F.length(column), F.lit(8))
    return F.transform(at, lambda i: F.conv(F.hex(F.substring(F.col(column), i, F.lit(8))), 16, -10).cast("long"))


def join(docs: DataFrame, size: int = 5, tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when 100 * |intersection| >= 80 * |union| of their distinct shingles of
    ``size`` words (words between white space, A-Z lowered; a text of fewer words is one shingle).
    component_id is the smallest doc_id reachable by links. Null, empty and blank texts have no
    shingles and link with nothing. Rows that share an id count as one node; a row without an id
    takes the component of the documents with an equal set, null if none has an id.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = stored(slim.mapInArrow(tb.tidy(_profiler(size)), _PROFILE), "profiles")
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    regions = profile.where("n > 0").select("cid", "region").mapInArrow(tb.tidy(dealer_of(buckets, FREQUENT)), DEALT)
    shared = regions.groupBy("bucket").applyInArrow(frequencies(buckets, FREQUENT), DEALT)
    modulus = F.pmod(F.col("cid").cast("decimal(20,0)") + F.when(F.col("cid") < 0, F.lit("18446744073709551616").cast("decimal(20,0)"))
                     .otherwise(0), F.lit(buckets)).cast("int")
    classes = profile.where("n > 0").select("cid", "n").distinct().withColumn("bucket", -1 - modulus)
    posting = stored(shared.groupBy("bucket").cogroup(classes.groupBy("bucket"))
                     .applyInArrow(_candidates, "hash long, cid long"), "postings")
    roots = posting.groupBy("hash").agg(F.min("cid").alias("b"), F.max("cid").alias("top")).where("b < top")
    cluster = components(posting.join(roots.drop("top"), "hash").select(F.col("cid").alias("a"), "b"))

    heads = (profile.where("n > 0").groupBy("digest", "cid").agg(F.min("doc_id").alias("doc_id"))
             .join(cluster.select(F.col("node").alias("cid"), F.col("root").alias("cluster")), "cid")
             .where("doc_id is not null").select("doc_id", "cluster"))
    heads = stored(heads, "heads")
    sets = stored(slim.join(small(heads), "doc_id").select("cluster", "doc_id", "text")
                  .mapInArrow(tb.tidy(_setter(size)), _SETS), "sets")
    comp = components(_links(sets, tokens))

    first = profile.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("head"), F.count("*").alias("copies"))
    special = (first.join(comp.withColumnRenamed("node", "head"), "head", "left")
               .where("copies > 1 or root is not null or head is null")
               .select("digest", F.coalesce("root", "head").alias("class")))
    return (profile.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(stored(special, "classes"), "digest", "left")
            .select("doc_id", "n_shingles", F.coalesce("class", "doc_id").alias("component_id")))


def keep_first(docs: DataFrame, size: int = 5) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    Decided row by row: rows that repeat an id or have none are documents of their own and come
    after all others of their component. Null, empty and blank texts stay.
    """
    rows = by_row(docs)
    return without_rows(rows, join(narrow(rows), size).where("doc_id > component_id"))
