"""Exact dedup by content sort: equal normalised texts become neighbours and are compared in full.

Sampled splitters range-partition the rows by a bounded key of the normalised bytes (their first
64, then their digest) followed by the order of preference, so a group of copies of any size is
split over as many partitions as it needs. Each partition is sorted externally, by Spark, on the
whole bytes; one streaming pass compares each row with its predecessor in full. Groups that cross
a partition boundary meet through at most two rows per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import textblocks as tb
from daybook.llm.tables import by_row, narrow, stored, without_rows

#: White space that does not count in comparisons.
BLANK = r"[\x20\x09-\x0D]+"
_RUNS = ("doc_id long, n_points long, text_sha256 string, keep_id long, run_size long, "
         "run_points long, part int, run long, edge boolean")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the runs of equal neighbours of one sorted partition.

    Holds one batch and, for a run that spans batches, its ids; rows leave when their run ends.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held: list[pa.RecordBatch] = []  # rows of the run that is still open
    last, run = None, 0

    def close(final: bool) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        n, best = rows.num_rows, rows.slice(0, 1)
        same = lambda v, kind: pa.array([v] * n, kind)
        return pa.RecordBatch.from_arrays([
            *(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (
                rows["doc_id"], rows["n_points"], rows["text_sha256"])),
            same(best["doc_id"][0].as_py(), pa.int64()), same(n, pa.int64()),
            same(best["n_points"][0].as_py(), pa.int64()), same(part, pa.int32()),
            same(run, pa.int64()), same(run == 0 or final, pa.bool_())],
            names=[f.split()[0] for f in _RUNS.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("content")
        fresh = np.ones(batch.num_rows, bool)
        fresh[0] = last is None or text[0].as_py() != last
        if batch.num_rows > 1:
            fresh[1:] = pc.not_equal(text.slice(1), text.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        last = text[batch.num_rows - 1].as_py()
        slim = batch.select(["doc_id", "n_points", "text_sha256"])
        cuts = np.flatnonzero(fresh).tolist()
        if cuts and cuts[0] > 0 or not cuts:
            held.append(slim.slice(0, cuts[0] if cuts else batch.num_rows))
        if not cuts:
            continue
        if held:
            yield close(False)
            run += 1
        if len(cuts) > 1:  # runs that begin and end in this batch, all at once
            yield _whole(slim.slice(cuts[0], cuts[-1] - cuts[0]), np.diff(cuts), part, run)
            run += len(cuts) - 1
        held = [slim.slice(cuts[-1])]
    if held:
        yield close(True)


def _whole(rows: pa.RecordBatch, sizes: np.ndarray, part: int, run: int) -> pa.RecordBatch:
    n, first = rows.num_rows, np.cumsum(sizes) - sizes
    pick = pa.array(np.repeat(first, sizes))
    number = np.repeat(np.arange(len(sizes)) + run, sizes)
    return pa.RecordBatch.from_arrays([
        *rows.columns, rows.column("doc_id").take(pick), pa.array(np.repeat(sizes, sizes), pa.int64()),
        rows.column("n_points").take(pick), pa.array(np.full(n, part), pa.int32()),
        pa.array(number, pa.int64()), pa.array(number == 0)],
        names=[f.split()[0] for f in _RUNS.split(", ")])


def copies(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and all empty texts are equal. Of equal texts the one with the most
    code points stays, then the smallest doc_id (null ids last). Rows that repeat an id are counted
    apart; all rows with the id that stays are kept. Columns other than doc_id and text are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    content = F.regexp_replace(text, BLANK, "")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.length("text").cast("long").alias("n_points"),
        content.cast("binary").alias("content"))
    keyed = keyed.withColumn("text_sha256", F.sha2("content", 256)).withColumn(
        "head", F.substring("content", 1, 64))
    order = ["head", "text_sha256", F.desc("n_points"), F.asc_nulls_last("doc_id")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(
        "head", "text_sha256", "content", F.desc("n_points"), F.asc_nulls_last("doc_id"))
    runs = stored(ordered.select("doc_id", "n_points", "text_sha256", "content")
                  .mapInArrow(tb.tidy(_compare), _RUNS), "runs")

    best = F.min(F.struct(-F.col("run_points"), F.col("keep_id").isNull(), "keep_id"))
    # at most two runs of a partition touch its ends, so this side has two rows per partition
    ends = (runs.where("edge").groupBy("text_sha256", "part", "run")
            .agg(F.first("run_size").alias("run_size"), F.first("run_points").alias("run_points"),
                 F.first("keep_id").alias("keep_id"))
            .groupBy("text_sha256").agg(F.sum("run_size").alias("all_size"), best.alias("best"))
            .select("text_sha256", "all_size", F.col("best.keep_id").alias("all_keep")))
    found = runs.join(F.broadcast(ends), "text_sha256", "left")
    keep = F.when(F.col("edge"), F.col("all_keep")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"),
                        F.when(F.col("edge"), F.col("all_size")).otherwise(F.col("run_size")).alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts: the longest, then the smallest doc_id.

    Decided row by row: of rows that repeat an id or have none each stays or goes for its own text,
    and among equal ones a row without an id, or with an id that an earlier row has, comes last.
    """
    rows = by_row(docs)
    return without_rows(rows, copies(narrow(rows)).where("not kept"))
