"""Whitening of embeddings with Spark MLlib's BlockMatrix.

Entries become integers, x = floor(64 c) + 1,000,000, so that counts, sums and deviations are exact.
Rows are numbered without gaps and centred before anything is multiplied: n x - S is an integer, and
only its quotient by n is rounded. The centred rows are dealt into blocks; their transpose times
themselves is the scatter, whose eigenvectors are found on the driver (as many numbers as dimensions
squared); the blocks times the whitening matrix are the projected rows. The identity error is
measured on these rows, not derived.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm import textblocks as tb
from daybook.llm.tables import bounded, stored

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
#: Rows of a block.
BLOCK_ROWS = 1024
#: A component with less than this part of the greatest variance is rounding, not data.
LEAST = 1e-12
_SAFE = 2 ** 62


@dataclass(frozen=True)
class Whitening:
    """What was learned: rows, exact sums per dimension, unit eigenvectors (columns) and eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _numbered(dims: int) -> Callable:
    """Integer entries of the rows that take part, numbered within their partition."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            c = batch.column("c").values.to_numpy(zero_copy_only=False).reshape(n, dims)
            x = np.floor(SCALE * c).astype(np.int64) + SHIFT
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(at, at + n)),
                pa.ListArray.from_arrays(np.arange(0, n * dims + 1, dims, dtype=np.int32), x.ravel())],
                names=["vec_id", "part", "place", "x"])
            at += n
    return number


def _rows_of(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums of a partition."""
    total = None
    for batch in batches:
        if batch.num_rows:
            x = _rows_of(batch, "x").sum(axis=0)
            total = x if total is None else total + x
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["sums"])


def _centred(n: int, sums: list[int]) -> Callable:
    """Centred rows and their exact deviation."""
    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.array(sums, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows_of(batch, "x")
            # 64 bits where they do, else Python's integers
            wide = max(abs(int(x.max())), abs(int(x.min()))) * n > _SAFE or max(map(abs, sums)) > _SAFE
            exact = x.astype(object) * n - total if wide else x * n - total.astype(np.int64)
            far = exact.astype(object) if int(np.abs(exact).max()) ** 2 * x.shape[1] > _SAFE else exact
            deviation = (far * far).sum(axis=1)
            y = (exact / n).astype(np.float64)
            yield pa.RecordBatch.from_arrays([
                batch.column("part"), batch.column("place"), batch.column("vec_id"),
                pa.array([v if -2 ** 63 <= v < 2 ** 63 else None for v in map(int, deviation)], pa.int64()),
                pa.ListArray.from_arrays(np.arange(0, y.size + 1, y.shape[1], dtype=np.int32), y.ravel())],
                names=["part", "place", "vec_id", "deviation", "y"])
    return centre


def _scatters(column: str) -> Callable:
    """Sum and scatter of a partition's rows."""
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = gram = None
        for batch in batches:
            if not batch.num_rows:
                continue
            z = _rows_of(batch, column)
            total = z.sum(axis=0) if total is None else total + z.sum(axis=0)
            gram = z.T @ z if gram is None else gram + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([gram.ravel()])], names=["sums", "gram"])
    return scatter


def _added(df: DataFrame, column: str) -> list:
    """Element-wise sum of arrays of one length, in order."""
    rows = (df.select(F.posexplode(column).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect())
    return [r["v"] for r in rows]


_PLACE = T.StructType([T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])
_INTS, _DOUBLES = (pa.list_(pa.field("element", kind, False)) for kind in (pa.int32(), pa.float64()))
#: A matrix as Spark stores it.
_MATRIX = [pa.field("type", pa.int8(), False), pa.field("numRows", pa.int32(), False), pa.field("numCols", pa.int32(), False),
           pa.field("colPtrs", _INTS), pa.field("rowIndices", _INTS), pa.field("values", _DOUBLES),
           pa.field("isTransposed", pa.bool_(), False)]
_BLOCK = T.StructType([T.StructField("place", _PLACE), T.StructField("block", MatrixUDT())])


def _assembled(rows: pa.Table) -> pa.Table:
    """One block of the matrix from its rows, in the layout of a dense matrix kept row by row."""
    rows = rows.sort_by("index").combine_chunks()
    y = rows["y"].combine_chunks() if isinstance(rows["y"], pa.ChunkedArray) else rows["y"]
    n, none = rows.num_rows, pa.array([None], _INTS)
    dims = len(y.flatten()) // n
    block = pa.StructArray.from_arrays(
        [pa.array([1], pa.int8()), pa.array([n], pa.int32()), pa.array([dims], pa.int32()), none, none,
         pa.ListArray.from_arrays(pa.array([0, n * dims], pa.int32()), y.flatten(), type=_DOUBLES), pa.array([True])],
        fields=_MATRIX)
    place = pa.StructArray.from_arrays([pa.array([rows["index"][0].as_py() // BLOCK_ROWS]), pa.array([0])], names=["i", "j"])
    return pa.table([place, block], names=["place", "block"])


def _blocks(rows: DataFrame, dims: int) -> BlockMatrix:
    """(index, y) as blocks of ``BLOCK_ROWS`` rows and all columns."""
    dealt = rows.select("index", "y").groupBy(F.floor(F.col("index") / BLOCK_ROWS)).applyInArrow(_assembled, _BLOCK)
    return BlockMatrix(callMLlibFunc("createBlockMatrix", dealt, BLOCK_ROWS, dims, 0, 0), BLOCK_ROWS, dims)


def _scatter(blocks: BlockMatrix, splits: int) -> np.ndarray:
    """Transpose times blocks: products are formed in ``splits`` tasks and added up, never in one."""
    model = blocks.transpose()._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(model, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def _usable(embeddings: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """vec_id and entries of the rows that take part, and their length."""
    c = F.col(vector).cast("array<double>")
    fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(
        c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = embeddings.where(F.coalesce(fine, F.lit(False))).select("vec_id", c.alias("c"))
    size = rows.groupBy(F.size("c").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return (rows, 0) if size is None else (rows.where(F.size("c") == size["dims"]), size["dims"])


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    Rows take no part whose vector is null, empty or holds null, NaN or infinite entries, nor those
    whose vector is not as long as most are (of equally many the longer). All others count, repeated
    ones and those without an id too. There are fewer components than asked for where the rows span
    fewer dimensions, none where they are all the same. A deviation beyond 64 bits is null. Other
    columns are ignored. Entries are taken to be less than 2**50 in size.
    """
    spark = bounded(embeddings.sparkSession)
    rows, dims = _usable(embeddings, vector)
    if not dims:
        return spark.createDataFrame([], _RESULT)
    numbered = stored(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "c")
                      .mapInArrow(_numbered(dims), "vec_id long, part int, place long, x array<long>"), "vectors")
    parts = numbered.groupBy("part").agg(F.max("place").alias("last")).orderBy("part").collect()  # one row a task
    starts, n = [], 0
    for r in parts:
        starts.append((r["part"], n))
        n += r["last"] + 1
    sums = [int(v) for v in _added(numbered.mapInArrow(_sums, "sums array<long>").select(
        F.col("sums").cast("array<decimal(20,0)>").alias("sums")), "sums")]
    offsets = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    centred = stored(numbered.mapInArrow(
        _centred(n, sums), "part int, place long, vec_id long, deviation long, y array<double>")
        .join(offsets, "part").select((F.col("start") + F.col("place")).alias("index"), "vec_id", "deviation", "y"), "centred")
    blocks = _blocks(centred, dims)
    splits = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(parts))
    learned = _learned(n, sums, _scatter(blocks, splits) / n, components)
    if not len(learned.values):
        return spark.createDataFrame([], _RESULT)
    projected = stored(_projected(spark, blocks, learned.matrix), "projected")
    k = len(learned.values)
    gram = projected.mapInArrow(_scatters("z"), "sums array<double>, gram array<double>")
    mean = np.array(_added(gram, "sums")) / n
    covariance = np.array(_added(gram, "gram")).reshape(k, k) / n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = F.array(*[F.lit(float(v / learned.trace)) for v in learned.values])
    return (projected.join(centred.select("index", "vec_id", "deviation"), "index")
            .select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"),
                    F.lit(error).alias("identity_error")))


def _learned(n: int, sums: list[int], covariance: np.ndarray, components: int) -> Whitening:
    """Eigenvectors by falling eigenvalue, those without variance left out."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(values.max(initial=0.0), 0.0) * LEAST]
    return Whitening(n, sums, vectors[:, order], values[order], float(np.trace(covariance)))


def _projected(spark, blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """(index, z): blocks times the whitening matrix, which is one block of its own."""
    d, k = matrix.shape
    local = DenseMatrix(d, k, matrix.ravel(order="F").tolist())
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), local)], 1), d, k)
    product = blocks.multiply(right)
    return callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model).mapInArrow(
        _rows_of_blocks, "index long, z array<double>")


def _rows_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            place, block = row.values()
            n, k = block["numRows"], block["numCols"]
            z = np.array(block["values"]).reshape((n, k) if block["isTransposed"] else (k, n))
            z = z if block["isTransposed"] else np.ascontiguousarray(z.T)
            yield pa.RecordBatch.from_arrays([
                pa.array(place["_1"] * BLOCK_ROWS + np.arange(n)),
                pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), z.ravel())], names=["index", "z"])
