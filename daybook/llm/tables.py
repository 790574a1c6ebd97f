"""Reading the given tables, intermediate tables in the shared folder, size-checked joins."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch

#: A side of a join is broadcast only up to this many rows of a few numbers each.
BROADCAST_ROWS = 200_000


#: Rows and bytes of text that pass between Spark and Python at once; documents can be long.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def _importable(spark: SparkSession) -> None:
    """Sends this package to the Python workers where they would not find it by themselves."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    seen = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if any(p and Path(p, "daybook").exists() for p in seen) or not root.is_dir():
        return
    if not getattr(context, "_daybook_sent", False):
        target = Path(tempfile.mkdtemp(prefix="package-")) / "daybook.zip"  # read on the driver, which serves it
        with zipfile.ZipFile(target, "w") as out:
            for f in sorted(root.glob("daybook/**/*.py")):
                out.write(f, f.relative_to(root))
        context.addPyFile(str(target))
        context._daybook_sent = True


def bounded(spark: SparkSession) -> SparkSession:
    """The session, with batches for Python that stay small where documents are long."""
    _importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: a cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    # the default codec keeps buffers of the size of a page outside the heap, and packed rows are large
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a table for broadcast if a count that stops at ``most`` rows shows it is small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def held_out(column: str = "doc_id"):
    """Rows that no label may be learned from: crc32 of the id as text divisible by five."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


#: The column that tells rows apart.
ROW = "__row"


def by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for every row, in the order of doc_id.

    The first row of each doc_id has the id itself. Further rows with that id, and those without
    one, get numbers beyond all ids (which are below 2**62). Where no id is missing or repeated,
    nothing is written or joined.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("__id"))
    odd = ids.groupBy("__id").agg(F.count("*").alias("n")).where("n > 1 or __id is null")
    if odd.isEmpty():
        return docs.withColumn(ROW, F.col("doc_id").cast("long"))
    placed = stored(docs.withColumn("__id", F.col("doc_id").cast("long"))
                    .withColumn("__place", F.monotonically_increasing_id()), "rows")
    top = placed.agg(F.coalesce(F.max("__id"), F.lit(0))).first()[0]
    firsts = (placed.select("__id", "__place").where("__id is not null").groupBy("__id")
              .agg(F.min("__place").alias("__first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    first = F.col("__id").isNotNull() & F.coalesce(F.col("__first") == F.col("__place"), F.lit(True))
    return placed.join(small(firsts), "__id", "left").withColumn(
        ROW, F.when(first, F.col("__id")).otherwise(F.col("__place") + F.lit(max(top, 0) + 1))).select(*docs.columns, ROW)


def without_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``by_row`` whose number is not among ``dropped`` (doc_id), in their old columns."""
    gone = stored(dropped.select(F.col("doc_id").alias(ROW)), "dropped")
    return rows.join(small(gone), ROW, "left_anti").drop(ROW)


def narrow(rows: DataFrame) -> DataFrame:
    """Row number as doc_id, and text."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")
