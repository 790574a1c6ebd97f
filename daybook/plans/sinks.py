"""Writing tables: Parquet, CSV, JSON, relational databases, run state."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.plans.books import Books
from daybook.schema import CONFIG, TABLES

JDBC_BATCH = 1000


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the stored table."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Add to the stored table, e.g. one fiscal year per run."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is taken while it is written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_all(tables: Mapping[str, DataFrame], write: Callable[[str, DataFrame], None],
              at_once: int = 4) -> dict[str, int]:
    """Write several tables, a few at a time; rows written per table."""
    def one(name: str) -> tuple[str, int]:
        df, seen = counted(tables[name], name)
        write(name, df)
        return name, seen.get["rows"]

    with ThreadPoolExecutor(at_once) as pool:
        return dict(pool.map(one, list(tables)))


def load(books: Mapping[str, DataFrame], folder: str, truncate: bool = True) -> dict[str, int]:
    """Write every table below ``folder``, replacing what is there or adding to it."""
    write = full_refresh if truncate else append
    return write_all(books, lambda name, df: write(df, f"{folder.rstrip('/')}/{name}"))


def save_bucketed(books: Books, folder: str, buckets: int = 64, database: str = "default") -> None:
    """Store transaction tables bucketed and sorted by voucher, masters plainly.

    Joins of a voucher with its lines then need no shuffle.
    """
    for name in books:
        writer = books[name].write.mode("overwrite").option("path", f"{folder.rstrip('/')}/{name}")
        if "guid" in books[name].columns and TABLES[name].half == "transaction":
            writer = writer.bucketBy(buckets, "guid").sortBy("guid")
        writer.saveAsTable(f"{database}.{name}")


def open_bucketed(spark: SparkSession, names: list[str], database: str = "default") -> Books:
    return Books(spark, {n: spark.table(f"{database}.{n}") for n in names}, colocated=True)


def csv_text(df: DataFrame) -> DataFrame:
    """Values as CSV fields: no line breaks or tabs in text, 1/0 for booleans, ISO dates."""
    def clean(name: str, dtype: str):
        c = F.col(f"`{name}`")
        if dtype == "string":
            one_line = F.regexp_replace(F.replace(c, F.lit("\r"), F.lit("")), "[\n\t]", " ")
            return one_line.alias(name)
        if dtype == "boolean":
            return c.cast("tinyint").cast("string").alias(name)
        return c.cast("string").alias(name)

    return df.select(*[clean(n, t) for n, t in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, every field quoted, quotes doubled, NULL empty."""
    csv_text(df).write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', quoteAll=True, emptyValue="", nullValue="")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, NULL fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def jdbc_options(url: str, table: str, connections: int = 16, driver: str | None = None,
                 properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of the relational sink: batched inserts over a bounded number of connections."""
    options = {"url": url, "dbtable": table, "batchsize": str(JDBC_BATCH),
               "numPartitions": str(connections), "isolationLevel": "READ_COMMITTED",
               **(properties or {})}
    return {**options, "driver": driver} if driver else options


def write_jdbc(df: DataFrame, url: str, table: str, truncate: bool = True, **options) -> None:
    """Load a database table from all executors, emptying it first unless appending."""
    writer = df.write.format("jdbc").options(**jdbc_options(url, table, **options))
    writer.option("truncate", "true").mode("overwrite" if truncate else "append").save()


# Names of the run-state entries.
STATE_TIMESTAMP = "Update Timestamp"
STATE_COMPANY = "Company Name"
STATE_FROM = "Period From"
STATE_TO = "Period To"
STATE_MASTER = "Last AlterID Master"
STATE_TRANSACTION = "Last AlterID Transaction"
#: Not one of the six: the source's number at the last sync run, which a stream does not move.
STATE_SYNCED = "Synced AlterID Transaction"


def run_state(spark: SparkSession, company: str, period_from, period_to, last_master: int,
              last_transaction: int, at: dt.datetime | None = None) -> DataFrame:
    """The six name/value rows that describe a finished run."""
    at = at or dt.datetime.now()
    return spark.createDataFrame([
        (STATE_TIMESTAMP, at.isoformat(sep=" ", timespec="seconds")), (STATE_COMPANY, company),
        (STATE_FROM, str(period_from)), (STATE_TO, str(period_to)),
        (STATE_MASTER, str(last_master)), (STATE_TRANSACTION, str(last_transaction)),
    ], CONFIG.schema)


def write_state(state: DataFrame, path: str) -> None:
    """Written last: a run that fails earlier leaves the old state and is repeated."""
    state.coalesce(1).write.mode("overwrite").parquet(path)
