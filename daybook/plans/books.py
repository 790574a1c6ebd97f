"""A set of accounting tables, addressed by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schema import CONFIG, TABLES, Table, incremental_columns


class Books(Mapping[str, DataFrame]):
    """Tables by name; each is built on first use so a report only plans what it reads."""

    def __init__(self, spark: SparkSession,
                 tables: Mapping[str, DataFrame | Callable[[], DataFrame]], colocated: bool = False):
        self.spark = spark
        self.colocated = colocated  # transaction tables are bucketed by guid
        self._tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") and name not in self.__dict__.get("_tables", {}):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError:
            raise AttributeError(name) from None

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def with_tables(self, **tables: DataFrame) -> "Books":
        return Books(self.spark, {**self._tables, **tables}, self.colocated)

    def create_views(self) -> None:
        for name in self:
            self[name].createOrReplaceTempView(name)


def default_of(sql_type: str) -> Column:
    """What a missing field is stored as: '' for text, NULL for dates, 0 for numbers."""
    if sql_type == "string":
        return F.lit("")
    return F.lit(None if sql_type == "date" else 0).cast(sql_type)


def conform(df: DataFrame, table: Table | str, incremental: bool = False) -> DataFrame:
    """Exactly the columns of ``table`` in order, typed, absent ones defaulted."""
    table = TABLES[table] if isinstance(table, str) else table
    wanted = (incremental_columns(table) if incremental
              else [(c, table.type(c)) for c in table.columns])
    return df.select(*[
        (F.col(f"`{c}`").cast(t) if c in df.columns else default_of(t)).alias(c) for c, t in wanted
    ])


def open_books(spark: SparkSession, folder: str, names: list[str] | None = None) -> Books:
    """Books stored as one Parquet folder per table."""
    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(f"{folder.rstrip('/')}/{name}")

    return Books(spark, {n: reader(n) for n in (names or [CONFIG.name, *TABLES])})
