"""Scans over source tables and documents: periods, versions, filters and aggregates."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.calendar import as_date
from daybook.plans.books import Books
from daybook.schema import tables

# Aggregates a source may compute.
AGGREGATES = {"SUM": F.sum, "COUNT": F.count, "AVG": F.avg, "MIN": F.min, "MAX": F.max}


def in_period(df: DataFrame, start=None, end=None, date: str = "date") -> DataFrame:
    """Rows dated within the inclusive bounds; the comparison reaches the Parquet scan."""
    if start is not None:
        df = df.where(F.col(date) >= as_date(start))
    if end is not None:
        df = df.where(F.col(date) <= as_date(end))
    return df


def select_half(books: Books, masters: bool = True, transactions: bool = True) -> Books:
    """Master tables only, transaction tables only, or both."""
    wanted = {"master": masters, "transaction": transactions}
    names = [t.name for t in tables() if wanted[t.half] and t.name in books]
    return Books(books.spark, {n: (lambda n=n: books[n]) for n in names}, books.colocated)


def all_of(df: DataFrame, conditions: list[str | Column]) -> DataFrame:
    """Rows that satisfy every condition."""
    return reduce(lambda d, c: d.where(c), conditions, df)


def versions(df: DataFrame) -> DataFrame:
    """Key and change number of every row."""
    return df.select("guid", F.col("alterid").cast("bigint").alias("alterid"))


def changed_after(df: DataFrame, last: int) -> DataFrame:
    """Rows whose change number lies beyond the last one synchronised."""
    return df.where(F.col("alterid") > last)


def computed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add columns given as SQL expressions over the source."""
    return df.withColumns({name: F.expr(e) for name, e in columns.items()})


def aggregated(df: DataFrame, by: Mapping[str, str], measures: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Group by named expressions; ``measures`` is ``name -> (SUM|COUNT|AVG|MIN|MAX, expression)``."""
    keys = [F.expr(e).alias(name) for name, e in by.items()]
    return df.groupBy(*keys).agg(*[
        AGGREGATES[fn.upper()](F.expr(e)).alias(name) for name, (fn, e) in measures.items()])


def companies(parts: Mapping[str, DataFrame]) -> DataFrame:
    """The same table of several companies as one, told apart by ``company``."""
    named = [df.withColumn("company", F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named)
