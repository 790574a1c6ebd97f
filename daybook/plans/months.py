"""Vouchers and their lines by the month of the voucher.

The month is a number such as 202004, 0 where there is no date or no voucher. Small books go by
years instead, 202000. It is a column of stored transaction tables that is no part of the books:
layouts partition by it, period reports prune by it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.calendar import as_date
from daybook.operators.lookup import lookup
from daybook.plans.books import Books
from daybook.schema import TABLES

MONTH = "_month"


def month_of(date: Column | str = "date", by: str = "month") -> Column:
    c = F.col(date) if isinstance(date, str) else date
    return F.coalesce(F.year(c) * 100 + (F.month(c) if by == "month" else F.lit(0)), F.lit(0)).cast("int")


def is_dealt(name: str, df: DataFrame) -> bool:
    """Whether rows of the table belong to vouchers."""
    return "guid" in df.columns and not name.startswith("mst_")


def placed(tables: Mapping[str, DataFrame], by: str = "month") -> dict[str, DataFrame]:
    """The tables with the month of each row's voucher; others as they are.

    A header's month is that of its date. A line keeps the month it has and takes it from the
    header in ``tables`` otherwise.
    """
    heads = tables["trn_voucher"].withColumn(MONTH, month_of(by=by)) if "trn_voucher" in tables else None
    out = {}
    for name in tables:
        df = tables[name]
        if name == "trn_voucher":
            df = heads
        elif is_dealt(name, df) and MONTH not in df.columns:
            if heads is None:
                df = df.withColumn(MONTH, F.lit(0))
            else:  # a voucher has few lines, so its key is never hot
                df = lookup(df, heads.select("guid", MONTH), "guid", "left", unique=True).withColumn(
                    MONTH, F.coalesce(MONTH, F.lit(0)))
        out[name] = df
    return out


def of_all_headers(lines: DataFrame, heads: DataFrame, repeated: DataFrame) -> DataFrame:
    """Lines that carry their document's month, as a join to the headers ``heads`` gives them.

    That is the same but for vouchers whose guid several headers have, the ``repeated`` ones: there a line
    comes once with the month of each.
    """
    months = lookup(heads.select("guid", MONTH), repeated, "guid", "left_semi", measure=True).groupBy("guid").agg(
        F.collect_list(MONTH).alias("_months"))
    own = F.array(MONTH)
    return lookup(lines, months, "guid", "left", measure=True, unique=True).withColumn(
        MONTH, F.explode(F.coalesce("_months", own))).select(*lines.columns)


def within(lines: DataFrame, start=None, end=None) -> DataFrame:
    """Rows whose voucher may lie in the period, judged by month where the layout has it."""
    if MONTH not in lines.columns:
        return lines
    # years are numbers that end in 00
    for bound, low in ((start, True), (end, False)):
        if bound is not None:
            limit = F.when(F.col(MONTH) % 100 == 0, month_of(as_date(bound), "year")).otherwise(month_of(as_date(bound)))
            lines = lines.where(F.col(MONTH) >= limit if low else F.col(MONTH) <= limit)
    return lines


def save_by_month(books: Books, folder: str) -> None:
    """Store the books with transaction tables partitioned by month; ``open_books`` reads them."""
    for name, df in placed({n: books[n] for n in books}).items():
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if name in TABLES and is_dealt(name, df):
            writer = df.hint("rebalance", MONTH).write.mode("overwrite").option(
                "partitionOverwriteMode", "static").partitionBy(MONTH)
        writer.parquet(f"{folder.rstrip('/')}/{name}")
