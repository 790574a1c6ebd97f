"""Building blocks shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.calendar import as_date
from daybook.operators.lookup import lookup
from daybook.plans.books import Books
from daybook.plans.months import MONTH, within

MONEY = "decimal(27,2)"
QUANTITY = "decimal(25,4)"


def not_order() -> Column:
    return F.col("is_order_voucher") == 0


def posted() -> Column:
    """Orders and stock notes write accounting rows that have no financial effect."""
    return not_order() & (F.col("is_inventory_voucher") == 0)


def between(start=None, end=None) -> Column:
    """``date`` within the given bounds; an absent bound is open."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col("date") >= as_date(start))
    if end is not None:
        condition = condition & (F.col("date") <= as_date(end))
    return condition


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def debit(amount: Column | str = "amount") -> Column:
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.when(c < 0, -c).otherwise(F.lit(0))


def credit(amount: Column | str = "amount") -> Column:
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.when(c > 0, c).otherwise(F.lit(0))


def total(c: Column, sql_type: str = MONEY) -> Column:
    """Sum with 0 for no rows."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(sql_type)


def entries(books: Books, vouchers: DataFrame, lines: DataFrame | None = None,
            how: str = "inner", table: str = "trn_accounting", start=None, end=None) -> DataFrame:
    """Lines of ``table`` (or ``lines`` cut from it) joined to already filtered vouchers.

    With the period of the vouchers, lines stored by month are read from its folders only.
    """
    lines = within(books[table], start, end) if lines is None else lines
    lines = lines.drop(MONTH)
    if books.colocated:
        return lines.join(vouchers, "guid", how)
    # a voucher has few lines, so its key is never hot
    return lookup(lines, vouchers, "guid", how, unique=True)


def with_ledgers(books: Books, lines: DataFrame, ledgers: DataFrame, how: str = "inner",
                 keys_from: DataFrame | None = None) -> DataFrame:
    """Accounting lines joined to attributes of their ledger."""
    keys_from = books.trn_accounting if keys_from is None else keys_from
    return lookup(lines, ledgers, "ledger", how, keys_from=keys_from.select("ledger"), measure=True)


def ledger_groups(books: Books) -> DataFrame:
    """Ledger name with the attributes of its group."""
    groups = books.mst_group.select(
        F.col("name").alias("parent"), "primary_group",
        F.col("is_revenue").alias("group_is_revenue"),
        F.col("is_deemedpositive").alias("group_is_deemedpositive"), "affects_gross_profit")
    return books.mst_ledger.select(F.col("name").alias("ledger"), "parent", "opening_balance").join(
        groups, "parent")


def voucher_categories(books: Books) -> DataFrame:
    """Voucher type with its base type."""
    return books.mst_vouchertype.select(
        F.col("name").alias("voucher_type"), F.col("parent").alias("voucher_category"),
        "affects_stock")
