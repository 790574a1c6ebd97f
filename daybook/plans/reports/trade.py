"""Sales, purchases and cash: daily, monthly, registers and views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import calendar
from daybook.operators.lookup import lookup
from daybook.plans.books import Books
from daybook.plans.months import within
from daybook.plans.reports.common import (
    between, credit, debit, entries, ledger_groups, money, posted, voucher_categories,
    with_ledgers,
)

SALES = ["Sales", "Credit Note"]
PURCHASES = ["Purchase", "Debit Note"]


def _group_entries(books: Books, group: str, vouchers: DataFrame, start=None, end=None) -> DataFrame:
    """Entries on the ledgers of one primary group; ledgers are cut down before vouchers join."""
    ledgers = ledger_groups(books).where(F.lower("primary_group") == group.lower()).select("ledger")
    lines = within(books.trn_accounting, start, end).select("guid", "ledger", "amount")
    lines = with_ledgers(books, lines, ledgers, keys_from=lines)
    return entries(books, vouchers, lines)


def daily_cash_movement(books: Books, start, end, posted_only: bool = False) -> DataFrame:
    """Receipts and payments of every day through cash ledgers."""
    effect = posted() if posted_only else F.lit(True)
    types = voucher_categories(books).where(
        F.lower("voucher_category").isin("receipt", "payment", "contra")).select("voucher_type")
    vouchers = lookup(within(books.trn_voucher, start, end).where(between(start, end) & effect)
                      .select("guid", "date", "voucher_type"), types, "voucher_type", measure=True)
    moved = _group_entries(books, "Cash-in-hand", vouchers.select("guid", "date"), start, end).groupBy("date").agg(
        money(F.sum(debit())).alias("receipt"), money(F.sum(credit())).alias("payment"))
    return calendar.fill(calendar.days(books.spark, start, end), moved, ["date"]).orderBy("date")


def _movement(books: Books, group: str, start, end, sign: int, posted_only: bool) -> DataFrame:
    effect = posted() if posted_only else F.lit(True)
    vouchers = within(books.trn_voucher, start, end).where(between(start, end) & effect).select("guid", "date")
    return _group_entries(books, group, vouchers, start, end).groupBy("date").agg(
        money(F.sum("amount") * sign).alias("amount"))


def _daily(books: Books, start, end, moved: DataFrame) -> DataFrame:
    return calendar.fill(calendar.days(books.spark, start, end), moved, ["date"]).orderBy("date")


def _monthly(books: Books, start, end, moved: DataFrame) -> DataFrame:
    by_month = moved.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        money(F.sum("amount")).alias("amount"))
    spine = calendar.months(books.spark, start, end)
    return calendar.fill(spine, by_month, ["year", "month"]).orderBy("year", "month")


def sales_daily(books: Books, start, end, posted_only: bool = False) -> DataFrame:
    """Sales of every day. Order and note vouchers count unless ``posted_only``."""
    return _daily(books, start, end, _movement(books, "Sales Accounts", start, end, 1, posted_only))


def sales_monthly(books: Books, start, end, posted_only: bool = False) -> DataFrame:
    return _monthly(books, start, end, _movement(books, "Sales Accounts", start, end, 1, posted_only))


def purchase_daily(books: Books, start, end, posted_only: bool = True) -> DataFrame:
    return _daily(books, start, end,
                  _movement(books, "Purchase Accounts", start, end, -1, posted_only))


def purchase_monthly(books: Books, start, end, posted_only: bool = True) -> DataFrame:
    return _monthly(books, start, end,
                    _movement(books, "Purchase Accounts", start, end, -1, posted_only))


def _categorised(books: Books, categories: list[str]) -> DataFrame:
    types = voucher_categories(books).where(F.col("voucher_category").isin(categories))
    return lookup(books.trn_voucher, types, "voucher_type", measure=True)


def _register(books: Books, categories: list[str], sign: int) -> DataFrame:
    parties = books.mst_ledger.select(F.col("name").alias("party_name"), "gstn")
    vouchers = lookup(
        _categorised(books, categories).where(posted()).select(
            "guid", "date", "voucher_type", "voucher_number", "party_name", "voucher_category"),
        parties, "party_name", measure=True, keys_from=books.trn_voucher.select("party_name"))
    lines = entries(books, vouchers, books.trn_accounting.select("guid", "ledger", "amount"))
    counter = with_ledgers(books, lines.where(F.col("ledger") != F.col("party_name")),
                           ledger_groups(books).select("ledger", "primary_group"))
    return counter.select(
        "date", "voucher_type", "voucher_number", "ledger",
        (F.col("amount") * sign).cast("decimal(17,2)").alias("amount"),
        "party_name", "gstn", "primary_group", "voucher_category")


def sales_register(books: Books) -> DataFrame:
    return _register(books, SALES, 1)


def purchase_register(books: Books) -> DataFrame:
    """Amounts are positive for purchases."""
    return _register(books, PURCHASES, -1)


def _trade_view(books: Books, categories: list[str], group: str) -> DataFrame:
    parties = books.mst_ledger.select(
        F.col("name").alias("party_name"), F.col("parent").alias("party_parent"))
    vouchers = lookup(
        _categorised(books, categories).select(
            "guid", "date", "voucher_number", "voucher_type", "voucher_category", "party_name"),
        parties, "party_name", measure=True, keys_from=books.trn_voucher.select("party_name"))
    return _group_entries(books, group, vouchers).select(
        "date", "voucher_number", "voucher_type", "voucher_category", "party_name",
        "party_parent", "ledger", "amount")


def sales_view(books: Books) -> DataFrame:
    return _trade_view(books, SALES, "Sales Accounts")


def purchase_view(books: Books) -> DataFrame:
    return _trade_view(books, PURCHASES, "Purchase Accounts")


def create_views(books: Books) -> None:
    """Register the two trade views in the session catalog."""
    sales_view(books).createOrReplaceTempView("vw_sales")
    purchase_view(books).createOrReplaceTempView("vw_purchase")
