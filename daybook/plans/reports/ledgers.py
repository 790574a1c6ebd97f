"""Ledger balances, statements and the trial balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.calendar import as_date
from daybook.operators.lookup import lookup
from daybook.plans.books import Books
from daybook.plans.months import within
from daybook.plans.reports.common import (
    between, credit, debit, entries, ledger_groups, money, posted, total, voucher_categories,
    with_ledgers,
)


def trial_balance(books: Books, start, end) -> DataFrame:
    """Opening, debit, credit and closing of every ledger.

    One pass over the entries up to ``end`` gives both the movement before the period and
    within it. Revenue ledgers start every period at zero.
    """
    before = F.col("date") < as_date(start)
    vouchers = within(books.trn_voucher, end=end).where(posted() & between(end=end)).select("guid", "date")
    moved = entries(books, vouchers, end=end).groupBy("ledger").agg(
        F.sum(F.when(before, F.col("amount"))).alias("prior"),
        F.sum(F.when(~before, debit())).alias("debit"),
        F.sum(F.when(~before, credit())).alias("credit"),
    )
    zero = F.lit(0)
    ledgers = books.mst_ledger.select("name", "is_revenue", "opening_balance")
    rows = ledgers.join(moved, ledgers.name == moved.ledger, "left").select(
        "name",
        F.when(F.col("is_revenue") == 0, F.col("opening_balance") + F.coalesce("prior", zero))
         .otherwise(zero).alias("opening"),
        F.coalesce("debit", zero).alias("debit"),
        F.coalesce("credit", zero).alias("credit"),
    )
    return rows.select(
        "name", money("opening").alias("opening"), money("debit").alias("debit"),
        money("credit").alias("credit"),
        money(F.col("opening") + F.col("credit") - F.col("debit")).alias("closing"),
    ).orderBy("name")


def account_statement(books: Books, ledger: str, start, end, distinct: bool = False,
                      posted_only: bool = False) -> DataFrame:
    """Entries of one ledger with the other ledgers of each voucher as one sorted text.

    ``distinct`` lists each other ledger once; otherwise once per entry. ``posted_only``
    selects the ledger's own rows by voucher effect instead of by the accounting flag.
    Vouchers without any other ledger do not appear.
    """
    own_filter = posted() if posted_only else F.col("is_accounting_voucher") == 1
    head = ["guid", "date", "voucher_number", "voucher_type", "narration"]
    vouchers = within(books.trn_voucher, start, end).where(between(start, end) & own_filter & posted()).select(*head)
    lines = entries(books, vouchers, within(books.trn_accounting, start, end).select("guid", "ledger", "amount"))
    own = F.col("ledger") == ledger
    # both groupings keep the lines' partitioning by voucher; equal ledgers of a voucher are
    # counted before they are listed, so what is gathered is one value per ledger
    per_ledger = lines.groupBy(*head, "ledger").agg(
        F.count("*").cast("int").alias("times"), F.collect_list(F.when(own, F.col("amount"))).alias("amounts"))
    other = F.when(~own, F.struct("ledger", "times"))
    per_voucher = per_ledger.groupBy(*head).agg(
        F.flatten(F.collect_list("amounts")).alias("amounts"),
        F.array_sort(F.collect_list(other)).alias("found")).where("size(found) > 0")
    names = F.col("found.ledger") if distinct else F.flatten(F.transform(
        "found", lambda f: F.array_repeat(f["ledger"], f["times"])))
    return per_voucher.select(*head, F.array_join(names, ",").alias("ledgers"), F.explode("amounts").alias("amount")).select(
        "date", "voucher_number", "voucher_type", "ledgers",
        money(debit()).alias("debit"), money(credit()).alias("credit"), "narration",
    ).orderBy("date", "voucher_number")


def accounting_voucher_view(books: Books) -> DataFrame:
    """Opening balances and every posted entry with group and voucher category."""
    groups = ledger_groups(books)
    opening = groups.where(F.col("opening_balance") != 0).select(
        F.make_date(F.lit(2000), F.lit(1), F.lit(1)).alias("date"),
        F.lit("Opening Balance").alias("voucher_type"), F.lit("").alias("voucher_number"),
        "ledger", F.col("opening_balance").alias("amount"), F.lit("").alias("party_name"),
        "primary_group", F.lit("Opening Balance").alias("voucher_category"))
    vouchers = lookup(
        books.trn_voucher.where(posted()).select(
            "guid", "date", "voucher_type", "voucher_number", "party_name"),
        voucher_categories(books), "voucher_type", measure=True)
    lines = entries(books, vouchers, books.trn_accounting.select("guid", "ledger", "amount"))
    current = with_ledgers(books, lines, groups.select("ledger", "primary_group"))
    return opening.unionByName(current.select(opening.columns))


def accounting_effects(books: Books) -> DataFrame:
    vouchers = books.trn_voucher.where(posted()).select("guid", "date", "voucher_number", "voucher_type")
    return entries(books, vouchers, books.trn_accounting.select("guid", "ledger", "amount")).drop("guid")


def ledger_closing_balances(books: Books, as_of=None) -> DataFrame:
    """Opening, debit, credit and closing of every ledger that has entries."""
    vouchers = within(books.trn_voucher, end=as_of).where(posted() & between(end=as_of)).select("guid")
    moved = entries(books, vouchers, end=as_of).groupBy("ledger").agg(
        total(debit()).alias("net_debit"), total(credit()).alias("net_credit"))
    ledgers = books.mst_ledger.select(F.col("name").alias("ledger"), "opening_balance")
    opening = money(F.coalesce("opening_balance", F.lit(0)))
    return moved.join(ledgers, "ledger", "left").select(
        F.col("ledger").alias("name"), opening.alias("opening_balance"), "net_debit", "net_credit",
        money(opening + F.col("net_credit") - F.col("net_debit")).alias("closing_balance"))


def profit_and_loss(books: Books, keep_notes: bool = False, zero_if_empty: bool = False) -> DataFrame:
    """Income and expense balances with opening and closing stock.

    ``keep_notes`` counts stock-note vouchers too; ``zero_if_empty`` turns missing stock
    figures into 0.
    """
    effect = F.col("is_order_voucher") == 0 if keep_notes else posted()
    types = voucher_categories(books).where(F.col("affects_stock") == 0).select("voucher_type")
    vouchers = books.trn_voucher.where(effect).select("guid", "voucher_type")
    groups = ledger_groups(books)
    # sums by ledger and type first: few rows remain to meet the masters, whatever the hot ledgers
    moved = entries(books, vouchers, books.trn_accounting.select("guid", "ledger", "amount")).groupBy(
        "ledger", "voucher_type").agg(F.sum("amount").alias("balance"))
    by_group = (
        moved.join(types, "voucher_type").join(groups.where(F.col("group_is_revenue") == 1), "ledger")
        .groupBy(F.col("primary_group").alias("group"), "ledger")
        .agg(F.when(F.max("group_is_deemedpositive") == 1, "expense").otherwise("income").alias("nature"),
             F.when(F.max("affects_gross_profit") == 1, "Y").otherwise("N").alias("affects_gross_profit"),
             money(F.sum("balance")).alias("balance")))

    def stock_row(df: DataFrame, name: str, nature: str) -> DataFrame:
        balance = F.coalesce("balance", F.lit(0)) if zero_if_empty else F.col("balance")
        return df.select(F.lit(name).alias("group"), F.lit(name).alias("ledger"),
                         F.lit(nature).alias("nature"), F.lit("Y").alias("affects_gross_profit"),
                         money(balance).alias("balance"))

    opening = groups.where(F.col("primary_group") == "Stock-in-hand").agg(
        F.sum("opening_balance").alias("balance"))
    closing = latest_stock(books).agg((-F.sum("stock_value")).alias("balance"))
    return (by_group.unionByName(stock_row(opening, "Opening Stock", "expense"))
            .unionByName(stock_row(closing, "Closing Stock", "income")))


def latest_stock(books: Books, as_of=None) -> DataFrame:
    """The newest stock value of every ledger, no later than ``as_of``."""
    values = books.trn_closingstock_ledger
    if as_of is not None:
        values = values.where(F.col("stock_date") <= as_date(as_of))
    newest = F.max(F.struct("stock_date", "stock_value"))
    return values.groupBy("ledger").agg(newest.alias("v")).select(
        "ledger", F.col("v.stock_date").alias("stock_date"),
        F.col("v.stock_value").alias("stock_value"))
