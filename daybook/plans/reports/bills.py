"""Bill-wise receivables, payables and bill status.

A bill is opened by a ``New Ref`` or ``Advance`` row and settled by ``Agst Ref`` rows of the
same ledger and name. Both kinds are summed in one grouping, so no row meets another row of
its bill and a bill with very many settlements is combined before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.calendar import as_date
from daybook.operators.lookup import lookup
from daybook.plans.books import Books
from daybook.plans.reports.common import entries, money, posted


def _opens() -> Column:
    return F.col("billtype").isin("New Ref", "Advance")


def _settles() -> Column:
    return F.col("billtype") == "Agst Ref"


def all_bills(books: Books) -> DataFrame:
    """Opening bills and voucher bills in one shape."""
    columns = ["date", "ledger", "name", "amount", "billtype", "bill_credit_period"]
    opening = books.mst_opening_bill_allocation.select(
        F.col("bill_date").alias("date"), "ledger", "name",
        F.col("opening_balance").cast("decimal(19,4)").alias("amount"),
        F.lit("New Ref").alias("billtype"), "bill_credit_period")
    current = entries(
        books, books.trn_voucher.select("guid", "date"), table="trn_bill").withColumn(
        "amount", F.col("amount").cast("decimal(19,4)"))
    return opening.unionByName(current.select(columns))


def outstanding(books: Books, as_of, dedupe: bool = False) -> DataFrame:
    """Billed, adjusted and outstanding amount of every opened bill.

    When a bill is opened by several rows its settlements count once per row; ``dedupe``
    counts them once.
    """
    settled = F.coalesce(F.sum(F.when(_settles(), F.col("amount"))), F.lit(0))
    openings = F.count(F.when(_opens(), 1))
    # unnamed bills match no settlement
    named = F.col("ledger").isNotNull() & F.col("name").isNotNull()
    bills = (
        all_bills(books).where(_opens() | _settles()).groupBy("ledger", "name")
        .agg(openings.alias("openings"), settled.alias("settled"),
             F.coalesce(F.max(F.when(_opens(), F.col("amount"))), F.lit(0)).alias("billed"),
             F.max(F.when(_opens(), F.col("date"))).alias("date"),
             F.max(F.when(_opens(), F.col("bill_credit_period"))).alias("credit_days"))
        .where(F.col("openings") > 0))
    times = F.lit(1) if dedupe else F.col("openings").cast("decimal(10,0)")
    adjusted = F.when(named, F.col("settled") * times).otherwise(F.lit(0))
    amount = "decimal(29,4)"
    return bills.select(
        "ledger", "name", F.col("billed").cast(amount).alias("billed_amount"),
        adjusted.cast(amount).alias("adjusted_amount"),
        (F.col("billed") + adjusted).cast(amount).alias("outstanding_amount"),
        "date", F.date_add("date", F.col("credit_days")).alias("due_on"),
        (F.datediff(as_date(as_of), "date") - F.col("credit_days")).alias("overdue_by_days"))


def _pending(books: Books, as_of, sign: int, dedupe: bool) -> DataFrame:
    pending = F.col("outstanding_amount") * sign
    return outstanding(books, as_of, dedupe).where(pending > 0).select(
        "date", F.col("name").alias("ref_number"), F.col("ledger").alias("party_name"),
        pending.cast("decimal(29,4)").alias("pending_amount"), "due_on", "overdue_by_days",
    ).orderBy(F.desc("overdue_by_days"))


def bills_payable(books: Books, as_of, dedupe: bool = False) -> DataFrame:
    return _pending(books, as_of, 1, dedupe)


def bills_receivable(books: Books, as_of, dedupe: bool = False) -> DataFrame:
    return _pending(books, as_of, -1, dedupe)


def bill_status(books: Books) -> DataFrame:
    """Every bill-opening row of posted vouchers with the settlements of its bill name."""
    vouchers = books.trn_voucher.where(posted()).select("guid")
    rows = entries(
        books, vouchers,
        books.trn_bill.where(_opens() | _settles()).select("guid", "name", "amount", "billtype"),
        table="trn_bill")
    settled = rows.where(_settles()).groupBy("name").agg(F.sum("amount").alias("settled"))
    adjusted = F.coalesce("settled", F.lit(0))
    opened = rows.where(_opens())
    return lookup(opened, settled, "name", "left", keys_from=books.trn_bill.select("name")).select(
        F.col("name").alias("bill_name"), F.col("amount").alias("bill_amount"),
        money(adjusted).alias("adjusted_amount"),
        money(F.col("amount") + adjusted).alias("pending_amount"))
