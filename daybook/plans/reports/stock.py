"""Stock movements, stock summary and closing stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.lookup import lookup
from daybook.plans.books import Books
from daybook.plans.reports.common import not_order, QUANTITY, credit, debit, entries, voucher_categories
from daybook.plans.reports.ledgers import latest_stock

NOTES = ["Receipt Note", "Delivery Note"]


def stock_summary(books: Books) -> DataFrame:
    """Opening, inward, outward and closing quantity of every item.

    A tracked consignment may be recorded by a note, by an invoice or by both. Per item and
    tracking number the total quantity of notes is compared with that of invoices: invoices
    move the stock when both agree, notes when they exceed, neither otherwise. Untracked lines
    always count. Each consignment is reduced to six sums, so the verdict needs no join back
    to the lines; orders take part in the comparison but never move stock.
    """
    is_note = F.col("voucher_category").isin(NOTES)
    q = F.col("quantity")
    vouchers = lookup(books.trn_voucher.select("guid", "voucher_type", "is_order_voucher"),
                      voucher_categories(books), "voucher_type", measure=True)
    tracking = F.nullif(F.col("tracking_number"), F.lit("")).alias("tracking_number")
    lines = entries(
        books, vouchers.select("guid", "voucher_category", "is_order_voucher"),
        books.trn_inventory.select("guid", "item", "quantity", tracking), table="trn_inventory")

    def moved(side, direction):
        return F.sum(F.when(not_order() & side, direction(q)).otherwise(F.lit(0)))

    consignments = lines.groupBy("item", "tracking_number").agg(
        F.sum(F.when(is_note, F.abs(q)).otherwise(F.lit(0))).alias("noted"),
        F.sum(F.when(~is_note, F.abs(q)).otherwise(F.lit(0))).alias("invoiced"),
        moved(is_note, credit).alias("note_in"), moved(is_note, debit).alias("note_out"),
        moved(~is_note, credit).alias("invoice_in"), moved(~is_note, debit).alias("invoice_out"))
    untracked = F.col("tracking_number").isNull()

    def effect(side: str):
        note, invoice = F.col(f"note_{side}"), F.col(f"invoice_{side}")
        return (F.when(untracked, note + invoice)
                .when(F.col("noted") == F.col("invoiced"), invoice)
                .when(F.col("noted") > F.col("invoiced"), note))

    effects = consignments.groupBy("item").agg(
        F.sum(effect("in")).alias("in_qty"), F.sum(effect("out")).alias("out_qty"))
    items = books.mst_stock_item.select("name", "parent", "uom", "opening_balance")
    inward = F.coalesce("in_qty", F.lit(0)).cast(QUANTITY)
    outward = F.coalesce("out_qty", F.lit(0)).cast(QUANTITY)
    return items.join(effects, items.name == effects.item, "left").select(
        "name", "parent", "uom", F.col("opening_balance").cast(QUANTITY).alias("op_qty"),
        inward.alias("in_qty"), outward.alias("out_qty"),
        (F.col("opening_balance") + inward - outward).cast(QUANTITY).alias("clo_bal"))


def first_events(books: Books) -> DataFrame:
    """Stock lines that move stock when whichever document comes first counts.

    Untracked lines all count. Of the lines sharing an item and a tracking number the earliest
    counts; ties are settled by voucher, quantity and amount. The earliest is found as a
    minimum, which combines before the shuffle, so no group is ever sorted as a whole.
    """
    columns = ["date", "voucher_number", "voucher_type", "item", "quantity", "amount", "godown"]
    vouchers = books.trn_voucher.where(not_order()).select(
        "guid", "date", "voucher_number", "voucher_type")
    lines = entries(
        books, vouchers,
        books.trn_inventory.select("guid", "item", "quantity", "amount", "godown", "tracking_number"),
        table="trn_inventory")
    untracked = lines.where(F.col("tracking_number") == "").select(columns)
    tracked = (
        lines.where(F.coalesce(F.col("tracking_number") != "", F.lit(True)))
        .groupBy("tracking_number", "item")
        .agg(F.min(F.struct("date", "guid", "quantity", "amount", "voucher_number",
                            "voucher_type", "godown")).alias("first"))
        .select("item", "first.*").select(columns))
    return untracked.unionByName(tracked)


def stock_voucher_view(books: Books) -> DataFrame:
    """Opening batches and first stock events in one shape."""
    opening = books.mst_opening_batch_allocation.select(
        F.make_date(F.lit(2000), F.lit(1), F.lit(1)).alias("date"),
        F.lit("").alias("voucher_number"), F.lit("Opening Balance").alias("voucher_type"),
        "item", F.col("opening_balance").alias("quantity"),
        F.col("opening_value").alias("amount"), "godown")
    return opening.unionByName(first_events(books))


def _effects(books: Books, condition) -> DataFrame:
    vouchers = books.trn_voucher.where(condition).select(
        "guid", "date", "voucher_number", "voucher_type")
    lines = books.trn_inventory.select("guid", "item", "quantity")
    return entries(books, vouchers, lines, table="trn_inventory").drop("guid")


def inventory_effects(books: Books) -> DataFrame:
    """Every non-order line moves stock (notes are not used)."""
    return _effects(books, not_order())


def inventory_effects_notes_only(books: Books) -> DataFrame:
    """Only notes move stock (notes are always used)."""
    return _effects(books, not_order() & (F.col("is_inventory_voucher") == 1))


def inventory_effects_first_event(books: Books) -> DataFrame:
    """Whichever document comes first moves stock (notes are sometimes used)."""
    return first_events(books).select("date", "voucher_number", "voucher_type", "item", "quantity")


def closing_stock_value(books: Books, as_of) -> DataFrame:
    """Stock value of every ledger on ``as_of`` or the nearest earlier date."""
    return latest_stock(books, as_of)
