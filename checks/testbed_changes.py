"""Two states of the testbed, before and after a round of changes, in the incremental schema.

* vouchers dated 2001 or later are new, low-priority fulfilled ones are deleted, urgent pending
  ones are edited (their amount was one higher before);
* customers whose number ends in 3 are renamed;
* numbers of automatically numbered vouchers dated 1998 or later move up by one.

Change numbers of the first state are at most the number of orders, later ones lie above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans.books import Books, conform
from checks.testbed import Testbed

SUFFIX = " Ltd"


class ChangingTestbed(Testbed):
    def __init__(self, spark: SparkSession, folder: str, after: bool):
        super().__init__(spark, folder)
        self.after = after

    def last_before(self) -> Column:
        """The highest change number of the first state."""
        return self.source("orders").agg(F.count("*").alias("n")).scalar()

    def new_name(self, name: Column) -> Column:
        if not self.after:
            return name
        return F.when(name.startswith("Customer#") & name.endswith("3"),
                      F.concat(name, F.lit(SUFFIX))).otherwise(name)

    def changing_orders(self) -> DataFrame:
        edited = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
        fresh = F.col("date") >= "2001-01-01"
        gone = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")
        k, m = F.col("k"), F.col("m")
        number = F.when((m != 7) & (F.col("date") >= "1998-01-01"), k + 1).otherwise(k)
        orders = self.orders().where(~gone if self.after else ~fresh)
        changed = edited | fresh
        return orders.withColumns({
            "alterid": F.when(changed, k + 1 + self.last_before()).otherwise(k + 1)
            if self.after else k + 1,
            "number": number if self.after else k,
            "amt": F.col("amt") if self.after else F.when(edited, F.col("amt") + 1)
            .otherwise(F.col("amt")).cast("decimal(17,2)"),
        })

    def ledgers(self) -> DataFrame:
        number = F.regexp_extract("name", r"(\d*)$", 1).try_cast("bigint")
        base = super().ledgers().withColumn("_number", F.coalesce(number, F.lit(0)))
        moved = F.col("name") != self.new_name(F.col("name"))
        rows = base.withColumns({
            "alterid": F.when(moved, F.col("_number") + 1 + self.last_before())
            .otherwise(F.col("_number") + 1) if self.after else F.col("_number") + 1,
            "_parent": F.concat(F.lit("G:"), "parent"),
            "name": self.new_name(F.col("name"))})
        return conform(rows, "mst_ledger", incremental=True)

    def voucher_types(self) -> DataFrame:
        rows = super().voucher_types().withColumns(
            {"alterid": F.lit(1), "_parent": F.col("guid")})
        return conform(rows, "mst_vouchertype", incremental=True)

    def vouchers(self) -> DataFrame:
        m = F.col("m")
        rows = self.changing_orders().select(
            "guid", "alterid", "date", "voucher_type",
            F.concat(F.lit("T:"), "voucher_type").alias("_voucher_type"),
            F.col("number").cast("string").alias("voucher_number"),
            self.new_name(F.col("party")).alias("party_name"),
            F.concat(F.lit("L:"), "party").alias("_party_name"),
            (m > 1).cast("tinyint").alias("is_accounting_voucher"),
            (m == 1).cast("tinyint").alias("is_inventory_voucher"),
            (m == 0).cast("tinyint").alias("is_order_voucher"))
        return conform(rows, "trn_voucher", incremental=True)

    def accounting(self) -> DataFrame:
        first, second, signed = self.entry_pair(F.col("amt"))
        entries = F.array(F.struct(first.alias("l"), signed.alias("amount")),
                          F.struct(second.alias("l"), (-signed).alias("amount")))
        return self.changing_orders().select("guid", "alterid", F.inline(entries)).select(
            "guid", "alterid", self.new_name(F.col("l")).alias("ledger"),
            F.concat(F.lit("L:"), "l").alias("_ledger"), "amount")

    def opening_bills(self) -> DataFrame:
        rows = super().opening_bills().withColumns(
            {"_ledger": F.concat(F.lit("L:"), "ledger"), "ledger": self.new_name(F.col("ledger"))})
        return conform(rows, "mst_opening_bill_allocation", incremental=True)

    def state(self) -> Books:
        return Books(self.spark, {
            "mst_ledger": self.ledgers, "mst_vouchertype": self.voucher_types,
            "mst_opening_bill_allocation": self.opening_bills,
            "trn_voucher": self.vouchers,
            "trn_accounting": lambda: conform(self.accounting(), "trn_accounting", incremental=True),
        })

    def delta(self) -> Books:
        """Rows of this state whose change number lies beyond the first state's."""
        last = self.last_before()

        def beyond(df: DataFrame) -> DataFrame:
            return df.where(F.col("alterid") > last)

        return Books(self.spark, {
            "mst_ledger": lambda: beyond(self.ledgers()),
            "mst_vouchertype": lambda: beyond(self.voucher_types()),
            "mst_opening_bill_allocation": lambda: self.opening_bills().join(
                beyond(self.ledgers()).select(F.col("guid").alias("_ledger")), "_ledger", "left_semi")
                .select(*self.opening_bills().columns),
            "trn_voucher": lambda: beyond(self.vouchers()),
            "trn_accounting": lambda: conform(
                beyond(self.accounting()), "trn_accounting", incremental=True),
        })


def two_states(spark: SparkSession, folder: str) -> tuple[ChangingTestbed, ChangingTestbed]:
    return ChangingTestbed(spark, folder, False), ChangingTestbed(spark, folder, True)
