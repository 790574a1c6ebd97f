"""The provided order-and-line tables recast as accounting tables.

Every target row comes from a source row by arithmetic on its own columns, so no join or
shuffle is spent before a report starts. With ``k`` the order key, ten consecutive orders
form a block ``b`` sharing one party, and the position in the block decides the voucher type:

0 Sales Order, 1 Delivery Note, 2 Credit Note, 3 Purchase, 4 Debit Note, 5 Receipt,
6 Payment, 7 Contra, 8 and 9 Sales.

The whole of every source table is used.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans.books import Books, conform
from daybook.session import compiled

VOUCHER_TYPES = ["Sales Order", "Delivery Note", "Credit Note", "Purchase", "Debit Note",
                 "Receipt", "Payment", "Contra", "Sales"]
TYPE_OF_POSITION = [*VOUCHER_TYPES, "Sales"]

# name -> (is_revenue, is_deemedpositive, affects_gross_profit)
ROOT_GROUPS = {
    "Sundry Debtors": (0, 1, 0),
    "Sundry Creditors": (0, 0, 0),
    "Sales Accounts": (1, 0, 1),
    "Purchase Accounts": (1, 1, 1),
    "Cash-in-hand": (0, 1, 0),
    "Bank Accounts": (0, 1, 0),
    "Stock-in-hand": (0, 1, 0),
}

# name -> (group, is_revenue, opening balance)
FIXED_LEDGERS = {
    "Sales": ("Sales Accounts", 1, 0),
    "Purchase": ("Purchase Accounts", 1, 0),
    "Cash": ("Cash-in-hand", 0, -50000),
    "Bank": ("Bank Accounts", 0, -90000),
    **{f"Stock{i}": ("Stock-in-hand", 0, -24000 - i) for i in range(5)},
}


def _money(c: Column | str, sql_type: str = "decimal(17,2)") -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(sql_type)


def _numbered(prefix: str, number: Column) -> Column:
    """The prefix and the number, padded to at least nine digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(9), F.length(digits)), F.lit("0")))


def literal_rows(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A constant relation the optimiser knows the size of; Python text and ints only."""
    def sql(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(sql(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns.split())})")


def _pick(position: Column, values: list) -> Column:
    """``values[position]``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), position.cast("int") + 1)


class Testbed:
    """Accounting tables over one folder of provided Parquet files."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        compiled(spark)
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    # -- vouchers -------------------------------------------------------------------------

    def orders(self) -> DataFrame:
        """Orders with block, position, voucher type and party."""
        customers = self.source("customer").agg(F.count("*").alias("n")).scalar()
        suppliers = self.source("supplier").agg(F.count("*").alias("n")).scalar()
        k = F.col("o_orderkey")
        block = F.floor(k / 10)
        buys = F.col("m").isin(3, 4, 6)
        return (
            self.source("orders")
            .withColumns({"k": k, "b": block, "m": (k % 10).cast("int")})
            .withColumns({
                "guid": F.concat(F.lit("V"), k.cast("string")),
                "date": F.to_date("o_orderdate"),
                "voucher_type": _pick(F.col("m"), TYPE_OF_POSITION),
                "amt": _money("o_totalprice"),
                "party": F.when(buys, _numbered("Supplier#", F.col("b") % suppliers))
                          .otherwise(_numbered("Customer#", F.col("b") % customers)),
            })
        )

    def vouchers(self) -> DataFrame:
        m = F.col("m")
        return self.orders().select(
            "guid", "date", "voucher_type",
            F.col("k").cast("string").alias("voucher_number"),
            F.lit("").alias("reference_number"), F.lit(None).cast("date").alias("reference_date"),
            F.col("o_orderpriority").alias("narration"), F.col("party").alias("party_name"),
            F.lit("").alias("place_of_supply"),
            m.isin(3, 8, 9).cast("tinyint").alias("is_invoice"),
            (m > 1).cast("tinyint").alias("is_accounting_voucher"),
            (m == 1).cast("tinyint").alias("is_inventory_voucher"),
            (m == 0).cast("tinyint").alias("is_order_voucher"),
        )

    @staticmethod
    def entry_pair(amount: Column) -> tuple[Column, Column, Column]:
        """(first ledger, second ledger, signed amount of the first) of a voucher."""
        m = F.col("m")
        first = F.when(m == 7, "Bank").otherwise(F.col("party"))
        second = _pick(m, ["Sales", "Sales", "Sales", "Purchase", "Purchase",
                           "Cash", "Cash", "Cash", "Sales", "Sales"])
        return first, second, F.when(m.isin(2, 3, 5), amount).otherwise(-amount)

    def accounting(self) -> DataFrame:
        first, second, signed = self.entry_pair(F.col("amt"))
        is_first = F.col("side") == 0
        rows = (
            self.orders().select("guid", "m", "party", "amt", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
            .select("guid", F.when(is_first, first).otherwise(second).alias("ledger"),
                    F.when(is_first, signed).otherwise(-signed).alias("amount")))
        return conform(rows, "trn_accounting")

    def bills(self) -> DataFrame:
        m = F.col("m")
        rows = self.orders().where(m.isin(3, 5, 6, 8, 9)).select(
            "guid", F.col("party").alias("ledger"),
            F.concat(F.when(m == 9, "C").otherwise("B"), F.col("b").cast("string")).alias("name"),
            F.when(m.isin(6, 8, 9), -F.col("amt")).otherwise(F.col("amt")).alias("amount"),
            F.when(m.isin(3, 8, 9), "New Ref").otherwise("Agst Ref").alias("billtype"),
            (F.col("k") % 90).cast("int").alias("bill_credit_period"),
        )
        return conform(rows, "trn_bill")

    # -- stock ----------------------------------------------------------------------------

    def lines(self) -> DataFrame:
        """Order lines plus their copies on the block's delivery note."""
        k = F.col("l_orderkey")
        b, m = F.floor(k / 10), (k % 10).cast("int")
        tracked = (m == 8) & (F.col("l_linenumber") % 3 == 0)
        quantity = F.when(m.isin(2, 3), F.col("l_quantity")).otherwise(-F.col("l_quantity"))
        copied = tracked & (b % 3 < 2)
        copy = F.col("copy") == 1
        times = F.when(copy & (b % 3 == 1), 2).otherwise(1)
        exploded = self.source("lineitem").select("*", F.explode(
            F.when(copied, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
        return exploded.select(
            F.concat(F.lit("V"), F.when(copy, b * 10 + 1).otherwise(k).cast("string")).alias("guid"),
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("item"),
            _money(quantity * times, "decimal(15,4)").alias("quantity"),
            _money("l_extendedprice").alias("amount"),
            F.when(tracked, F.concat(F.lit("T"), b.cast("string"))).otherwise("").alias("tracking_number"),
            F.lit("Main").alias("godown"))

    def inventory(self) -> DataFrame:
        return conform(self.lines(), "trn_inventory")

    def stock_items(self) -> DataFrame:
        rows = self.source("part").select(
            F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("guid"),
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("name"),
            F.col("p_brand").alias("parent"), F.lit("Nos").alias("uom"),
            F.col("p_size").alias("opening_balance"))
        return conform(rows, "mst_stock_item")

    def opening_batches(self) -> DataFrame:
        rows = self.source("part").select(
            F.lit("Primary Batch").alias("name"),
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("item"),
            F.col("p_size").alias("opening_balance"),
            (_money("p_retailprice") * F.col("p_size")).alias("opening_value"),
            F.lit("Main").alias("godown"))
        return conform(rows, "mst_opening_batch_allocation")

    def closing_stock(self) -> DataFrame:
        rows = (
            self.source("events")
            .groupBy(F.concat(F.lit("Stock"), (F.col("user_id") % 5).cast("string")).alias("ledger"),
                     F.to_date("ts").alias("stock_date"))
            .agg(F.max("value").alias("stock_value")))
        return conform(rows, "trn_closingstock_ledger")

    # -- masters --------------------------------------------------------------------------

    def groups(self) -> DataFrame:
        fixed = literal_rows(
            self.spark,
            "guid name parent primary_group is_revenue is_deemedpositive affects_gross_profit",
            [(f"G:{n}", n, "", n, *flags) for n, flags in ROOT_GROUPS.items()])
        region, nation = self.source("region"), self.source("nation")

        def debtor_group(df: DataFrame, name: Column, parent: Column) -> DataFrame:
            return df.select(
                F.concat(F.lit("G:"), name).alias("guid"), name.alias("name"),
                parent.alias("parent"), F.lit("Sundry Debtors").alias("primary_group"),
                F.lit(0).alias("is_revenue"), F.lit(1).alias("is_deemedpositive"),
                F.lit(0).alias("affects_gross_profit"))

        regions = debtor_group(region, F.col("r_name"), F.lit("Sundry Debtors"))
        nations = debtor_group(
            nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")),
            F.col("n_name"), F.col("r_name"))
        return conform(fixed.unionByName(regions).unionByName(nations), "mst_group")

    def ledgers(self) -> DataFrame:
        fixed = literal_rows(
            self.spark, "guid name parent is_revenue opening_balance gstn",
            [(f"L:{n}", n, g, r, o, "") for n, (g, r, o) in FIXED_LEDGERS.items()],
        ).withColumn("opening_balance", _money("opening_balance"))
        customers = (
            self.source("customer")
            .join(self.source("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.concat(F.lit("L:"), F.col("c_name")).alias("guid"), F.col("c_name").alias("name"),
                F.col("n_name").alias("parent"), F.lit(0).alias("is_revenue"),
                _money(-F.col("c_acctbal")).alias("opening_balance"),
                F.col("c_mktsegment").alias("gstn")))
        suppliers = self.source("supplier").select(
            F.concat(F.lit("L:"), F.col("s_name")).alias("guid"), F.col("s_name").alias("name"),
            F.lit("Sundry Creditors").alias("parent"), F.lit(0).alias("is_revenue"),
            _money("s_acctbal").alias("opening_balance"), F.lit("").alias("gstn"))
        return conform(fixed.unionByName(customers).unionByName(suppliers), "mst_ledger")

    def opening_bills(self) -> DataFrame:
        rows = self.source("customer").select(
            F.col("c_name").alias("ledger"), (-F.col("c_acctbal")).alias("opening_balance"),
            F.lit(dt.date(1995, 1, 1)).alias("bill_date"),
            F.concat(F.lit("OB"), F.col("c_custkey").cast("string")).alias("name"),
            F.lit(30).alias("bill_credit_period"), F.lit(0).alias("is_advance"))
        return conform(rows, "mst_opening_bill_allocation")

    def voucher_types(self) -> DataFrame:
        rows = literal_rows(
            self.spark, "guid name parent numbering_method",
            [(f"T:{n}", n, n, "Manual" if n == "Contra" else "Automatic") for n in VOUCHER_TYPES])
        return conform(rows, "mst_vouchertype")

    def books(self) -> Books:
        return Books(self.spark, {
            "mst_group": self.groups,
            "mst_ledger": self.ledgers,
            "mst_vouchertype": self.voucher_types,
            "mst_stock_item": self.stock_items,
            "mst_opening_batch_allocation": self.opening_batches,
            "mst_opening_bill_allocation": self.opening_bills,
            "trn_voucher": self.vouchers,
            "trn_accounting": self.accounting,
            "trn_bill": self.bills,
            "trn_inventory": self.inventory,
            "trn_closingstock_ledger": self.closing_stock,
        })


def testbed(spark: SparkSession, folder: str) -> Books:
    return Testbed(spark, folder).books()


testbed.__test__ = False  # not a test, whatever its name
