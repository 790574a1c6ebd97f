"""The provided tables recast as exported documents: nested lists, all leaves text.

Every document comes from one source row; lists have the one to three entries written here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.testbed import Testbed


def _struct(**fields: Column | str) -> Column:
    return F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


def _text(c: Column) -> Column:
    return c.cast("string")


def _yes(c: Column) -> Column:
    return F.when(c, "Yes").otherwise("No")


def voucher_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Accounting, payroll and attendance vouchers, one per order."""
    bed = Testbed(spark, folder)
    m = F.col("m")
    first, second, signed = bed.entry_pair(F.col("amt"))

    def amount_text(value: Column) -> Column:
        foreign = F.concat(F.lit("$ "), _text(F.abs(value) * 2), F.lit(" @ 0.5/$ = Rs "), _text(value))
        return F.when(m == 2, foreign).otherwise(_text(value))

    def centres(value: Column) -> Column:
        return F.array(_struct(name=F.col("o_orderpriority"), amount=_text(value)))

    def categories(value: Column) -> Column:
        return F.array(_struct(category=F.col("o_orderstatus"), costcentreallocations=centres(value)))

    def entry(ledger: Column, value: Column, bills: Column, revenue: Column) -> Column:
        return _struct(
            ledgername=ledger, amount=amount_text(value), isdeemedpositive=_yes(value < 0),
            billallocations=bills,
            bankallocations=F.when(
                ledger.isin("Bank", "Cash"),
                F.array(_struct(
                    transactiontype="Cheque", instrumentdate=F.date_format("date", "yyyyMMdd"),
                    instrumentnumber=_text(F.col("k")), bankname="First Bank", amount=_text(value),
                    bankersdate=F.when(m == 7, "").otherwise(F.date_format("date", "yyyyMMdd"))))),
            costcentreallocations=F.when(revenue, centres(value)),
            categoryallocations=F.when(revenue, categories(value)),
            inventoryallocations=F.when(revenue, F.array(_struct(
                stockitemname=F.concat(F.lit("P"), _text(F.col("o_custkey"))),
                categoryallocations=categories(value)))))

    bill = F.array(_struct(
        name=F.concat(F.when(m == 9, "C").otherwise("B"), _text(F.col("b"))),
        amount=_text(F.when(m.isin(6, 8, 9), -F.col("amt")).otherwise(F.col("amt"))),
        billtype=F.when(m.isin(3, 8, 9), "New Ref").otherwise("Agst Ref"),
        billcreditperiod=F.concat(_text(F.col("k") % 90), F.lit(" Days"))))
    has_bill = m.isin(3, 5, 6, 8, 9)
    pay = F.array(_struct(payheadname="Basic", payheadsortorder="1", amount=_text(F.col("amt"))),
                  _struct(payheadname="Allowance", payheadsortorder="2", amount=_text(F.col("k") % 100)))
    return bed.orders().select(
        "guid", F.date_format("date", "yyyyMMdd").alias("date"),
        F.col("voucher_type").alias("vouchertypename"), _text(F.col("k")).alias("vouchernumber"),
        F.concat(F.lit("R&amp;D "), F.col("o_orderpriority")).alias("narration"),
        F.col("party").alias("partyledgername"), _yes(m.isin(3, 8, 9)).alias("isinvoice"),
        _yes((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")).alias("iscancelled"),
        _yes(F.lit(False)).alias("isoptional"),
        _text(F.col("k") + 1).alias("alterid"),
        F.array(
            entry(first, signed, F.when(has_bill, bill), F.lit(False)),
            entry(second, -signed, F.when(F.lit(False), bill), second.isin("Sales", "Purchase")),
        ).alias("allledgerentries"),
        F.when(m == 3, F.array(_struct(
            ledgername="Freight", amount=_text(-F.col("k") % 1000), addlalloctype="By Quantity",
            rateofinvoicetax=F.concat(F.lit(" "), _text(F.col("k") % 28), F.lit(".5"))))
        ).alias("ledgerentries"),
        F.when(m == 6, F.array(_struct(
            category=F.col("o_orderstatus"),
            employeeentry=F.array(_struct(
                employeename=F.col("o_orderpriority"), amount=_text(F.col("amt")),
                employeesortorder=_text(F.col("k") % 7), payheadallocations=pay))))
        ).alias("categoryentry"),
        F.when(m == 7, F.array(_struct(
            name=F.col("o_orderpriority"), attendancetype="Present",
            attdtypetimevalue=F.concat(_text(F.col("k") % 12), F.lit(".25")),
            attdtypevalue=F.concat(_text(F.col("k") % 5), F.lit(" Days"))))
        ).alias("attendanceentries"))


def stock_voucher_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Stock vouchers, one per order line, received back when the line was returned."""
    line = Testbed(spark, folder).source("lineitem")
    money = F.col("l_extendedprice").cast("decimal(17,2)")
    quantity = F.concat(F.lit(" "), _text(F.col("l_quantity").cast("decimal(15,2)")), F.lit(" Nos"))
    tracking = (F.when(F.col("l_linestatus") == "O", F.concat(F.lit("T"), _text(F.col("l_partkey"))))
                .when(F.col("l_returnflag") == "A", "").otherwise("Not Applicable"))
    batch = _struct(
        batchname=F.concat(F.lit("B"), _text(F.col("l_suppkey"))), actualqty=quantity,
        amount=_text(money), godownname="Main", destinationgodownname=F.col("l_linestatus"),
        trackingnumber=tracking)
    return line.select(
        F.concat(F.lit("V"), _text(F.col("l_orderkey"))).alias("guid"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("date"),
        F.array(_struct(
            stockitemname=F.concat(F.lit("P"), _text(F.col("l_partkey"))), actualqty=quantity,
            rate=F.concat(_text(money), F.lit("/Nos")),
            amount=_text(money), addlamount=_text(F.col("l_tax")), discount=_text(F.col("l_discount")),
            godownname="Main", trackingnumber=tracking, orderno="",
            orderduedate=F.when(F.col("l_linestatus") == "F", "").otherwise(
                F.date_format("l_shipdate", "yyyyMMdd")),
            isdeemedpositive=_yes(F.col("l_returnflag") == "R"),
            batchallocations=F.array(batch))).alias("allinventoryentries"))


def stock_item_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Stock items with three levels of tax details, batches and standard prices."""
    part = Testbed(spark, folder).source("part")
    price = F.col("p_retailprice").cast("decimal(15,4)")

    def rate(head: str, value: Column) -> Column:
        return _struct(gstratedutyhead=head, gstrate=_text(value), gstratevaluationtype="Not Applicable")

    def dated(date: str, value: Column) -> Column:
        return _struct(date=date, rate=F.concat(_text(value), F.lit("/Nos")))

    return part.select(
        F.concat(F.lit("I"), _text(F.col("p_partkey"))).alias("guid"),
        F.concat(F.lit("P"), _text(F.col("p_partkey"))).alias("name"),
        F.when(F.col("p_type") == "SMALL", "Primary").otherwise(F.col("p_brand")).alias("parent"),
        F.lit("Not Applicable").alias("category"), F.lit("Nos").alias("baseunits"),
        F.col("p_name").alias("description"),
        F.concat(F.lit("(-)"), _text(F.col("p_size")), F.lit(" Nos")).alias("openingbalance"),
        F.concat(_text(price), F.lit("/Nos")).alias("openingrate"),
        F.when(F.col("p_type") == "ECONOMY", "").otherwise("Applicable").alias("gstapplicable"),
        F.array(_struct(
            applicablefrom="20170701", hsncode=_text(F.col("p_size")), taxability="Taxable",
            statewisedetails=F.array(_struct(statename="Any", ratedetails=F.array(
                rate("Central", F.col("p_size") / 2), rate("State", F.col("p_size") / 2),
                rate("Integrated", F.col("p_size"))))))).alias("gstdetails"),
        F.array(_struct(
            batchname="Primary Batch", openingbalance=_text(F.col("p_size")),
            openingrate=F.concat(_text(price), F.lit("/Nos")), openingvalue=_text(price),
            godownname="Main", mfdon="")).alias("batchallocations"),
        F.array(dated("20200401", price), dated("20210401", price + 1)).alias("standardcostlist"),
        F.array(dated("20200401", price * 2)).alias("standardpricelist"))


def ledger_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Customer ledgers with opening bills, and stock ledgers with dated values."""
    bed = Testbed(spark, folder)
    balance = (-F.col("c_acctbal")).cast("decimal(17,2)")
    customers = bed.source("customer").join(
        bed.source("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("L:"), F.col("c_name")).alias("guid"), F.col("c_name").alias("name"),
        F.col("n_name").alias("parent"), _text(balance).alias("openingbalance"),
        F.lit("No").alias("isrevenue"), F.lit("").alias("partygstin"),
        F.array(_struct(gstin=F.lit("old")), _struct(gstin=F.col("c_mktsegment"))).alias("ledgstregdetails"),
        F.array(F.col("n_name"), F.col("c_mktsegment")).alias("address"),
        F.lit("+91").alias("ledgercountryisdcode"), _text(F.col("c_custkey")).alias("ledgermobile"),
        F.concat(_text(F.col("c_nationkey")), F.lit(" Days")).alias("billcreditperiod"),
        F.array(_struct(
            name=F.concat(F.lit("OB"), _text(F.col("c_custkey"))), billdate="19950101",
            openingbalance=_text(balance), billcreditperiod="30 Days", isadvance="No",
        )).alias("billallocations"),
        F.array(_struct(date="20240101", amount="1")).alias("ledgerclosingvalues"))
    stock = bed.closing_stock().select(
        F.col("ledger").alias("name"), F.lit("Stock-in-hand").alias("parent"),
        F.array(_struct(date=F.date_format("stock_date", "yyyyMMdd"),
                        amount=_text(F.col("stock_value")))).alias("ledgerclosingvalues"))
    return customers.unionByName(stock, allowMissingColumns=True)


def group_documents(spark: SparkSession, folder: str) -> DataFrame:
    return Testbed(spark, folder).groups().select(
        "guid", "name", F.when(F.col("parent") == "", "Primary").otherwise(F.col("parent")).alias("parent"),
        F.col("primary_group").alias("_primarygroup"), _yes(F.col("is_revenue") == 1).alias("isrevenue"),
        _yes(F.col("is_deemedpositive") == 1).alias("isdeemedpositive"),
        _yes(F.col("affects_gross_profit") == 1).alias("affectsgrossprofit"))


def voucher_type_documents(spark: SparkSession, folder: str) -> DataFrame:
    return Testbed(spark, folder).voucher_types().select(
        "guid", "name", "parent", F.col("numbering_method").alias("numberingmethod"))


def documents(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "group": group_documents(spark, folder), "ledger": ledger_documents(spark, folder),
        "vouchertype": voucher_type_documents(spark, folder),
        "stockitem": stock_item_documents(spark, folder),
        "voucher": voucher_documents(spark, folder),
    }
