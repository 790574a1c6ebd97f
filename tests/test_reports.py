"""Invariants and edge cases of the reports."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators import calendar, hierarchy
from daybook.plans import reports as R
from daybook.plans.books import Books
from daybook.schema import TABLES
from checks.testbed import testbed

FROM, TO = "1998-04-01", "1999-03-31"


@pytest.fixture
def empty(spark, rows):
    return Books(spark, {n: rows(n) for n in TABLES})


def test_every_voucher_balances(spark, folder):
    sums = testbed(spark, folder).trn_accounting.groupBy("guid").agg(F.sum("amount").alias("s"))
    assert sums.where("s <> 0").count() == 0


def test_trial_balance_adds_up(spark, folder):
    tb = R.trial_balance(testbed(spark, folder), FROM, TO)
    totals = tb.agg(F.sum("debit").alias("d"), F.sum("credit").alias("c")).first()
    assert totals.d == totals.c > 0
    assert tb.where("closing <> opening + credit - debit").count() == 0
    names = [r.name for r in tb.select("name").collect()]
    assert names == sorted(names)


def test_reports_on_empty_tables(empty):
    for report in (R.accounting_voucher_view, R.accounting_effects, R.sales_register, R.purchase_register,
                   R.stock_summary, R.stock_voucher_view, R.bill_status, R.ledger_closing_balances,
                   R.sales_view, R.inventory_effects):
        assert report(empty).count() == 0
    assert R.trial_balance(empty, FROM, TO).count() == 0
    assert R.account_statement(empty, "Cash", FROM, TO).count() == 0
    assert R.bills_payable(empty, TO).count() == 0
    daily = R.sales_daily(empty, FROM, TO).collect()
    assert len(daily) == 365 and {r.amount for r in daily} == {Decimal("0.00")}
    stock = {r.ledger: r.balance for r in R.profit_and_loss(empty).collect()}
    assert stock == {"Opening Stock": None, "Closing Stock": None}
    stock = {r.ledger: r.balance for r in R.profit_and_loss(empty, zero_if_empty=True).collect()}
    assert set(stock.values()) == {Decimal("0.00")}


def test_long_periods_and_months(spark):
    assert calendar.days(spark, "2000-01-01", "2009-12-31").count() == 3653
    assert calendar.months(spark, "2020-01-31", "2020-03-01").count() == 3
    assert calendar.days(spark, "2020-01-02", "2020-01-01").count() == 0


@pytest.mark.parametrize("counts,expected", [
    ([3, 2, 4], [(0, 1, 5), (2, 2, 4)]), ([9, 1], [(0, 0, 9), (1, 1, 1)]), ([1], [(0, 0, 1)]), ([], [])])
def test_batches(spark, counts, expected):
    start = dt.date(2020, 4, 1)
    dates = [(start + dt.timedelta(days=i),) for i, n in enumerate(counts) for _ in range(n)]
    got = calendar.batches(spark.createDataFrame(dates, "date date"), 5).collect()
    day = lambda i: start + dt.timedelta(days=i)
    assert [(r.date_from, r.date_to, r.rows) for r in got] == [(day(a), day(b), n) for a, b, n in expected]
    assert [r.batch for r in got] == list(range(1, len(expected) + 1))


def bills(spark, rows, *records):
    v = [{"guid": r["guid"], "date": r.get("date", "2020-01-01")} for r in records]
    return Books(spark, {
        "trn_voucher": rows("trn_voucher", *v), "mst_opening_bill_allocation": rows("mst_opening_bill_allocation"),
        "trn_bill": rows("trn_bill", *[{k: x for k, x in r.items() if k != "date"} for r in records])})


def test_bill_opened_twice(spark, rows):
    """Settlements count once per opening row, or once with ``dedupe``."""
    b = bills(spark, rows,
              {"guid": "1", "ledger": "L", "name": "B", "amount": 100, "billtype": "New Ref", "bill_credit_period": 5},
              {"guid": "2", "ledger": "L", "name": "B", "amount": 80, "billtype": "Advance", "date": "2020-01-03"},
              {"guid": "3", "ledger": "L", "name": "B", "amount": -30, "billtype": "Agst Ref"},
              {"guid": "4", "ledger": "L", "name": "C", "amount": -30, "billtype": "Agst Ref"},
              {"guid": "5", "ledger": "L", "name": "B", "amount": 999, "billtype": "On Account"})
    [r] = R.bills_payable(b, "2020-01-31").collect()
    assert (r.pending_amount, r.date, r.due_on, r.overdue_by_days) == (
        Decimal("40.0000"), dt.date(2020, 1, 3), dt.date(2020, 1, 8), 23)
    [r] = R.bills_payable(b, "2020-01-31", dedupe=True).collect()
    assert r.pending_amount == Decimal("70.0000")
    assert R.bills_receivable(b, "2020-01-31").count() == 0


def test_statement_lists_repeated_ledgers(spark, rows):
    b = Books(spark, {
        "trn_voucher": rows("trn_voucher",
                            {"guid": "1", "date": "2020-01-01", "is_accounting_voucher": 1},
                            {"guid": "2", "date": "2020-01-01", "is_accounting_voucher": 1}),
        "trn_accounting": rows("trn_accounting", *[
            {"guid": "1", "ledger": x, "amount": a} for x, a in
            (("Cash", -3), ("B", 1), ("A", 1), ("B", 1))], {"guid": "2", "ledger": "Cash", "amount": 1})})
    [r] = R.account_statement(b, "Cash", "2020-01-01", "2020-12-31").collect()
    assert (r.ledgers, r.debit, r.credit) == ("A,B,B", Decimal("3.00"), Decimal("0.00"))
    [r] = R.account_statement(b, "Cash", "2020-01-01", "2020-12-31", distinct=True).collect()
    assert r.ledgers == "A,B"


def stock(spark, rows, *lines):
    types = {"S": ("Sales", 0, 0), "D": ("Delivery Note", 1, 0), "O": ("Sales Order", 0, 1)}
    return Books(spark, {
        "mst_vouchertype": rows("mst_vouchertype", *[{"name": n, "parent": n} for n, _, _ in types.values()]),
        "mst_stock_item": rows("mst_stock_item", {"name": "X", "opening_balance": 100}),
        "mst_opening_batch_allocation": rows("mst_opening_batch_allocation"),
        "trn_voucher": rows("trn_voucher", *[
            {"guid": str(i), "voucher_type": types[k][0], "is_inventory_voucher": types[k][1],
             "is_order_voucher": types[k][2], "date": f"2020-01-{i + 1:02d}"} for i, (k, _, _) in enumerate(lines)]),
        "trn_inventory": rows("trn_inventory", *[
            {"guid": str(i), "item": "X", "quantity": q, "tracking_number": t} for i, (_, q, t) in enumerate(lines)]),
    })


@pytest.mark.parametrize("lines,out", [
    ([("S", -5, ""), ("S", -5, "")], 10),  # untracked lines all count
    ([("D", -5, "T"), ("S", -5, "T")], 5),  # equal: the invoice
    ([("D", -7, "T"), ("S", -5, "T")], 7),  # more noted: the note
    ([("D", -4, "T"), ("S", -5, "T")], 0),  # more invoiced: neither
    ([("D", -4, "T")], 4), ([("S", -4, "T")], 0), ([("O", -4, "")], 0),
])
def test_stock_summary_branches(spark, rows, lines, out):
    [r] = R.stock_summary(stock(spark, rows, *lines)).collect()
    assert (r.out_qty, r.clo_bal) == (Decimal(out), Decimal(100 - out))


def test_null_tracking_numbers(spark, rows):
    """Summary: NULL is untracked. First event: NULL is one more tracking number."""
    b = stock(spark, rows, ("S", -5, ""), ("S", -6, ""))
    b = b.with_tables(trn_inventory=b.trn_inventory.withColumn("tracking_number", F.lit(None).cast("string")))
    assert R.stock_summary(b).first().out_qty == 11
    assert [r.quantity for r in R.inventory_effects_first_event(b).collect()] == [-5]


def test_first_event_ties(spark, rows):
    b = stock(spark, rows, ("S", -5, "T"), ("D", -9, "T"), ("O", -1, "T"))
    same_day = b.trn_voucher.withColumn("date", F.lit("2020-01-01").cast("date"))
    assert [r.quantity for r in R.stock_voucher_view(b.with_tables(trn_voucher=same_day)).collect()] == [-5]


def tree(spark, *pairs):
    return spark.createDataFrame(pairs, "name string, parent string")


def test_hierarchies(spark):
    t = tree(spark, ("a", ""), ("b", "a"), ("c", "b"), ("d", "a"))
    assert sorted(r.name for r in hierarchy.descendants(t, "a").collect()) == ["a", "b", "c", "d"]
    assert sorted(r.name for r in hierarchy.ancestors(t, "c").collect()) == ["a", "b", "c"]
    assert hierarchy.ancestors(t, "zz").count() == 0
    ledgers = spark.createDataFrame([("l1", "c"), ("l2", "d")], "name string, parent string")
    assert [r.name for r in hierarchy.members(ledgers, t, "b").collect()] == ["l1"]


def test_cycles_are_an_error(spark):
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT"):
        hierarchy.descendants(tree(spark, ("a", "b"), ("b", "a")), "a", levels=20).count()


def test_deep_hierarchies(spark):
    chain = tree(spark, *[(f"n{i}", f"n{i - 1}" if i else "") for i in range(20)])
    assert hierarchy.ancestors(chain, "n19", levels=30).count() == 20


def test_views(spark, folder):
    R.create_views(testbed(spark, folder))
    assert spark.sql("SELECT sum(amount) FROM vw_sales").first()[0] > 0
    assert spark.table("vw_purchase").columns[0] == "date"
