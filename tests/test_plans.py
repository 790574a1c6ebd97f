"""What the physical plans must and must not contain."""

import pytest

from checks import registry
from daybook.operators import lookup
from daybook.plans import reports as R
from daybook.plans.books import open_books
from daybook.plans.sinks import load
from checks.testbed import testbed

LAZY = [q for q in sorted(registry.queries()) if q[0] in "rvqnte" or q.startswith("c_")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, folder, name):
    p = plan(registry.queries()[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "BatchEvalPython", "MapInPandas"):
        assert bad not in p
    assert "SinglePartition" not in p or "partial_" in p or name.startswith(("r6", "r7", "f5"))


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("books"))
    load(testbed(spark, folder), path)
    return open_books(spark, path)


def test_filters_and_columns_reach_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    p = R.trial_balance(stored, "1998-04-01", "1999-03-31")._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(date,1999-03-31)" in p and "EqualTo(is_order_voucher,0)" in p
    assert "narration" not in p.split("== Physical Plan ==")[1]


def test_stored_books_give_the_same_report(spark, folder, stored):
    a = R.trial_balance(stored, "1998-04-01", "1999-03-31")
    b = R.trial_balance(testbed(spark, folder), "1998-04-01", "1999-03-31")
    assert a.exceptAll(b).count() == 0


def test_untracked_stock_needs_no_window(stored):
    p = plan(R.stock_voucher_view(stored))
    assert "Window" not in p and p.count("partial_min") >= 1


def test_bills_need_one_grouping_and_no_bill_join(stored):
    p = plan(R.bills_payable(stored, "2001-12-31"))
    assert p.count("SortMergeJoin") + p.count("BroadcastHashJoin") == 1  # bills with their vouchers


def test_nested_columns_are_pruned(spark, folder, tmp_path):
    """A table stored as documents is read only where the flat table needs it."""
    from daybook.plans.ingest import flatten
    from checks.testbed_documents import voucher_documents
    voucher_documents(spark, folder).write.parquet(str(tmp_path / "docs"))
    flat = flatten(spark.read.parquet(str(tmp_path / "docs")), "trn_attendance")
    schema = plan(flat).split("ReadSchema:")[1]
    assert "attendanceentries" in schema and "allledgerentries" not in schema


def test_oracle_texts_read_whole_tables():
    for name, sql in registry.oracle_sql().items():
        assert " limit " not in sql.lower(), name


def test_profit_and_loss_reads_its_facts_once(spark, stored, monkeypatch):
    """Without any broadcast: no sketch of hot keys, one scan of each fact table."""
    want = sorted(map(tuple, R.profit_and_loss(stored).collect()), key=str)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = R.profit_and_loss(stored)
        p = plan(df)
        assert "approx_top_k" not in p and "Generate" not in p
        scans = [line for line in p.split("\n") if "FileScan" in line]
        assert sum("/trn_accounting" in s for s in scans) == 1 and sum("/trn_voucher" in s for s in scans) == 1
        assert sorted(map(tuple, df.collect()), key=str) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
