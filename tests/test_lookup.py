"""The shuffle path of joins: same rows as a plain join, hot keys spread out."""

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.compare import differences
from daybook.operators import lookup as L

REPORTS = ["r1_account_statement", "r2_accounting_voucher_view", "r3_bills_payable",
           "r5_daily_cash_movement", "r8_profit_and_loss", "r11_purchase_register",
           "r15_stock_summary", "r16_stock_voucher_view", "r17_trial_balance", "q6_bill_status",
           "v1_sales_view", "e15_master_guids", "c_synced_trn_accounting", "c_synced_trn_voucher"]


def skewed(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("key"),
        F.col("id").alias("v"))
    other = spark.range(60).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        (F.col("id") * 2).alias("w"))
    return facts, other.where(F.col("w") % 3 != 0).unionByName(other.where("key = 'hot'"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("share", [5, 1000])
def test_salted_join_is_the_plain_join(spark, how, share):
    facts, other = skewed(spark)
    got = L.salted_join(facts, other, "key", how, share=share)
    want = facts.join(other, "key", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_keys_are_the_frequent_ones(spark):
    facts, _ = skewed(spark)
    assert [r.key for r in L.hot_keys(facts, "key", share=5).collect()] == ["hot"]
    assert L.hot_keys(facts, "key", share=2).count() == 0


def test_a_hot_key_is_spread_over_partitions(spark):
    facts, other = skewed(spark)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = L.salted_join(facts, other, "key", share=5)
        sizes = joined.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_only_behind_a_size_check(spark):
    facts, other = skewed(spark)
    assert L.is_small(other) and not L.is_small(other, 10)
    assert L.fits(other, 60) and not L.fits(other, 5)


@pytest.mark.parametrize("name", REPORTS)
def test_queries_without_broadcasts(spark, con, folder, name, monkeypatch):
    """Every side counts as large and most keys as hot: results stay the same."""
    monkeypatch.setattr(L, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(L, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(L, "fits", lambda df, rows=None: False)
    monkeypatch.setattr(L.salted_join, "__defaults__", ("inner", None, 20))
    found = differences(registry.queries()[name](spark, folder), con, registry.oracle_sql()[name])
    assert found == []
