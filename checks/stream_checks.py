"""Streams next to sync runs: several collections in one stream, synced tables, master runs between batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import io_checks, sync_checks, testbed_documents
from checks.ingest_checks import _ACCOUNTING
from checks.oracle_books import with_books
from checks.testbed_changes import two_states
from daybook.plans import sync as S
from daybook.plans.books import Books, conform
from daybook.plans.ingest import flattened
from daybook.plans.store import Store
from daybook.session import scratch
from daybook.sources import scan
from daybook.streaming import continuous

_CHANGE = ["collection", "guid", "alterid", "deleted"]
_DOCUMENTS = {"ledger": "struct<name:string,parent:string>", "stockitem": "struct<name:string>",
              "number": "struct<voucher_number:string>"}


def _change(df, collection, alterid, deleted=False, document=None):
    """Rows of a stream of several collections."""
    return df.select(
        F.lit(collection).alias("collection"), "guid", F.col(alterid).cast("bigint").alias("alterid") if isinstance(alterid, str)
        else F.lit(alterid).cast("bigint").alias("alterid"), F.lit(deleted).alias("deleted"),
        *[(document if name == collection and document is not None else F.lit(None)).cast(kind).alias(name)
          for name, kind in _DOCUMENTS.items()])


def _several(spark, folder):
    """Synced tables, then one stream with renamed ledgers, deleted items and renumbered vouchers."""
    before, after = two_states(spark, folder)
    base = scratch(spark, "several")
    store = Store(spark, f"{base}/store", parts=1, by="year")
    state = before.state()
    items = conform(before.stock_items().withColumn("alterid", F.lit(1)), "mst_stock_item", incremental=True)
    store.commit({**{n: state[n] for n in state}, "mst_stock_item": items})
    ledgers = _change(after.delta()["mst_ledger"], "ledger", "alterid", document=F.struct("name", "parent"))
    gone = _change(items.where("guid like '%7'"), "stockitem", 2, deleted=True)
    numbers = _change(S.automatic_numbers(after.vouchers(), after.voucher_types()), "number", 1, document=F.struct("voucher_number"))
    for part in (ledgers.unionByName(gone), numbers, ledgers):  # the last one is a repeat
        part.write.mode("append").parquet(f"{base}/landing")
    continuous.run(spark, f"{base}/landing", ledgers.schema, store, f"{base}/state").awaitTermination()
    return store.books()


def _documents(spark, folder):
    return testbed_documents.voucher_documents(spark, folder).withColumns(
        {"alterid": F.col("alterid").cast("bigint"), "deleted": F.lit(False)})


def _into_synced(spark, folder):
    """Urgent vouchers streamed into tables that a sync has filled with all others."""
    before, _ = two_states(spark, folder)
    docs, ledgers = _documents(spark, folder), io_checks.stored(before.ledgers(), "ledgers")
    names = {"mst_ledger": io_checks.stored(ledgers.select("guid", "name"), "names")}
    store = Store(spark, scratch(spark, "synced"), parts=1, by="year")
    others, few = flattened(
        store, docs.where("narration not like '%1-URGENT'").drop("deleted"), scratch(spark, "others"), names)
    store.commit({"mst_ledger": ledgers, **others}, ungathered=few)
    continuous.apply_changes(store, docs.where("narration like '%1-URGENT'"), 0)
    return store.books()["trn_accounting"].select("guid", "ledger", "_ledger", "amount")


def _master_run_between(spark, folder):
    """A sync run of masters alone between two batches; the second holds older changes."""
    before, after = two_states(spark, folder)
    docs = _documents(spark, folder)
    store = Store(spark, scratch(spark, "between"), parts=1, by="year")
    store.commit({"mst_ledger": before.ledgers()})
    half = docs.agg(F.max("alterid")).first()[0] // 2
    continuous.apply_changes(store, docs.where(F.col("alterid") > half), 0)
    S.run(store, {"mst_ledger": scan.versions(after.ledgers())}, Books(spark, {"mst_ledger": after.delta()["mst_ledger"]}),
          {"master": 10**9, "transaction": int(store.state()["Last AlterID Transaction"])})
    continuous.apply_changes(store, docs.where(F.col("alterid") <= half), 1)
    return store.books()["trn_voucher"].select("guid", "alterid", "narration")


QUERIES = {
    "w4_stream_renamed_ledgers": lambda s, f: _several(s, f)["trn_accounting"].select(*sync_checks._A),
    "w4_stream_renumbered": lambda s, f: _several(s, f)["trn_voucher"].select("guid", "voucher_number"),
    "w4_stream_deleted_items": lambda s, f: _several(s, f)["mst_stock_item"].select("guid", "name"),
    "w4_stream_into_synced": _into_synced,
    "w3_master_run_between": _master_run_between,
}

ORACLE = {
    "w4_stream_renamed_ledgers": sync_checks.ORACLE["c8_cascade_rename"],
    "w4_stream_renumbered": sync_checks._sql("""
      select guid, (case when gone then k else num end)::varchar as voucher_number from chg where not fresh"""),
    "w4_stream_deleted_items": """
      select 'I' || p_partkey as guid, 'P' || p_partkey as name from part where p_partkey::varchar not like '%7'""",
    "w4_stream_into_synced": with_books(f"""
      select a.guid, a.ledger, coalesce(l.guid, '') as _ledger, a.amount
      from ({_ACCOUNTING}) a left join mst_ledger l on l.name = a.ledger"""),
    "w3_master_run_between": io_checks.ORACLE["w3_late_lower_numbers"],
}
