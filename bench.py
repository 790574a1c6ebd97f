"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_METHOD_LIMIT`` another
limit for compiled methods. Reports run on stored books, ingest on landed documents; storing and
landing are not timed. Each query is planned and executed in full, its rows thrown away; one run
warms up, the median of the next three counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

HEADLINE = [
    "r1_account_statement", "r2_accounting_voucher_view", "r3_bills_payable", "r4_bills_receivable",
    "r5_daily_cash_movement", "r6_group_ancestors", "r7_group_descendants", "r8_profit_and_loss",
    "r9_purchase_daily", "r10_purchase_monthly", "r11_purchase_register", "r12_sales_daily",
    "r13_sales_monthly", "r14_sales_register", "r15_stock_summary", "r16_stock_voucher_view",
    "r17_trial_balance", "q4_inventory_effects_first_event", "q5_ledger_closing_balance",
    "q6_bill_status", "s14_date_batches", "c_synced_trn_accounting",
]
INGESTED = ["trn_voucher", "trn_accounting", "trn_bill", "trn_cost_inventory_category_centre",
            "trn_inventory"]


def ingest_queries(spark, folder: str) -> dict:
    """Flattening of voucher documents that have landed as Parquet; landing is not timed."""
    from daybook.plans.ingest import flatten
    from daybook.session import scratch
    from checks import testbed_documents as docs

    landed = scratch(spark, "documents")
    docs.voucher_documents(spark, folder).write.parquet(f"{landed}/vouchers")
    docs.stock_voucher_documents(spark, folder).write.parquet(f"{landed}/stock")

    def query(table: str):
        path = f"{landed}/{'stock' if table == 'trn_inventory' else 'vouchers'}"
        return lambda s, _: flatten(s.read.parquet(path), table)

    return {f"ingest_{t}": query(t) for t in INGESTED}


def report_queries(spark, folder: str, registered: dict) -> dict:
    """The headline queries; those that are reports read books stored beforehand."""
    from daybook.plans.books import open_books
    from daybook.plans.sinks import load
    from daybook.session import scratch
    from checks.testbed import testbed

    path, books = scratch(spark, "books"), testbed(spark, folder)
    load(books, path)
    stored = open_books(spark, path, list(books))

    def query(name: str):
        on_books = getattr(registered[name], "on_books", None)
        return registered[name] if on_books is None else lambda s, _: on_books(stored)

    return {n: query(n) for n in HEADLINE}


def main() -> None:
    from checks import registry
    from daybook.session import SETTINGS, session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                    spark__ui__enabled="false", spark__driver__memory="16g",
                    spark__sql__codegen__hugeMethodLimit=os.environ.get(
                        "BENCH_METHOD_LIMIT", SETTINGS["spark.sql.codegen.hugeMethodLimit"]))
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = registry.queries(), {}
    queries = {**report_queries(spark, folder, registered), **ingest_queries(spark, folder)}
    for name in queries:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
