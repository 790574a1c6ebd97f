"""Parts by month: what a change rewrites, what a period report reads, what is refused."""

import pytest
from pyspark.sql import functions as F

from checks.testbed import testbed
from checks.testbed_documents import voucher_documents
from daybook.plans import reports as R
from daybook.plans import sync as S
from daybook.plans.books import Books, conform, open_books
from daybook.plans.months import MONTH, save_by_month
from daybook.plans.store import Store
from daybook.sources import scan
from daybook.streaming import continuous


def _state(spark, month_of_moved="2020-02-10", changed=0):
    """1200 vouchers of four months; the first 300 of February changed, one of them moved."""
    rows = spark.range(1200).select(
        F.concat(F.lit("v"), "id").alias("guid"),
        F.when((F.col("id") % 4 == 1), F.col("id") + changed).otherwise(F.col("id")).alias("alterid"),
        F.when(F.col("id") == 1, F.to_date(F.lit(month_of_moved))).otherwise(
            F.make_date(F.lit(2020), (F.col("id") % 4 + 1).cast("int"), F.lit(10))).alias("date"),
        (F.col("id") + changed).cast("string").alias("narration"))
    lines = rows.select("guid", F.lit("Cash").alias("ledger"), F.lit(1 + changed).alias("amount"))
    return {"trn_voucher": conform(rows, "trn_voucher", incremental=True),
            "trn_accounting": conform(lines, "trn_accounting", incremental=True)}


def _run(store, spark, **moved):
    after = _state(spark, changed=5000, **moved)
    delta = {n: df.where("guid rlike 'v[0-9]+' and cast(substr(guid, 2) as int) % 4 = 1") for n, df in after.items()}
    return S.run(store, {"trn_voucher": scan.versions(after["trn_voucher"])}, Books(spark, delta), {"master": 0, "transaction": 9999})


def _parts(store):
    return {(n, k): p for n, t in store.head().tables.items() for k, p in t["parts"].items()}


@pytest.mark.parametrize("moved", ["2020-02-10", "2020-04-10"])
def test_changes_of_a_month_rewrite_that_month(spark, tmp_path, moved):
    store = Store(spark, str(tmp_path), parts=2)
    store.commit(_state(spark), {})
    before = _parts(store)
    _run(store, spark, month_of_moved=moved)
    after = _parts(store)
    other = {f"202004-{b}" for b in range(2)} if moved != "2020-02-10" else set()
    changed = {k for _, k in {k for k in {*before, *after} if before.get(k) != after.get(k)}}
    assert {f"202002-{b}" for b in range(2)} <= changed <= {f"202002-{b}" for b in range(2)} | other
    assert len(changed - {f"202002-{b}" for b in range(2)}) == (1 if other else 0)  # one bucket of the month moved to
    books = store.books(months=True)
    assert books["trn_voucher"].count() == books["trn_accounting"].count() == 1200
    heads = {r.guid: (r[MONTH], r.narration) for r in books["trn_voucher"].collect()}
    assert heads["v1"] == (int(moved[:4] + moved[5:7]), "5001") and heads["v2"] == (202003, "2")
    assert {r.guid: r[MONTH] for r in books["trn_accounting"].collect()} == {g: m for g, (m, _) in heads.items()}


def test_lines_without_their_voucher_are_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path), by="year")
    store.commit(_state(spark), {})
    with pytest.raises(ValueError, match="lines of vouchers"):
        S.run(store, {}, Books(spark, {"trn_accounting": _state(spark)["trn_accounting"]}), {"master": 0, "transaction": 7})
    assert store.head().number == 1 and store.state() == {}


def test_only_a_comparison_moves_the_number(spark, tmp_path):
    store = Store(spark, str(tmp_path), by="year")
    store.commit(_state(spark), {"Last AlterID Transaction": "3"})
    S.run(store, {}, Books(spark, {}), {"master": 4, "transaction": 9})
    assert store.state()["Last AlterID Transaction"] == "3" and S.STATE_SYNCED not in store.state()


def test_torn_control_file(spark, tmp_path):
    store = Store(spark, str(tmp_path), by="year")
    tables = _state(spark)
    store.commit(tables, {"a": "1"})
    (tmp_path / "control" / "000000000002.json").write_text('{"number": 2, "sta')
    (tmp_path / "control" / ".000000000002.json.crc").unlink(missing_ok=True)
    assert store.state() == {"a": "1"}
    store.commit(tables, {"a": "2"})
    assert store.state() == {"a": "2"} and store.head().number == 2
    store.commit(tables, {"a": "3"})
    assert store.head().number == 3


def test_older_change_of_a_deleted_voucher_stays_away(spark, folder, tmp_path):
    docs = voucher_documents(spark, folder).where("vouchernumber in ('5', '6')").withColumns(
        {"alterid": F.lit(10).cast("bigint"), "deleted": F.lit(False)})
    store = Store(spark, str(tmp_path), parts=1, by="year")
    five = docs.where("vouchernumber = '5'")
    seen = []
    for batch, change in enumerate([docs, five.withColumns({"alterid": F.lit(30), "deleted": F.lit(True)}),
                                    five.withColumn("alterid", F.lit(20)), five.withColumn("alterid", F.lit(25)),
                                    five.withColumn("alterid", F.lit(40))]):
        continuous.apply_changes(store, change.withColumn("alterid", F.col("alterid").cast("bigint")), batch)
        seen.append(store.books()["trn_voucher"].count())
    assert seen == [2, 1, 1, 1, 2]


PERIOD = ("1998-04-01", "1999-03-31")


@pytest.fixture(scope="module")
def by_month(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("by-month"))
    bed = testbed(spark, folder)
    save_by_month(Books(spark, {n: bed[n] for n in ("mst_group", "mst_ledger", "mst_vouchertype", "trn_voucher", "trn_accounting")}), path)
    return open_books(spark, path, ["mst_group", "mst_ledger", "mst_vouchertype", "trn_voucher", "trn_accounting"])


@pytest.mark.parametrize("report", [
    lambda b: R.account_statement(b, "Cash", *PERIOD), lambda b: R.daily_cash_movement(b, *PERIOD),
    lambda b: R.sales_daily(b, *PERIOD), lambda b: R.purchase_monthly(b, *PERIOD), lambda b: R.trial_balance(b, *PERIOD)])
def test_period_reports_read_folders_of_the_period(spark, folder, by_month, report):
    found, want = report(by_month), report(testbed(spark, folder))
    assert found.exceptAll(want).count() == want.exceptAll(found).count() == 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scans = [line for line in report(by_month)._jdf.queryExecution().executedPlan().toString().splitlines() if f"{MONTH}#" in line and "FileScan" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(scans) >= 2 and all(f"({MONTH}#" in s.split("PartitionFilters: [")[1].split("PushedFilters")[0] for s in scans)
