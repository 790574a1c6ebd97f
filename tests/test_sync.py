"""Incremental sync equals a full refresh; the store and the stream survive repetition."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import lookup
from daybook.plans import ingest
from daybook.plans import store as store_module
from daybook.plans import sync as S
from daybook.plans.books import Books
from daybook.plans.sinks import STATE_TRANSACTION
from daybook.plans.store import Store, Superseded
from daybook.schema import tables
from daybook.sources import scan
from checks.testbed_documents import voucher_documents
from daybook.streaming import continuous


class Source:
    """A small company that changes at random."""

    def __init__(self, seed):
        self.rnd, self.clock = random.Random(seed), 0
        self.ledgers, self.vouchers = {}, {}
        for _ in range(6):
            self.add_ledger()
        for _ in range(12):
            self.add_voucher()

    def tick(self):
        self.clock += 1
        return self.clock

    def add_ledger(self):
        n = self.tick()
        self.ledgers[f"L{n}"] = {"alterid": n, "name": f"ledger {n}"}

    def add_voucher(self):
        n = self.tick()
        lines = [(self.rnd.choice(sorted(self.ledgers)), self.rnd.randint(-9, 9)) for _ in range(self.rnd.randint(0, 3))]
        self.vouchers[f"V{n}"] = {"alterid": n, "lines": lines, "number": 0, "type": self.rnd.choice(["A", "M"])}

    def change(self):
        for _ in range(8):
            pick = self.rnd.random()
            if pick < 0.3:
                self.add_voucher()
            elif pick < 0.5:
                self.vouchers.pop(self.rnd.choice(sorted(self.vouchers)), None)
            elif pick < 0.75:
                v = self.vouchers[self.rnd.choice(sorted(self.vouchers))]
                v["alterid"] = self.tick()
                v["lines"] = [(g, a + 1) for g, a in v["lines"]]
            else:
                led = self.ledgers[self.rnd.choice(sorted(self.ledgers))]
                led["alterid"], led["name"] = self.tick(), led["name"] + "'"
        for i, v in enumerate(sorted(self.vouchers)):
            if self.vouchers[v]["type"] == "A":
                self.vouchers[v]["number"] = i

    def books(self, rows, after=-1):
        led = {g: l for g, l in self.ledgers.items()}
        v = {g: x for g, x in self.vouchers.items() if x["alterid"] > after}
        build = lambda t, recs: rows(t, *recs, incremental=True)
        return Books(None, {
            "mst_ledger": build("mst_ledger", [
                {"guid": g, "alterid": x["alterid"], "name": x["name"]} for g, x in led.items() if x["alterid"] > after]),
            "mst_vouchertype": build("mst_vouchertype", [
                {"guid": "TA", "alterid": 0, "name": "A", "numbering_method": "Automatic"},
                {"guid": "TM", "alterid": 0, "name": "M", "numbering_method": "Manual"}] if after < 0 else []),
            "trn_voucher": build("trn_voucher", [
                {"guid": g, "alterid": x["alterid"], "voucher_type": x["type"], "_voucher_type": "T" + x["type"],
                 "voucher_number": x["number"]} for g, x in v.items()]),
            "trn_accounting": build("trn_accounting", [
                {"guid": g, "ledger": led[l]["name"], "_ledger": l, "amount": a}
                for g, x in v.items() for l, a in x["lines"]]),
        })


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


PRIMARY = ("mst_ledger", "mst_vouchertype", "trn_voucher")


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_equals_full_refresh(spark, rows, tmp_path, seed):
    source, store = Source(seed), Store(spark, str(tmp_path), by="year")
    store.commit(dict(source.books(rows)), {"Last AlterID Master": "1", STATE_TRANSACTION: str(source.clock)})
    last = source.clock
    for _ in range(2):
        source.change()
        full, delta = source.books(rows), source.books(rows, last)
        delta = Books(spark, dict(delta))
        numbers = S.automatic_numbers(full["trn_voucher"], full["mst_vouchertype"])
        S.run(store, {t: scan.versions(full[t]) for t in PRIMARY}, delta,
              {"master": source.clock, "transaction": source.clock}, numbers)
        last = source.clock
        stored = store.books()
        for name in full:
            same(stored[name], full[name])
    assert S.run(store, {}, delta, {"master": last, "transaction": last}) == {}
    with pytest.raises(ValueError):
        S.run(store, {}, delta, {"master": last - 1, "transaction": last})


def test_master_cascade(spark, rows):
    before = Books(spark, {
        "mst_ledger": rows("mst_ledger", {"guid": "a", "alterid": 1, "name": "x"}, {"guid": "b", "alterid": 1, "name": "y"}, incremental=True),
        "mst_opening_bill_allocation": rows("mst_opening_bill_allocation", {"_ledger": "a", "ledger": "x"}, {"_ledger": "b", "ledger": "y"}, incremental=True)})
    source = spark.createDataFrame([("b", 1)], "guid string, alterid bigint")
    after = S.synced(before, {"mst_ledger": source}, Books(spark, {}))
    assert [r.name for r in after.mst_ledger.collect()] == ["y"]
    assert [r.ledger for r in after.mst_opening_bill_allocation.collect()] == ["y"]


def test_gate():
    g = S.gate({"master": 5, "transaction": 7}, {"master": 5, "transaction": 9})
    assert (g.master, g.transaction, g.restored, g.any) == (False, True, False, True)
    assert S.gate({"master": 5, "transaction": 7}, {"master": 4, "transaction": 7}).restored


def test_unchanged_half_is_not_rewritten(spark, rows, tmp_path):
    source, store = Source(3), Store(spark, str(tmp_path), by="year")
    store.commit(dict(source.books(rows)), {"Last AlterID Master": "9", STATE_TRANSACTION: "9"})
    full = source.books(rows)
    written = S.run(store, {t: scan.versions(full[t]) for t in PRIMARY},
                    Books(spark, dict(source.books(rows, source.clock))), {"master": 9, "transaction": 99})
    assert set(written) == {"trn_voucher", "trn_accounting"}
    same(store.books()["trn_accounting"], full["trn_accounting"])


def test_failed_run_leaves_the_last_version(spark, rows, tmp_path):
    source, store = Source(4), Store(spark, str(tmp_path), by="year")
    store.commit(dict(source.books(rows)), {STATE_TRANSACTION: "1"})
    bad = rows("trn_voucher", {"guid": "z"}, incremental=True).withColumn(
        "narration", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        store.commit({"trn_voucher": bad}, {STATE_TRANSACTION: "2"})
    assert store.state() == {STATE_TRANSACTION: "1"}
    same(store.books()["trn_voucher"], source.books(rows)["trn_voucher"])


def _files(store):
    return {(n, k): p for n, t in store.head().tables.items() for k, p in t["parts"].items()}


def test_one_voucher_rewrites_its_part_only(spark, folder, tmp_path):
    docs = voucher_documents(spark, folder).withColumns({"alterid": F.col("alterid").cast("bigint"), "deleted": F.lit(False)})
    store = Store(spark, str(tmp_path), parts=2, by="year")
    continuous.apply_changes(store, docs, 0)
    before, full = _files(store), {r.guid for r in store.books()["trn_voucher"].select("guid").collect()}
    one = docs.where("vouchernumber = '5'").withColumns({"alterid": F.lit(10**9), "narration": F.lit("edited")})
    continuous.apply_changes(store, one, 1)
    after = _files(store)
    stored = store.rows(store.head(), "trn_voucher", months=True)
    part = store.parts_of(stored.where("alterid = 1000000000")).pop()
    assert {k for k in after if after[k] != before.get(k)} <= {k for k in after if k[1] == part} | {
        (continuous.DELETED, p) for p in store.undated_parts(one)}
    assert {r.guid for r in store.books()["trn_voucher"].select("guid").collect()} == full
    assert [r.narration for r in store.books()["trn_voucher"].where("alterid = 1000000000").collect()] == ["edited"]
    assert store.forget(keep=1) == len({k for k in before if after.get(k) != before[k]})  # the rest is still in use
    assert store.books()["trn_accounting"].count() > 0


def test_master_change_without_rename_leaves_vouchers_alone(spark, rows, tmp_path):
    source, store = Source(5), Store(spark, str(tmp_path), parts=2, by="year")
    store.commit(dict(source.books(rows)), {"Last AlterID Master": "1", STATE_TRANSACTION: "1"})
    before, full = _files(store), source.books(rows)
    state = {t: scan.versions(full[t]) for t in PRIMARY}
    changed = full["mst_ledger"].withColumn("alterid", F.col("alterid") + 1000)
    S.run(store, {**state, "mst_ledger": scan.versions(changed)}, Books(spark, {"mst_ledger": changed}), {"master": 2000, "transaction": 1})
    after = _files(store)
    assert {n for (n, k) in after if after[n, k] != before.get((n, k))} <= {t.name for t in tables("master")}
    assert after["mst_ledger", "-"] != before["mst_ledger", "-"]


def test_second_writer_is_refused(spark, rows, tmp_path):
    store, other = Store(spark, str(tmp_path), by="year"), Store(spark, str(tmp_path), by="year")
    base = other.head()
    ledger = rows("mst_ledger", {"guid": "a", "name": "x"}, incremental=True)
    store.commit({"mst_ledger": ledger})
    with pytest.raises(Superseded):
        other.commit({"mst_ledger": ledger.withColumn("name", F.lit("y"))}, base=base)
    assert [r.name for r in store.books()["mst_ledger"].collect()] == ["x"]
    store.commit({"mst_ledger": ledger})
    assert store.forget(keep=1) == 2  # the refused writer's folder, and the first version's


def test_stream_equals_batch(spark, folder, tmp_path):
    """Files landed between runs, in pieces, give what one batch over all of them gives."""
    docs = voucher_documents(spark, folder).withColumns(
        {"alterid": F.col("alterid").cast("bigint"), "deleted": F.lit(False)})
    later = docs.where(F.col("vouchernumber").endswith("5")).withColumns(
        {"alterid": F.col("alterid") + 1_000_000, "deleted": F.col("vouchernumber").endswith("15")})
    landing, store = str(tmp_path / "landing"), Store(spark, str(tmp_path / "store"), 1, "year")
    for part in (docs.where("alterid % 2 = 0 and alterid < 700"), docs.where("alterid >= 700 or alterid % 2 = 1"), later):
        part = part.where("alterid >= 0")
        part.write.mode("append").parquet(landing)
    continuous.run(spark, landing, docs.schema, store, str(tmp_path / "cp")).awaitTermination()
    once = Store(spark, str(tmp_path / "once"), 1, "year")
    continuous.apply_changes(once, spark.read.schema(docs.schema).parquet(landing), 0)
    streamed, batch = store.books(), once.books()
    assert set(streamed) == {t.name for t in tables("transaction")}
    for name in ("trn_voucher", "trn_accounting", "trn_payhead"):
        same(streamed[name], batch[name])
    before = store.head()
    continuous.run(spark, landing, docs.schema, store, str(tmp_path / "cp")).awaitTermination()
    assert store.head() == before  # nothing landed, nothing written


def test_polling_stream(spark, folder, tmp_path):
    """The timed trigger applies what has landed and then waits."""
    docs = voucher_documents(spark, folder).where("vouchernumber = '5'").withColumns(
        {"alterid": F.col("alterid").cast("bigint"), "deleted": F.lit(False)})
    docs.write.parquet(str(tmp_path / "landing"))
    store = Store(spark, str(tmp_path / "store"), 1, "year")
    query = continuous.run(spark, str(tmp_path / "landing"), docs.schema, store, str(tmp_path / "cp"), every_minutes=1 / 60)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert store.books()["trn_voucher"].count() == 1


def test_keys_are_joined_only_where_digests_differ(spark, monkeypatch):
    """Removed, changed and new keys, and one without a guid, among many that stay."""
    before = spark.range(20000).selectExpr("if(id = 7, null, concat('g', id)) as guid", "id as alterid")
    after = (before.where("alterid not in (11, 12)")
             .selectExpr("guid", "if(alterid in (100, 2000), alterid + 1000000, alterid) as alterid")
             .unionByName(spark.sql("select 'new' as guid, 3000000L as alterid")).repartition(3))
    found = lambda f: {r.guid for r in f(before, after).collect()}
    functions = (S.deleted_keys, S.modified_keys, S.removed_keys)
    want = [found(f) for f in functions]
    assert want[1] == {"g100", "g2000"} and want[0] >= {"g11", "g12"}
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    assert [found(f) for f in functions] == want
    ours, theirs = S.suspects(before, after)
    assert {"g11", "g12", "g100", "g2000"} <= {r.guid for r in ours.collect()}
    assert ours.count() + theirs.count() < 40
    # what is shuffled by guid has met the digests before
    for side in S.removed_keys(before, after)._jdf.queryExecution().executedPlan().toString().split("hashpartitioning(guid")[1:]:
        assert "LeftSemi" in side.split("hashpartitioning(guid")[0]


def test_equal_sides_have_no_changed_leaves(spark):
    keys = spark.range(5000).selectExpr("concat('g', id % 4000) as guid", "id as alterid")
    assert S.changed_leaves(keys, keys.repartition(5)).isEmpty()
    assert S.changed_leaves(keys.limit(0), keys.limit(0)).isEmpty()
    assert S.changed_leaves(keys, keys.unionByName(keys.limit(1))).count() == 1


def _changes(spark):
    return spark.sql("""
      select * from values ('a', '20200401', 1L, false, 'old'), ('a', '20210401', 2L, false, 'new'), ('b', '20200501', 3L, false, 'b'),
        (null, '20200601', 4L, false, 'none'), (null, '20200601', 5L, false, 'none again'), ('c', '20200701', 6L, false, 'c'),
        ('c', '20200701', 6L, true, 'gone') as t(guid, date, alterid, deleted, narration)""").withColumn(
        "allledgerentries", F.expr("array(struct('Cash' as ledgername, '1' as amount), struct('Bank' as ledgername, '-1' as amount))"))


@pytest.mark.parametrize("rows_at_once", [0, 200_000])
def test_batch_lines_are_not_joined_to_headers(spark, tmp_path, monkeypatch, rows_at_once):
    """Lines have their document's month, repeats and objects without guid count once, nothing staged is left."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", rows_at_once)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    store, plans, commit = Store(spark, str(tmp_path), 1, "month"), [], Store.commit
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"

    def seen(self, tables, *args):
        plans.append(tables["trn_accounting"]._jdf.queryExecution().optimizedPlan().toString())
        return commit(self, tables, *args)

    monkeypatch.setattr(Store, "commit", seen)
    continuous.apply_changes(store, _changes(spark), 0)
    assert "Join" not in plans[0]
    lines = store.rows(store.head(), "trn_accounting", months=True)
    assert sorted(tuple(r) for r in lines.groupBy("guid", "_month").count().collect()) == [
        ("", 202006, 2), ("a", 202104, 2), ("b", 202005, 2)]
    assert {(r.guid, r.narration) for r in store.books()["trn_voucher"].collect()} == {("", "none again"), ("a", "new"), ("b", "b")}
    older = _changes(spark).where("guid in ('a', 'c')").withColumns({"alterid": F.lit(2), "narration": F.lit("late"), "deleted": F.lit(False)})
    continuous.apply_changes(store, older.unionByName(_changes(spark).where("guid = 'b'").withColumn("alterid", F.lit(9))), 1)
    assert {(r.guid, r.narration) for r in store.books()["trn_voucher"].collect()} == {
        ("", "none again"), ("a", "new"), ("b", "b")}
    assert store.books()["trn_accounting"].count() == 6 and not store._names("data")


def _voucher_changes(spark, rows):
    return spark.createDataFrame([(g, a, d, date, "old" if text is None else text) for g, a, d, date, text in rows],
                                 "guid string, alterid long, deleted boolean, date string, narration string")


def test_new_vouchers_are_added_beside_stored_parts(spark, tmp_path, monkeypatch):
    """Parts that only gain vouchers were rewritten whole, so that every batch read and wrote all of a year."""
    monkeypatch.setattr(continuous, "FOLDERS", 3)
    store = Store(spark, str(tmp_path), parts=1, by="year")
    want, year = {}, {}
    for batch in range(continuous.FOLDERS + 2):
        new = [(f"v{batch}-{i}", 10 * batch + i, False, f"{2001 + i}0401", None) for i in range(2)]
        before = dict(year)
        continuous.apply_changes(store, _voucher_changes(spark, new), batch)
        year = store.head().tables["trn_voucher"]["parts"]
        want |= {g: (a, t or "old") for g, a, _, _, t in new}
        if 0 < batch < continuous.FOLDERS:
            assert set(before.items()) <= set(year.items()) and len(year) == 2 * (batch + 1)
    assert len(year) == 4  # rewritten once, when there were too many folders, and added to after that
    # a change and a deletion rewrite the part they lie in, whatever folders it has
    last = [("v0-0", 900, False, "20010401", "new"), ("v4-0", 901, True, "20010401", None), ("v1-1", 902, False, "20010401", "moved")]
    continuous.apply_changes(store, _voucher_changes(spark, last), 99)
    want |= {"v0-0": (900, "new"), "v1-1": (902, "moved")}
    del want["v4-0"]
    found = [(r.guid, (r.date.year, r.narration)) for r in store.books()["trn_voucher"].collect()]
    assert sorted(g for g, _ in found) == sorted(want)
    assert dict(found)["v0-0"] == (2001, "new") and dict(found)["v1-1"] == (2001, "moved")
    assert sum(t == "old" for _, (_, t) in found) == len(want) - 2
    store.forget(1)
    assert store.books()["trn_voucher"].count() == len(want)


def test_many_repeats(spark, tmp_path, monkeypatch):
    """The last change of each object, found by keys; a deletion wins a tie, rows without guid are one object."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 3)
    store = Store(spark, str(tmp_path), parts=1, by="year")
    rows = [(f"v{i}", a, d, "20010401", f"{i}-{a}") for i in range(9) for a, d in ((1, False), (3, i % 3 == 0), (2, False), (3, False))]
    work = continuous.Batch(store, store.head(), {}, None)
    changes = _voucher_changes(spark, [*rows, (None, 5, False, "20010401", "x"), (None, 6, False, "20010401", "y"), ("w", None, False, "", "z")])
    seen, newest = [], continuous.newest
    monkeypatch.setattr(continuous, "newest", lambda df: seen.append(df.columns) or newest(df))
    found = {(r.guid, r.alterid, r.deleted, r.narration) for r in work.latest(changes.repartition(3)).collect()}
    work.close()
    assert found == {(f"v{i}", 3, i % 3 == 0, f"{i}-3") for i in range(9)} | {(None, 6, False, "y"), ("w", None, False, "z")}
    assert not seen  # documents are not aggregated


def test_tables_read_their_fields_and_new_rows_are_not_shuffled(spark, folder, tmp_path, monkeypatch):
    """Every table read whole documents, and its rows were shuffled by part before they were written."""
    docs = voucher_documents(spark, folder).withColumns({"alterid": F.col("alterid").cast("bigint"), "deleted": F.lit(False)})
    plans, write = {}, store_module.full_refresh

    def seen(df, path, *args):
        plans[path.split("/")[-1]] = df._jdf.queryExecution().optimizedPlan().toString(), [f.name for f in _leaf_fields(df)]
        return write(df, path, *args)

    monkeypatch.setattr(store_module, "full_refresh", seen)
    few = Store(spark, str(tmp_path / "few"), 1, "year")
    continuous.apply_changes(few, docs.where("alterid <= 700"), 0)
    continuous.apply_changes(few, docs.where("alterid > 700"), 1)
    lines = [n for n in plans if n.startswith("trn_")]
    assert len(lines) == len(tables("transaction")) and not any("Rebalance" in plans[n][0] for n in lines)
    assert not any("PythonRDD" in p or "LogicalRDD" in p for p, _ in plans.values())
    assert "bankallocations" not in plans["trn_accounting"][1] and "bankallocations" in plans["trn_bank"][1]
    monkeypatch.setattr(store_module, "FILES", 0)  # many parts: rows are gathered, whole documents give the same
    monkeypatch.setattr(continuous, "fields_read", lambda schema, *args: schema)
    many = Store(spark, str(tmp_path / "many"), 1, "year")
    continuous.apply_changes(many, docs, 0)
    assert all("Rebalance" in plans[n][0] for n in ("trn_voucher", "trn_accounting"))
    for table in tables("transaction"):
        same(few.books()[table.name], many.books()[table.name])


def _leaf_fields(df):
    """The fields of the entries of lists that a plan reads."""
    leaves, found = df._jdf.queryExecution().optimizedPlan().collectLeaves(), []
    for i in range(leaves.size()):
        fields = T.StructType.fromJson(json.loads(leaves.apply(i).schema().json())).fields
        for f in fields:
            found += f.dataType.elementType.fields if isinstance(f.dataType, T.ArrayType) else []
    return found


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_marked_rows(spark, tmp_path, monkeypatch, limit):
    """Documents that count are picked by one bit each, or by a join where the bits are too many."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    work = continuous.Batch(Store(spark, str(tmp_path), 1, "year"), None, {}, None)
    ids = spark.range(0, 100_000, 1, 3).selectExpr("if(id < 50000, id, id + (1L << 33)) as _row", "id")
    kept = ids.where("id % 7 in (0, 3) or id in (1, 32768, 32769, 65537)")
    got = work.marked(ids, kept.select("_row"))
    assert got.columns == ids.columns and ("_row" in got._jdf.queryExecution().analyzed().toString())
    same(got, kept)
    work.close()


def test_first_load_carries_months(spark, folder, tmp_path):
    """Lines were joined to headers for their month; that gives the same, also where headers share a guid."""
    docs = voucher_documents(spark, folder).where("vouchernumber < 300")
    twice = docs.unionByName(docs.where("vouchernumber like '%3'")).unionByName(
        docs.where("vouchernumber like '%4'").withColumn("date", F.lit("20300101")))
    names = docs.selectExpr("partyledgername as name").distinct().selectExpr("name", "concat('L:', name) as guid")
    party = names.where("name like 'Customer%'").limit(1)
    for i, (given, ledgers) in enumerate(((docs, None), (twice, None), (docs, names.unionByName(party)))):
        store = Store(spark, str(tmp_path / f"store{i}"), 1, "year")
        masters = None if ledgers is None else {"mst_ledger": spark.createDataFrame(ledgers.collect(), ledgers.schema)}
        found, few = ingest.flattened(store, given, str(tmp_path / f"docs{i}"), masters)
        assert bool(few) == (i == 0)
        joined = store.placed({t.name: ingest.flatten(given, t, masters=masters) for t in tables("transaction")})
        for name in ("trn_voucher", "trn_accounting", "trn_payhead"):
            same(found[name], joined[name])
            assert i or "Join" not in found[name]._jdf.queryExecution().optimizedPlan().toString()
    store.commit({"trn_accounting": found["trn_accounting"]}, ungathered=few)
    same(store.books()["trn_accounting"], joined["trn_accounting"].drop("_month"))
