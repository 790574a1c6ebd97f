"""Incremental sync between two states derived from the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.oracle_books import with_books
from daybook.plans import sync as S
from daybook.plans.books import Books
from daybook.plans.ingest import with_master_guids
from daybook.plans.sinks import STATE_TRANSACTION
from daybook.schema import TABLES
from daybook.sources import scan
from checks.testbed import Testbed
from checks.testbed_changes import two_states


def _states(fn):
    return lambda spark, folder: fn(*two_states(spark, folder))


def _watermark(spark, folder):
    """The run state is the one a first run over the orders leaves behind."""
    before, _ = two_states(spark, folder)
    last = before.vouchers().agg(F.max("alterid").cast("string").alias("value"))
    return S.watermark(last.withColumn("name", F.lit(STATE_TRANSACTION)), STATE_TRANSACTION)


def _gate(spark, folder):
    before, after = two_states(spark, folder)

    def top(df):
        return df.agg(F.max("alterid")).first()[0]

    g = S.gate({"master": top(before.ledgers()), "transaction": top(before.vouchers())},
               {"master": top(after.ledgers()), "transaction": top(after.vouchers())})
    return spark.range(1).select(F.lit(g.master).alias("master_changed"),
                                 F.lit(g.transaction).alias("transaction_changed"),
                                 F.lit(g.restored).alias("restored"))


def _synced(table, columns, **kw):
    def run(spark, folder):
        before, after = two_states(spark, folder)
        state = after.state()
        source = {t: scan.versions(state[t]) for t in ("mst_ledger", "mst_vouchertype", "trn_voucher")}
        numbers = S.automatic_numbers(state["trn_voucher"], state["mst_vouchertype"])
        return S.synced(before.state(), source, after.delta(), numbers, **kw)[table].select(*columns)
    return run


_V = ["guid", "alterid", "voucher_number", "party_name", "_party_name"]
_A = ["guid", "ledger", "_ledger", "amount"]


def _removed(b, a):
    return S.removed_keys(b.vouchers(), scan.versions(a.vouchers()))


def _cost_centre_parents(spark, folder):
    """Regions as cost centres above nations; one region is renamed."""
    bed = Testbed(spark, folder)
    region = bed.source("region").select(F.concat(F.lit("R"), "r_regionkey").alias("guid"), F.col("r_name").alias("name"),
                                         F.lit("").alias("parent"))
    nation = bed.source("nation").join(bed.source("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("N"), "n_nationkey").alias("guid"), F.col("n_name").alias("name"), F.col("r_name").alias("parent"))
    before = with_master_guids(region.unionByName(nation).withColumn("alterid", F.lit(1)), TABLES["mst_cost_centre"],
                               {"mst_cost_centre": region.unionByName(nation)})
    asia = (F.col("name") == "ASIA")
    after = before.withColumn("alterid", F.when(asia, 2).otherwise(1)).withColumn(
        "name", F.when(asia, "ASIA Ltd").otherwise(F.col("name")))
    books = Books(spark, {"mst_cost_centre": before})
    return S.synced(books, {"mst_cost_centre": scan.versions(after)}, Books(spark, {"mst_cost_centre": after.where("alterid = 2")}))[
        "mst_cost_centre"].select("guid", "name", "parent", "_parent")


QUERIES = {
    "c8_cost_centre_parents": _cost_centre_parents,
    "s10_versions": _states(lambda b, a: scan.versions(a.vouchers())),
    "s11_changed_after": _states(lambda b, a: a.delta()["trn_voucher"].select("guid", "alterid")),
    "c1_watermark": _watermark,
    "c2_gate": _gate,
    "c3_deleted_keys": _states(lambda b, a: S.deleted_keys(b.vouchers(), a.vouchers())),
    "c4_modified_keys": _states(lambda b, a: S.modified_keys(b.vouchers(), a.vouchers())),
    "c5_without_removed": _states(
        lambda b, a: S.without(b.vouchers(), _removed(b, a)).select("guid", "alterid")),
    "c6_cascade_delete": _states(
        lambda b, a: S.without(b.accounting(), _removed(b, a)).select(*_A)),
    "c6_cascade_delete_master": _states(lambda b, a: S.without(
        b.opening_bills(), S.removed_keys(b.ledgers(), a.ledgers()), "_ledger").select("ledger", "name")),
    "c7_append": _states(lambda b, a: S.appended(
        S.without(b.vouchers(), _removed(b, a)), a.delta()["trn_voucher"]).select("guid", "alterid")),
    "c8_cascade_rename": _states(lambda b, a: S.with_names(
        b.state()["trn_accounting"], "ledger", S.renamed(b.ledgers(), a.ledgers())).select(*_A)),
    "c8_repair_names": _states(lambda b, a: S.with_names(
        b.state()["trn_accounting"], "ledger", a.ledgers()).select(*_A)),
    "c9_renumber": _states(lambda b, a: S.renumbered(
        b.vouchers(), S.automatic_numbers(a.vouchers(), a.voucher_types())).select("guid", "voucher_number")),
    "c_synced_trn_voucher": _synced("trn_voucher", _V),
    "c_synced_trn_voucher_party_names": _synced("trn_voucher", _V, party_names=True),
    "c_synced_trn_accounting": _synced("trn_accounting", _A),
    "c_synced_mst_ledger": _synced("mst_ledger", ["guid", "alterid", "name"]),
    "c_synced_opening_bills": _synced("mst_opening_bill_allocation", ["ledger", "_ledger", "name"]),
}

_NEW = "case when {0} like 'Customer#%3' then {0} || ' Ltd' else {0} end"
_CHG = {
    "chg": """
      select *, o_orderpriority = '1-URGENT' and o_orderstatus = 'P' as edited,
        date >= date '2001-01-01' as fresh, o_orderpriority = '5-LOW' and o_orderstatus = 'F' as gone,
        case when m <> 7 and date >= date '1998-01-01' then k + 1 else k end as num,
        (select count(*) from orders) as n from ord""",
    "entry": """
      select *, case when m = 7 then 'Bank' else party end as led, 1 as e,
        case when m in (2, 3, 5) then 1 else -1 end as sgn from chg
      union all select *, case when m in (3, 4) then 'Purchase' when m in (5, 6, 7) then 'Cash' else 'Sales' end,
        2, case when m in (2, 3, 5) then -1 else 1 end from chg""",
    "ledver": f"""
      select guid, name, {_NEW.format("name")} as new_name, gstn,
        coalesce(try_cast(regexp_extract(name, '([0-9]*)$', 1) as bigint), 0) + 1 as alt,
        (select count(*) from orders) as n from mst_ledger""",
}


def _sql(q):
    return with_books(q, _CHG)


_AFTER_ALT = "case when edited or fresh then k + 1 + n else k + 1 end"
_OLD_AMT = "cast(sgn * (amt + case when edited then 1 else 0 end) as decimal(17,2))"
_NEW_AMT = "cast(sgn * amt as decimal(17,2))"


def _voucher_after(party):
    return _sql(f"""
      select guid, {_AFTER_ALT} as alterid,
        (case when m <> 7 or edited or fresh then num else k end)::varchar as voucher_number,
        {party} as party_name, 'L:' || party as _party_name from chg where not gone""")


ORACLE = {
    "s10_versions": _sql(f"select guid, {_AFTER_ALT} as alterid from chg where not gone"),
    "s11_changed_after": _sql(
        "select guid, k + 1 + n as alterid from chg where not gone and (edited or fresh)"),
    "c1_watermark": _sql("select max(k + 1) as last from chg where not fresh"),
    "c2_gate": _sql(f"""
      select (select max(alt + case when name <> new_name then n else 0 end) > max(alt) from ledver) as master_changed,
        (select max({_AFTER_ALT}) filter (not gone) <> max(k + 1) filter (not fresh) from chg) as transaction_changed,
        (select max({_AFTER_ALT}) filter (not gone) < max(k + 1) filter (not fresh) from chg) as restored"""),
    "c8_cost_centre_parents": """
      select 'R' || r_regionkey as guid, r_name || case when r_name = 'ASIA' then ' Ltd' else '' end as name,
        '' as parent, '' as _parent from region
      union all select 'N' || n_nationkey, n_name, r_name || case when r_name = 'ASIA' then ' Ltd' else '' end,
        'R' || r_regionkey from nation join region on n_regionkey = r_regionkey""",
    "c3_deleted_keys": _sql("select guid from chg where gone and not fresh"),
    "c4_modified_keys": _sql("select guid from chg where edited and not gone and not fresh"),
    "c5_without_removed": _sql(
        "select guid, k + 1 as alterid from chg where not fresh and not gone and not edited"),
    "c6_cascade_delete": _sql(f"""select guid, led as ledger, 'L:' || led as _ledger, {_OLD_AMT} as amount
      from entry where not fresh and not gone and not edited"""),
    "c6_cascade_delete_master": """
      select c_name as ledger, 'OB' || c_custkey as name from customer where c_name not like '%3'""",
    "c7_append": _sql(f"select guid, {_AFTER_ALT} as alterid from chg where not gone"),
    "c8_cascade_rename": _sql(f"""
      select guid, {_NEW.format("led")} as ledger, 'L:' || led as _ledger, {_OLD_AMT} as amount
      from entry where not fresh"""),
    "c9_renumber": _sql("""
      select guid, (case when gone then k else num end)::varchar as voucher_number from chg where not fresh"""),
    "c_synced_trn_voucher": _voucher_after(
        f"case when edited or fresh then {_NEW.format('party')} else party end"),
    "c_synced_trn_voucher_party_names": _voucher_after(_NEW.format("party")),
    "c_synced_trn_accounting": _sql(f"""
      select guid, {_NEW.format("led")} as ledger, 'L:' || led as _ledger, {_NEW_AMT} as amount
      from entry where not gone"""),
    "c_synced_mst_ledger": _sql("""
      select guid, case when name <> new_name then alt + n else alt end as alterid, new_name as name from ledver"""),
    "c_synced_opening_bills": f"""
      select {_NEW.format("c_name")} as ledger, 'L:' || c_name as _ledger, 'OB' || c_custkey as name from customer""",
}
ORACLE["c8_repair_names"] = ORACLE["c8_cascade_rename"]
