"""Incremental sync: two states of a source to the next snapshot of the tables.

Order of phases: detect, delete, cascade the delete, append, carry renamed masters over,
renumber. Each is a function of DataFrames; ``synced`` composes them lazily, so a table is
read and written once per run whatever happens to it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.lookup import is_small, lookup
from daybook.plans.books import Books
from daybook.plans.months import MONTH
from daybook.plans.sinks import STATE_MASTER, STATE_SYNCED, STATE_TRANSACTION
from daybook.plans.store import Store
from daybook.schema import LINKS, TABLES, tables
from daybook.session import scratch

# Rows that go with a removed master, as (table, column holding its guid).
# Everything below a voucher goes with the voucher.
_CASCADE_DELETE = {
    "mst_ledger": [
        ("mst_opening_bill_allocation", "_ledger"),
        ("trn_closingstock_ledger", "_ledger"),
    ],
    "mst_stock_item": [
        ("mst_gst_effective_rate", "_item"),
        ("mst_opening_batch_allocation", "_item"),
        ("mst_stockitem_standard_cost", "_item"),
        ("mst_stockitem_standard_price", "_item"),
    ],
    "trn_voucher": [(t.name, "guid") for t in tables("transaction", "Derived")],
}
CASCADE_DELETE: list[tuple[str, str, str]] = [
    (parent, table, column) for parent, targets in _CASCADE_DELETE.items() for table, column in targets]

KEYS = ("guid", "alterid")
#: Groups that keys are compared in before they are joined.
LEAVES = 1 << 16


def watermark(config: DataFrame, name: str) -> DataFrame:
    """The last synchronised change number of one half, 0 before the first run."""
    return config.where(F.col("name") == name).agg(
        F.coalesce(F.max(F.col("value").try_cast("bigint")), F.lit(0)).cast("bigint").alias("last"))


@dataclass(frozen=True)
class Gate:
    """Which halves of the source changed since the last run."""

    master: bool
    transaction: bool
    restored: bool  # the source went back to an older state: only a full refresh is right

    @property
    def any(self) -> bool:
        return self.master or self.transaction


def gate(last: Mapping[str, int], source: Mapping[str, int]) -> Gate:
    """Compare the last synchronised and the source's change numbers of both halves."""
    return Gate(source["master"] != last["master"], source["transaction"] != last["transaction"],
                any(source[half] < last[half] for half in ("master", "transaction")))


def _leaf() -> Column:
    return F.pmod(F.xxhash64("guid"), F.lit(LEAVES)).cast("int").alias("_leaf")


def _signed(keys: DataFrame, sign: int) -> DataFrame:
    digest = F.xxhash64(*keys.columns)
    return keys.select(
        _leaf(), F.lit(sign).alias("n"), (F.shiftright(digest, 32) * sign).alias("high"),
        (digest.bitwiseAND(F.lit(0xFFFFFFFF)) * sign).alias("low"), F.col("guid").isNull().alias("odd"))


def changed_leaves(current: DataFrame, source: DataFrame) -> DataFrame:
    """The groups of keys that are not the same on both sides, at most ``LEAVES`` numbers.

    Groups are formed by a hash of ``guid``. Their counts and sums of 64-bit digests over all columns
    do not depend on the order of rows and are combined before the shuffle, so no key is shuffled. A
    group with keys missing altogether counts as changed.
    """
    sides = _signed(current, 1).unionByName(_signed(source, -1))
    return sides.groupBy("_leaf").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")], F.max("odd").alias("odd")).where(
        "n <> 0 or high <> 0 or low <> 0 or odd").select("_leaf")


def suspects(current: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys of both sides, cut down to the groups that differ, where the source's are too many to broadcast."""
    if is_small(source):
        return current, source
    leaves = F.broadcast(changed_leaves(current, source))
    cut = [df.withColumn("_leaf", _leaf()).join(leaves, "_leaf", "left_semi").drop("_leaf") for df in (current, source)]
    return cut[0], cut[1]


def deleted_keys(current: DataFrame, source: DataFrame) -> DataFrame:
    """Keys of rows that the source no longer has."""
    ours, theirs = suspects(current.select("guid"), source.select("guid"))
    return lookup(ours, theirs, "guid", "left_anti", unique=True)


def _with_source(current: DataFrame, source: DataFrame, how: str) -> DataFrame:
    theirs = source.select("guid", F.col("alterid").alias("_source_alterid"),
                           F.lit(True).alias("_in_source"))
    return lookup(current, theirs, "guid", how, unique=True)


def _modified() -> Column:
    return F.coalesce(F.col("alterid") != F.col("_source_alterid"), F.lit(False))


def modified_keys(current: DataFrame, source: DataFrame) -> DataFrame:
    """Keys of rows whose change number differs in the source."""
    return _with_source(*suspects(current.select(*KEYS), source.select(*KEYS)), "inner").where(_modified()).select("guid")


def removed_keys(current: DataFrame, source: DataFrame) -> DataFrame:
    """Deleted and modified keys, in one pass; modified rows come back with the append."""
    compared = _with_source(*suspects(current.select(*KEYS), source.select(*KEYS)), "left")
    return compared.where(F.col("_in_source").isNull() | _modified()).select("guid")


def kept_rows(current: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of a Primary table that the source still has, unchanged."""
    compared = _with_source(current, source, "inner")
    return compared.where(~_modified()).select(*current.columns)


def without(df: DataFrame, removed: DataFrame, column: str = "guid",
            keys_from: DataFrame | None = None) -> DataFrame:
    """Rows whose ``column`` is not among the removed keys."""
    keys = removed.select(F.col("guid").alias(column))
    return lookup(df, keys, column, "left_anti", measure=True,
                  keys_from=None if keys_from is None else keys_from.select(column))


def appended(df: DataFrame, delta: DataFrame) -> DataFrame:
    return df.unionByName(delta)


def renamed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Guid and new name of masters whose name changed."""
    old = before.select("guid", F.col("name").alias("_old_name"))
    return lookup(after.select("guid", "name"), old, "guid", unique=True).where(
        ~F.col("name").eqNullSafe(F.col("_old_name"))).select("guid", "name")


def with_names(df: DataFrame, column: str, names: DataFrame,
               keys_from: DataFrame | None = None) -> DataFrame:
    """Set ``column`` to the name of the master whose guid is in ``_column``, where known."""
    key = f"_{column}"
    new = names.select(F.col("guid").alias(key), F.col("name").alias("_new_name"))
    order = df.columns
    return lookup(df, new, key, "left", measure=True,
                  keys_from=None if keys_from is None else keys_from.select(key)).withColumn(
        column, F.coalesce("_new_name", column)).select(*order)


def renumbered(vouchers: DataFrame, fresh: DataFrame) -> DataFrame:
    """Take over the numbers of automatically numbered vouchers.

    Inserting a voucher shifts the numbers of those after it without changing them otherwise.
    """
    numbers = fresh.select("guid", F.col("voucher_number").alias("_fresh"))
    order = vouchers.columns
    return lookup(vouchers, numbers, "guid", "left", unique=True).withColumn(
        "voucher_number", F.coalesce("_fresh", "voucher_number")).select(*order)


def automatic_numbers(vouchers: DataFrame, voucher_types: DataFrame) -> DataFrame:
    """Guid and number of the source's vouchers whose type is numbered automatically."""
    types = voucher_types.where(F.col("numbering_method").contains("Auto")).select(
        F.col("name").alias("voucher_type"))
    return lookup(vouchers, types, "voucher_type", "left_semi", measure=True).select(
        "guid", "voucher_number")


def synced(current: Books, source: Mapping[str, DataFrame], delta: Books,
           numbers: DataFrame | None = None, changed: Gate | None = None,
           party_names: bool = False, repair_names: bool = False,
           stage: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> Books:
    """The tables after one run, in the incremental schema.

    ``source`` maps Primary tables to all their keys and change numbers, ``delta`` holds the
    rows changed since the watermark, ``numbers`` the numbers of automatically numbered
    vouchers. A half that did not change, and any table no phase touches, is passed through.

    Names are carried over for masters renamed in this run; ``repair_names`` re-reads the
    names of all masters. ``party_names`` also carries them into voucher headers.

    Removed keys and renamed masters are needed by many tables; ``stage`` may store them.
    """
    changed = changed or Gate(True, True, False)
    active = {"master": changed.master, "transaction": changed.transaction}
    primary = {t.name for t in tables(nature="Primary")
               if active[t.half] and t.name in source and t.name in current}

    @cache
    def removed(parent: str) -> DataFrame:
        return stage(f"removed-{parent}", removed_keys(current[parent], source[parent]))

    @cache
    def reloaded(name: str) -> DataFrame:
        """The table after delete, cascaded delete and append."""
        df = current[name]
        if name in primary:
            df = kept_rows(df, source[name])
        for parent, target, column in CASCADE_DELETE:
            if target == name and parent in primary:
                df = without(df, removed(parent), column, current[name])
        if active[TABLES[name].half] and name in delta:
            df = appended(df, delta[name])
        return df

    @cache
    def names_of(master: str) -> DataFrame:
        if repair_names:
            return reloaded(master).select("guid", "name")
        return stage(f"renamed-{master}", renamed(current[master], reloaded(master)))

    def result(name: str) -> DataFrame:
        df = reloaded(name)
        for link in LINKS if changed.master else []:
            carried = link.renames or (party_names and link.column == "party_name")
            if link.table == name and carried and link.master in primary:
                df = with_names(df, link.column, names_of(link.master), current[name])
        if name == "trn_voucher" and changed.transaction and numbers is not None:
            df = renumbered(df, numbers)
        return df

    def lazily(name: str):
        return lambda: result(name)

    return Books(current.spark, {n: lazily(n) for n in current if n in TABLES})


def touched(current: Books, changed: Gate) -> set[str]:
    """Tables a run may alter: those of a changed half and those naming a changed master."""
    halves = {h for h, on in (("master", changed.master), ("transaction", changed.transaction)) if on}
    names = {t.name for t in TABLES.values() if t.half in halves}
    if changed.master:
        names |= {link.table for link in LINKS}
    return {n for n in names if n in current}


def _changed_vouchers(current: Books, source: Mapping[str, DataFrame], delta: Books, changed: Gate,
                      numbers: DataFrame | None, stage: Callable[[str, DataFrame], DataFrame],
                      party_names: bool, repair_names: bool) -> DataFrame | None:
    """Guid and month, old and new, of the vouchers a run alters, with repeats; None if there are none."""
    found = []
    if changed.transaction and "trn_voucher" in current:
        heads = current["trn_voucher"].select("guid", "voucher_number", MONTH)
        if "trn_voucher" in source:
            gone = stage("removed-trn_voucher", removed_keys(current["trn_voucher"], source["trn_voucher"]))
            found.append(lookup(heads, gone, "guid", "left_semi", measure=True, keys_from=gone))
        if numbers is not None:
            fresh = numbers.select("guid", F.col("voucher_number").alias("_fresh"))
            found.append(lookup(heads, fresh, "guid", unique=True)
                         .where(~F.col("voucher_number").eqNullSafe(F.col("_fresh"))))
    if changed.transaction and "trn_voucher" in delta:
        found.append(delta["trn_voucher"])
    for link in LINKS if changed.master else []:
        table = TABLES[link.table]
        carried = link.renames or (party_names and link.column == "party_name")
        if not (carried and table.half == "transaction" and link.table in current
                and link.master in source and link.master in current and link.master in delta):
            continue
        rows = current[link.table].select("guid", link.key, MONTH)
        if not repair_names:
            names = stage(f"renamed-{link.master}", renamed(
                current[link.master], appended(kept_rows(current[link.master], source[link.master]), delta[link.master])))
            if names.isEmpty():  # nothing to carry: the table is not even read
                continue
            rows = lookup(rows, names.select(F.col("guid").alias(link.key)), link.key, "left_semi", measure=True)
        found.append(rows)
    if not found:
        return None
    every = found[0].select("guid", MONTH)
    for df in found[1:]:
        every = every.unionByName(df.select("guid", MONTH))
    return every


def _refuse_lines_without_header(delta: Books) -> None:
    """Lines come with their voucher; without it nobody could tell which of its rows they replace."""
    lines = [delta[t.name].select("guid") for t in tables("transaction", "Derived") if t.name in delta]
    if not lines:
        return
    every = lines[0]
    for df in lines[1:]:
        every = every.unionByName(df)
    if "trn_voucher" in delta:
        every = every.join(delta["trn_voucher"].select("guid"), "guid", "left_anti")
    if not every.isEmpty():
        raise ValueError("the change set has lines of vouchers that it does not have itself")


def run(store: Store, source: Mapping[str, DataFrame], delta: Books, source_state: Mapping[str, int],
        numbers: DataFrame | None = None, party_names: bool = False, repair_names: bool = False) -> dict[str, int]:
    """One incremental run against the stored tables; rows per table written.

    Nothing is written when the source's change numbers are those of the last run. Of the
    transaction tables only the parts are rewritten that hold a voucher the run alters or that one
    moves to; a master change without a rename alters none. Keys shared by many tables are stored in
    scratch space first. The new change numbers become visible together with the tables, so a run
    that fails is simply repeated. The number of the transaction half moves only in a run that
    compared the vouchers with the source, or found that half unchanged.
    """
    names = {"master": STATE_MASTER, "transaction": STATE_TRANSACTION}
    head = store.head()
    changed = gate({half: int(head.state.get(name, 0)) for half, name in names.items()}, source_state)
    if not changed.any:
        return {}
    if changed.restored:
        raise ValueError("the source was restored to an older state: reload it in full")
    folder, staged = scratch(store.spark, "sync"), {}

    def stage(name: str, df: DataFrame) -> DataFrame:
        if name not in staged:
            df.write.parquet(f"{folder}/{name}")
            staged[name] = store.spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        return staged[name]

    whole = store.books(head, months=True)
    _refuse_lines_without_header(delta)
    delta = Books(store.spark, store.placed({n: delta[n] for n in delta}))
    vouchers = _changed_vouchers(whole, source, delta, changed, numbers, stage, party_names, repair_names)
    parts = store.parts_of(vouchers) if vouchers is not None else set()
    altered = touched(whole, changed)
    lines = {n for n in altered if TABLES[n].half == "transaction" and "guid" in store.columns(head, n)}
    compared = changed.transaction and "trn_voucher" in source
    if "trn_voucher" in source:
        buckets = {int(p.split("-")[1]) for p in parts}
        source = {**source, "trn_voucher": source["trn_voucher"].where(
            store.bucket().isin(*buckets) if buckets else F.lit(False))}
    after = synced(store.books(head, parts, months=True), source, delta, numbers, changed, party_names, repair_names, stage)
    state = {STATE_MASTER: str(source_state["master"])}
    if compared or not changed.transaction:
        state[STATE_TRANSACTION] = str(source_state["transaction"])
    if compared:
        state[STATE_SYNCED] = state[STATE_TRANSACTION]
    rows = store.commit({n: after[n] for n in sorted(altered - (set() if parts else lines))}, state, parts, head)
    return {**{n: 0 for n in lines}, **rows}
