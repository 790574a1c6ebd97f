"""Continuous operation: changes landed as files, applied micro-batch by micro-batch.

A change is a document with ``guid``, ``alterid`` and ``deleted``; what is deleted needs no more
than its guid. Changes of one collection come as its documents. A stream of several collections has
``collection``, ``guid``, ``alterid``, ``deleted`` and one struct per collection with its document;
the collection ``number`` gives vouchers a new ``voucher_number`` without changing them otherwise.

The stream's checkpoint remembers which files were read; the store remembers which batch was
applied, so a batch that is delivered again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daybook.operators.hierarchy import members
from daybook.operators import lookup as joins
from daybook.operators.lookup import lookup
from daybook.plans.ingest import STOCK_GROUP, dated, fields_read, flatten, with_base_types
from daybook.plans.months import MONTH
from daybook.plans.sinks import STATE_SYNCED, STATE_TRANSACTION
from daybook.plans.store import Store, Version
from daybook.plans.sync import CASCADE_DELETE, appended, renamed, renumbered, with_names, without
from daybook.schema import LINKS, TABLES, Table, tables

DELETED = "_deleted_voucher"
NUMBERS = "number"
#: A part in so many folders is rewritten when rows are added to it.
FOLDERS = 8
_ROW = "_row"
#: Of Spark's bitmaps.
BITMAP_BYTES = 4096


def newest(changes: DataFrame) -> DataFrame:
    """The last change of every object; a deletion wins a tie."""
    latest = F.max_by(F.struct(*[F.col(c) for c in changes.columns]),
                      F.struct("alterid", "deleted"))
    return changes.groupBy(F.col("guid").alias("_guid")).agg(latest.alias("c")).select("c.*")


def routed(changes: DataFrame) -> dict[str, DataFrame]:
    """The changes of each collection as documents with ``guid``, ``alterid`` and ``deleted``."""
    if "collection" not in changes.columns:
        return {"voucher": changes}
    common = ["guid", "alterid", "deleted"]
    out = {}
    for field in changes.schema.fields:
        if isinstance(field.dataType, T.StructType):
            inner = [F.col(f"`{field.name}`.`{f}`").alias(f) for f in field.dataType.names if f not in common]
            out[field.name] = changes.where(F.col("collection") == field.name).select(*common, *inner)
    return out


def _newer(latest: DataFrame, stored: list[DataFrame | None], synced: int) -> DataFrame:
    """Changes that are newer than what is stored of the same object, with its month if it has one.

    ``stored`` holds objects and remembered deletions. An object that is not known at all is taken,
    unless a sync run has seen a state of the source that includes the change: then it is no longer
    there.
    """
    none = F.lit(None).cast("int").alias(MONTH)
    known = None
    for df in (d for d in stored if d is not None):
        keys = df.select("guid", F.col("alterid").alias("_known"), MONTH if MONTH in df.columns else none)
        keys = lookup(keys, latest.select("guid"), "guid", "left_semi", measure=True, unique=True)
        known = keys if known is None else known.unionByName(keys)
    if known is None:
        return latest.where(F.col("alterid") > synced).withColumn(MONTH, none)
    known = known.groupBy("guid").agg(F.max("_known").alias("_known"), F.max(MONTH).alias(MONTH))
    return lookup(latest, known, "guid", "left", unique=True).where(
        F.col("alterid") > F.coalesce("_known", F.lit(synced))).drop("_known")


class Batch:
    """One micro-batch against the stored tables."""

    def __init__(self, store: Store, head: Version, routes: Mapping[str, DataFrame], voucher_types: DataFrame | None):
        self.store, self.head, self.routes = store, head, routes
        self.result: dict[str, DataFrame] = {}
        self.renames: dict[str, DataFrame] = {}
        self.accepted: list[DataFrame] = []  # guid, alterid and deleted of the changes that count
        self.held: list[DataFrame] = []
        self.folder = f"data/batch-{uuid.uuid4().hex}"  # of documents that several tables are read from
        self.place: str | None = None  # where the last documents were stored
        self.ungathered: set[str] = set()  # tables with few parts and no stored rows
        self.types = voucher_types
        self.top = 0

    def hold(self, df: DataFrame) -> DataFrame:
        self.held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once; each table then reads the fields it needs. Untyped columns cannot be written."""
        if "void" in df.schema.simpleString():
            self.place = None
            return self.hold(df)
        self.place = f"{self.store.folder}/{self.folder}/{name}"
        df.write.parquet(self.place)
        return self.store.spark.read.schema(df.schema).parquet(self.place)

    def only(self, docs: DataFrame, table: Table) -> DataFrame:
        """The documents that were stored last, ``docs``, with what a table reads of them."""
        if self.place is None:
            return docs
        schema = fields_read(docs.schema, table, ["guid", "deleted", "vouchertypename", MONTH])
        return self.store.spark.read.schema(schema).parquet(self.place)

    def latest(self, changes: DataFrame) -> DataFrame:
        """The last change of every object.

        A batch of a stream comes as whole rows, so it is stored before its keys are read. These tell which
        objects changed more than once. Where they are many, the stored rows that count are marked by one bit
        each, and documents are copied without a shuffle; only for more bits than may be broadcast they are
        shuffled, once and unsorted, by the number of the row.
        """
        untyped = "void" in changes.schema.simpleString()
        # the month is read from the date once, not again by every table
        numbered = self.stage("changes", changes if untyped else dated(changes, self.store.by).withColumn(
            _ROW, F.monotonically_increasing_id()))
        changes = numbered.drop(_ROW)
        several = self.hold(changes.groupBy(F.col("guid").alias("_guid")).count().where("count > 1").select("_guid"))
        repeated = several.count()
        if repeated == 0:
            return changes
        if repeated > joins.BROADCAST_ROWS:
            if untyped:
                return self.hold(newest(changes))
            last = numbered.groupBy("guid").agg(F.max_by(_ROW, F.struct("alterid", "deleted")).alias(_ROW)).select(_ROW)
            return self.stage("latest", self.marked(numbered, last).drop(_ROW))
        several, same = F.broadcast(several), F.col("guid").eqNullSafe(F.col("_guid"))
        return self.stage("latest", changes.join(several, same, "left_anti").unionByName(
            newest(changes.join(several, same, "left_semi"))))

    def marked(self, numbered: DataFrame, rows: DataFrame) -> DataFrame:
        """The documents with the numbers ``rows``, each of which comes once."""
        bits = self.hold(rows.groupBy(F.bitmap_bucket_number(_ROW).alias("_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(_ROW)).alias("_bits")))
        if not joins.fits(bits, joins.BROADCAST_BYTES // BITMAP_BYTES):
            return numbered.join(rows.hint("shuffle_hash"), _ROW, "left_semi")
        place = F.bitmap_bit_position(_ROW)
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        bit = F.getbit(byte, (place % 8).cast("int"))
        return numbered.withColumn("_bucket", F.bitmap_bucket_number(_ROW)).join(F.broadcast(bits), "_bucket").where(
            bit == 1).select(*numbered.columns)

    def accepted_of(self, latest: DataFrame, keys: DataFrame, count: int) -> DataFrame:
        """The documents of ``latest`` with the given keys; all of them are read from where they are."""
        if count == latest.count():
            return latest
        keys = keys.select(F.col("guid").alias("_guid"))
        keys = F.broadcast(keys) if count <= joins.BROADCAST_ROWS else keys
        return self.stage("accepted", latest.join(keys, F.col("guid").eqNullSafe(F.col("_guid")), "left_semi"))

    def close(self) -> None:
        for df in self.held:
            df.unpersist()
        self.store.drop(self.folder)

    def table(self, name: str) -> DataFrame | None:
        """A master table as this batch leaves it, or as it is stored."""
        return self.result[name] if name in self.result else self.store.rows(self.head, name)

    def deletions(self, keys: DataFrame) -> DataFrame | None:
        return self.store.rows(self.head, DELETED, self.store.undated_parts(keys))

    def names(self) -> dict[str, DataFrame]:
        """Masters by name for new rows: also by the old names of those this batch renames."""
        out = {}
        for master in {link.master for link in LINKS}:
            now = self.table(master)
            if now is None:
                continue
            now = now.select("name", "guid")
            if master in self.renames:
                old = lookup(self.store.rows(self.head, master).select("name", "guid"),
                             self.renames[master].select("guid"), "guid", "left_semi", unique=True)
                now = now.unionByName(old.join(now.select("name"), "name", "left_anti"))
            out[master] = now
        return out

    def apply_masters(self) -> None:
        """Deleted, changed and new masters with what hangs on them, then names that changed."""
        for collection, changes in self.routes.items():
            mine = [t for t in TABLES.values() if t.path.split(".")[0] == collection and t.half == "master"]
            primary = next((t for t in mine if t.nature == "Primary"), None)
            if primary is None:
                continue
            latest = self.hold(newest(changes))
            pending = self.hold(_newer(latest, [self.store.rows(self.head, primary.name), self.deletions(latest)], -1).drop(MONTH))
            if pending.isEmpty():
                continue
            self.accepted.append(pending.select("guid", "alterid", "deleted"))
            for table in sorted(mine, key=lambda t: t.nature != "Primary"):
                self._replace(table, pending, primary.name)
            before = self.store.rows(self.head, primary.name)
            if before is not None:
                names = self.hold(renamed(before, self.result[primary.name]))
                if not names.isEmpty():
                    self.renames[primary.name] = names
        for link in LINKS:
            if link.renames and link.master in self.renames and TABLES[link.table].half == "master":
                df = self.table(link.table)
                if df is not None and link.key in df.columns:
                    self.result[link.table] = with_names(df, link.column, self.renames[link.master])

    def _replace(self, table, pending: DataFrame, primary: str) -> None:
        """The table without the rows of changed objects, and with their new ones.

        A list that the documents do not have is not known to be empty: there only the rows of
        deleted objects go.
        """
        nested, stored = table.path.split(".")[1:], self.store.rows(self.head, table.name)
        told = not nested or nested[0] in pending.columns
        kept, rows = pending.where(~F.col("deleted")).drop("deleted"), None
        if told:
            groups = self.table("mst_group")
            if table.name == "trn_closingstock_ledger" and groups is not None:
                kept = members(kept, groups, STOCK_GROUP)
            plain = stored is not None and set(stored.columns) <= set(table.columns)
            rows = flatten(kept, table, masters=None if plain else self.names())
        if stored is None:
            if rows is not None and table.nature == "Primary":
                self.result[table.name] = rows
            return
        column = "guid" if table.nature == "Primary" else next(
            (c for parent, target, c in CASCADE_DELETE if (parent, target) == (primary, table.name)), None)
        if column in stored.columns:
            left = without(stored, (pending if told else pending.where("deleted")).select("guid"), column)
            self.result[table.name] = left if rows is None else appended(left, rows.select(stored.columns))

    def apply_vouchers(self) -> set[str]:
        """Changed vouchers, new numbers and new names of masters; the parts that these touch."""
        store, head = self.store, self.head
        heads = store.rows(head, "trn_voucher", months=True)
        pending, parts, numbers = None, set(), None
        if "voucher" in self.routes:
            latest = self.latest(self.routes["voucher"])
            # of the headers only keys, change numbers and folders are read
            known = None if heads is None else heads.select("guid", "alterid", MONTH)
            keys = latest.select("guid", "alterid", "deleted")
            keys = self.hold(_newer(keys, [known, self.deletions(keys)], int(head.state.get(STATE_SYNCED, -1))))
            top, count = keys.agg(F.max("alterid"), F.count("*")).first()
            self.top = top or 0
            self.accepted.append(keys.drop(MONTH))
            # only these can have rows in the store
            removed = keys.where(F.col(MONTH).isNotNull())
            parts |= store.parts_of(removed)
            removed = removed.select("guid")
            removed = F.broadcast(removed) if joins.fits(removed) else removed
            pending = self.accepted_of(latest, keys, count)
        if NUMBERS in self.routes and heads is not None:
            numbers = self.hold(newest(self.routes[NUMBERS]).select("guid", "voucher_number"))
            fresh = numbers.withColumnRenamed("voucher_number", "_fresh")
            parts |= store.parts_of(lookup(heads.select("guid", "voucher_number", MONTH), fresh, "guid", unique=True)
                                    .where(~F.col("voucher_number").eqNullSafe(F.col("_fresh"))))
        for link in LINKS:
            rows = store.rows(head, link.table, months=True) if link.master in self.renames else None
            if link.renames and TABLES[link.table].half == "transaction" and rows is not None and link.key in rows.columns:
                keys = self.renames[link.master].select(F.col("guid").alias(link.key))
                parts |= store.parts_of(lookup(rows.select("guid", link.key, MONTH), keys, link.key, "left_semi", measure=True))
        rows, added = {}, set()
        if pending is not None:
            types = self.types if self.types is not None else self.table("mst_vouchertype")
            names = self.names()
            broadcast = all(joins.is_small(df) or joins.fits(df) for df in names.values())
            for table in tables("transaction"):
                kept = self.only(pending, table).where(~F.col("deleted")).drop("deleted")
                kept = kept if MONTH in kept.columns else dated(kept, store.by)
                if types is not None and "basevouchertype" not in kept.columns:
                    kept = with_base_types(kept, types)
                stored = store.columns(head, table.name)
                plain = table.nature == "Derived" and (not names if stored is None else set(stored) <= set(table.columns))
                # lines take the month from their own document, so none is joined to its header
                rows[table.name] = flatten(kept, table, masters=None if plain else names, carried=[MONTH])
                if plain or broadcast:
                    self.ungathered.add(table.name)
            # rows of parts where nothing goes are added beside what is there
            added = store.parts_of(rows["trn_voucher"])
            parts |= added & store.scattered(head, "trn_voucher", FOLDERS)
            if parts or self.renames or numbers is not None or self.place is None or not store.writes_few(pending, len(added)):
                self.ungathered.clear()
        for table in tables("transaction") if parts or added else []:
            stored = store.rows(head, table.name, parts, months=True)
            df = rows.get(table.name)
            if stored is not None:
                df = stored if df is None else appended(
                    stored.join(removed, "guid", "left_anti"), df.select(stored.columns))  # a voucher has few lines
            if df is None:
                continue
            for link in LINKS:
                if link.table == table.name and link.renames and link.master in self.renames and link.key in df.columns:
                    df = with_names(df, link.column, self.renames[link.master])
            self.result[table.name] = renumbered(df, numbers) if table.name == "trn_voucher" and numbers is not None else df
        return parts

    def remember_deletions(self) -> set[str]:
        """Deleted objects are kept with the number of their deletion until a newer change."""
        changed = None
        for df in self.accepted:
            changed = df if changed is None else changed.unionByName(df)
        if changed is None:
            return set()
        changed = self.hold(changed)
        parts = self.store.undated_parts(changed)
        before = self.store.rows(self.head, DELETED, parts)
        gone = changed.where("deleted").select("guid", "alterid")
        if before is not None:
            gone = appended(without(before, changed.select("guid")), gone)
        self.result[DELETED] = gone.withColumn(MONTH, F.lit(0))
        return parts


def apply_changes(store: Store, changes: DataFrame, batch: int,
                  voucher_types: DataFrame | None = None, stream: str = "changes") -> dict[str, int]:
    """Apply one micro-batch to the stored tables; rows per table written.

    Each change is compared with what is stored of its own object, so changes may come late, in
    any order and more than once. A batch is known by its stream and number. Of the transaction
    tables only the parts are read and written that changed vouchers lie in or move to, that hold
    a voucher with a new number, or a line that names a renamed master. Tables that a sync run has
    filled keep the incremental schema: new rows get the guids of the masters they name.
    """
    head = store.head()
    mark = f"Batch {stream}"
    if batch <= int(head.state.get(mark, -1)):
        return {}
    work = Batch(store, head, routed(changes), voucher_types)
    try:
        work.apply_masters()
        parts = work.apply_vouchers()
        remembered = work.remember_deletions()
        if not work.result:
            return {}
        last = max(int(work.top), int(head.state.get(STATE_TRANSACTION, 0)))
        return store.commit(work.result, {STATE_TRANSACTION: str(last), mark: str(batch)},
                            {**{t.name: parts for t in tables("transaction")}, DELETED: remembered}, head, work.ungathered)
    finally:
        work.close()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity a checkpoint gave its stream; a new checkpoint is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def run(spark: SparkSession, landing: str, schema: T.StructType, store: Store, checkpoint: str,
        every_minutes: float = 0, file_format: str = "parquet",
        voucher_types: DataFrame | None = None) -> StreamingQuery:
    """Start applying landed changes: once (0 minutes) or every so many minutes.

    Batches never overlap and no batch runs when nothing has landed.
    """
    changes = spark.readStream.format(file_format).schema(schema).load(landing)
    writer = (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, batch: apply_changes(
            store, df, batch, voucher_types, _stream_id(spark, checkpoint)) and None))
    writer = (writer.trigger(processingTime=f"{round(every_minutes * 60)} seconds") if every_minutes > 0
              else writer.trigger(availableNow=True))
    return writer.start()
