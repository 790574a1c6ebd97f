"""Exported documents to relational tables.

``docs`` is one DataFrame per collection, one row per exported object, nested lists as arrays
of structs, leaves as export text (typed leaves are accepted too).
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import decode as D
from daybook.functions import fields as E
from daybook.operators import hierarchy
from daybook.operators.lookup import fits, is_small, lookup
from daybook.operators.reshape import Rows, compare, explode_path, explode_paths
from daybook.plans.books import Books
from daybook.plans.definitions import raw_value, value
from daybook.plans.months import MONTH, month_of, of_all_headers
from daybook.plans.store import Store
from daybook.schema import TABLES, TYPES, Table, incremental_columns, links_of, tables
from daybook.sources.xml import document_schema

STOCK_GROUP = "Stock-in-hand"


def document_filters(rows: Rows, table: Table, start=None, end=None, after: int | None = None) -> Column:
    """Which documents take part, decided before anything is exploded."""
    condition = F.lit(True)
    for flag in ("iscancelled", "isoptional"):
        if table.half == "transaction" and rows.has(flag):
            condition &= D.logical(rows.raw(flag)) == 0
    if table.payroll_only:
        condition &= D.logical(rows.raw("forpayroll")) == 1
    if table.name == "mst_gst_effective_rate":
        condition &= ~E.blank(rows.raw("gstapplicable"))
    if start is not None and table.half == "transaction":
        condition &= D.date_value(rows.raw("date")) >= F.lit(start).cast("date")
    if end is not None and table.half == "transaction":
        condition &= D.date_value(rows.raw("date")) <= F.lit(end).cast("date")
    if after is not None:
        condition &= rows.raw("alterid").try_cast("bigint") > after
    return condition


def _selected(docs: DataFrame, table: Table, start=None, end=None, after: int | None = None) -> Rows:
    whole = explode_path(docs, table.path.split(".")[0])
    return explode_path(docs.where(document_filters(whole, table, start, end, after)), table.path)


def fields_read(schema: T.StructType, table: Table | str, carried: Collection[str] = ()) -> T.StructType:
    """The fields that a table takes from documents of this schema, and the ``carried`` ones.

    Where entries of a list are exploded, Spark reads all that they hold; stored documents are therefore
    read with this schema.
    """
    table = TABLES[table] if isinstance(table, str) else table

    def cut(have: T.DataType, wanted: T.DataType, more: Collection[str] = ()) -> T.DataType:
        if isinstance(have, T.ArrayType) and isinstance(wanted, T.ArrayType):
            return T.ArrayType(cut(have.elementType, wanted.elementType), have.containsNull)
        if not (isinstance(have, T.StructType) and isinstance(wanted, T.StructType)):
            return have
        kept = [T.StructField(f.name, cut(f.dataType, wanted[f.name].dataType) if f.name in wanted.names else f.dataType, f.nullable)
                for f in have.fields if f.name in wanted.names or f.name in more]
        return T.StructType(kept) if kept else have

    return cut(schema, document_schema(table.path.split(".")[0], [table.name]), ["basevouchertype", *carried])


def dated(vouchers: DataFrame, by: str = "month") -> DataFrame:
    """Voucher documents with the month of their date, which their lines can carry."""
    return vouchers.withColumn(MONTH, month_of(D.date_value(explode_path(vouchers, "voucher").raw("date")), by))


def with_base_types(vouchers: DataFrame, voucher_types: DataFrame) -> DataFrame:
    """Voucher documents with the base type of their (possibly user-defined) voucher type."""
    types = voucher_types.select(F.col("name").alias("vouchertypename"),
                                 F.col("parent").alias("basevouchertype"))
    return lookup(vouchers, types, "vouchertypename", "left", measure=True)


def flatten(docs: DataFrame, table: Table | str, start=None, end=None, after: int | None = None,
            masters: Mapping[str, DataFrame] | None = None, carried: Collection[str] = ()) -> DataFrame:
    """Rows of one table from the documents of its collection.

    ``start``/``end`` bound the voucher date and ``after`` the change number. With ``masters``
    the result has the incremental schema: ``alterid`` and the guids of named masters. Columns of
    the documents that are ``carried`` follow as they are.
    """
    table = TABLES[table] if isinstance(table, str) else table
    rows = _selected(docs, table, start, end, after)
    columns = [value(rows, table, c).cast(table.type(c)).alias(c) for c in table.columns]
    if masters is None:
        return rows.df.select(*columns, *carried)
    alterid = rows.raw("alterid").try_cast("bigint").alias("alterid")
    flat = rows.df.select(*columns, *([alterid] if table.nature == "Primary" else []), *carried)
    return with_master_guids(flat, table, masters).select(
        *[F.col(c).cast(t).alias(c) for c, t in incremental_columns(table)], *carried)


def flattened(store: Store, vouchers: DataFrame, folder: str,
              masters: Mapping[str, DataFrame] | None = None) -> tuple[dict[str, DataFrame], set[str]]:
    """All transaction tables of a first load, with months as ``store`` keeps them, and which need not be gathered.

    The documents are written once, to ``folder``, and each table reads its fields there. A line carries the month
    of its document, so it is joined to headers only where several have its guid: documents with one guid, or
    a header with a name that several masters have.
    """
    vouchers = dated(vouchers, store.by)
    session, schema = vouchers.sparkSession, vouchers.schema
    vouchers.write.parquet(folder)

    def rows(table: Table) -> DataFrame:
        docs = session.read.schema(fields_read(schema, table, ["guid", MONTH])).parquet(folder)
        return flatten(docs, table, masters=masters, carried=[MONTH])

    named = [masters[link.master] for link in links_of("trn_voucher").values() if link.master in (masters or {})]
    unique = all(m.where(F.col("name").isNotNull()).groupBy("name").count().where("count > 1").isEmpty() for m in named)
    heads = (flatten(session.read.schema(schema).parquet(folder), "trn_voucher", carried=[MONTH]) if unique
             else rows(TABLES["trn_voucher"])).select("guid", MONTH)
    repeated = heads.groupBy("guid").count().where("count > 1").select("guid")
    several = not repeated.isEmpty()
    found = {t.name: rows(t) if t.nature == "Primary" or not several else of_all_headers(rows(t), heads, repeated)
             for t in tables("transaction")}
    few = not several and store.writes_few(session.read.schema(schema).parquet(folder), len(store.parts_of(heads)))
    few = few and all(is_small(df) or fits(df) for df in (masters or {}).values())
    return found, set(found) if few else set()


def with_master_guids(df: DataFrame, table: Table, masters: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``_x`` = guid of the master row named by ``x``, '' where there is none."""
    flat = df  # where hot names are looked for, free of the joins added below
    for column, link in links_of(table.name).items():
        if link.master not in masters:
            df = df.withColumn(link.key, F.lit(""))
            continue
        names = masters[link.master].select(F.col("name").alias(column), F.col("guid").alias(link.key))
        df = lookup(df, names, column, "left", measure=True, keys_from=flat.select(column))
        df = df.withColumn(link.key, F.coalesce(link.key, F.lit("")))
    return df


def ingest(docs: Mapping[str, DataFrame], half: str | None = None, start=None, end=None,
           company: str | None = None, stock_group: str = STOCK_GROUP) -> Books:
    """All tables that the given collections can fill, built on first use."""
    session = next(iter(docs.values())).sparkSession
    prepared = dict(docs)
    if "voucher" in docs and "vouchertype" in docs:
        prepared["voucher"] = with_base_types(docs["voucher"], flatten(docs["vouchertype"], "mst_vouchertype"))

    def build(table: Table) -> DataFrame:
        source = prepared[table.path.split(".")[0]]
        if table.name == "trn_closingstock_ledger" and "group" in docs:
            groups = flatten(docs["group"], "mst_group")
            source = hierarchy.members(source, groups, stock_group)
        out = flatten(source, table, start, end)
        return out if company is None else out.withColumn("company", F.lit(company))

    def lazily(table: Table):
        return lambda: build(table)

    return Books(session, {
        t.name: lazily(t) for t in TABLES.values()
        if t.path.split(".")[0] in docs and half in (None, t.half)})


def quality(docs: DataFrame, table: Table | str) -> DataFrame:
    """Per column: values present, blank values defaulted, unreadable values rejected.

    One aggregation over the documents, turned from columns into rows afterwards.
    """
    table = TABLES[table] if isinstance(table, str) else table
    rows = _selected(docs, table)
    raws = {c: raw_value(rows, table, c) for c in table.columns}
    texts = rows.df.select(*[r.alias(c) for c, r in raws.items()])

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    totals = texts.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            count(~E.blank(F.col(c))).alias("present"),
            count(E.blank(F.col(c))).alias("defaulted"),
            count(~E.blank(F.col(c)) & ~F.coalesce(D.readable(table.kind(c), F.col(c)), F.lit(False))
                  ).alias("rejected")).alias(c)
        for c in table.columns])
    return totals.select(F.inline(F.array(*[F.col(c) for c in table.columns]))).select(
        F.lit(table.name).alias("table"), "column", "present", "defaulted", "rejected")


def landed_quality(spark, collection: str, counts: Mapping[str, int]) -> DataFrame:
    """The row of the quality table for a landed collection's objects; broken ones are rejected."""
    return spark.range(1).select(
        F.lit(collection).alias("table"), F.lit("").alias("column"),
        F.lit(counts["objects"] - counts["broken"]).cast("long").alias("present"), F.lit(0).cast("long").alias("defaulted"),
        F.lit(counts["broken"]).cast("long").alias("rejected"))


@dataclass(frozen=True)
class FieldSpec:
    """A column of a user-defined table.

    ``datatype`` is string, number, decimal, date or boolean. At most one of the transforms
    applies, in the order expression, replace, concat, lookup. ``expression`` is SQL over the
    fields of the enclosing objects, named as they are there (the innermost wins), and is checked
    against their schema when the table is planned; its result is taken as it is, cast to
    ``datatype``. ``replace`` is a text to strip or a ``(find, put)`` pair; ``lookup`` is
    ``(field, collection, key, returned field)``.
    """

    name: str
    datatype: str
    source: str
    replace: str | tuple[str, str] | None = None
    concat: str | None = None
    lookup: tuple[str, str, str, str] | None = None
    expression: str | None = None


_DATATYPES = {"string": "text", "number": "amount", "decimal": "number", "date": "date",
              "boolean": "logical"}


def _spec_value(rows: Rows, spec: FieldSpec) -> Column:
    kind = _DATATYPES[spec.datatype]
    raw = rows.raw(spec.source)
    if spec.replace is not None:
        find, put = (spec.replace, "") if isinstance(spec.replace, str) else spec.replace
        raw = E.replace_first(raw, find, put)
    elif spec.concat is not None:
        raw = E.joined(rows.values(spec.source), spec.concat)
    elif spec.lookup is not None:
        raw = F.col(f"_looked_up_{spec.name}")
    return D.decode(kind, raw).cast(_sql_type(spec)).alias(spec.name)


def _with_expressions(df: DataFrame, rows: Rows, fields: list[FieldSpec]) -> DataFrame:
    if not any(f.expression for f in fields):
        return df.select(*[_spec_value(rows, f) for f in fields])
    names = {n: None for _, schema in rows.levels for n in schema.names}
    scope = df.select(*[_spec_value(rows, f).alias(f"_value_{f.name}") for f in fields if not f.expression],
                      *[rows.find(n)[0][0].alias(n) for n in names])
    return scope.select(*[
        F.expr(f.expression).cast(_sql_type(f)).alias(f.name) if f.expression
        else F.col(f"`_value_{f.name}`").alias(f.name) for f in fields])


def _sql_type(spec: FieldSpec) -> str:
    return {"number": "decimal(17,2)"}.get(spec.datatype, TYPES[_DATATYPES[spec.datatype]])


def flatten_paths(docs: Mapping[str, DataFrame], paths: list[str], fields: list[FieldSpec],
                  where: tuple[str, str, object] | None = None) -> DataFrame:
    """A user-defined table over one or more paths of one collection.

    ``where`` is ``(field, operator, value)`` on the documents.
    """
    collection = paths[0].split(".")[0]
    source = docs[collection]
    if where is not None:
        source = source.where(compare(explode_path(source, collection), *where))
    parts = []
    for rows in explode_paths(source, paths):
        df = rows.df
        for spec in (f for f in fields if f.lookup is not None):
            field, other, key, returned = spec.lookup
            found = docs[other].select(F.col(key).cast("string").alias("_key"),
                                       F.col(returned).cast("string").alias(f"_looked_up_{spec.name}"))
            df = lookup(df.withColumn("_key", rows.raw(field)), found, "_key", "left", measure=True,
                        keys_from=rows.df.select(rows.raw(field).alias("_key"))).drop("_key")
        parts.append(_with_expressions(df, rows, fields))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
