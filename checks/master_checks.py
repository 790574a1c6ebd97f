"""Master tables and all CSV tables: documents from the provided tables, flattened and typed.

A master is given as its source table and, for each column, the text its document holds and the
value expected, both in SQL that Spark and DuckDB share; the same one stands for both.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.oracle_books import with_books
from daybook.plans import ingest, sinks
from daybook.plans.definitions import source
from daybook.schema import TABLES
from daybook.session import scratch
from daybook.sources import delimited
from checks.testbed import testbed


def _yes(condition: str) -> tuple[str, str]:
    return f"case when {condition} then 'Yes' else 'No' end", f"case when {condition} then 1 else 0 end"


def _list(a: str, b: str) -> tuple[str, str]:
    return f"array({a}, {b})", f"concat({a}, ', ', {b})"


_ROOT = ("case when n_nationkey % 5 = 0 then 'Primary' else concat('P', n_regionkey) end",
         "case when n_nationkey % 5 = 0 then '' else concat('P', n_regionkey) end")
_NONE = ("case when n_nationkey % 4 = 0 then 'Not Applicable' else 'Days' end", "case when n_nationkey % 4 = 0 then '' else 'Days' end")
_GUID = "concat('g', n_nationkey)"

# table -> provided table and columns; what is not listed is missing from the documents
_MASTERS = {
    "mst_group": ("nation", {
        "guid": _GUID, "name": "n_name", "parent": _ROOT, "primary_group": "concat('P', n_regionkey)",
        "is_revenue": _yes("n_nationkey % 2 = 0"), "is_deemedpositive": _yes("n_nationkey % 3 = 0"),
        "is_reserved": _yes("n_nationkey % 4 = 0"), "affects_gross_profit": _yes("n_nationkey % 7 = 0"),
        "sort_position": ("cast(n_nationkey * 10 as string)", "n_nationkey * 10")}),
    "mst_vouchertype": ("nation", {
        "guid": _GUID, "name": "n_name", "parent": "case when n_nationkey % 2 = 0 then 'Sales' else 'Purchase' end",
        "numbering_method": "'Automatic'", "is_deemedpositive": _yes("n_nationkey % 3 = 0"), "affects_stock": _yes("n_nationkey % 2 = 0")}),
    "mst_uom": ("nation", {
        "guid": _GUID, "name": "n_name", "formalname": "concat(n_name, ' unit')", "is_simple_unit": _yes("n_nationkey % 2 = 0"),
        "base_units": "'Nos'", "conversion": ("concat(n_nationkey, '.5')", "n_nationkey + 0.5")}),
    "mst_godown": ("supplier", {
        "guid": "concat('s', s_suppkey)", "name": "s_name", "parent": "case when s_suppkey % 2 = 0 then 'Primary' else 'Main' end",
        "address": _list("s_name", "'Yard'")}),
    "mst_stock_category": ("nation", {"guid": _GUID, "name": "n_name", "parent": _ROOT}),
    "mst_stock_group": ("nation", {"guid": _GUID, "name": "concat(n_name, ' &amp; more')", "parent": _ROOT}),
    "mst_cost_category": ("region", {
        "guid": "concat('r', r_regionkey)", "name": "r_name", "allocate_revenue": _yes("r_regionkey < 3"),
        "allocate_non_revenue": _yes("r_regionkey > 1")}),
    "mst_cost_centre": ("nation", {"guid": _GUID, "name": "n_name", "parent": _ROOT, "category": "concat('c', n_regionkey)"}),
    "mst_attendance_type": ("nation", {
        "guid": _GUID, "name": "n_name", "parent": _ROOT, "uom": _NONE, "attendance_type": "'Attendance'", "attendance_period": "'Month'"}),
    "mst_employee": ("customer", {
        "guid": "concat('e', c_custkey)", "name": "c_name", "parent": "c_mktsegment", "id_number": "concat('#', c_custkey)",
        "date_of_joining": ("'20200115'", "date '2020-01-15'"), "designation": "'Clerk'", "function_role": "c_mktsegment",
        "gender": ("case when c_nationkey = 3 then 'Unknown' else 'Other' end", "case when c_nationkey = 3 then '' else 'Other' end"),
        "address": _list("c_name", "c_mktsegment"), "email": "concat(c_custkey, '@x.org')", "mobile": "cast(c_custkey as string)"}),
    "mst_payhead": ("customer", {
        "guid": "concat('h', c_custkey)", "name": "c_name", "parent": "c_mktsegment", "payslip_name": "concat('Pay ', c_custkey)",
        "pay_type": ("case when c_nationkey = 3 then 'Not Applicable' else 'Earnings' end", "case when c_nationkey = 3 then '' else 'Earnings' end"),
        "income_type": "'Fixed'", "calculation_type": "'Flat'"}),
}
_PAYROLL = "c_nationkey % 2 = 0"


def _text(spec) -> str:
    return spec if isinstance(spec, str) else spec[0]


def _query(name: str):
    given, columns = _MASTERS[name]
    table = TABLES[name]

    def run(spark, folder):
        rows = spark.read.parquet(f"{folder}/{given}.parquet")
        docs = rows.select(*[F.expr(_text(s)).alias(source(table, c)) for c, s in columns.items()],
                           *([F.expr(_yes(_PAYROLL)[0]).alias("forpayroll")] if table.payroll_only else []))
        return ingest.flatten(docs, name)
    return run


def _expected(name: str) -> str:
    given, columns = _MASTERS[name]
    table, out = TABLES[name], []
    for c in table.columns:
        kind = {"string": "varchar"}.get(table.type(c), table.type(c))
        missing = "''" if kind == "varchar" else "null" if kind == "date" else "0"
        spec = columns.get(c, (missing, missing))
        wanted = spec if isinstance(spec, str) else spec[1]
        out.append(f"cast({wanted.replace('&amp;', '&')} as {kind}) as {c}")
    return f"select {', '.join(out)} from {given}" + (f" where {_PAYROLL}" if table.payroll_only else "")


_CSV = ["mst_group", "mst_ledger", "mst_stock_item", "mst_vouchertype", "mst_opening_bill_allocation", "mst_opening_batch_allocation",
        "trn_closingstock_ledger", "trn_voucher", "trn_accounting", "trn_bill", "trn_inventory"]


def _all_csv(spark, folder):
    """Every table through the CSV sink and back; tables without rows are written empty."""
    path, books = scratch(spark, "csv"), testbed(spark, folder)
    for name in TABLES:
        df = books[name] if name in books else spark.createDataFrame([], TABLES[name].schema)
        sinks.write_csv(df, f"{path}/{name}.csv")
    back, parts = delimited.open_csv(spark, path, views=False), None
    for name in sorted(TABLES):
        part = back[name].agg(F.lit(name).alias("table"), F.count("*").alias("rows"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _one_element(spark, folder):
    """A repeated value with one entry is read as that value, with more as nothing."""
    rows = spark.read.parquet(f"{folder}/customer.parquet")
    docs = rows.select(
        F.concat(F.lit("c"), "c_custkey").alias("guid"),
        F.when(F.col("c_custkey") % 2 == 0, F.array("c_name")).otherwise(F.array("c_name", "c_mktsegment")).alias("name"),
        F.col("c_mktsegment").alias("parent"), (F.col("c_nationkey") == 3).alias("isrevenue"))
    return ingest.flatten(docs, "mst_group").select("guid", "name", "parent", "is_revenue")


QUERIES = {
    **{f"n1_{name}": _query(name) for name in _MASTERS},
    "s4_all_csv_tables": _all_csv,
    "t15_one_element": _one_element,
}

ORACLE = {
    **{f"n1_{name}": _expected(name) for name in _MASTERS},
    "s4_all_csv_tables": with_books(" union all ".join(
        f"select '{t}' as \"table\", (select count(*) from {t}) as rows" if t in _CSV
        else f"select '{t}' as \"table\", 0::bigint as rows" for t in sorted(TABLES))),
    "t15_one_element": """
      select 'c' || c_custkey as guid, case when c_custkey % 2 = 0 then c_name else '' end as name,
        c_mktsegment as parent, (c_nationkey = 3)::tinyint as is_revenue from customer""",
}
