"""Ingest queries: documents built from the provided tables, flattened and decoded."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.oracle_books import with_books
from daybook.functions import decode as D
from daybook.functions import fields as E
from daybook.operators.reshape import explode_path
from daybook.plans import ingest as I
from checks import testbed_documents as docs
from checks.testbed import Testbed


def _flat(build, table, **kw):
    return lambda spark, folder: I.flatten(build(spark, folder), table, **kw)


def _ingested(table):
    return lambda spark, folder: I.ingest(docs.documents(spark, folder))[table]


def _decoding(spark, folder):
    o = Testbed(spark, folder).orders()
    k, amt = F.col("k"), F.col("amt").cast("string")
    raw = o.select(
        "k", F.date_format("date", "yyyyMMdd").alias("d8"), F.date_format("date", "d-MMM-yy").alias("dm"),
        F.when(k % 2 == 0, "Yes").otherwise("No").alias("flag"), amt.alias("amount"),
        F.concat(amt, F.lit(" Nos")).alias("qty"), F.concat(amt, F.lit("/Kg")).alias("rate"),
        F.concat(F.lit("$ 1 @ 70/$ = Rs "), amt).alias("forex"),
        F.concat(F.lit("$ 1/M2 = Rs "), amt, F.lit("/M2")).alias("forex_rate"),
        F.concat(F.lit("$ 1/12 Nos = Rs "), amt, F.lit("/12 Nos")).alias("dozen_rate"),
        F.concat(F.lit("(-)"), amt).alias("marked"),
        F.concat(k.cast("string"), F.when(k % 3 == 0, " days").otherwise(" Days")).alias("due"),
        F.concat(F.lit("A&amp;B &#65;&lt;\t"), "o_orderpriority").alias("note"))
    return raw.select(
        "k", D.date_value(F.col("d8")).alias("date8"), D.date_value(F.substring("d8", 1, 7)).alias("date7"),
        D.short_date(F.col("dm")).alias("short_date"), D.logical(F.col("flag")).alias("flag"),
        D.decode("amount", F.col("amount")).alias("amount"),
        D.decode("amount", F.col("note")).alias("not_a_number"),
        D.decode("quantity", F.col("qty")).alias("quantity"), D.decode("rate", F.col("rate")).alias("rate"),
        D.decode("rate", F.col("forex_rate")).alias("forex_rate"),
        D.decode("rate", F.col("dozen_rate")).alias("dozen_rate"),
        D.decode("amount", F.col("forex")).alias("home_amount"),
        D.decode("amount", F.col("marked")).alias("marked"), D.days(F.col("due")).alias("due_days"),
        D.text(F.col("note")).alias("note"),
        D.signed_amount(F.col("amount"), F.col("k") % 2 == 0).alias("signed"),
        D.export_text(F.concat(F.lit("<ENVELOPE>"), F.col("note"))).alias("cleaned"))


def _field_expressions(spark, folder):
    c = Testbed(spark, folder).source("customer")
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    tags = F.array(F.struct(segment.alias("f")), F.struct(key.alias("f")))
    empty = F.when(F.col("c_nationkey") == 3, segment).otherwise("")
    marker = F.when(F.col("c_nationkey") == 3, "Primary").otherwise(segment)
    na = F.when(F.col("c_nationkey") == 3, "Not Applicable").otherwise(segment)
    return c.select(
        "c_custkey", E.blank_root(marker).alias("parent"), E.blank_not_applicable(na).alias("category"),
        E.blank_unknown(F.when(F.col("c_nationkey") == 3, "Unknown").otherwise(segment)).alias("gender"),
        E.joined(F.array(segment, key)).alias("address"),
        E.formatted("%s %s", empty, F.lit("+91"), empty).alias("mobile"),
        E.first_or_last_of(empty, tags, "f").alias("gstn"),
        E.nth(tags, 1)["f"].alias("first"), E.nth(tags, 3)["f"].alias("third"),
        E.replace_first(segment, "E", "_").alias("replaced"),
        E.replace_first(segment, "O").alias("stripped"))


def _scoped(spark, folder):
    """Innermost value wins, the outer one fills in where the inner object lacks it."""
    o = Testbed(spark, folder).orders()
    nested = o.select(
        "guid", F.col("party").alias("name"),
        F.array(F.struct(F.when(F.col("m") < 5, F.col("voucher_type")).alias("name"),
                         F.col("amt").alias("amount"))).alias("entries"))
    rows = explode_path(nested, "doc.entries")
    return rows.df.select(rows.raw("guid").alias("guid"), rows.raw("name").alias("name"),
                          rows.raw("..name").alias("outer_name"), rows.raw("amount").alias("amount"))


def _merged_paths(spark, folder):
    """Two nested lists of one collection into one user-defined table."""
    fields = [I.FieldSpec("guid", "string", "guid"),
              I.FieldSpec("ledger", "string", "ledgername", replace=("Customer#", "C")),
              I.FieldSpec("amount", "number", "amount"), I.FieldSpec("date", "date", "date"),
              I.FieldSpec("invoice", "boolean", "isinvoice"),
              I.FieldSpec("base", "string", "vouchertypename",
                          lookup=("vouchertypename", "vouchertype", "name", "numberingmethod"))]
    d = {"voucher": docs.voucher_documents(spark, folder),
         "vouchertype": docs.voucher_type_documents(spark, folder)}
    return I.flatten_paths(
        d, ["voucher.allledgerentries", "voucher.ledgerentries", "voucher.allledgerentries.billallocations"],
        fields, where=("vouchertypename", "!=", "Contra"))


def _quality(spark, folder):
    return I.quality(docs.stock_voucher_documents(spark, folder), "trn_inventory")


def _filtered(operator, value):
    def run(spark, folder):
        d = docs.voucher_documents(spark, folder)
        whole = explode_path(d, "voucher")
        return d.where(I.compare(whole, "vouchernumber", operator, value)).select("guid")
    return run


def _with_guids(spark, folder):
    bed = Testbed(spark, folder)
    masters = {"mst_ledger": bed.ledgers(), "mst_vouchertype": bed.voucher_types()}
    return I.flatten(docs.voucher_documents(spark, folder), "trn_voucher", masters=masters).select(
        "guid", "alterid", "voucher_type", "_voucher_type", "party_name", "_party_name")


_VOUCHER_TABLES = ["trn_accounting", "trn_bill", "trn_bank", "trn_cost_centre",
                   "trn_cost_category_centre", "trn_cost_inventory_category_centre",
                   "trn_inventory_additional_cost", "trn_employee", "trn_payhead", "trn_attendance"]

def _expressed(spark, folder):
    """Columns by SQL over the fields of an entry and of the voucher around it."""
    spec = I.FieldSpec
    return I.flatten_paths({"voucher": docs.voucher_documents(spark, folder)}, ["voucher.allledgerentries"], [
        spec("guid", "string", "guid"), spec("ledger", "string", "ledgername"),
        spec("label", "string", "", expression="concat(upper(ledgername), ' / ', vouchernumber)"),
        spec("cents", "decimal", "", expression="try_cast(regexp_extract(amount, '[0-9.]+$', 0) as decimal(17,2)) * 100"),
        spec("year", "string", "", expression="substr(date, 1, 4)")])


QUERIES = {
    "t_decoding": _decoding,
    "e_field_expressions": _field_expressions,
    "n1_trn_voucher": _ingested("trn_voucher"),
    **{f"n1_{t}": _flat(docs.voucher_documents, t) for t in _VOUCHER_TABLES},
    "x_column_expression": _expressed,
    "n1_trn_inventory": _flat(docs.stock_voucher_documents, "trn_inventory"),
    "n1_trn_batch": _flat(docs.stock_voucher_documents, "trn_batch"),
    "n1_mst_stock_item": _flat(docs.stock_item_documents, "mst_stock_item"),
    "n1_mst_gst_effective_rate": _flat(docs.stock_item_documents, "mst_gst_effective_rate"),
    "n1_mst_opening_batch_allocation": _flat(docs.stock_item_documents, "mst_opening_batch_allocation"),
    "n1_mst_stockitem_standard_cost": _flat(docs.stock_item_documents, "mst_stockitem_standard_cost"),
    "n1_mst_stockitem_standard_price": _flat(docs.stock_item_documents, "mst_stockitem_standard_price"),
    "n1_mst_ledger": _flat(docs.ledger_documents, "mst_ledger"),
    "n1_mst_opening_bill_allocation": _flat(docs.ledger_documents, "mst_opening_bill_allocation"),
    "f5_trn_closingstock_ledger": _ingested("trn_closingstock_ledger"),
    "f9_trn_accounting_in_period": _flat(
        docs.voucher_documents, "trn_accounting", start="1998-04-01", end="1999-03-31"),
    "n2_merged_paths": _merged_paths,
    "n3_scoped_lookup": _scoped,
    "f8_filter_at_least": _filtered(">=", 5000),
    "f8_filter_not_equal": _filtered("!=", "77"),
    "e15_master_guids": _with_guids,
    "s17_quality": _quality,
}

_LIVE = "from ord where not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')"
_SECOND = "case when m in (3, 4) then 'Purchase' when m in (5, 6, 7) then 'Cash' else 'Sales' end"
_FIRST = "case when m = 7 then 'Bank' else party end"
_SIGNED = "case when m in (2, 3, 5) then amt else -amt end"
_ENTRY = f"""(select *, {_FIRST} as ledger, {_SIGNED} as a, 1 as e {_LIVE}
  union all select *, {_SECOND}, -({_SIGNED}), 2 {_LIVE})"""
_REVENUE = f"{_ENTRY} where e = 2 and ledger in ('Sales', 'Purchase')"
_ITEM_TEXT = ("'' as alias, '' as notes, '' as part_number, '' as costing_method, "
              "'' as gst_type_of_supply, '' as gst_hsn_code, '' as gst_hsn_description, '' as gst_taxability")
_FREIGHT = "cast(-k % 1000 as decimal(17,2))"
_TRACK = """case when l_linestatus = 'O' then 'T' || l_partkey else '' end"""


def _zero(columns: str, kind: str) -> str:
    return ", ".join(f"cast(0 as {kind}) as {c}" for c in columns.split())


def _blank(columns: str) -> str:
    return ", ".join(f"'' as {c}" for c in columns.split())


_ACCOUNTING = f"""
      select guid, ledger, a as amount,
        cast(case when m = 2 then a * 2 else 0 end as decimal(17,2)) as amount_forex,
        case when m = 2 then '$' else '' end as currency from {_ENTRY}"""

ORACLE = {
    "t_decoding": with_books("""
      select k, date as date8, cast(null as date) as date7, date as short_date,
        (k % 2 = 0)::tinyint as flag, amt as amount, cast(0 as decimal(17,2)) as not_a_number,
        cast(amt as decimal(15,4)) as quantity, cast(amt as decimal(15,4)) as rate,
        cast(amt as decimal(15,4)) as forex_rate, cast(amt as decimal(15,4)) as dozen_rate, amt as home_amount,
        -amt as marked, (case when k % 3 = 0 then 0 else k end)::int as due_days,
        'A&B A<' || o_orderpriority as note,
        cast(case when k % 2 = 0 then -amt else amt end as decimal(17,2)) as signed,
        'A&B < ' || o_orderpriority as cleaned from ord"""),
    "e_field_expressions": """
      select c_custkey, case when n then '' else s end as parent, case when n then '' else s end as category,
        case when n then '' else s end as gender, s || ', ' || c_custkey as address,
        case when n then '+91 ' || s else '' end as mobile,
        case when n then s else c_custkey::varchar end as gstn, s as "first", cast(null as varchar) as third,
        case when strpos(s, 'E') > 0 then substr(s, 1, strpos(s, 'E') - 1) || '_' || substr(s, strpos(s, 'E') + 1)
          else s end as replaced,
        case when strpos(s, 'O') > 0 then substr(s, 1, strpos(s, 'O') - 1) || substr(s, strpos(s, 'O') + 1)
          else s end as stripped
      from (select c_custkey, c_mktsegment as s, c_nationkey = 3 as n from customer)""",
    "n1_trn_voucher": with_books(f"""
      select guid, date, voucher_type, k::varchar as voucher_number, '' as reference_number,
        cast(null as date) as reference_date, 'R&D ' || o_orderpriority as narration, party as party_name,
        '' as place_of_supply, (m in (3, 8, 9))::tinyint as is_invoice,
        (m > 1)::tinyint as is_accounting_voucher, (m = 1)::tinyint as is_inventory_voucher,
        (m = 0)::tinyint as is_order_voucher {_LIVE}"""),
    "x_column_expression": with_books(f"""
      select guid, ledger, upper(ledger) || ' / ' || k as label, cast(abs(a) * 100 as decimal(15,4)) as cents,
        strftime(date, '%Y') as year
      from (select *, {_FIRST} as ledger, {_SIGNED} as a from ord union all select *, {_SECOND}, -({_SIGNED}) from ord)"""),
    "n1_trn_accounting": with_books(_ACCOUNTING),
    "f9_trn_accounting_in_period": with_books(
        f"{_ACCOUNTING} where date between date '1998-04-01' and date '1999-03-31'"),
    "n1_trn_bill": with_books(f"""
      select guid, party as ledger, (case when m = 9 then 'C' else 'B' end) || b as name,
        cast(case when m in (6, 8, 9) then -amt else amt end as decimal(17,2)) as amount,
        case when m in (3, 8, 9) then 'New Ref' else 'Agst Ref' end as billtype,
        (k % 90)::int as bill_credit_period {_LIVE} and m in (3, 5, 6, 8, 9)"""),
    "n1_trn_bank": with_books(f"""
      select guid, ledger, 'Cheque' as transaction_type, date as instrument_date,
        k::varchar as instrument_number, 'First Bank' as bank_name, a as amount,
        case when m = 7 then null else date end as bankers_date
      from {_ENTRY} where ledger in ('Bank', 'Cash')"""),
    "n1_trn_cost_centre": with_books(
        f"select guid, ledger, o_orderpriority as costcentre, a as amount from {_REVENUE}"),
    "n1_trn_cost_category_centre": with_books(f"""
      select guid, ledger, o_orderstatus as costcategory, o_orderpriority as costcentre, a as amount
      from {_REVENUE}"""),
    "n1_trn_cost_inventory_category_centre": with_books(f"""
      select guid, ledger, 'P' || o_custkey as item, o_orderstatus as costcategory,
        o_orderpriority as costcentre, a as amount from {_REVENUE}"""),
    "n1_trn_inventory_additional_cost": with_books(f"""
      select guid, 'Freight' as ledger, {_FREIGHT} as amount,
        'By Quantity' as additional_allocation_type,
        cast(k % 28 + 0.5 as decimal(9,4)) as rate_of_invoice_tax {_LIVE} and m = 3"""),
    "n1_trn_employee": with_books(f"""
      select guid, o_orderstatus as category, o_orderpriority as employee_name, amt as amount,
        (k % 7)::int as employee_sort_order {_LIVE} and m = 6"""),
    "n1_trn_payhead": with_books(f"""
      select guid, o_orderstatus as category, o_orderpriority as employee_name,
        (k % 7)::int as employee_sort_order, p.name as payhead_name, p.pos::int as payhead_sort_order,
        cast(case when p.pos = 1 then amt else k % 100 end as decimal(17,2)) as amount
      from (select * {_LIVE} and m = 6), (values ('Basic', 1), ('Allowance', 2)) p(name, pos)"""),
    "n1_trn_attendance": with_books(f"""
      select guid, o_orderpriority as employee_name, 'Present' as attendancetype_name,
        cast(k % 12 + 0.25 as decimal(17,2)) as time_value, cast(k % 5 as decimal(17,2)) as type_value
      {_LIVE} and m = 7"""),
    "n1_trn_inventory": f"""
      select 'V' || l_orderkey as guid, 'P' || l_partkey as item,
        cast(case when l_returnflag = 'R' then l_quantity else -l_quantity end as decimal(15,4)) as quantity,
        cast(l_extendedprice as decimal(15,4)) as rate,
        cast(l_extendedprice as decimal(17,2)) as amount, cast(l_tax as decimal(17,2)) as additional_amount,
        cast(l_discount as decimal(17,2)) as discount_amount, 'Main' as godown, {_TRACK} as tracking_number,
        '' as order_number, case when l_linestatus = 'F' then null else cast(l_shipdate as date) end as order_duedate
      from lineitem""",
    "n1_trn_batch": f"""
      select 'V' || l_orderkey as guid, 'P' || l_partkey as item, 'B' || l_suppkey as name,
        cast(case when l_returnflag = 'R' then l_quantity else -l_quantity end as decimal(15,4)) as quantity,
        cast(l_extendedprice as decimal(17,2)) as amount, 'Main' as godown,
        l_linestatus as destination_godown, {_TRACK} as tracking_number from lineitem""",
    "n1_mst_stock_item": f"""
      select 'I' || p_partkey as guid, 'P' || p_partkey as name,
        case when p_type = 'SMALL' then '' else p_brand end as parent, '' as category,
        p_name as description, 'Nos' as uom, '' as alternate_uom,
        cast(-p_size as decimal(15,4)) as opening_balance, cast(p_retailprice as decimal(15,4)) as opening_rate,
        {_zero("conversion closing_balance closing_rate", "decimal(15,4)")},
        {_zero("opening_value closing_value", "decimal(17,2)")}, {_zero("gst_rate", "decimal(9,4)")},
        {_ITEM_TEXT} from part""",
    "n1_mst_gst_effective_rate": f"""
      select 'P' || p_partkey as item, date '2017-07-01' as applicable_from, '' as hsn_description,
        p_size::varchar as hsn_code, h.head as duty_head, cast(p_size * h.part as decimal(9,4)) as rate,
        {_zero("rate_per_unit", "decimal(9,4)")}, '' as valuation_type, 0::tinyint as is_rcm_applicable,
        {_blank("nature_of_transaction nature_of_goods supply_type")}, 'Taxable' as taxability
      from part, (values ('Central', 0.5), ('State', 0.5), ('Integrated', 1.0)) h(head, part)
      where p_type <> 'ECONOMY'""",
    "n1_mst_opening_batch_allocation": """
      select 'Primary Batch' as name, 'P' || p_partkey as item, cast(p_size as decimal(15,4)) as opening_balance,
        cast(p_retailprice as decimal(15,4)) as opening_rate, cast(p_retailprice as decimal(17,2)) as opening_value,
        'Main' as godown, cast(null as date) as manufactured_on from part""",
    "n1_mst_stockitem_standard_cost": """
      select 'P' || p_partkey as item, d.date, cast(cast(p_retailprice as decimal(15,4)) + d.more as decimal(15,4)) as rate
      from part, (values (date '2020-04-01', 0), (date '2021-04-01', 1)) d(date, more)""",
    "n1_mst_stockitem_standard_price": """
      select 'P' || p_partkey as item, date '2020-04-01' as date,
        cast(cast(p_retailprice as decimal(15,4)) * 2 as decimal(15,4)) as rate from part""",
    "n1_mst_ledger": with_books(f"""
      with known as (
        select 'L:' || c_name as guid, c_name as name, n_name as parent, cast(-c_acctbal as decimal(17,2)) as o,
          n_name || ', ' || c_mktsegment as address, '+91 ' || c_custkey as mobile, c_mktsegment as gstn,
          c_nationkey::int as days from customer join nation on c_nationkey = n_nationkey
        union all select '', ledger, 'Stock-in-hand', 0, '', '', '', 0 from trn_closingstock_ledger)
      select guid, name, parent, o as opening_balance, address as mailing_address, mobile, gstn,
        days as bill_credit_period, 0::tinyint as is_revenue, 0::tinyint as is_deemedpositive,
        {_zero("closing_balance", "decimal(17,2)")}, {_zero("tax_rate", "decimal(9,4)")},
        {_blank("alias description notes mailing_name mailing_state mailing_country mailing_pincode email "
                "it_pan gst_registration_type gst_supply_type gst_duty_head bank_account_holder "
                "bank_account_number bank_ifsc bank_swift bank_name bank_branch")}
      from known"""),
    "n1_mst_opening_bill_allocation": """
      select c_name as ledger, cast(-c_acctbal as decimal(17,4)) as opening_balance,
        date '1995-01-01' as bill_date, 'OB' || c_custkey as name, 30 as bill_credit_period,
        0::tinyint as is_advance from customer""",
    "f5_trn_closingstock_ledger": with_books("select ledger, stock_date, stock_value from trn_closingstock_ledger"),
    "n2_merged_paths": with_books(f"""
      with entry as (
        select guid, {_FIRST} as ledger, {_SIGNED} as amount, date, m, voucher_type from ord
        union all select guid, {_SECOND}, -({_SIGNED}), date, m, voucher_type from ord
        union all select guid, 'Freight', {_FREIGHT}, date, m, voucher_type from ord where m = 3)
      select guid, replace(ledger, 'Customer#', 'C') as ledger, amount, date,
        (m in (3, 8, 9))::tinyint as invoice, 'Automatic' as base from entry where m <> 7"""),
    "n3_scoped_lookup": with_books("""
      select guid, case when m < 5 then voucher_type else party end as name, party as outer_name,
        amt::varchar as amount from ord"""),
    "f8_filter_at_least": with_books("select guid from ord where k >= 5000"),
    "f8_filter_not_equal": with_books("select guid from ord where k <> 77"),
    "e15_master_guids": with_books(f"""
      select guid, k + 1 as alterid, voucher_type, 'T:' || voucher_type as _voucher_type,
        party as party_name, 'L:' || party as _party_name {_LIVE}"""),
    "s17_quality": """
      with base as (
        select count(*) as n, count(*) filter (l_linestatus = 'O' or l_returnflag = 'A' and false) as tracked,
          count(*) filter (l_linestatus <> 'F') as due from lineitem)
      select 'trn_inventory' as "table", c as "column",
        case c when 'tracking_number' then tracked when 'order_number' then 0 when 'order_duedate' then due else n end
          as present,
        n - case c when 'tracking_number' then tracked when 'order_number' then 0 when 'order_duedate' then due else n end
          as defaulted, 0::bigint as rejected
      from base, (select unnest(['guid', 'item', 'quantity', 'rate', 'amount', 'additional_amount',
        'discount_amount', 'godown', 'tracking_number', 'order_number', 'order_duedate']) as c)""",
}
