"""The accounting tables as DuckDB CTEs over the provided tables, written independently."""

from __future__ import annotations

import re

# stated here once more, so that the SQL does not take its constants from what it checks
VOUCHER_TYPES = ["Contra", "Credit Note", "Debit Note", "Delivery Note", "Payment", "Purchase", "Receipt", "Sales",
                 "Sales Order"]
# group: is_revenue, is_deemedpositive, affects_gross_profit
ROOT_GROUPS = {
    "Bank Accounts": (0, 1, 0), "Cash-in-hand": (0, 1, 0), "Purchase Accounts": (1, 1, 1), "Sales Accounts": (1, 0, 1),
    "Stock-in-hand": (0, 1, 0), "Sundry Creditors": (0, 0, 0), "Sundry Debtors": (0, 1, 0),
}
# ledger: group, is_revenue, opening balance
FIXED_LEDGERS = {
    "Bank": ("Bank Accounts", 0, -90000), "Cash": ("Cash-in-hand", 0, -50000),
    "Purchase": ("Purchase Accounts", 1, 0), "Sales": ("Sales Accounts", 1, 0),
    "Stock0": ("Stock-in-hand", 0, -24000), "Stock1": ("Stock-in-hand", 0, -24001), "Stock2": ("Stock-in-hand", 0, -24002),
    "Stock3": ("Stock-in-hand", 0, -24003), "Stock4": ("Stock-in-hand", 0, -24004),
}

_TYPE_CASE = """case m when 0 then 'Sales Order' when 1 then 'Delivery Note' when 2 then 'Credit Note'
  when 3 then 'Purchase' when 4 then 'Debit Note' when 5 then 'Receipt' when 6 then 'Payment'
  when 7 then 'Contra' else 'Sales' end"""

_GROUPS = " union all ".join(
    f"select 'G:{n}' as guid, '{n}' as name, '' as parent, '{n}' as primary_group, {r} as is_revenue, "
    f"{d} as is_deemedpositive, {a} as affects_gross_profit" for n, (r, d, a) in ROOT_GROUPS.items())
_LEDGERS = " union all ".join(
    f"select 'L:{n}' as guid, '{n}' as name, '{g}' as parent, {r} as is_revenue, "
    f"cast({o} as decimal(17,2)) as opening_balance, '' as gstn"
    for n, (g, r, o) in FIXED_LEDGERS.items())
_TYPES = " union all ".join(
    f"select 'T:{n}' as guid, '{n}' as name, '{n}' as parent, "
    f"'{'Manual' if n == 'Contra' else 'Automatic'}' as numbering_method, 0 as affects_stock"
    for n in VOUCHER_TYPES)

CTES: dict[str, str] = {
    "ord": f"""
        select *, {_TYPE_CASE} as voucher_type,
          case when m in (3, 4, 6)
            then 'Supplier#' || lpad((b % (select count(*) from supplier))::varchar, 9, '0')
            else 'Customer#' || lpad((b % (select count(*) from customer))::varchar, 9, '0') end as party
        from (select o_orderkey as k, o_orderkey // 10 as b, o_orderkey % 10 as m,
                'V' || o_orderkey as guid, cast(o_orderdate as date) as date,
                cast(o_totalprice as decimal(17,2)) as amt, o_custkey, o_orderstatus, o_orderpriority
              from orders)""",
    "trn_voucher": """
        select guid, date, voucher_type, k::varchar as voucher_number, o_orderpriority as narration,
          party as party_name, (m = 0)::int as is_order_voucher, (m = 1)::int as is_inventory_voucher,
          (m > 1)::int as is_accounting_voucher
        from ord""",
    "trn_accounting": """
        select guid, case when m = 7 then 'Bank' else party end as ledger,
          case when m in (2, 3, 5) then amt else -amt end as amount from ord
        union all
        select guid, case when m in (3, 4) then 'Purchase' when m in (5, 6, 7) then 'Cash' else 'Sales' end,
          case when m in (2, 3, 5) then -amt else amt end from ord""",
    "trn_bill": """
        select guid, party as ledger, (case when m = 9 then 'C' else 'B' end) || b as name,
          case when m in (6, 8, 9) then -amt else amt end as amount,
          case when m in (3, 8, 9) then 'New Ref' else 'Agst Ref' end as billtype,
          (k % 90)::int as bill_credit_period
        from ord where m in (3, 5, 6, 8, 9)""",
    "mst_group": f"""
        {_GROUPS}
        union all select 'G:' || r_name, r_name, 'Sundry Debtors', 'Sundry Debtors', 0, 1, 0 from region
        union all select 'G:' || n_name, n_name, r_name, 'Sundry Debtors', 0, 1, 0
          from nation join region on n_regionkey = r_regionkey""",
    "mst_ledger": f"""
        {_LEDGERS}
        union all select 'L:' || c_name, c_name, n_name, 0, cast(-c_acctbal as decimal(17,2)), c_mktsegment
          from customer join nation on c_nationkey = n_nationkey
        union all select 'L:' || s_name, s_name, 'Sundry Creditors', 0, cast(s_acctbal as decimal(17,2)), ''
          from supplier""",
    "mst_vouchertype": _TYPES,
    "mst_stock_item": """
        select 'I' || p_partkey as guid, 'P' || p_partkey as name, p_brand as parent, 'Nos' as uom,
          cast(p_size as decimal(15,4)) as opening_balance from part""",
    "mst_opening_batch_allocation": """
        select 'Primary Batch' as name, 'P' || p_partkey as item,
          cast(p_size as decimal(15,4)) as opening_balance,
          cast(cast(p_retailprice as decimal(17,2)) * p_size as decimal(17,2)) as opening_value,
          'Main' as godown from part""",
    "mst_opening_bill_allocation": """
        select c_name as ledger, cast(-c_acctbal as decimal(17,4)) as opening_balance,
          date '1995-01-01' as bill_date, 'OB' || c_custkey as name, 30 as bill_credit_period
        from customer""",
    "trn_closingstock_ledger": """
        select 'Stock' || (user_id % 5) as ledger, cast(ts as date) as stock_date,
          cast(max(value) as decimal(17,2)) as stock_value
        from events group by 1, 2""",
    "inv_line": """
        select l_orderkey // 10 as b, l_orderkey % 10 as m, l_orderkey as k, 'P' || l_partkey as item,
          cast(case when l_orderkey % 10 in (2, 3) then l_quantity else -l_quantity end as decimal(15,4)) as quantity,
          cast(l_extendedprice as decimal(17,2)) as amount,
          case when l_orderkey % 10 = 8 and l_linenumber % 3 = 0 then 'T' || (l_orderkey // 10) else '' end
            as tracking_number
        from lineitem""",
    "trn_inventory": """
        select 'V' || k as guid, item, quantity, amount, 'Main' as godown, tracking_number from inv_line
        union all
        select 'V' || (10 * b + 1), item,
          cast(quantity * (case when b % 3 = 0 then 1 else 2 end) as decimal(15,4)), amount, 'Main',
          tracking_number
        from inv_line where tracking_number <> '' and b % 3 < 2""",
}


def with_books(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it needs, directly or through other CTEs."""
    ctes = {**CTES, **(extra or {})}
    needed: list[str] = []

    def need(text: str) -> None:
        for name, body in ctes.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(body)
                if name not in needed:
                    needed.append(name)

    need(sql)
    prefix = ",\n".join(f"{n} as ({ctes[n]})" for n in needed)
    if sql.lstrip().lower().startswith("with recursive"):
        return f"with recursive {prefix},\n{sql.lstrip()[len('with recursive'):]}"
    if sql.lstrip().lower().startswith("with"):
        return f"with {prefix},\n{sql.lstrip()[len('with'):]}"
    return f"with {prefix}\n{sql}"
