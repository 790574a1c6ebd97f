"""Where each column of each table comes from in the exported documents.

A column is read from the field of the same name without underscores, looked up from the
innermost object outwards, unless a source or a rule says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions import decode as D
from daybook.functions import fields as E
from daybook.operators.reshape import Rows
from daybook.schema import TABLES, Table

# The field of a column, where it is not the column name without underscores.
SOURCES: dict[str, dict[str, str]] = {
    "mst_group": {
        "primary_group": "_primarygroup",
    },
    "mst_ledger": {
        "alias": "onlyalias",
        "notes": "narration",
        "mailing_address": "address",
        "mailing_state": "ledstatename",
        "mailing_country": "countryname",
        "mailing_pincode": "pincode",
        "mobile": "ledgermobile",
        "it_pan": "incometaxnumber",
        "gstn": "partygstin",
        "gst_supply_type": "gsttypeofsupply",
        "tax_rate": "rateoftaxcalculation",
        "bank_account_holder": "bankaccholdername",
        "bank_account_number": "bankdetails",
        "bank_ifsc": "ifscode",
        "bank_swift": "swiftcode",
        "bank_name": "bankingconfigbank",
        "bank_branch": "bankbranchname",
    },
    "mst_uom": {
        "name": "symbol",
    },
    "mst_stock_item": {
        "alias": "onlyalias",
        "notes": "narration",
        "part_number": "partno",
        "uom": "baseunits",
        "alternate_uom": "additionalunits",
        "gst_type_of_supply": "gstmsttypeofsupply",
        "gst_hsn_code": "infgsthsncode",
        "gst_hsn_description": "infgsthsndescription",
        "gst_rate": "infgstigstrate",
        "gst_taxability": "infgsttaxablility",
    },
    "mst_attendance_type": {
        "uom": "baseunits",
        "attendance_type": "attendanceproductiontype",
    },
    "mst_employee": {
        "id_number": "mailingname",
        "date_of_joining": "dateofjoin",
        "date_of_release": "deactivationdate",
        "function_role": "function",
        "father_mother_name": "fathername",
        "mobile": "mobilenumber",
        "email": "emailid",
        "pan": "pannumber",
        "aadhar": "aadharnumber",
        "uan": "uannumber",
        "pf_number": "pfaccountnumber",
    },
    "mst_payhead": {
        "income_type": "paystattype",
    },
    "mst_gst_effective_rate": {
        "item": "name",
        "hsn_description": "hsn",
        "duty_head": "gstratedutyhead",
        "rate": "gstrate",
        "rate_per_unit": "gstrateperunit",
        "valuation_type": "gstratevaluationtype",
        "is_rcm_applicable": "isreversechargeapplicable",
        "nature_of_transaction": "gstnatureoftransaction",
    },
    "mst_opening_batch_allocation": {
        "name": "batchname",
        "item": "..name",
        "godown": "godownname",
        "manufactured_on": "mfdon",
    },
    "mst_opening_bill_allocation": {
        "ledger": "..name",
    },
    "trn_closingstock_ledger": {
        "ledger": "..name",
        "stock_date": "date",
        "stock_value": "amount",
    },
    "mst_stockitem_standard_cost": {
        "item": "..name",
    },
    "mst_stockitem_standard_price": {
        "item": "..name",
    },
    "trn_voucher": {
        "voucher_type": "vouchertypename",
        "reference_number": "reference",
        "party_name": "partyledgername",
    },
    "trn_accounting": {
        "ledger": "ledgername",
    },
    "trn_inventory": {
        "item": "stockitemname",
        "quantity": "actualqty",
        "additional_amount": "addlamount",
        "discount_amount": "discount",
        "godown": "godownname",
        "order_number": "orderno",
    },
    "trn_cost_centre": {
        "ledger": "ledgername",
        "costcentre": "name",
    },
    "trn_cost_category_centre": {
        "ledger": "ledgername",
        "costcategory": "category",
        "costcentre": "name",
    },
    "trn_cost_inventory_category_centre": {
        "ledger": "ledgername",
        "item": "stockitemname",
        "costcategory": "category",
        "costcentre": "name",
    },
    "trn_bill": {
        "ledger": "ledgername",
    },
    "trn_bank": {
        "ledger": "..ledgername",
    },
    "trn_batch": {
        "item": "stockitemname",
        "name": "batchname",
        "quantity": "actualqty",
        "godown": "godownname",
        "destination_godown": "destinationgodownname",
    },
    "trn_inventory_additional_cost": {
        "ledger": "ledgername",
        "additional_allocation_type": "addlalloctype",
    },
    "trn_attendance": {
        "employee_name": "name",
        "attendancetype_name": "attendancetype",
        "time_value": "attdtypetimevalue",
        "type_value": "attdtypevalue",
    },
}

# Base voucher types by their effect; any other type has none of the three.
ACCOUNTING_TYPES = ["Journal", "Receipt", "Payment", "Contra", "Purchase", "Sales", "Credit Note",
                    "Debit Note"]
INVENTORY_TYPES = ["Receipt Note", "Delivery Note", "Stock Journal"]
ORDER_TYPES = ["Purchase Order", "Sales Order"]

Rule = Callable[[Rows, str], Column]


def source(table: Table, column: str) -> str:
    return SOURCES.get(table.name, {}).get(column, column.replace("_", ""))


def _on_text(fn: Callable[[Column], Column]) -> Rule:
    return lambda rows, field: fn(rows.raw(field))


def _joined(rows: Rows, field: str) -> Column:
    return E.joined(rows.values(field))


def _or_last(member: str) -> Rule:
    """Own value, else that of the last tax registration."""
    def rule(rows: Rows, field: str) -> Column:
        registrations = rows.entries_with("ledgstregdetails", member)
        own = rows.raw(field)
        return own if registrations is None else E.first_or_last_of(own, registrations, member)
    return rule


def _mobile(rows: Rows, field: str) -> Column:
    number = rows.raw(field)
    return E.formatted("%s %s", number, rows.raw("ledgercountryisdcode"), number)


def _type_in(types: list[str]) -> Rule:
    def rule(rows: Rows, field: str) -> Column:
        base = rows.raw("basevouchertype" if rows.has("basevouchertype") else "vouchertypename")
        return F.when(base.isin(types), "Yes").otherwise("No")
    return rule


# (table, column) -> rule; "*" applies to every table
RULES: dict[tuple[str, str], Rule] = {
    ("*", "parent"): _on_text(E.blank_root),
    ("mst_vouchertype", "parent"): _on_text(lambda c: c),
    ("mst_godown", "parent"): _on_text(lambda c: c),
    ("*", "address"): _joined,
    ("mst_ledger", "mailing_address"): _joined,
    ("mst_ledger", "mobile"): _mobile,
    ("mst_ledger", "gstn"): _or_last("gstin"),
    ("mst_ledger", "gst_registration_type"): _or_last("gstregistrationtype"),
    ("mst_employee", "gender"): _on_text(E.blank_unknown),
    ("trn_accounting", "currency"): _on_text(lambda c: c),
    ("trn_voucher", "is_accounting_voucher"): _type_in(ACCOUNTING_TYPES),
    ("trn_voucher", "is_inventory_voucher"): _type_in(INVENTORY_TYPES),
    ("trn_voucher", "is_order_voucher"): _type_in(ORDER_TYPES),
    **{(t, c): _on_text(E.blank_not_applicable) for t, c in [
        ("mst_stock_item", "category"), ("mst_stock_item", "uom"), ("mst_stock_item", "alternate_uom"),
        ("mst_attendance_type", "uom"), ("mst_payhead", "pay_type"), ("mst_payhead", "income_type"),
        ("mst_gst_effective_rate", "valuation_type"), ("trn_inventory", "tracking_number"),
        ("trn_inventory", "order_number"), ("trn_batch", "tracking_number")]},
}

# Nested lists and plain-value lists read by rules rather than by a table path.
EXTRA_FIELDS = {
    "ledger": ["ledgercountryisdcode", "ledgstregdetails.gstin",
               "ledgstregdetails.gstregistrationtype", "forpayroll"],
    "costcentre": ["forpayroll"],
    "stockitem": ["gstapplicable"],
    "voucher": ["iscancelled", "isoptional"],
}
PLAIN_LISTS = {"ledger": ["address"], "godown": ["address"], "costcentre": ["address"]}


def raw_value(rows: Rows, table: Table, column: str) -> Column:
    """The text a column is decoded from, all source rules applied."""
    rule = RULES.get((table.name, column)) or RULES.get(("*", column))
    field = source(table, column)
    return rule(rows, field) if rule else rows.raw(field)


def value(rows: Rows, table: Table, column: str) -> Column:
    """The typed value of a column."""
    kind = table.kind(column)
    if (table.name, column) == ("trn_accounting", "amount_forex"):
        return D.foreign_amount(rows.raw("amount"))
    if (table.name, column) == ("trn_accounting", "currency"):
        return D.currency_symbol(rows.raw("amount"))
    decoded = D.decode(kind, raw_value(rows, table, column))
    if kind == "quantity":
        inward = D.logical(rows.raw("isdeemedpositive")) == 1
        return D.signed_quantity(decoded, inward).cast(table.type(column))
    return decoded


def collections() -> dict[str, list[Table]]:
    """Tables by the collection their documents come from."""
    out: dict[str, list[Table]] = {}
    for table in TABLES.values():
        out.setdefault(table.path.split(".")[0], []).append(table)
    return out
