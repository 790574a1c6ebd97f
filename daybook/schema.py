"""The fixed relational schema: 33 tables of accounting masters and transactions.

Column names and precisions are fixed values: they are the contract with whoever queries
the tables. The kind of a column follows from its name unless ``kinds`` says otherwise:

* ``is_*``, ``affects_*``, ``allocate_*``        -> logical (tinyint 0/1)
* ``date``, ``*_date``, ``date_of_*``, ``*_duedate``, ``applicable_from``, ``manufactured_on`` -> date
* everything else                                 -> text
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# kind -> Spark SQL type
TYPES = {
    "text": "string",
    "logical": "tinyint",
    "date": "date",
    "int": "int",
    "days": "int",
    "number": "decimal(15,4)",
    "marked": "decimal(15,4)",
    "percent": "decimal(9,4)",
    "amount": "decimal(17,2)",
    "bill_amount": "decimal(17,4)",
    "quantity": "decimal(15,4)",
    "time": "decimal(17,2)",
    "rate": "decimal(15,4)",
}

_LOGICAL = re.compile(r"^(is|affects|allocate)_")
_DATE = re.compile(r"^(date|.*_date|date_of_.*|.*_duedate|applicable_from|manufactured_on)$")


@dataclass(frozen=True)
class Table:
    """One target table: where its rows come from and how its columns are typed."""

    name: str
    path: str  # collection, then the nested lists below it, dot separated
    columns: tuple[str, ...]
    kinds: dict[str, str] = field(default_factory=dict)
    payroll_only: bool = False

    @property
    def nature(self) -> str:
        return "Primary" if "." not in self.path and "guid" in self.columns else "Derived"

    @property
    def half(self) -> str:
        """``master`` or ``transaction``: which part of a sync loads the table."""
        return "transaction" if self.path.split(".")[0] == "voucher" else "master"

    def kind(self, column: str) -> str:
        if column in self.kinds:
            return self.kinds[column]
        if _LOGICAL.match(column):
            return "logical"
        return "date" if _DATE.match(column) else "text"

    def type(self, column: str) -> str:
        return TYPES[self.kind(column)]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c}` {self.type(c)}" for c in self.columns)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


def _table(name: str, path: str, columns: str, payroll_only: bool = False, **kinds: str) -> Table:
    by_column = {c: kind for kind, cols in kinds.items() for c in cols.split()}
    return Table(name, path, tuple(columns.split()), by_column, payroll_only)


_LINE = "voucher.allledgerentries"
_ITEM = "voucher.allinventoryentries"

# Table names, column names and precisions.
_MASTERS = [
    _table("mst_group", "group",
           "guid name parent primary_group is_revenue is_deemedpositive is_reserved "
           "affects_gross_profit sort_position", int="sort_position"),
    _table("mst_ledger", "ledger",
           "guid name parent alias description notes is_revenue is_deemedpositive opening_balance "
           "closing_balance mailing_name mailing_address mailing_state mailing_country "
           "mailing_pincode email mobile it_pan gstn gst_registration_type gst_supply_type "
           "gst_duty_head tax_rate bank_account_holder bank_account_number bank_ifsc bank_swift "
           "bank_name bank_branch bill_credit_period",
           amount="opening_balance closing_balance", percent="tax_rate", days="bill_credit_period"),
    _table("mst_vouchertype", "vouchertype",
           "guid name parent numbering_method is_deemedpositive affects_stock"),
    _table("mst_uom", "unit",
           "guid name formalname is_simple_unit base_units additional_units conversion",
           number="conversion"),
    _table("mst_godown", "godown", "guid name parent address"),
    _table("mst_stock_category", "stockcategory", "guid name parent"),
    _table("mst_stock_group", "stockgroup", "guid name parent"),
    _table("mst_stock_item", "stockitem",
           "guid name parent category alias description notes part_number uom alternate_uom "
           "conversion opening_balance opening_rate opening_value closing_balance closing_rate "
           "closing_value costing_method gst_type_of_supply gst_hsn_code gst_hsn_description "
           "gst_rate gst_taxability",
           number="conversion", marked="opening_balance closing_balance",
           rate="opening_rate closing_rate", amount="opening_value closing_value",
           percent="gst_rate"),
    _table("mst_cost_category", "costcategory", "guid name allocate_revenue allocate_non_revenue"),
    _table("mst_cost_centre", "costcentre", "guid name parent category"),
    _table("mst_attendance_type", "attendancetype",
           "guid name parent uom attendance_type attendance_period"),
    _table("mst_employee", "costcentre",
           "guid name parent id_number date_of_joining date_of_release designation function_role "
           "location gender date_of_birth blood_group father_mother_name spouse_name address mobile "
           "email pan aadhar uan pf_number pf_joining_date pf_relieving_date pr_account_number",
           payroll_only=True),
    _table("mst_payhead", "ledger",
           "guid name parent payslip_name pay_type income_type calculation_type leave_type "
           "calculation_period", payroll_only=True),
    _table("mst_gst_effective_rate", "stockitem.gstdetails.statewisedetails.ratedetails",
           "item applicable_from hsn_description hsn_code duty_head rate rate_per_unit "
           "valuation_type is_rcm_applicable nature_of_transaction nature_of_goods supply_type "
           "taxability", percent="rate rate_per_unit"),
    _table("mst_opening_batch_allocation", "stockitem.batchallocations",
           "name item opening_balance opening_rate opening_value godown manufactured_on",
           marked="opening_balance", rate="opening_rate", amount="opening_value"),
    _table("mst_opening_bill_allocation", "ledger.billallocations",
           "ledger opening_balance bill_date name bill_credit_period is_advance",
           bill_amount="opening_balance", days="bill_credit_period"),
    _table("trn_closingstock_ledger", "ledger.ledgerclosingvalues",
           "ledger stock_date stock_value", amount="stock_value"),
    _table("mst_stockitem_standard_cost", "stockitem.standardcostlist", "item date rate", rate="rate"),
    _table("mst_stockitem_standard_price", "stockitem.standardpricelist", "item date rate", rate="rate"),
]

_TRANSACTIONS = [
    _table("trn_voucher", "voucher",
           "guid date voucher_type voucher_number reference_number reference_date narration "
           "party_name place_of_supply is_invoice is_accounting_voucher is_inventory_voucher "
           "is_order_voucher"),
    _table("trn_accounting", _LINE, "guid ledger amount amount_forex currency",
           amount="amount amount_forex"),
    _table("trn_inventory", _ITEM,
           "guid item quantity rate amount additional_amount discount_amount godown "
           "tracking_number order_number order_duedate",
           quantity="quantity", rate="rate", amount="amount additional_amount discount_amount"),
    _table("trn_cost_centre", f"{_LINE}.costcentreallocations",
           "guid ledger costcentre amount", amount="amount"),
    _table("trn_cost_category_centre", f"{_LINE}.categoryallocations.costcentreallocations",
           "guid ledger costcategory costcentre amount", amount="amount"),
    _table("trn_cost_inventory_category_centre",
           f"{_LINE}.inventoryallocations.categoryallocations.costcentreallocations",
           "guid ledger item costcategory costcentre amount", amount="amount"),
    _table("trn_bill", f"{_LINE}.billallocations",
           "guid ledger name amount billtype bill_credit_period",
           amount="amount", days="bill_credit_period"),
    _table("trn_bank", f"{_LINE}.bankallocations",
           "guid ledger transaction_type instrument_date instrument_number bank_name amount "
           "bankers_date", amount="amount"),
    _table("trn_batch", f"{_ITEM}.batchallocations",
           "guid item name quantity amount godown destination_godown tracking_number",
           quantity="quantity", amount="amount"),
    _table("trn_inventory_additional_cost", "voucher.ledgerentries",
           "guid ledger amount additional_allocation_type rate_of_invoice_tax",
           amount="amount", percent="rate_of_invoice_tax"),
    _table("trn_employee", "voucher.categoryentry.employeeentry",
           "guid category employee_name amount employee_sort_order",
           amount="amount", int="employee_sort_order"),
    _table("trn_payhead", "voucher.categoryentry.employeeentry.payheadallocations",
           "guid category employee_name employee_sort_order payhead_name payhead_sort_order amount",
           amount="amount", int="employee_sort_order payhead_sort_order"),
    _table("trn_attendance", "voucher.attendanceentries",
           "guid employee_name attendancetype_name time_value type_value",
           amount="time_value", time="type_value"),
]

CONFIG = Table("config", "", ("name", "value"))
TABLES: dict[str, Table] = {t.name: t for t in [*_MASTERS, *_TRANSACTIONS]}


def tables(half: str | None = None, nature: str | None = None) -> list[Table]:
    """Tables of one half (``master``/``transaction``) and nature (``Primary``/``Derived``)."""
    return [t for t in TABLES.values()
            if half in (None, t.half) and nature in (None, t.nature)]


# Which column of which table names a row of which master, as (table, column). In the
# incremental schema each such column ``x`` has a sibling ``_x`` holding the guid of the named row.
# A rename of the master is carried over to these columns.
_RENAMED_LINKS = {
    "mst_group": [
        ("mst_group", "parent"),
        ("mst_ledger", "parent"),
    ],
    "mst_ledger": [
        ("trn_accounting", "ledger"),
        ("trn_cost_centre", "ledger"),
        ("trn_cost_category_centre", "ledger"),
        ("trn_cost_inventory_category_centre", "ledger"),
        ("trn_bill", "ledger"),
        ("trn_bank", "ledger"),
        ("trn_inventory_additional_cost", "ledger"),
        ("trn_payhead", "payhead_name"),
    ],
    "mst_vouchertype": [
        ("mst_vouchertype", "parent"),
        ("trn_voucher", "voucher_type"),
    ],
    "mst_uom": [
        ("mst_stock_item", "uom"),
    ],
    "mst_godown": [
        ("mst_godown", "parent"),
        ("mst_opening_batch_allocation", "godown"),
        ("trn_inventory", "godown"),
        ("trn_batch", "godown"),
        ("trn_batch", "destination_godown"),
    ],
    "mst_stock_category": [
        ("mst_stock_item", "category"),
    ],
    "mst_stock_group": [
        ("mst_stock_group", "parent"),
        ("mst_stock_item", "parent"),
    ],
    "mst_stock_item": [
        ("trn_inventory", "item"),
        ("trn_batch", "item"),
        ("trn_cost_inventory_category_centre", "item"),
        ("mst_stockitem_standard_cost", "item"),
        ("mst_stockitem_standard_price", "item"),
    ],
    "mst_cost_category": [
        ("trn_cost_category_centre", "costcategory"),
        ("trn_cost_inventory_category_centre", "costcategory"),
        ("trn_employee", "category"),
        ("trn_payhead", "category"),
    ],
    "mst_cost_centre": [
        ("mst_cost_centre", "parent"),
        ("trn_cost_centre", "costcentre"),
        ("trn_cost_category_centre", "costcentre"),
        ("trn_cost_inventory_category_centre", "costcentre"),
        ("trn_employee", "employee_name"),
        ("trn_payhead", "employee_name"),
        ("trn_attendance", "employee_name"),
    ],
    "mst_attendance_type": [
        ("trn_attendance", "attendancetype_name"),
    ],
}

# Columns that name a master as well, to which a rename is not carried over.
_FIXED_LINKS = {
    "mst_ledger": [
        ("mst_opening_bill_allocation", "ledger"),
        ("trn_closingstock_ledger", "ledger"),
        ("trn_voucher", "party_name"),
        ("mst_payhead", "parent"),
    ],
    "mst_uom": [
        ("mst_stock_item", "alternate_uom"),
        ("mst_attendance_type", "uom"),
    ],
    "mst_stock_category": [
        ("mst_stock_category", "parent"),
    ],
    "mst_stock_item": [
        ("mst_gst_effective_rate", "item"),
        ("mst_opening_batch_allocation", "item"),
    ],
    "mst_cost_category": [
        ("mst_employee", "parent"),
    ],
    "mst_attendance_type": [
        ("mst_attendance_type", "parent"),
    ],
}


@dataclass(frozen=True)
class Link:
    master: str
    table: str
    column: str
    renames: bool

    @property
    def key(self) -> str:
        return f"_{self.column}"


LINKS: list[Link] = [
    Link(master, table, column, renames)
    for links, renames in ((_RENAMED_LINKS, True), (_FIXED_LINKS, False))
    for master, entries in links.items() for table, column in entries
]


def links_of(table: str) -> dict[str, Link]:
    """The columns of ``table`` that name a master row."""
    return {link.column: link for link in LINKS if link.table == table}


def incremental_columns(table: Table) -> list[tuple[str, str]]:
    """``(column, type)`` of the incremental schema: alterid after guid, ``_x`` after ``x``."""
    links, out = links_of(table.name), []
    for column in table.columns:
        out.append((column, table.type(column)))
        if column == "guid" and table.nature == "Primary":
            out.append(("alterid", "bigint"))
        if column in links:
            out.append((f"_{column}", "string"))
    return out
