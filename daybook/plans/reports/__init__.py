"""The report library: one function per report, ``report(books, ...) -> DataFrame``."""

from daybook.plans.reports.bills import bill_status, bills_payable, bills_receivable, outstanding
from daybook.plans.reports.ledgers import (
    account_statement, accounting_effects, accounting_voucher_view, ledger_closing_balances,
    profit_and_loss, trial_balance,
)
from daybook.plans.reports.stock import (
    closing_stock_value, inventory_effects, inventory_effects_first_event,
    inventory_effects_notes_only, stock_summary, stock_voucher_view,
)
from daybook.plans.reports.trade import (
    create_views, daily_cash_movement, purchase_daily, purchase_monthly, purchase_register,
    purchase_view, sales_daily, sales_monthly, sales_register, sales_view,
)

__all__ = [
    "account_statement", "accounting_effects", "accounting_voucher_view", "bill_status",
    "bills_payable", "bills_receivable", "closing_stock_value", "create_views",
    "daily_cash_movement", "inventory_effects", "inventory_effects_first_event",
    "inventory_effects_notes_only", "ledger_closing_balances", "outstanding", "profit_and_loss",
    "purchase_daily", "purchase_monthly", "purchase_register", "purchase_view", "sales_daily",
    "sales_monthly", "sales_register", "sales_view", "stock_summary", "stock_voucher_view",
    "trial_balance",
]
