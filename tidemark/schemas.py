"""Canonical tables. Money is DOUBLE in the reporting unit; tickers are strings and keep their leading zeros."""

from __future__ import annotations

FLOWS = ["revenue", "operating_income", "net_income", "gross_profit", "eps", "interest_expense", "operating_cash_flow", "capital_expenditure", "cost_of_goods_sold", "ebitda", "free_cash_flow"]
INCOME = ["revenue", "cost_of_goods_sold", "gross_profit", "operating_income", "net_income", "ebitda", "eps", "interest_expense", "dividends_per_share"]
BALANCE = ["total_assets", "total_liabilities", "total_equity", "current_assets", "current_liabilities", "total_debt", "cash_and_equivalents", "inventory", "accounts_receivable", "issued_shares"]
CASH = ["operating_cash_flow", "capital_expenditure", "free_cash_flow", "dividends_paid"]

PRICES = "ticker string, date date, open double, high double, low double, close double, volume double"
FINANCIALS = "ticker string, fiscal_quarter string, report_date date, available_date date, " + ", ".join(f"{c} double" for c in INCOME + BALANCE + CASH)
FILINGS = "ticker string, filing_date date, filing_type string, business_overview string, risks string, mda string, governance string"
NEWS = "ticker string, date date, published_at timestamp, source string, headline string, summary string, url string"
MACRO = "category string, key string, period string, date date, value_num double, value_str string"
UNIVERSE = "ticker string, market string, sector string, name string"
SECTORS = "ticker string, sector string, as_of_date date"
MARKET_CAP = "ticker string, name string, market string, close bigint, market_cap bigint, issued_shares bigint, trade_date date"
VALUATION = "ticker string, market string, target_month_end date, source_month string, per double, pbr double, eps double"
NEWS_META = "ticker string, day date, status string, crawl_dates array<date>, raw_count bigint, page_cap boolean"
CHECKS = "check string, entity string, status string, detail string, metrics map<string,double>"
