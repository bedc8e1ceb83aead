"""Statements: amendments, year-to-date to single quarter, derived fields, account mapping, merges with market data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import or_missing, round_half_up, truthy
from tidemark.operators.asof import first_source, latest_n

# Account names by field, in order of preference.
KR_ACCOUNTS = {
    "revenue": ["매출액", "영업수익"],
    "operating_income": ["영업이익", "영업이익(손실)"],
    "net_income": ["당기순이익", "당기순이익(손실)", "분기순이익", "반기순이익"],
    "total_assets": ["자산총계"],
    "total_liabilities": ["부채총계"],
    "total_equity": ["자본총계"],
    "current_assets": ["유동자산"],
    "current_liabilities": ["유동부채"],
    "gross_profit": ["매출총이익", "매출총손익"],
    "total_debt": ["차입금합계", "총차입금", "단기차입금", "차입금", "금융부채", "사채 및 차입금"],
    "eps": ["주당순이익", "주당이익", "기본주당이익"],
    "interest_expense": ["이자비용"],
    "operating_cash_flow": ["영업활동현금흐름", "영업활동으로 인한 현금흐름"],
    "capital_expenditure": ["유형자산의취득", "유형자산취득"],
    "cost_of_goods_sold": ["매출원가"],
    "cash_and_equivalents": ["현금및현금성자산", "현금 및 현금성자산"],
    "inventory": ["재고자산"],
    "accounts_receivable": ["매출채권", "매출채권 및 기타채권"],
}
US_ACCOUNTS = {
    "revenue": ["Total Revenue", "Operating Revenue"],
    "cost_of_goods_sold": ["Cost Of Revenue", "Reconciled Cost Of Revenue"],
    "gross_profit": ["Gross Profit"],
    "operating_income": ["Operating Income", "Total Operating Income As Reported"],
    "net_income": ["Net Income", "Net Income Common Stockholders"],
    "ebitda": ["EBITDA", "Normalized EBITDA"],
    "eps": ["Basic EPS", "Diluted EPS"],
    "interest_expense": ["Interest Expense"],
    "total_assets": ["Total Assets"],
    "total_liabilities": ["Total Liabilities Net Minority Interest"],
    "total_equity": ["Stockholders Equity", "Total Equity Gross Minority Interest"],
    "current_assets": ["Current Assets"],
    "current_liabilities": ["Current Liabilities"],
    "total_debt": ["Total Debt"],
    "cash_and_equivalents": ["Cash And Cash Equivalents", "Cash Cash Equivalents And Short Term Investments"],
    "inventory": ["Inventory"],
    "accounts_receivable": ["Accounts Receivable", "Receivables"],
    "issued_shares": ["Ordinary Shares Number", "Share Issued"],
    "operating_cash_flow": ["Operating Cash Flow"],
    "capital_expenditure": ["Capital Expenditure"],
    "free_cash_flow": ["Free Cash Flow"],
    "dividends_paid": ["Cash Dividends Paid"],
}


def latest_amendment(reports: DataFrame, keys: Sequence[str], received: str, number: str) -> DataFrame:
    """Of several filings for one period the one received last; equal dates go to the higher number."""
    return latest_n(reports, keys, [F.desc(received), F.desc(number)], 1)


def latest_filing(filings: DataFrame, key: str, is_annual: Column, received: str, number: str) -> DataFrame:
    """One filing per company: annual reports first, then the latest."""
    return latest_n(filings, [key], [F.desc(is_annual), F.desc(received), F.desc(number)], 1)


def uncumulate(statements: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("ticker",), year: str = "fy", quarter: str = "fq", digits: int | None = None) -> DataFrame:
    """Year-to-date flows to single quarters: the difference from the previous quarter of the same year.

    First quarters and nulls stay; where the previous quarter is absent the result is null, which a bare lag would miss.
    """
    w = Window.partitionBy(*keys, year).orderBy(quarter)
    adjacent = F.lag(quarter).over(w) == F.col(quarter) - 1
    out = {}
    for f in fields:
        diff = F.when(adjacent, F.col(f) - F.lag(f).over(w))
        value = F.when(F.col(quarter) == 1, F.col(f)).otherwise(diff)
        out[f] = value if digits is None else round_half_up(value, digits)
    return statements.withColumns(out)


def derive_fields(df: DataFrame) -> DataFrame:
    """Gross profit, EBITDA and free cash flow where they are missing; 0 counts as missing."""
    both = lambda a, b: or_missing(F.col(a)).isNotNull() & or_missing(F.col(b)).isNotNull()
    gross = F.when(both("revenue", "cost_of_goods_sold"), F.col("revenue") - F.col("cost_of_goods_sold"))
    own = lambda c: or_missing(F.col(c)) if c in df.columns else F.lit(None).cast("double")
    return df.withColumns(
        {
            "gross_profit": F.coalesce(own("gross_profit"), gross),
            "ebitda": F.coalesce(own("ebitda"), F.col("operating_income")),
            "free_cash_flow": F.when(both("operating_cash_flow", "capital_expenditure"), F.col("operating_cash_flow") - F.abs("capital_expenditure")),
        }
    )


def drop_empty(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.where(F.coalesce(*(F.col(f).cast("double") for f in fields)).isNotNull())


def map_accounts(lines: DataFrame, keys: Sequence[str], account: str, value: str, row_no: str, accounts: dict[str, list[str]]) -> DataFrame:
    """Statement lines to one row per key with a column per field.

    For each field the candidates are tried in order, first for equal names, then for contained ones; a line whose
    amount cannot be read is skipped. Each field's best match of a line is an expression over its few fixed candidates,
    so the lines are aggregated without a join.
    """
    readable = lines.where(F.col(value).isNotNull())

    def best(candidates: list[str]) -> Column:
        name, n = F.col(account), len(candidates)  # the first equal candidate, else the first contained one, ranks a line
        rank = F.coalesce(*(F.when(name == c, i) for i, c in enumerate(candidates)), *(F.when(name.contains(c), n + i) for i, c in enumerate(candidates)))
        return F.min_by(value, rank.cast("bigint") * 1_000_000_000_000 + F.col(row_no))  # a number, so that nothing is sorted

    out = readable.groupBy(*keys).agg(*(best(cs).alias(f) for f, cs in accounts.items()))
    return out.where(F.greatest(*(F.col(f).isNotNull() for f in accounts), F.lit(False)))


def map_wide_accounts(wide: DataFrame, keys: Sequence[str], accounts: dict[str, list[str]]) -> DataFrame:
    """First non-null of a field's named columns; columns that the source lacks are passed over."""
    null = F.lit(None).cast("double")
    return wide.select(*keys, *(F.coalesce(*(F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in cs if c in wide.columns), null).alias(f) for f, cs in accounts.items()))


def merge_market(statements: DataFrame, market: DataFrame, price: DataFrame) -> DataFrame:
    """Statements with shares, EPS, cap and close filled from market data, each a left join on ticker.

    Issued shares fill every quarter that lacks them; EPS follows from income (in millions) and shares when it is
    null; the close comes from the statement, else the market snapshot, else the last price.
    """
    m = market.select("ticker", F.col("market_cap").alias("m_cap"), F.col("last_close").alias("m_close"), F.col("issued_shares").alias("m_shares"))
    p = price.select("ticker", F.col("last_close").alias("p_close"))
    out = statements.join(m, "ticker", "left").join(p, "ticker", "left")
    own = lambda c: F.col(c) if c in statements.columns else F.lit(None).cast("double")
    shares = F.coalesce(own("issued_shares"), F.col("m_shares"))
    filled = F.when(F.col("eps").isNull() & truthy(F.col("net_income")) & truthy(shares), round_half_up(F.col("net_income") * 1e6 / shares))
    return out.withColumns(
        {"eps": F.coalesce("eps", filled), "issued_shares": shares, "market_cap": F.coalesce(own("market_cap"), "m_cap"), "last_close_price": F.coalesce(own("last_close_price"), or_missing(F.col("m_close")), "p_close")}
    ).drop("m_cap", "m_close", "m_shares", "p_close")


def implied_shares(caps: DataFrame, close: str, cap_hundred_millions: str) -> DataFrame:
    """Caps in units of 1e8 to whole money and implied shares; rows without a positive close and cap go."""
    ok = caps.where((F.col(close) > 0) & (F.col(cap_hundred_millions) > 0))
    money = F.floor(F.col(cap_hundred_millions) * 1e8 + 0.5).cast("bigint")
    return ok.withColumn("market_cap", money).withColumn("issued_shares", F.floor(F.col("market_cap") / F.col(close) + 0.5).cast("bigint"))


def unband_valuation(rows: DataFrame, price: Column, e_band: Column, e_mult: Column, b_band: Column, b_mult: Column) -> DataFrame:
    """Earnings and book value per share from price bands, then PER and PBR; zeros give null."""
    eps = F.try_divide(e_band, or_missing(e_mult))
    bps = F.try_divide(b_band, or_missing(b_mult))
    return rows.withColumns({"eps": eps, "bps": bps, "per": F.try_divide(price, or_missing(eps)), "pbr": F.try_divide(price, or_missing(bps))})


def prefer_consolidated(lines: DataFrame, keys: Sequence[str] = ("corp", "bsns_year", "reprt_code"), kind: str = "fs_div") -> DataFrame:
    """Consolidated lines (CFS) of a report where it has any, else its separate ones (OFS)."""
    return first_source([lines.where(F.col(kind) == "CFS"), lines.where(F.col(kind) == "OFS")], keys)


def three_statements(income: DataFrame, balance: DataFrame, cash: DataFrame, keys: Sequence[str] = ("ticker", "period_end")) -> DataFrame:
    """Income statements with their balance sheet and cash flow of the same period end; income drives, the others may lack."""
    return income.join(balance, list(keys), "left").join(cash, list(keys), "left")
