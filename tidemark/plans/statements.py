"""Statements, sectors and snapshots, with their checks in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import last_business_day
from tidemark.functions.hashing import md5_seed
from tidemark.functions.numbers import round_half_up
from tidemark.operators import asof, fundamentals, quality, sectors
from tidemark.plans.market import AS_OF, day, last_close_asof
from tidemark.snapshot import content_hash
from tidemark.sources import adapters as A
from tidemark.sources.adapters import with_tables

FIELDS = ["revenue", "operating_income", "net_income", "total_assets", "total_equity", "current_assets", "current_liabilities", "total_debt", "eps"]
R4 = "floor({} * 10000 + 0.5) / 10000"


def quarter_uncumulate(spark: SparkSession, sf: str) -> DataFrame:
    out = fundamentals.uncumulate(A.statements(spark, sf), A.YTD, digits=1)
    return out.select("ticker", "fiscal_quarter", *A.YTD, "total_assets")


def report_latest_amendment(spark: SparkSession, sf: str) -> DataFrame:
    return fundamentals.latest_amendment(A.report_list(spark, sf).where("rcept_dt <= '19991231'"), ["corp", "bsns_year", "q"], "rcept_dt", "rcept_no")


def latest_filing(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.report_list(spark, sf).where("rcept_dt <= '19991231'")
    return fundamentals.latest_filing(rows, "corp", F.col("q") == 4, "rcept_dt", "rcept_no")


def quarters_latest8(spark: SparkSession, sf: str) -> DataFrame:
    known = asof.as_of_cut(A.statements(spark, sf), day(), "report_date")
    return asof.latest_n(known, ["ticker"], [F.desc("report_date")], 8).select("ticker", "fiscal_quarter", "report_date", "revenue")


def quarters_lagged_availability(spark: SparkSession, sf: str) -> DataFrame:
    known = asof.as_of_cut(A.statements(spark, sf), day(), "period_end", 60)
    return known.groupBy("ticker").agg(F.count("*").alias("n"), F.max("period_end").alias("last_period_end"))


def statement_derived_fields(spark: SparkSession, sf: str) -> DataFrame:
    out = fundamentals.derive_fields(A.statements(spark, sf))
    return out.select("ticker", "fiscal_quarter", *(round_half_up(F.col(c), 2).alias(c) for c in ("gross_profit", "ebitda", "free_cash_flow")))


def _latest_quarter(spark: SparkSession, sf: str) -> DataFrame:
    single = fundamentals.derive_fields(fundamentals.uncumulate(A.statements(spark, sf), A.YTD))
    return asof.latest_n(asof.as_of_cut(single, day(), "report_date"), ["ticker"], [F.desc("report_date")], 1)


def fundamentals_merge(spark: SparkSession, sf: str) -> DataFrame:
    q = _latest_quarter(spark, sf).withColumn("eps", F.when(F.col("ticker") % 2 == 0, F.col("eps")))
    caps = A.market_caps(spark, sf).where((F.col("trade_date") <= day()) & (F.col("ticker") % 3 != 0)).groupBy("ticker")
    market = caps.agg(F.max_by("market_cap", "trade_date").cast("double").alias("market_cap"), F.max_by("close", "trade_date").alias("last_close")).withColumn("issued_shares", (F.col("ticker") + 1000).cast("double"))
    out = fundamentals.merge_market(q, market, last_close_asof(spark, sf))
    return out.select("ticker", "fiscal_quarter", round_half_up(F.col("eps"), 2).alias("eps"), "issued_shares", "market_cap", "last_close_price")


def sector_averages(spark: SparkSession, sf: str) -> DataFrame:
    q = _latest_quarter(spark, sf).join(last_close_asof(spark, sf).select("ticker", "last_close"), "ticker", "left")
    return sectors.sector_averages(A.universe(spark, sf).select("ticker", "sector"), q)


def sector_averages_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the last business day of every month of 1998 and 1999 in one plan: decision dates are joined, not looped over."""
    months = spark.sql("SELECT explode(sequence(DATE'1998-01-01', DATE'1999-12-01', INTERVAL 1 MONTH)) AS m").select(last_business_day(F.col("m")).alias("decision_date"))
    spine = A.universe(spark, sf).select("ticker", "sector").crossJoin(F.broadcast(months))
    single = fundamentals.derive_fields(fundamentals.uncumulate(A.statements(spark, sf), A.YTD))
    picked = ["revenue", "gross_profit", "operating_income", "net_income", "eps", *A.LEVELS]
    at = asof.as_of_join(spine, single, ["ticker"], "decision_date", "report_date", picked)
    priced = asof.as_of_join(at, A.prices(spark, sf).withColumnRenamed("close", "last_close"), ["ticker"], "decision_date", "date", ["last_close"])
    key = F.struct("decision_date", "ticker")
    members = priced.select(key.alias("ticker"), F.struct("decision_date", "sector").alias("sector"))
    out = sectors.sector_averages(members, priced.withColumn("ticker", key))
    return out.select("sector.decision_date", F.col("sector.sector").alias("sector_name"), *sectors.METRICS, "n_tickers")


def sector_tickers(spark: SparkSession, sf: str) -> DataFrame:
    out = sectors.tickers_by_sector(A.universe(spark, sf))
    return out.select("sector", F.array_join(F.col("tickers").cast("array<string>"), ",").alias("tickers"))


def field_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return quality.field_coverage(_latest_quarter(spark, sf), FIELDS)


def completeness(spark: SparkSession, sf: str) -> DataFrame:
    n = A.universe(spark, sf).count()
    return quality.complete(field_coverage(spark, sf), n, FIELDS)


def snapshot_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """One row per ticker and decision month: bars, quarters and news known then, the last close and the cap."""
    months = spark.sql("SELECT explode(sequence(DATE'1999-07-01', DATE'1999-12-01', INTERVAL 1 MONTH)) AS m").select(last_business_day(F.col("m")).alias("decision_date"))
    spine = A.universe(spark, sf).select("ticker", "sector").crossJoin(F.broadcast(months))
    at = asof.as_of_join(spine, A.prices(spark, sf), ["ticker"], "decision_date", "date", ["close"])
    at = asof.as_of_join(at.withColumnsRenamed({"matched_date": "price_date", "close": "last_close"}), A.market_caps(spark, sf), ["ticker"], "decision_date", "trade_date", ["market_cap"], 45)
    quarters = A.statements(spark, sf).select("ticker", "report_date", "fiscal_quarter")
    at = asof.as_of_join(at, quarters, ["ticker"], "decision_date", "report_date", ["fiscal_quarter"])
    return at.select("decision_date", "ticker", "sector", "price_date", "last_close", "market_cap", "fiscal_quarter")


def snapshot_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """Content hashes of counts: bars and quarters per ticker, key-sorted JSON, first 16 hex digits of SHA-256."""
    p = asof.latest_n(asof.as_of_cut(A.prices(spark, sf).select("ticker", "date"), day()), ["ticker"], [F.desc("date")], 300)
    q = asof.latest_n(asof.as_of_cut(A.statements(spark, sf).select("ticker", "report_date"), day(), "report_date"), ["ticker"], [F.desc("report_date")], 8)
    u = A.universe(spark, sf).select("ticker", "sector")
    named = lambda df: u.join(df, "ticker").withColumn("ticker", F.lpad(F.col("ticker").cast("string"), 6, "0"))
    return content_hash(named(p), "prices_hash", ["sector"]).join(content_hash(named(q), "fundamentals_hash", ["sector"]), "sector", "full_outer")


def ticker_seeds(spark: SparkSession, sf: str) -> DataFrame:
    return A.universe(spark, sf).select("ticker", md5_seed(F.col("name")).alias("seed"))


def pit_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the latest-quarter result that were not yet known: none."""
    return asof.look_ahead(quarters_latest8(spark, sf), "report_date", day())


QUERIES = {
    f.__name__: f
    for f in (
        quarter_uncumulate, report_latest_amendment, latest_filing, quarters_latest8, quarters_lagged_availability, statement_derived_fields, fundamentals_merge, sector_averages, sector_averages_monthly, sector_tickers,
        field_coverage, completeness, snapshot_monthly, snapshot_hashes, ticker_seeds, pit_leaks,
    )
}

_SINGLE = ", un AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN fq = 1 THEN {c} WHEN lag(fq) OVER y = fq - 1 THEN {c} - lag({c}) OVER y END AS {c}" for c in A.YTD) + ") FROM st WINDOW y AS (PARTITION BY ticker, fy ORDER BY fq))"
_DERIVED = (
    ", dv AS (SELECT *, CASE WHEN coalesce(revenue, 0) <> 0 AND coalesce(cost_of_goods_sold, 0) <> 0 THEN revenue - cost_of_goods_sold END AS gross_profit, operating_income AS ebitda,"
    " CASE WHEN coalesce(operating_cash_flow, 0) <> 0 AND coalesce(capital_expenditure, 0) <> 0 THEN operating_cash_flow - abs(capital_expenditure) END AS free_cash_flow FROM {src})"
)
_LATEST = _SINGLE + _DERIVED.format(src="un") + f", lq AS (SELECT * FROM dv WHERE report_date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY report_date DESC) = 1)"
_CLOSE = f", lc AS (SELECT ticker, arg_max(close, date) AS last_close FROM px WHERE date <= DATE '{AS_OF}' GROUP BY 1)"
_RATIO = {
    "roa": "coalesce(net_income, 0) / total_assets",
    "roe": "CASE WHEN total_equity <> 0 THEN coalesce(net_income, 0) / total_equity END",
    "gross_margin": "coalesce(gross_profit, 0) / revenue",
    "operating_margin": "coalesce(operating_income, 0) / revenue",
    "net_margin": "coalesce(net_income, 0) / revenue",
    "current_ratio": "CASE WHEN current_liabilities > 0 THEN coalesce(current_assets, 0) / current_liabilities END",
    "debt_to_equity": "CASE WHEN total_equity > 0 THEN coalesce(total_debt, 0) / total_equity END",
    "asset_turnover": "revenue / total_assets",
    "pe_ttm": "CASE WHEN last_close <> 0 AND eps > 0 THEN last_close / (eps * 4) END",
}


def _averages(keys: str, source: str) -> str:
    rows = ", ".join(f"CASE WHEN revenue <> 0 AND total_assets <> 0 THEN {v} END AS {k}" for k, v in _RATIO.items())
    means = ", ".join(R4.format(f"(sum({k}::DECIMAL(28,12))::DOUBLE / nullif(count({k}), 0))") + f" AS {k}" for k in _RATIO)
    return f" SELECT {keys}, {means}, count(roa) AS n_tickers FROM (SELECT {keys}, {rows} FROM {source}) GROUP BY {keys}"


_DATES = ", dd AS (SELECT (last_day(d) - greatest(isodow(last_day(d)) - 5, 0)::INT)::DATE AS decision_date FROM (SELECT unnest(generate_series(DATE '{}', DATE '1999-12-01', INTERVAL 1 MONTH))::DATE AS d))"

SQL = {
    "quarter_uncumulate": with_tables("st", _SINGLE + " SELECT ticker, fiscal_quarter, " + ", ".join(f"floor({c} * 10 + 0.5) / 10 AS {c}" for c in A.YTD) + ", total_assets FROM un"),
    "report_latest_amendment": with_tables("rl", " SELECT * FROM rl WHERE rcept_dt <= '19991231' QUALIFY row_number() OVER (PARTITION BY corp, bsns_year, q ORDER BY rcept_dt DESC, rcept_no DESC) = 1"),
    "latest_filing": with_tables("rl", " SELECT * FROM rl WHERE rcept_dt <= '19991231' QUALIFY row_number() OVER (PARTITION BY corp ORDER BY (q = 4) DESC, rcept_dt DESC, rcept_no DESC) = 1"),
    "quarters_latest8": with_tables("st", f" SELECT ticker, fiscal_quarter, report_date, revenue FROM st WHERE report_date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY report_date DESC) <= 8"),
    "quarters_lagged_availability": with_tables("st", f" SELECT ticker, count(*) AS n, max(period_end) AS last_period_end FROM st WHERE period_end + 60 <= DATE '{AS_OF}' GROUP BY 1"),
    "statement_derived_fields": with_tables("st", _DERIVED.format(src="st") + " SELECT ticker, fiscal_quarter, " + ", ".join(f"floor({c} * 100 + 0.5) / 100 AS {c}" for c in ("gross_profit", "ebitda", "free_cash_flow")) + " FROM dv"),
    "fundamentals_merge": with_tables(
        "st cap",
        _LATEST + _CLOSE + f", mk AS (SELECT ticker, arg_max(market_cap, trade_date)::DOUBLE AS m_cap, arg_max(close, trade_date) AS m_close, (ticker + 1000)::DOUBLE AS shares FROM cap WHERE trade_date <= DATE '{AS_OF}' AND ticker % 3 <> 0 GROUP BY ticker)"
        " SELECT ticker, fiscal_quarter, floor(coalesce(CASE WHEN ticker % 2 = 0 THEN eps END, CASE WHEN net_income <> 0 AND shares <> 0 THEN floor(net_income * 1e6 / shares + 0.5) END) * 100 + 0.5) / 100 AS eps, shares AS issued_shares, m_cap AS market_cap,"
        " coalesce(nullif(m_close, 0), last_close) AS last_close_price FROM lq LEFT JOIN mk USING (ticker) LEFT JOIN lc USING (ticker)",
    ),
    "sector_averages": with_tables("px uni st", _LATEST + _CLOSE + _averages("sector", "(SELECT u.sector, lq.*, lc.last_close FROM uni u LEFT JOIN lq USING (ticker) LEFT JOIN lc USING (ticker))")),
    "sector_averages_monthly": with_tables(
        "px uni st",
        _SINGLE + _DERIVED.format(src="un") + _DATES.format("1998-01-01") + ", sp AS (SELECT ticker, sector AS sector_name, decision_date FROM uni CROSS JOIN dd), j AS (SELECT sp.*, dv.* EXCLUDE (ticker) FROM sp ASOF LEFT JOIN dv ON sp.ticker = dv.ticker AND sp.decision_date >= dv.report_date),"
        " k AS (SELECT j.*, px.close AS last_close FROM j ASOF LEFT JOIN px ON j.ticker = px.ticker AND j.decision_date >= px.date)" + _averages("decision_date, sector_name", "k"),
    ),
    "sector_tickers": with_tables("uni", " SELECT sector, string_agg(ticker::VARCHAR, ',' ORDER BY ticker) AS tickers FROM uni GROUP BY 1"),
    "field_coverage": with_tables("st", _LATEST + " SELECT count(*) AS tickers, " + ", ".join(f"count({f}) AS {f}" for f in FIELDS) + " FROM lq"),
    "completeness": with_tables("st uni", _LATEST + ", n AS (SELECT floor(count(*) * 0.5)::INT AS fl FROM uni) SELECT any_value(fl) AS floor, " + ", ".join(f"count({f}) >= any_value(fl) AS {f}_ok" for f in FIELDS) + " FROM lq CROSS JOIN n"),
    "snapshot_monthly": with_tables(
        "cap st",
        _DATES.format("1999-07-01") + ", sp AS (SELECT ticker, sector, decision_date FROM uni CROSS JOIN dd), a AS (SELECT sp.*, px.date AS price_date, px.close AS last_close FROM sp ASOF LEFT JOIN px ON sp.ticker = px.ticker AND sp.decision_date >= px.date),"
        " b AS (SELECT a.*, CASE WHEN decision_date - c.trade_date <= 45 THEN c.market_cap END AS market_cap FROM a ASOF LEFT JOIN cap c ON a.ticker = c.ticker AND a.decision_date >= c.trade_date)"
        " SELECT decision_date, b.ticker, sector, price_date, last_close, market_cap, st.fiscal_quarter FROM b ASOF LEFT JOIN st ON b.ticker = st.ticker AND b.decision_date >= st.report_date",
    ),
    "snapshot_hashes": with_tables(
        "px uni st",
        f", p AS (SELECT ticker, least(count(*), 300) AS n FROM px WHERE date <= DATE '{AS_OF}' GROUP BY 1), q AS (SELECT ticker, least(count(*), 8) AS n FROM st WHERE report_date <= DATE '{AS_OF}' GROUP BY 1),"
        + ", ".join(f"h{x} AS (SELECT sector, substr(sha256('{{' || string_agg('\"' || lpad(ticker::VARCHAR, 6, '0') || '\": ' || n, ', ' ORDER BY lpad(ticker::VARCHAR, 6, '0')) || '}}'), 1, 16) AS h FROM uni JOIN {x} USING (ticker) GROUP BY 1)" for x in "pq")
        + " SELECT sector, hp.h AS prices_hash, hq.h AS fundamentals_hash FROM hp FULL JOIN hq USING (sector)",
    ),
    "ticker_seeds": with_tables("uni", " SELECT ticker, ('0x' || substr(md5(name), 1, 8))::BIGINT % 2147483648 AS seed FROM uni"),
    "pit_leaks": with_tables("st", " SELECT ticker, fiscal_quarter, report_date, revenue FROM st WHERE false"),
}
