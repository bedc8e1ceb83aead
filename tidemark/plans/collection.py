"""Collection and bookkeeping: account mapping, valuation bands, catalog windows, batches, preflight, with their checks in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import sinks
from tidemark.functions import text as T
from tidemark.functions.dates import last_business_day, months_between_inclusive
from tidemark.functions.numbers import coverage_floor, round_half_up
from tidemark.operators import asof, fundamentals, news, quality, sectors
from tidemark.plans.market import AS_OF, day
from tidemark.plans.news import NEWS_DAY, at
from tidemark.sources import adapters as A
from tidemark.sources.adapters import with_tables


def account_mapping_kr(spark: SparkSession, sf: str) -> DataFrame:
    """Statement lines under exact and longer names; for each field the best name with a readable amount."""
    s = A.statements(spark, sf)
    odd = F.col("ticker") % 2 == 1
    line = lambda name, value, n: F.struct(name.alias("name"), value.alias("amount"), F.lit(n).alias("row_no"))
    lines = F.array(
        line(F.when(odd, "매출액").otherwise("매출액 합계"), F.col("revenue"), 1), line(F.lit("영업수익"), F.col("operating_income"), 2), line(F.lit("자산총계"), F.when(F.col("ticker") % 3 != 0, F.col("total_assets")), 3),
        line(F.lit("유동자산"), F.col("current_assets"), 4), line(F.lit("단기차입금"), F.col("total_debt"), 5), line(F.lit("총차입금 합계"), F.col("current_liabilities"), 6),
    )
    rows = s.select("ticker", "fiscal_quarter", F.explode(lines).alias("l")).select("ticker", "fiscal_quarter", "l.*")
    names = {k: fundamentals.KR_ACCOUNTS[k] for k in ("revenue", "total_assets", "current_assets", "total_debt")}
    return fundamentals.map_accounts(rows, ["ticker", "fiscal_quarter"], "name", "amount", "row_no", names)


def account_mapping_us(spark: SparkSession, sf: str) -> DataFrame:
    wide = A.statements(spark, sf).select("ticker", "fiscal_quarter", F.when(F.col("ticker") % 2 == 0, F.col("revenue")).alias("Total Revenue"), F.col("cost_of_goods_sold").alias("Operating Revenue"), F.when(F.col("ticker") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("eps")).alias("Basic EPS"))
    return fundamentals.map_wide_accounts(wide, ["ticker", "fiscal_quarter"], {k: fundamentals.US_ACCOUNTS[k] for k in ("revenue", "eps", "net_income")})


def valuation_unband(spark: SparkSession, sf: str) -> DataFrame:
    """Earnings and book value per share from bands named with their multiples."""
    s = asof.latest_n(A.statements(spark, sf), ["ticker"], [F.desc("report_date")], 1)
    e_name = F.concat(F.lit("PER "), (F.col("ticker") % 4).cast("string"), F.lit(".5X"))
    e, b = T.multiplier(e_name), T.multiplier(F.when(F.col("ticker") % 5 != 0, F.lit("PBR 2X")))
    out = fundamentals.unband_valuation(s, F.col("total_assets"), F.col("revenue"), e, F.col("total_equity"), b)
    return out.select("ticker", *(round_half_up(F.col(c), 4).alias(c) for c in ("eps", "bps", "per", "pbr")))


def last_valuation_of_month(spark: SparkSession, sf: str) -> DataFrame:
    p = A.prices(spark, sf)
    return p.groupBy("ticker", F.date_format("date", "yyyy-MM").alias("source_month")).agg(F.max("date").alias("target_date"), F.max_by("close", "date").alias("close"))


def news_catalog_window(spark: SparkSession, sf: str) -> DataFrame:
    """Items of the window once per address; the earliest captured day wins."""
    catalog = A.news(spark, sf)
    tickers = catalog.select("ticker").distinct()
    return news.build_window(catalog, tickers, at(), 20).select("ticker", "date", "url", "seq")


def remaining_work(spark: SparkSession, sf: str) -> DataFrame:
    """Universe times months less what is there: what a resumed run has to do."""
    months = spark.range(1).select(F.explode(months_between_inclusive(F.lit("1995-01-01").cast("date"), F.lit("1995-12-01").cast("date"))).alias("month"))
    have = A.market_caps(spark, sf).where("ticker % 5 <> 0 or month(month) % 2 = 0").select("ticker", "month")
    return asof.missing_combinations([A.universe(spark, sf).select("ticker"), months.select(F.col("month").cast("date").alias("month"))], have)


def closed_months(spark: SparkSession, sf: str) -> DataFrame:
    """Months that were over on the date, with the decision day held back to it."""
    months = spark.range(1).select(F.explode(months_between_inclusive(F.lit("1999-06-01").cast("date"), F.lit("2000-06-01").cast("date"))).alias("month")).select(F.col("month").cast("date"))
    today = F.lit("1999-12-15").cast("date")
    held = F.least(last_business_day(F.col("month")), today)
    return months.select("month", held.alias("decision_date"), (F.date_format("month", "yyyy-MM") < F.date_format(today, "yyyy-MM")).alias("closed"))


def checkpoint_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of 25 tickers in order; the last one may be short."""
    u = A.universe(spark, sf).select("ticker", "market")
    w = Window.partitionBy("market").orderBy("ticker")
    rows = u.withColumn("batch", F.floor((F.row_number().over(w) - 1) / 25).cast("int"))
    return rows.groupBy("market", "batch").agg(F.count("*").alias("n"), F.min("ticker").alias("first_ticker"), F.max("ticker").alias("last_ticker"))


def map_merge_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """State per market as a map of ticker to cap: the later payload replaces equal keys."""
    u = A.universe(spark, sf)
    old = u.select("market", "ticker", F.col("market_cap").alias("v"), F.lit(0).alias("batch"))
    new = u.where("ticker % 3 = 0").select("market", "ticker", (F.col("market_cap") + 1).alias("v"), F.lit(1).alias("batch"))
    merged = sinks.merge_batches(old.union(new), ["market", "ticker"])
    return merged.groupBy("market").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ticker", "v"))), lambda x: F.concat_ws("=", x["ticker"].cast("string"), F.format_number(x["v"], 2))), ";").alias("state"))


def charset_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes in the declared character set back to text."""
    d, text = A.table(spark, sf, "documents"), F.col("text")
    charset = F.when(F.col("doc_id") % 2 == 0, "UTF-8").otherwise("UTF-16")
    raw = F.when(F.col("doc_id") % 2 == 0, F.encode(text, "UTF-8")).otherwise(F.encode(text, "UTF-16"))
    back = F.when(charset == "UTF-8", F.decode(raw, "UTF-8")).otherwise(F.decode(raw, "UTF-16"))
    return d.select("doc_id", back.alias("text"))


def preflight(spark: SparkSession, sf: str) -> DataFrame:
    """Latest quarter's required fields, cap and close per ticker: degraded with the names of what is missing."""
    q = asof.latest_n(A.statements(spark, sf).where(F.col("report_date") <= day()), ["ticker"], [F.desc("report_date")], 1)
    caps = A.market_caps(spark, sf).where((F.col("trade_date") <= day()) & (F.col("ticker") % 4 != 0)).groupBy("ticker").agg(F.max_by("market_cap", "trade_date").alias("market_cap"))
    need = ["revenue", "total_assets", "current_assets", "current_liabilities", "market_cap"]
    return quality.preflight(A.universe(spark, sf), q, caps, need)


def coverage_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Per market: tickers with a known cap against half of the universe."""
    caps = A.market_caps(spark, sf).where("trade_date between date'1999-12-20' and date'1999-12-31'").select("ticker").distinct().withColumn("has", F.lit(True))
    g = A.universe(spark, sf).join(caps, "ticker", "left").groupBy("market").agg(F.count("*").alias("n"), F.count("has").alias("with_cap"))
    return g.select("market", "n", "with_cap", coverage_floor(F.col("n")).alias("needed"), (F.col("with_cap") >= coverage_floor(F.col("n"))).alias("ok"))


def coverage_warnings(spark: SparkSession, sf: str) -> DataFrame:
    q = A.statements(spark, sf).withColumn("issued_shares", F.lit(None).cast("double"))
    return quality.warnings(quality.field_coverage(q, ["revenue", "issued_shares"]), ["revenue", "issued_shares"])


def sector_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Averages as rows of (sector, metric, value), as the nested map holds them."""
    from tidemark.plans.statements import sector_averages

    return sectors.as_metric_map(sector_averages(spark, sf)).select("sector", F.explode("avg_metrics").alias("metric", "value"))


def clean_financial_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Quarters in which at least one field is known."""
    s = A.statements(spark, sf).select("ticker", "fiscal_quarter", F.when(F.col("ticker") % 2 == 0, F.col("revenue")).alias("revenue"), F.col("current_assets"))
    return fundamentals.drop_empty(s, ["revenue", "current_assets"])


QUERIES = {
    f.__name__: f
    for f in (
        account_mapping_kr, account_mapping_us, valuation_unband, last_valuation_of_month, news_catalog_window, remaining_work, closed_months, checkpoint_batches, map_merge_last_wins, charset_decode, preflight,
        coverage_gate, coverage_warnings, sector_metric_rows, clean_financial_rows,
    )
}


def _metric_rows() -> str:
    from tidemark.operators.sectors import METRICS
    from tidemark.plans.statements import SQL as S

    body = S["sector_averages"]
    return "SELECT sector, metric, value FROM (" + " UNION ALL ".join(f"SELECT sector, '{m}' AS metric, {m} AS value FROM ({body})" for m in METRICS) + ") WHERE value IS NOT NULL"


_LAST_Q = f", lq AS (SELECT * FROM st WHERE report_date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY report_date DESC) = 1)"

SQL = {
    "account_mapping_kr": with_tables("st", " SELECT ticker, fiscal_quarter, CASE WHEN ticker % 2 = 1 THEN revenue ELSE operating_income END AS revenue, CASE WHEN ticker % 3 <> 0 THEN total_assets END AS total_assets, current_assets, total_debt FROM st"),
    "account_mapping_us": with_tables("st", " SELECT ticker, fiscal_quarter, CASE WHEN ticker % 2 = 0 THEN revenue ELSE cost_of_goods_sold END AS revenue, CASE WHEN ticker % 3 <> 0 THEN eps END AS eps, NULL::DOUBLE AS net_income FROM st"),
    "valuation_unband": with_tables(
        "st",
        ", s AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY report_date DESC) = 1), m AS (SELECT ticker, total_assets AS p, revenue / (ticker % 4 + 0.5::DOUBLE) AS eps, CASE WHEN ticker % 5 <> 0 THEN total_equity / 2 END AS bps FROM s)"
        " SELECT ticker, floor(eps * 10000 + 0.5) / 10000 AS eps, floor(bps * 10000 + 0.5) / 10000 AS bps, floor(p / nullif(eps, 0) * 10000 + 0.5) / 10000 AS per, floor(p / nullif(bps, 0) * 10000 + 0.5) / 10000 AS pbr FROM m",
    ),
    "last_valuation_of_month": with_tables("px", " SELECT ticker, strftime(date, '%Y-%m') AS source_month, max(date) AS target_date, arg_max(close, date) AS close FROM px GROUP BY 1, 2"),
    "news_catalog_window": with_tables("nw", f" SELECT ticker, date, url, seq FROM nw WHERE date BETWEEN DATE '{NEWS_DAY}' - 19 AND DATE '{NEWS_DAY}' QUALIFY row_number() OVER (PARTITION BY ticker, url ORDER BY date, seq) = 1"),
    "remaining_work": with_tables("cap", " SELECT ticker, m::DATE AS month FROM (SELECT ticker FROM uni) CROSS JOIN generate_series(DATE '1995-01-01', DATE '1995-12-01', INTERVAL 1 MONTH) AS g(m) EXCEPT SELECT ticker, month FROM cap WHERE ticker % 5 <> 0 OR month(month) % 2 = 0"),
    "closed_months": "WITH m AS (SELECT unnest(generate_series(DATE '1999-06-01', DATE '2000-06-01', INTERVAL 1 MONTH))::DATE AS month) SELECT month, least((last_day(month) - greatest(isodow(last_day(month)) - 5, 0)::INT)::DATE, DATE '1999-12-15') AS decision_date, month < DATE '1999-12-01' AS closed FROM m",
    "checkpoint_batches": with_tables("uni", ", r AS (SELECT ticker, market, ((row_number() OVER (PARTITION BY market ORDER BY ticker) - 1) // 25)::INT AS batch FROM uni) SELECT market, batch, count(*) AS n, min(ticker) AS first_ticker, max(ticker) AS last_ticker FROM r GROUP BY 1, 2"),
    "map_merge_last_wins": with_tables("uni", ", m AS (SELECT market, ticker, CASE WHEN ticker % 3 = 0 THEN market_cap + 1 ELSE market_cap END AS v FROM uni) SELECT market, count(*) AS n, string_agg(ticker || '=' || format('{:,.2f}', v), ';' ORDER BY ticker) AS state FROM m GROUP BY 1"),
    "charset_decode": "SELECT doc_id, text FROM documents",
    "preflight": with_tables(
        "cap st",
        _LAST_Q + f", mc AS (SELECT ticker, arg_max(market_cap, trade_date) AS market_cap FROM cap WHERE trade_date <= DATE '{AS_OF}' AND ticker % 4 <> 0 GROUP BY 1),"
        " g AS (SELECT ticker, fiscal_quarter, concat_ws(',', CASE WHEN revenue IS NULL THEN 'revenue' END, CASE WHEN total_assets IS NULL THEN 'total_assets' END, CASE WHEN current_assets IS NULL THEN 'current_assets' END, CASE WHEN current_liabilities IS NULL THEN 'current_liabilities' END, CASE WHEN mc.market_cap IS NULL THEN 'market_cap' END) AS missing"
        " FROM (SELECT ticker FROM uni) LEFT JOIN lq USING (ticker) LEFT JOIN mc USING (ticker)) SELECT ticker, CASE WHEN fiscal_quarter IS NULL THEN 'failed' WHEN missing <> '' THEN 'degraded' ELSE 'ok' END AS status, missing FROM g",
    ),
    "coverage_gate": with_tables("cap", ", c AS (SELECT DISTINCT ticker FROM cap WHERE trade_date BETWEEN DATE '1999-12-20' AND DATE '1999-12-31'), g AS (SELECT market, count(*) AS n, count(c.ticker) AS with_cap, floor(count(*) * 0.5)::BIGINT AS needed FROM uni LEFT JOIN c ON uni.ticker = c.ticker GROUP BY 1) SELECT *, with_cap >= needed AS ok FROM g"),
    "coverage_warnings": "SELECT 'no ticker has issued_shares' AS warning",
    "sector_metric_rows": _metric_rows(),
    "clean_financial_rows": with_tables("st", " SELECT ticker, fiscal_quarter, CASE WHEN ticker % 2 = 0 THEN revenue END AS revenue, current_assets FROM st WHERE ticker % 2 = 0 OR current_assets IS NOT NULL"),
}
