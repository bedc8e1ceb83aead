"""Prices, caps, universe and sources, with their checks in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import last_business_day
from tidemark.functions.numbers import round_half_up
from tidemark.operators import asof, macro, sectors, universe
from tidemark.operators.fundamentals import implied_shares
from tidemark.sources import adapters as A
from tidemark.sources import readers
from tidemark.sources.adapters import with_tables

AS_OF = "1999-12-31"


def day() -> Column:
    return F.lit(AS_OF).cast("date")


R2 = "floor({} * 100 + 0.5) / 100"
R1 = "floor({} * 10 + 0.5) / 10"


def prices_asof_last300(spark: SparkSession, sf: str) -> DataFrame:
    return asof.latest_n(asof.as_of_cut(A.prices(spark, sf), day()), ["ticker"], [F.desc("date")], 300)


def last_close_asof(spark: SparkSession, sf: str) -> DataFrame:
    out = asof.latest_value(A.prices(spark, sf), ["ticker"], "close", "date", day())
    return out.select("ticker", "date", F.col("close").alias("last_close"))


def return_21bar(spark: SparkSession, sf: str) -> DataFrame:
    return macro.bar_return(A.prices(spark, sf), day(), 21)


def benchmark_asof(spark: SparkSession, sf: str) -> DataFrame:
    known = A.benchmark_prices(spark, sf).where(F.col("date") <= day())
    return known.orderBy(F.desc("date")).limit(300).select("date", round_half_up(F.col("close"), 2).alias("close"), "volume")


def month_end_trading_days(spark: SparkSession, sf: str) -> DataFrame:
    return asof.last_of_month(A.prices(spark, sf), ["ticker"], "date")


def latest_trading_day(spark: SparkSession, sf: str) -> DataFrame:
    return A.prices(spark, sf).where((F.col("date") <= day()) & (F.col("date") >= F.date_sub(day(), 14))).groupBy("ticker").agg(F.max("date").alias("date"))


def cap_asof_staleness(spark: SparkSession, sf: str) -> DataFrame:
    return asof.newest_snapshot(A.market_caps(spark, sf), ["ticker", "market"], "trade_date", day(), 7).select("ticker", "market", "trade_date", "market_cap")


def cap_asof_multi_month(spark: SparkSession, sf: str) -> DataFrame:
    """Every ticker's cap as known on the last business day of every month of 1998 and 1999, at most 45 days old."""
    months = spark.sql("SELECT explode(sequence(DATE'1998-01-01', DATE'1999-12-01', INTERVAL 1 MONTH)) AS m").select(last_business_day(F.col("m")).alias("decision_date"))
    spine = A.universe(spark, sf).select("ticker").crossJoin(F.broadcast(months))
    out = asof.as_of_join(spine, A.market_caps(spark, sf), ["ticker"], "decision_date", "trade_date", ["market_cap"], 45)
    return out.select("ticker", "decision_date", F.col("matched_trade_date").alias("trade_date"), "market_cap")


def cap_dedupe_last(spark: SparkSession, sf: str) -> DataFrame:
    """One cap per ticker: the last by trade date."""
    return asof.keep_first(A.market_caps(spark, sf), ["ticker"], [F.desc("trade_date")]).select("ticker", "market_cap", "trade_date")


def month_label_to_month_end(spark: SparkSession, sf: str) -> DataFrame:
    """Month labels joined to the market's last trading day of that month."""
    ends = asof.last_of_month(A.prices(spark, sf), [], "date").select("date")
    return readers.relabel_months(A.market_caps(spark, sf).select("ticker", "month", "market_cap"), ends, "month")


def implied_share_counts(spark: SparkSession, sf: str) -> DataFrame:
    caps = A.universe(spark, sf).select("ticker", (F.col("market_cap") / 100).alias("cap_eok"))
    closes = last_close_asof(spark, sf).select("ticker", F.col("last_close").alias("close"))
    return implied_shares(caps.join(closes, "ticker"), "close", "cap_eok").select("ticker", "market_cap", "issued_shares")


def universe_topn(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf)
    return universe.top_by_cap(u.where("market in ('ASIA', 'EUROPE')"), u.select("ticker", "market_cap"), 20).select("ticker", "market_cap")


def universe_manifest(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf)
    caps = [u.where(F.col("market") == m).select("ticker", "market", F.col("market_cap").cast("string")) for m in ("ASIA", "EUROPE", "AMERICA")]
    return universe.manifest(caps, u.select("ticker", "name", "sector"), 30).select("rank", "ticker", "market", "market_cap", "name", "sector")


def sector_map_default(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf)
    labels = u.where("ticker % 5 <> 0").select("ticker", F.when(F.col("ticker") % 7 == 0, "  ").otherwise(F.col("sector")).alias("sector"))
    return sectors.with_sector(u.select("ticker"), labels)


def source_priority_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    """Sector labels from three sources in order: tickers in one source never look at the next."""
    u = A.universe(spark, sf)
    first = u.where("ticker % 3 = 0").select("ticker", F.col("market").alias("label"))
    second = u.where("ticker % 2 = 0").select("ticker", F.col("sector").alias("label"))
    third = u.select("ticker", F.lit("General").alias("label"))
    return asof.first_source([first, second, third], ["ticker"]).select("ticker", "label", "source_rank")


def market_split_union(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf)
    listed = u.where("market like 'A%'").select("ticker", "market").unionByName(u.where("market like '%A'").select("ticker", "market"))
    return listed.distinct()


def listing_in_caps(spark: SparkSession, sf: str) -> DataFrame:
    caps = A.market_caps(spark, sf).where("trade_date >= date'2001-06-01'")
    return A.universe(spark, sf).join(caps, "ticker", "left_semi").select("ticker", "market")


def missing_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """(market, month) pairs without any cap above a bound."""
    caps = A.market_caps(spark, sf)
    present = caps.where("market_cap > 5000000").select("market", "month").distinct()
    return asof.missing_combinations([caps.select("market").distinct(), caps.select("month").distinct()], present)


def price_source_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """First non-empty price source per ticker and which one it was."""
    p = A.prices(spark, sf).select("ticker", "date", "close")
    return asof.first_source([p.where("ticker % 4 = 1"), p.where("ticker % 4 <> 2")], ["ticker"])


_INDICATORS = [*(f"roc_{n}" for n in (5, 10, 20, 30, 21, 63, 126, 252)), "bb_mid", "bb_high", "bb_low", "macd", "macd_signal", "rsi_14", "stoch_k", "stoch_d"]


def technical_indicator_bars(spark: SparkSession, sf: str) -> DataFrame:
    """All indicators over each ticker's last 300 known bars; the last 60 are returned."""
    known = asof.latest_n(asof.as_of_cut(A.prices(spark, sf), day()), ["ticker"], [F.desc("date")], 300)
    bars = asof.latest_n(macro.technical_indicators(known), ["ticker"], [F.desc("date")], 60)
    return bars.select("ticker", "date", *(round_half_up(F.col(c), 6).alias(c) for c in _INDICATORS))


def _indicator_sql() -> str:
    """The same bar by bar: exponential averages by recursion over each ticker's numbered bars."""
    roc = ", ".join(f"(close / nullif(lag(close, {n}) OVER w, 0)) * 100 - 100 AS roc_{n}" for n in (5, 10, 20, 30, 21, 63, 126, 252))
    step = lambda old, new, alpha: f"e.{old} + {alpha} * ({new} - e.{old})"
    rounded = ", ".join(f"floor({c} * 1000000 + 0.5) / 1000000 AS {c}" for c in _INDICATORS)
    return with_tables(
        "px",
        f""", b AS (SELECT ticker, date, close, high, low, row_number() OVER (PARTITION BY ticker ORDER BY date) AS k FROM (SELECT * FROM px WHERE date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 300)),
 f AS (SELECT *, {roc}, count(*) OVER w20 = 20 AS whole, avg(close) OVER w20 AS m, stddev_pop(close) OVER w20 AS sd, (close - min(low) OVER w14) / nullif(max(high) OVER w14 - min(low) OVER w14, 0) * 100 AS sr, close - lag(close) OVER w AS mv
  FROM b WINDOW w AS (PARTITION BY ticker ORDER BY k), w20 AS (PARTITION BY ticker ORDER BY k ROWS 19 PRECEDING), w14 AS (PARTITION BY ticker ORDER BY k ROWS 13 PRECEDING)),
 g AS (SELECT *, avg(sr) OVER (PARTITION BY ticker ORDER BY k ROWS 2 PRECEDING) AS stoch_k FROM f),
 h AS (SELECT *, avg(stoch_k) OVER (PARTITION BY ticker ORDER BY k ROWS 2 PRECEDING) AS stoch_d FROM g)"""
        + f""", e(ticker, k, e12, e26, sig, au, ad) AS (SELECT ticker, k, close, close, 0::DOUBLE, NULL::DOUBLE, NULL::DOUBLE FROM b WHERE k = 1
  UNION ALL SELECT f.ticker, f.k, {step("e12", "close", "2 / 13")}, {step("e26", "close", "2 / 27")}, {step("sig", "((" + step("e12", "close", "2 / 13") + ") - (" + step("e26", "close", "2 / 27") + "))", "2 / 10")},
   CASE WHEN f.k = 2 THEN greatest(mv, 0) ELSE {step("au", "greatest(mv, 0)", "1 / 14")} END, CASE WHEN f.k = 2 THEN greatest(-mv, 0) ELSE {step("ad", "greatest(-mv, 0)", "1 / 14")} END FROM e JOIN f ON f.ticker = e.ticker AND f.k = e.k + 1),
 i AS (SELECT h.*, CASE WHEN whole THEN m END AS bb_mid, CASE WHEN whole THEN m + 2 * sd END AS bb_high, CASE WHEN whole THEN m - 2 * sd END AS bb_low, e12 - e26 AS macd, sig AS macd_signal, CASE WHEN ad = 0 THEN CASE WHEN au = 0 THEN 50 ELSE 100 END ELSE 100 - 100 / (1 + au / ad) END AS rsi_14 FROM h JOIN e USING (ticker, k))
 SELECT ticker, date, {rounded} FROM i QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 60""",
    ).replace("WITH ", "WITH RECURSIVE ", 1)


QUERIES = {
    f.__name__: f
    for f in (
        prices_asof_last300, last_close_asof, return_21bar, benchmark_asof, month_end_trading_days, latest_trading_day, cap_asof_staleness, cap_asof_multi_month, cap_dedupe_last, month_label_to_month_end,
        implied_share_counts, universe_topn, universe_manifest, sector_map_default, source_priority_coalesce, market_split_union, listing_in_caps, missing_partitions, price_source_fallback, technical_indicator_bars,
    )
}

SQL = {
    "prices_asof_last300": with_tables("px", f" SELECT * FROM px WHERE date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 300"),
    "last_close_asof": with_tables("px", f" SELECT ticker, max(date) AS date, arg_max(close, date) AS last_close FROM px WHERE date <= DATE '{AS_OF}' GROUP BY ticker"),
    "return_21bar": with_tables("px", f", r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS r FROM px WHERE date <= DATE '{AS_OF}') SELECT a.ticker, {R1.format('((a.close - b.close) / nullif(b.close, 0) * 100)')} AS return_pct FROM r a JOIN r b ON a.ticker = b.ticker AND a.r = 1 AND b.r = 22"),
    "benchmark_asof": with_tables("idx", f" SELECT date, {R2.format('close')} AS close, volume FROM idx WHERE date <= DATE '{AS_OF}' ORDER BY date DESC LIMIT 300"),
    "month_end_trading_days": with_tables("px", " SELECT ticker, date_trunc('month', date)::DATE AS month, max(date) AS date FROM px GROUP BY 1, 2"),
    "latest_trading_day": with_tables("px", f" SELECT ticker, max(date) AS date FROM px WHERE date BETWEEN DATE '{AS_OF}' - 14 AND DATE '{AS_OF}' GROUP BY 1"),
    "cap_asof_staleness": with_tables("cap", f" SELECT ticker, market, trade_date, market_cap FROM cap WHERE trade_date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) = 1 AND trade_date >= DATE '{AS_OF}' - 7"),
    "cap_asof_multi_month": with_tables(
        "cap",
        """, m AS (SELECT unnest(generate_series(DATE '1998-01-01', DATE '1999-12-01', INTERVAL 1 MONTH))::DATE AS d), dd AS (SELECT (last_day(d) - greatest(isodow(last_day(d)) - 5, 0)::INT)::DATE AS decision_date FROM m),
 j AS (SELECT u.ticker, decision_date, c.trade_date, c.market_cap FROM uni u CROSS JOIN dd ASOF LEFT JOIN cap c ON u.ticker = c.ticker AND c.trade_date <= decision_date)
 SELECT ticker, decision_date, CASE WHEN decision_date - trade_date <= 45 THEN trade_date END AS trade_date, CASE WHEN decision_date - trade_date <= 45 THEN market_cap END AS market_cap FROM j""",
    ),
    "cap_dedupe_last": with_tables("cap", " SELECT ticker, arg_max(market_cap, trade_date) AS market_cap, max(trade_date) AS trade_date FROM cap GROUP BY 1"),
    "month_label_to_month_end": with_tables("cap", ", e AS (SELECT date_trunc('month', date)::DATE AS month, max(date) AS source_trade_date FROM px GROUP BY 1) SELECT ticker, month, source_trade_date, market_cap FROM cap JOIN e USING (month)"),
    "implied_share_counts": with_tables("px uni", f", c AS (SELECT ticker, arg_max(close, date) AS close FROM px WHERE date <= DATE '{AS_OF}' GROUP BY 1), m AS (SELECT ticker, close, floor(market_cap / 100 * 1e8 + 0.5)::BIGINT AS market_cap FROM uni JOIN c USING (ticker) WHERE close > 0 AND market_cap > 0) SELECT ticker, market_cap, floor(market_cap / close + 0.5)::BIGINT AS issued_shares FROM m"),
    "universe_topn": with_tables("uni", " SELECT ticker, market_cap FROM uni WHERE market IN ('ASIA', 'EUROPE') AND market_cap > 0 ORDER BY market_cap DESC, ticker LIMIT 20"),
    "universe_manifest": with_tables("uni", ", t AS (SELECT * FROM uni WHERE market IN ('ASIA', 'EUROPE', 'AMERICA') ORDER BY market_cap DESC, ticker LIMIT 30) SELECT (row_number() OVER (ORDER BY market_cap DESC, ticker))::INT AS rank, ticker, market, market_cap, name, sector FROM t"),
    "sector_map_default": with_tables("uni", " SELECT ticker, CASE WHEN ticker % 5 = 0 OR ticker % 7 = 0 THEN 'General' ELSE coalesce(sector, 'General') END AS sector FROM uni"),
    "source_priority_coalesce": with_tables("uni", " SELECT ticker, CASE WHEN ticker % 3 = 0 THEN market WHEN ticker % 2 = 0 THEN sector ELSE 'General' END AS label, CASE WHEN ticker % 3 = 0 THEN 0 WHEN ticker % 2 = 0 THEN 1 ELSE 2 END::INT AS source_rank FROM uni"),
    "market_split_union": with_tables("uni", " SELECT DISTINCT ticker, market FROM uni WHERE market LIKE 'A%' OR market LIKE '%A'"),
    "listing_in_caps": with_tables("cap", " SELECT ticker, market FROM uni WHERE ticker IN (SELECT ticker FROM cap WHERE trade_date >= DATE '2001-06-01')"),
    "missing_partitions": with_tables("cap", " SELECT market, month FROM (SELECT DISTINCT market FROM cap) CROSS JOIN (SELECT DISTINCT month FROM cap) EXCEPT SELECT market, month FROM cap WHERE market_cap > 5000000"),
    "price_source_fallback": with_tables("px", " SELECT ticker, CASE WHEN ticker % 4 = 1 THEN 0 ELSE 1 END::INT AS source_rank, date, close FROM px WHERE ticker % 4 <> 2"),
    "technical_indicator_bars": _indicator_sql(),
}
