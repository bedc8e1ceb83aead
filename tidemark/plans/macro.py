"""Macro series queries, with their checks in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions.numbers import round_half_up
from tidemark.operators import macro
from tidemark.plans.market import AS_OF, day
from tidemark.sources import adapters as A
from tidemark.sources.adapters import with_tables

HIGH, LOW = "1-URGENT", "5-LOW"


def macro_latest(spark: SparkSession, sf: str) -> DataFrame:
    return macro.latest(A.daily_macro(spark, sf), day())


def macro_yoy_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return macro.yoy_nearest(A.daily_macro(spark, sf).where("pmod(hash(date), 3) >= 0 and dayofmonth(date) % 4 <> 3"), day())


def macro_yoy_same_period(spark: SparkSession, sf: str) -> DataFrame:
    return macro.yoy_same_period(A.macro(spark, sf), day(), "M")


def macro_yoy_same_quarter(spark: SparkSession, sf: str) -> DataFrame:
    return macro.yoy_same_period(A.macro(spark, sf), day(), "Q")


def macro_mom(spark: SparkSession, sf: str) -> DataFrame:
    return macro.mom(A.macro(spark, sf), day())


def macro_level_change(spark: SparkSession, sf: str) -> DataFrame:
    return macro.level_change(A.macro(spark, sf), day())


def policy_stance(spark: SparkSession, sf: str) -> DataFrame:
    """Series means scaled to rates, then US and KR bounds."""
    rate = round_half_up(F.col("value") / 40000, 2)
    rows = A.macro(spark, sf).where("date >= date'1999-01-01'").select("series", "date", rate.alias("rate"))
    return rows.select("series", "date", "rate", macro.stance(F.col("rate"), 5.0, 2.0).alias("us_stance"), macro.stance(F.col("rate"), 3.5, 1.5).alias("kr_stance"))


def _pair(spark: SparkSession, sf: str, a: str, b: str) -> DataFrame:
    last = macro.latest(A.daily_macro(spark, sf), day())
    return last.agg(F.max(F.when(F.col("series") == a, F.col("value"))).alias("a"), F.max(F.when(F.col("series") == b, F.col("value"))).alias("b"))


def curve_spread(spark: SparkSession, sf: str) -> DataFrame:
    return _pair(spark, sf, HIGH, LOW).select(macro.spread(F.col("a"), F.col("b"), 2).alias("spread_us"), macro.spread(F.col("a"), F.col("b"), 4).alias("spread_kr"))


def trade_balance(spark: SparkSession, sf: str) -> DataFrame:
    return _pair(spark, sf, "2-HIGH", "3-MEDIUM").select(macro.spread(F.col("a"), F.col("b"), 4).alias("trade_balance"))


def series_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds from period tokens, and the requested four years cut to them."""
    tokens = A.macro(spark, sf).select("series", F.date_format("date", "yyyyMM").alias("token"))
    first = D.parse_period(F.col("token"), F.lit("M"))
    b = macro.series_bounds(tokens, first, first)
    lo, hi = macro.clamp(D.parse_period(D.period_start_token(day(), F.lit("M")), F.lit("M")), day(), F.col("first_date"), F.col("last_date"))
    return b.select("series", "first_date", "last_date", lo.alias("from_date"), hi.alias("to_date")).where("from_date <= to_date")


def macro_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Observations joined to a small series dimension; latest per key with its category."""
    spec = spark.createDataFrame([("1-URGENT", "rates_policy", "base_rate"), ("2-HIGH", "growth_economy", "exports"), ("3-MEDIUM", "growth_economy", "imports"), ("5-LOW", "market_risk", "usd_krw")], "series string, category string, key string")
    return macro.latest(A.daily_macro(spark, sf), day()).join(F.broadcast(spec), "series").select("category", "key", "value", "date")


def macro_key_counts(spark: SparkSession, sf: str) -> DataFrame:
    return macro_categories(spark, sf).groupBy("category").agg(F.count("*").alias("n_keys"))


QUERIES = {
    f.__name__: f
    for f in (macro_latest, macro_yoy_nearest, macro_yoy_same_period, macro_yoy_same_quarter, macro_mom, macro_level_change, policy_stance, curve_spread, trade_balance, series_bounds, macro_categories, macro_key_counts)
}

_LAST = f", la AS (SELECT series, floor(arg_max(value, date) * 10000 + 0.5) / 10000 AS value, max(date) AS date FROM dmac WHERE date BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}' GROUP BY 1)"
_TWO = f", k AS (SELECT series, value, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS r FROM mac WHERE date BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}'), t AS (SELECT series, max(value) FILTER (r = 1) AS cur, max(value) FILTER (r = 2) AS prev FROM k GROUP BY 1)"
_SPEC = ", sp(series, category, key) AS (VALUES ('1-URGENT', 'rates_policy', 'base_rate'), ('2-HIGH', 'growth_economy', 'exports'), ('3-MEDIUM', 'growth_economy', 'imports'), ('5-LOW', 'market_risk', 'usd_krw'))"


def _same(slot: str) -> str:
    return with_tables(
        "mac",
        f", n AS (SELECT series, value, date, year(date) AS y, {slot}(date) AS s FROM mac WHERE date <= DATE '{AS_OF}'), c AS (SELECT series, arg_max(value, date) AS cur, arg_max(y, date) AS y, arg_max(s, date) AS s FROM n GROUP BY 1),"
        " p AS (SELECT series, y, s, arg_min(value, date) AS past FROM n GROUP BY 1, 2, 3) SELECT c.series, floor((cur - past) / nullif(past, 0) * 100 * 10 + 0.5) / 10 AS yoy FROM c LEFT JOIN p ON c.series = p.series AND c.y - 1 = p.y AND c.s = p.s",
    )


SQL = {
    "macro_latest": with_tables("dmac", _LAST + " SELECT * FROM la"),
    "macro_yoy_nearest": with_tables(
        "dmac",
        f", n AS (SELECT * FROM dmac WHERE date BETWEEN DATE '{AS_OF}' - 400 AND DATE '{AS_OF}' AND day(date) % 4 <> 3), c AS (SELECT series, arg_max(value, date) AS cur, count(*) AS n FROM n GROUP BY 1),"
        f" p AS (SELECT series, value AS past FROM n QUALIFY row_number() OVER (PARTITION BY series ORDER BY abs(date - (DATE '{AS_OF}' - 365)), date DESC) = 1) SELECT series, CASE WHEN n >= 2 THEN floor((cur - past) / nullif(past, 0) * 100 * 10 + 0.5) / 10 END AS yoy FROM c JOIN p USING (series)",
    ),
    "macro_yoy_same_period": _same("month"),
    "macro_yoy_same_quarter": _same("quarter"),
    "macro_mom": with_tables("mac", _TWO + " SELECT series, floor((cur - prev) / nullif(prev, 0) * 100 * 10 + 0.5) / 10 AS mom FROM t"),
    "macro_level_change": with_tables("mac", _TWO + " SELECT series, floor(cur - prev + 0.5) AS change FROM t"),
    "policy_stance": with_tables(
        "mac",
        ", r AS (SELECT series, date, floor(value / 40000 * 100 + 0.5) / 100 AS rate FROM mac WHERE date >= DATE '1999-01-01') SELECT series, date, rate, CASE WHEN rate >= 5 THEN 'hawkish' WHEN rate <= 2 THEN 'dovish' ELSE 'neutral' END AS us_stance, CASE WHEN rate >= 3.5 THEN 'hawkish' WHEN rate <= 1.5 THEN 'dovish' ELSE 'neutral' END AS kr_stance FROM r",
    ),
    "curve_spread": with_tables("dmac", _LAST + f", p AS (SELECT max(value) FILTER (series = '{HIGH}') - max(value) FILTER (series = '{LOW}') AS d FROM la) SELECT floor(d * 100 + 0.5) / 100 AS spread_us, floor(d * 10000 + 0.5) / 10000 AS spread_kr FROM p"),
    "trade_balance": with_tables("dmac", _LAST + " SELECT floor((max(value) FILTER (series = '2-HIGH') - max(value) FILTER (series = '3-MEDIUM')) * 10000 + 0.5) / 10000 AS trade_balance FROM la"),
    "series_bounds": with_tables("mac", f" SELECT series, min(date) AS first_date, max(date) AS last_date, greatest(DATE '1995-01-01', min(date)) AS from_date, least(DATE '{AS_OF}', max(date)) AS to_date FROM mac GROUP BY 1"),
    "macro_categories": with_tables("dmac", _LAST + _SPEC + " SELECT category, key, value, date FROM la JOIN sp USING (series)"),
    "macro_key_counts": with_tables("dmac", _LAST + _SPEC + " SELECT category, count(*) AS n_keys FROM la JOIN sp USING (series) GROUP BY 1"),
}
