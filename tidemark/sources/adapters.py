"""Domain tables derived from the star-schema and event tables, for queries and checks on real volumes.

Money is summed as DECIMAL so that results do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import fiscal_quarter
from tidemark.functions.numbers import round_half_up

#: Statement columns that accumulate within a fiscal year, and those that are levels.
YTD = ["revenue", "cost_of_goods_sold", "operating_income", "net_income", "operating_cash_flow", "capital_expenditure", "eps"]
LEVELS = ["total_assets", "total_equity", "total_debt", "current_assets", "current_liabilities"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per supplier: unit prices of its lines by ship date."""
    px = F.col("l_extendedprice") / F.col("l_quantity")
    # one number, so that the first and last line are found by hash aggregation without a sort
    order = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey") % 1_000_000
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").cast("date").alias("date"), px.alias("px"), order.alias("o"), "l_quantity")
    bars = lines.groupBy("ticker", "date").agg(F.min_by("px", "o").alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", "o").alias("close"), F.sum("l_quantity").alias("volume"))
    return bars.select("ticker", "date", *(round_half_up(F.coalesce(c, F.lit(0.0)), 2).alias(c) for c in ("open", "high", "low", "close")), F.coalesce("volume", F.lit(0.0)).alias("volume"))


def benchmark_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pooled index: mean of the day's closes, exact in decimals."""
    day = prices(spark, sf_dir).groupBy("date")
    return day.agg((F.sum(F.col("close").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("close"), F.sum("volume").alias("volume"))


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    firms = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return firms.select(F.col("s_suppkey").alias("ticker"), F.col("r_name").alias("market"), F.col("n_name").alias("sector"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("market_cap"))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-to-date statements per supplier and quarter; some quarters are missing on purpose."""
    d = F.col("l_shipdate").cast("date")
    ext, disc, tax, qty = _money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)"), F.col("l_quantity").cast("decimal(12,0)")
    q = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("ticker"), F.year(d).alias("fy"), F.quarter(d).alias("fq"))
        .agg(
            F.sum(ext).alias("revenue"), F.sum(ext * disc).alias("cost_of_goods_sold"), F.sum(ext * tax).alias("operating_income"), F.sum(ext * (tax - disc)).alias("net_income"),
            F.sum(ext * tax).alias("operating_cash_flow"), F.sum(qty * disc).alias("capital_expenditure"), F.sum(qty * tax).alias("eps"),
            F.sum(qty).alias("q"), F.count("*").alias("n"),
        )
    )
    year = Window.partitionBy("ticker", "fy").orderBy("fq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.last_day(F.make_date("fy", F.col("fq") * 3, F.lit(1)))
    out = q.select(
        "ticker", "fy", "fq", F.concat(F.col("fy").cast("string"), F.lit("Q"), F.col("fq").cast("string")).alias("fiscal_quarter"), end.alias("period_end"), F.date_add(end, 60).alias("report_date"),
        *(F.sum(c).over(year).cast("double").alias(c) for c in YTD),
        (F.col("q").cast("double") * 1000).alias("total_assets"), F.when(F.col("ticker") % 7 == 0, 0.0).otherwise(F.col("q").cast("double") * 400 - F.col("n") * 100).alias("total_equity"),
        (F.col("n") * 250.0).alias("total_debt"), F.when(F.col("n") % 3 != 0, F.col("q").cast("double") * 300).alias("current_assets"), (F.col("n") % 5 * 1000.0).alias("current_liabilities"),
    )
    return out.where("(ticker * 31 + fy * 7 + fq) % 11 <> 0")


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly series per order priority: mean order value, dated on the first of the month."""
    d = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("series"), d.alias("date"))
    return rows.agg((F.sum(_money("o_totalprice")).cast("double") / F.count("*")).alias("value"))


def daily_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("series"), d.alias("date"))
    return rows.agg((F.sum(_money("o_totalprice")).cast("double") / F.count("*")).alias("value"))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("ticker"), F.col("ts").cast("date").alias("date"), F.col("ts").alias("published_at"), F.col("event_type").alias("headline"), F.col("props").alias("url"), F.col("event_id").alias("seq"))


def report_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings per customer: the order's quarter, 60 days before receipt; repeated quarters are amendments."""
    d = F.col("o_orderdate").cast("date")
    of = F.date_sub(d, 60)
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("corp"), F.year(of).alias("bsns_year"), F.quarter(of).alias("q"), F.date_format(d, "yyyyMMdd").alias("rcept_dt"), F.col("o_orderkey").alias("rcept_no"))


def market_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-end caps per supplier: last bar of each month times shares that follow from the ticker."""
    p = prices(spark, sf_dir)
    last = p.groupBy("ticker", F.trunc("date", "MM").alias("month")).agg(F.max("date").alias("trade_date"), F.max_by("close", "date").alias("close"))
    firms = universe(spark, sf_dir).select("ticker", "market")
    return last.join(firms, "ticker").select("ticker", "market", "month", "trade_date", "close", F.floor(F.col("close") * (F.col("ticker") + 1000) + 0.5).cast("bigint").alias("market_cap"))


def labelled_quarter(d: Column) -> Column:
    return fiscal_quarter(d)


#: The same tables as DuckDB common table expressions, written on their own for the checks.
SQL = {
    "px": """px AS (SELECT l_suppkey AS ticker, l_shipdate::DATE AS date, floor(coalesce(arg_min(p, k), 0) * 100 + 0.5) / 100 AS open, floor(coalesce(max(p), 0) * 100 + 0.5) / 100 AS high, floor(coalesce(min(p), 0) * 100 + 0.5) / 100 AS low, floor(coalesce(arg_max(p, k), 0) * 100 + 0.5) / 100 AS close, coalesce(sum(l_quantity), 0) AS volume
 FROM (SELECT *, l_extendedprice / l_quantity AS p, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS k FROM lineitem) GROUP BY 1, 2)""",
    "idx": "idx AS (SELECT date, sum(close::DECIMAL(18,2))::DOUBLE / count(*) AS close, sum(volume) AS volume FROM px GROUP BY date)",
    "uni": "uni AS (SELECT s_suppkey AS ticker, r_name AS market, n_name AS sector, s_name AS name, s_acctbal AS market_cap FROM supplier LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON s_nationkey = n_nationkey)",
    "st": """sq AS (SELECT l_suppkey AS ticker, year(l_shipdate) AS fy, quarter(l_shipdate) AS fq, sum(e) AS revenue, sum(e * d) AS cost_of_goods_sold, sum(e * t) AS operating_income, sum(e * (t - d)) AS net_income, sum(e * t) AS operating_cash_flow, sum(q * d) AS capital_expenditure, sum(q * t) AS eps, sum(q) AS q, count(*) AS n
 FROM (SELECT l_suppkey, l_shipdate, l_extendedprice::DECIMAL(18,2) AS e, l_discount::DECIMAL(4,2) AS d, l_tax::DECIMAL(4,2) AS t, l_quantity::DECIMAL(12,0) AS q FROM lineitem) GROUP BY ALL),
st AS (SELECT ticker, fy::INT AS fy, fq::INT AS fq, fy || 'Q' || fq AS fiscal_quarter, last_day(make_date(fy, fq * 3, 1)) AS period_end, last_day(make_date(fy, fq * 3, 1)) + 60 AS report_date,
 """
    + ", ".join(f"(sum({c}) OVER w)::DOUBLE AS {c}" for c in YTD)
    + """, q::DOUBLE * 1000 AS total_assets, CASE WHEN ticker % 7 = 0 THEN 0 ELSE q::DOUBLE * 400 - n * 100 END AS total_equity, n * 250.0::DOUBLE AS total_debt, CASE WHEN n % 3 <> 0 THEN q::DOUBLE * 300 END AS current_assets, (n % 5) * 1000.0::DOUBLE AS current_liabilities
 FROM sq WINDOW w AS (PARTITION BY ticker, fy ORDER BY fq) QUALIFY (ticker * 31 + fy * 7 + fq) % 11 <> 0)""",
    "mac": "mac AS (SELECT o_orderpriority AS series, date_trunc('month', o_orderdate)::DATE AS date, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS value FROM orders GROUP BY 1, 2)",
    "dmac": "dmac AS (SELECT o_orderpriority AS series, o_orderdate::DATE AS date, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS value FROM orders GROUP BY 1, 2)",
    "nw": "nw AS (SELECT user_id AS ticker, ts::DATE AS date, ts AS published_at, event_type AS headline, props AS url, event_id AS seq FROM events)",
    "rl": "rl AS (SELECT o_custkey AS corp, year(o_orderdate::DATE - 60)::INT AS bsns_year, quarter(o_orderdate::DATE - 60)::INT AS q, strftime(o_orderdate, '%Y%m%d') AS rcept_dt, o_orderkey AS rcept_no FROM orders)",
    "cap": "cap AS (SELECT ticker, market, month, trade_date, close, floor(close * (ticker + 1000) + 0.5)::BIGINT AS market_cap FROM (SELECT ticker, date_trunc('month', date)::DATE AS month, max(date) AS trade_date, arg_max(close, date) AS close FROM px GROUP BY 1, 2) JOIN (SELECT ticker, market FROM uni) USING (ticker))",
}
_NEEDS = {"idx": ["px"], "cap": ["px", "uni"]}


def with_tables(names: str, rest: str) -> str:
    """``WITH`` the named tables (and what they need), then more of the query."""
    order: list[str] = []
    for n in names.split():
        for x in [*_NEEDS.get(n, []), n]:
            if x not in order:
                order.append(x)
    return "WITH " + ",\n".join(SQL[x] for x in order) + rest
