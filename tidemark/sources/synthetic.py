"""Generated inputs: seeded by ticker, the same on any cluster. Values follow Spark's own generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_seed


def _uniform(*parts: Column) -> Column:
    """In (0, 1), fixed by its parts."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1_000_003)).cast("double") + 0.5) / 1_000_003.0


def _normal(*parts: Column) -> Column:
    """Box-Muller on two hashes."""
    return F.sqrt(-2 * F.log(_uniform(*parts, F.lit("u")))) * F.cos(2 * F.lit(3.141592653589793) * _uniform(*parts, F.lit("v")))


def prices(tickers: DataFrame, end: Column, n_days: int = 300, mu: float = 0.0003, sigma: float = 0.02) -> DataFrame:
    """Geometric Brownian motion over the last ``n_days`` weekdays up to ``end``."""
    back = F.explode(F.sequence(F.lit(0), F.lit(int(n_days * 1.5) + 10))).alias("k")
    days = tickers.select("ticker", back).withColumn("date", F.date_sub(end, F.col("k"))).where(F.weekday("date") < 5)
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    days = days.withColumn("r", F.row_number().over(newest)).where(F.col("r") <= n_days)
    seed = md5_seed(F.col("ticker"))
    step = F.lit(mu) + F.lit(sigma) * _normal(seed, F.col("date"))
    path = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    start = 20 + F.pmod(seed, F.lit(180)).cast("double")
    close = F.exp(F.log(start) + F.sum(step).over(path))
    spread = F.lit(sigma) / 2 * _uniform(seed, F.col("date"), F.lit("spread"))
    out = days.select("ticker", "date", close.alias("close"), spread.alias("s"), F.floor(1e5 + 9e5 * _uniform(seed, F.col("date"), F.lit("vol"))).cast("double").alias("volume"))
    r2 = lambda c: F.floor(c * 100 + 0.5) / 100
    return out.select("ticker", "date", r2(F.col("close") * (1 - F.col("s") / 2)).alias("open"), r2(F.col("close") * (1 + F.col("s"))).alias("high"), r2(F.col("close") * (1 - F.col("s"))).alias("low"), r2(F.col("close")).alias("close"), "volume")


def fundamentals(tickers: DataFrame, as_of: Column, n_quarters: int = 8) -> DataFrame:
    """Quarters ending 90 days apart, reported 20 to 59 days later and never after ``as_of``."""
    q = tickers.select("ticker", F.explode(F.sequence(F.lit(0), F.lit(n_quarters - 1))).alias("k")).withColumn("period_end", F.date_sub(as_of, 30 + F.col("k") * 90))
    seed = md5_seed(F.col("ticker"))
    lag = (20 + F.floor(40 * _uniform(seed, F.col("k"), F.lit("lag")))).cast("int")
    revenue = (500 + F.pmod(seed, F.lit(5000))).cast("double") * F.exp(0.05 * _normal(seed, F.col("k")))
    base = q.withColumn("report_date", F.least(F.date_add("period_end", lag), as_of)).withColumn("revenue", F.round(revenue, 1))
    part = lambda name, lo, hi: F.round(F.col("revenue") * (lo + (hi - lo) * _uniform(seed, F.col("k"), F.lit(name))), 1)
    return base.select(
        "ticker", F.concat(F.year("period_end").cast("string"), F.lit("Q"), F.quarter("period_end").cast("string")).alias("fiscal_quarter"), "report_date", "revenue",
        part("gross_profit", 0.3, 0.6).alias("gross_profit"), part("operating_income", 0.05, 0.25).alias("operating_income"), part("net_income", 0.02, 0.2).alias("net_income"),
        part("total_assets", 3, 6).alias("total_assets"), part("total_equity", 1, 3).alias("total_equity"), part("total_debt", 0.2, 1.5).alias("total_debt"),
        part("current_assets", 0.8, 1.6).alias("current_assets"), part("current_liabilities", 0.5, 1.2).alias("current_liabilities"), F.round(0.5 + 4 * _uniform(seed, F.col("k"), F.lit("eps")), 2).alias("eps"),
    )


def news(tickers: DataFrame, as_of: Column, n_items: int = 15) -> DataFrame:
    """Headlines from templates over the last 30 days."""
    seed = md5_seed(F.col("ticker"))
    templates = F.array(*map(F.lit, ("{t} reports quarterly results", "{t} opens a plant", "{t} names a new chief", "{t} faces an inquiry")))
    k = tickers.select("ticker", F.explode(F.sequence(F.lit(0), F.lit(n_items - 1))).alias("seq"))
    date = F.date_sub(as_of, F.floor(30 * _uniform(seed, F.col("seq"), F.lit("day"))).cast("int"))
    pick = F.element_at(templates, (1 + F.pmod(F.xxhash64(seed, F.col("seq")), F.lit(4))).cast("int"))
    return k.select("ticker", date.alias("date"), date.cast("timestamp").alias("published_at"), F.lit("wire").alias("source"), F.replace(pick, F.lit("{t}"), F.col("ticker")).alias("headline"), F.lit("").alias("summary"), F.lit(None).cast("string").alias("url"), "seq")


def universe(spark: SparkSession, n: int) -> DataFrame:
    ids = spark.range(n)
    return ids.select(F.lpad(F.col("id").cast("string"), 6, "0").alias("ticker"), F.element_at(F.array(F.lit("KOSPI"), F.lit("KOSDAQ")), (F.col("id") % 2 + 1).cast("int")).alias("market"), F.concat(F.lit("S"), (F.col("id") % 11).cast("string")).alias("sector"), F.concat(F.lit("Name "), F.col("id")).alias("name"))
