"""Universes: ranking by market cap, manifests, listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import normalize_ticker
from tidemark.operators.asof import keep_first


def top_by_cap(listing: DataFrame, caps: DataFrame, n: int) -> DataFrame:
    """Listed tickers with a positive cap, largest first, each once; ties go to the smaller ticker."""
    positive = caps.where("market_cap > 0").groupBy("ticker").agg(F.max("market_cap").alias("market_cap"))
    return positive.join(listing.select("ticker").distinct(), "ticker", "left_semi").orderBy(F.desc("market_cap"), "ticker").limit(n)


def manifest(caps: list[DataFrame], metadata: DataFrame, n: int) -> DataFrame:
    """Markets united, caps read as numbers, first row per ticker, top ``n``, metadata joined, ranks 1..n."""
    rows = caps[0]
    for c in caps[1:]:
        rows = rows.unionByName(c)
    rows = rows.withColumn("market_cap", F.col("market_cap").try_cast("double")).where("market_cap is not null and ticker is not null")
    best = keep_first(rows, ["ticker"], [F.desc("market_cap"), F.asc("market")]).orderBy(F.desc("market_cap"), "ticker").limit(n)
    # n rows meet in one task, as many as the manifest has
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("market_cap"), "ticker")))
    return ranked.join(metadata.drop("market", "market_cap"), "ticker", "left")


def listing_labels(listing: DataFrame, markets: list[str]) -> DataFrame:
    """Industry where it is filled, else sector; listed markets only, by prefix; one row per ticker."""
    known = F.lit(False)
    for m in markets:
        known = known | F.upper(F.col("market")).startswith(m)
    label = F.coalesce(F.nullif(F.trim("industry"), F.lit("")), F.nullif(F.trim("sector"), F.lit("")), F.lit("General"))
    rows = listing.where(known).withColumn("sector", label).withColumn("ticker", normalize_ticker(F.col("ticker")))
    return keep_first(rows, ["ticker"], [F.asc("market"), F.asc("sector")]).drop("industry")


def clean_tickers(df: DataFrame, pad: bool) -> DataFrame:
    t = F.trim("ticker")
    return df.withColumn("ticker", normalize_ticker(t) if pad else t).where("ticker is not null and ticker <> ''")


def member_count(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("n"))


def in_order(listing: DataFrame) -> DataFrame:
    """A universe by (market, ticker)."""
    return listing.orderBy("market", "ticker")


def all_tickers(listings: list[DataFrame]) -> DataFrame:
    """Every normalized ticker of several listings once, in order."""
    names = [x.select(F.col("ticker").cast("string").alias("ticker")) for x in listings]
    rows = reduce(DataFrame.union, names)
    return rows.select(normalize_ticker(F.col("ticker")).alias("ticker")).distinct().orderBy("ticker")


def index_members(table: DataFrame, fallback: DataFrame) -> DataFrame:
    """Members of an index: share classes are written with a dash; a fixed list stands in for an empty table."""
    chosen = table.select("ticker", "name", "sector", F.lit(0).alias("rank")).unionByName(fallback.select("ticker", "name", "sector", F.lit(1).alias("rank")))
    first = chosen.agg(F.min("rank").alias("first"))
    kept = chosen.join(F.broadcast(first), F.col("rank") == F.col("first")).drop("rank", "first")  # one row
    return kept.withColumn("ticker", F.replace(F.upper(F.trim("ticker")), F.lit("."), F.lit("-"))).orderBy("ticker")
