"""News: look-back windows, first-seen dedupe, the day-level catalog and its coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import days
from tidemark.operators.asof import keep_first, latest_n


def window(df: DataFrame, as_of: Column, lookback_days: int = 30, inclusive_start: bool = False, date: str = "date") -> DataFrame:
    """Items of the last ``lookback_days`` days; ``inclusive_start`` adds the day before them (31 days for 30)."""
    return df.where(F.col(date).between(F.date_sub(as_of, lookback_days if inclusive_start else lookback_days - 1), as_of))


def item_key(url: str = "url", headline: str = "headline", published: str = "published_at", date: str = "date") -> Column:
    """Identity of an item: its address, or headline and time where it has none."""
    when = F.coalesce(F.col(published).cast("string"), F.col(date).cast("string"))
    return F.when(F.coalesce(F.col(url), F.lit("")) != "", F.concat_ws("|", F.lit("url"), F.col(url))).otherwise(F.concat_ws("|", F.lit("headline"), F.col(headline), when))


def dedupe_first_seen(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return keep_first(df, keys, order)


def top_items(df: DataFrame, n: int = 15) -> DataFrame:
    """Newest first: time (or midnight of the date), then headline, both descending, nulls last."""
    return latest_n(df, ["ticker"], [F.desc_nulls_last(F.coalesce("published_at", F.col("date").cast("timestamp_ntz"))), F.desc_nulls_last("headline"), F.desc("seq")], n)


def page_order_items(df: DataFrame, n: int = 15) -> DataFrame:
    """First ``n`` items per ticker as the page lists them, each address once."""
    return latest_n(keep_first(df, ["ticker", "url"], [F.asc("seq")]), ["ticker"], [F.asc("seq")], n)


def archive_pages(rows: DataFrame, start: Column, most_pages: int = 200) -> DataFrame:
    """Rows of the pages that a crawl reads: up to the first page that is empty, brings no new address or reaches before ``start``.

    ``rows``: ticker, page, seq, date, url. Pages beyond ``most_pages`` are never read.
    """
    seen = Window.partitionBy("ticker", "url").orderBy("page", "seq")
    fresh = rows.where(F.col("page") < most_pages).withColumn("_new", F.row_number().over(seen) == 1)
    pages = fresh.groupBy("ticker", "page").agg(F.bool_or("_new").alias("some_new"), F.min("date").alias("oldest"))
    order = Window.partitionBy("ticker").orderBy("page")
    gap = F.col("page") != F.row_number().over(order) - 1
    ended = ~F.col("some_new") | (F.col("oldest") < start) | gap
    before = F.coalesce(F.max(ended.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    read = pages.withColumn("_gap", gap).withColumn("_before", before).where("_before = 0 and not _gap").select("ticker", "page")
    return fresh.where("_new").drop("_new").join(read, ["ticker", "page"]).where(F.col("date") >= start)


def day_status(captures: DataFrame) -> DataFrame:
    """Status of every day that crawls cover.

    ``captures``: ticker, crawl_date, required_start, page_cap (reached), last_in_window. Without a page cap all days
    from the window's start are ok. With one the oldest day seen is partial and the days after it, up to the crawl
    date, are ok even when empty. ok is sticky over crawls; crawl dates are a sorted set.
    """
    start = F.when(F.col("page_cap"), F.coalesce("last_in_window", "crawl_date")).otherwise(F.col("required_start"))
    per_day = captures.select("ticker", "crawl_date", "page_cap", start.alias("first"), F.explode(days(start, F.col("crawl_date"))).alias("day"))
    partial = F.col("page_cap") & (F.col("day") == F.col("first"))
    marked = per_day.withColumn("rank", F.when(partial, 1).otherwise(2))
    out = marked.groupBy("ticker", "day").agg(F.max("rank").alias("rank"), F.array_sort(F.collect_set("crawl_date")).alias("crawl_dates"))
    return out.select("ticker", "day", F.when(F.col("rank") == 2, "ok").otherwise("partial").alias("status"), "crawl_dates")


def merge_catalog(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Union by (ticker, day, item key); entries that are there already win over new ones, earlier crawls over later."""
    rows = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    keyed = rows.withColumn("_key", item_key())
    return keep_first(keyed, ["ticker", "date", "_key"], [F.asc("_new"), F.asc("crawl_date"), F.asc("seq")]).drop("_new", "_key")


def merge_day_meta(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert of day states: ok stays ok, crawl dates unite."""
    rows = existing.unionByName(incoming)
    rank = F.max(F.when(F.col("status") == "ok", 2).otherwise(1))
    out = rows.groupBy("ticker", "day").agg(rank.alias("r"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("crawl_dates")))).alias("crawl_dates"))
    return out.select("ticker", "day", F.when(F.col("r") == 2, "ok").otherwise("partial").alias("status"), "crawl_dates")


def build_window(catalog: DataFrame, tickers: DataFrame, as_of: Column, lookback_days: int = 30) -> DataFrame:
    """Items of the window, one per key; the earliest captured day wins."""
    near = window(catalog.join(tickers.select("ticker"), "ticker", "left_semi"), as_of, lookback_days)
    return keep_first(near.withColumn("_key", item_key()), ["ticker", "_key"], [F.asc("date"), F.asc("seq")]).drop("_key")


def coverage(tickers: DataFrame, meta: DataFrame, items: DataFrame, as_of: Column, lookback_days: int = 30) -> DataFrame:
    """Per ticker: captured, missing and page-capped days of the window, items, and ok only when nothing is amiss."""
    span = tickers.select("ticker", F.explode(days(F.date_sub(as_of, lookback_days - 1), as_of)).alias("day"))
    state = span.join(meta.select("ticker", "day", "status"), ["ticker", "day"], "left")
    sorted_days = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("day"))))
    agg = state.groupBy("ticker").agg(F.count("status").alias("captured_days"), sorted_days(F.col("status").isNull()).alias("missing_days"), sorted_days(F.col("status") == "partial").alias("capped_days"))
    n = window(items, as_of, lookback_days).groupBy("ticker").agg(F.count("*").alias("raw_count"))
    ok = (F.size("missing_days") == 0) & (F.size("capped_days") == 0)
    return agg.join(n, "ticker", "left").select("ticker", "captured_days", "missing_days", "capped_days", F.coalesce("raw_count", F.lit(0)).alias("raw_count"), F.when(ok, "ok").otherwise("degraded").alias("status"))
