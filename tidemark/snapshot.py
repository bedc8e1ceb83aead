"""Monthly snapshots: a bundle of input tables, frozen for one or many decision dates in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import counts_json, short_sha256
from tidemark.operators import asof, news, sectors


@dataclass(frozen=True)
class Tables:
    """One DataFrame per kind of provider; any may be an empty table of the right shape."""

    universe: DataFrame
    prices: DataFrame
    quarters: DataFrame
    filings: DataFrame
    news: DataFrame
    macro: DataFrame
    benchmark: DataFrame


#: Which of a profile's tables come from the official sources; the others are public or, where there is no public one, empty.
PROFILES = {
    "official": {"prices", "quarters", "filings", "news", "macro", "benchmark"},
    "official_enriched": {"prices", "quarters", "filings", "news", "macro", "benchmark"},
    "ci_safe": set(),
}


def tables_of(profile: str, official: Tables, public: Tables, quarters: DataFrame | None = None) -> Tables:
    """The bundle of a named profile. ``quarters`` (stored statements) replaces the profile's own."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile}; known: {', '.join(PROFILES)}")
    chosen = {f.name: getattr(official if f.name in PROFILES[profile] or f.name == "universe" else public, f.name) for f in fields(Tables)}
    return Tables(**(chosen | ({"quarters": quarters} if quarters is not None else {})))


@dataclass(frozen=True)
class Config:
    bars: int = 300
    quarters: int = 8
    news_items: int = 15
    news_days: int = 30


def build(t: Tables, as_of: Column, config: Config = Config()) -> dict[str, DataFrame]:
    """Everything known on ``as_of``: flat tables, each cut and limited per ticker."""
    members = t.universe.select("ticker")
    mine = lambda df: df.join(members, "ticker", "left_semi")
    prices = asof.latest_n(asof.as_of_cut(mine(t.prices), as_of), ["ticker"], [F.desc("date")], config.bars)
    quarters = asof.latest_n(asof.as_of_cut(mine(t.quarters), as_of, "report_date"), ["ticker"], [F.desc("report_date")], config.quarters)
    filings = asof.latest_n(asof.as_of_cut(mine(t.filings), as_of, "filing_date"), ["ticker"], [F.desc("filing_date")], 1)
    items = news.top_items(news.window(mine(t.news), as_of, config.news_days), config.news_items)
    closes = asof.latest_value(prices, ["ticker"], "close", "date", as_of).select("ticker", F.col("close").alias("last_close"))
    latest = asof.latest_n(quarters, ["ticker"], [F.desc("report_date")], 1).join(closes, "ticker", "left")
    benchmark = asof.as_of_cut(t.benchmark, as_of).orderBy(F.desc("date")).limit(config.bars)
    macro = asof.latest_value(t.macro, ["category", "key"], "value_num", "date", as_of, 180)
    return {"prices": prices, "quarters": quarters, "filings": filings, "news": items, "benchmark": benchmark, "macro": macro, "sector_averages": sectors.sector_averages(t.universe, latest)}


def nested(parts: dict[str, DataFrame], universe: DataFrame) -> DataFrame:
    """One row per ticker with its bars oldest first, quarters and news newest first."""
    bar, quarter = [c for c in parts["prices"].columns if c != "ticker"], [c for c in parts["quarters"].columns if c not in {"ticker", "report_date"}]
    bars = parts["prices"].groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("date", *(c for c in bar if c != "date")))).alias("prices"))
    quarters = parts["quarters"].groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("report_date", *quarter)), asc=False).alias("quarters"))
    items = parts["news"].groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("published_at", "headline", "url")), asc=False).alias("news"))
    out = universe.select("ticker", "sector")
    for p in (bars, quarters, items, parts["filings"]):
        out = out.join(p, "ticker", "left")
    return out


def content_hash(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Short hash of the rows per ticker as JSON with sorted keys, one for each group of ``by``: a universe's worth of counts."""
    counts = df.groupBy(*by, "ticker").agg(F.count("*").alias("n"))
    kv = F.struct(F.col("ticker").cast("string").alias("key"), F.col("n").alias("value"))
    return counts.groupBy(*by).agg(short_sha256(counts_json(F.collect_list(kv))).alias(name))


def content_hashes(parts: dict[str, DataFrame]) -> DataFrame:
    """One row of hashes of a snapshot's counts."""
    out = content_hash(parts["prices"], "prices_hash")
    for k in ("quarters", "filings", "news"):
        out = out.crossJoin(content_hash(parts[k], f"{k}_hash"))  # single rows
    return out
