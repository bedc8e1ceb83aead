"""Sector labels and guarded sector ratio averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_up, safe_ratio, truthy

METRICS = ["roa", "roe", "gross_margin", "operating_margin", "net_margin", "current_ratio", "debt_to_equity", "asset_turnover", "pe_ttm"]


def with_sector(universe: DataFrame, sectors: DataFrame, default: str = "General") -> DataFrame:
    """Left join of labels; unknown or blank ones get the default."""
    s = sectors.select("ticker", F.col("sector").alias("_sector"))
    return universe.join(s, "ticker", "left").withColumn("sector", F.coalesce(F.nullif(F.trim("_sector"), F.lit("")), F.lit(default))).drop("_sector")


def ratios(close: str = "last_close") -> dict[str, Column]:
    """Nine ratios of one quarter. Null numerators count as 0; a row without revenue and assets gives none."""
    c = F.col
    ok = truthy(c("revenue")) & truthy(c("total_assets"))
    top = lambda x: F.coalesce(c(x), F.lit(0.0))
    out = {
        "roa": safe_ratio(top("net_income"), c("total_assets")),
        "roe": F.when(truthy(c("total_equity")), safe_ratio(top("net_income"), c("total_equity"))),
        "gross_margin": safe_ratio(top("gross_profit"), c("revenue")),
        "operating_margin": safe_ratio(top("operating_income"), c("revenue")),
        "net_margin": safe_ratio(top("net_income"), c("revenue")),
        "current_ratio": F.when(c("current_liabilities") > 0, safe_ratio(top("current_assets"), c("current_liabilities"))),
        "debt_to_equity": F.when(c("total_equity") > 0, safe_ratio(top("total_debt"), c("total_equity"))),
        "asset_turnover": safe_ratio(c("revenue"), c("total_assets")),
        "pe_ttm": F.when(truthy(c(close)) & (c("eps") > 0), safe_ratio(c(close), c("eps") * 4)),
    }
    return {k: F.when(ok, v) for k, v in out.items()}


def sector_averages(members: DataFrame, quarters: DataFrame, close: str = "last_close") -> DataFrame:
    """Mean of each ratio per sector over the members' latest quarters; sectors without any value still appear.

    ``members``: ticker, sector. ``quarters``: one row per ticker. The means add DECIMALs, so any order gives the
    same digits; each metric has its own denominator because means skip nulls.
    """
    q = quarters.select("ticker", *(v.alias(k) for k, v in ratios(close).items()))
    rows = members.select("ticker", "sector").join(q, "ticker", "left")
    mean = lambda m: F.sum(F.col(m).cast("decimal(28,12)")).cast("double") / F.nullif(F.count(m), F.lit(0))
    return rows.groupBy("sector").agg(*(round_half_up(mean(m), 4).alias(m) for m in METRICS), F.count("roa").alias("n_tickers"))


def as_metric_map(averages: DataFrame) -> DataFrame:
    """sector, avg_metrics: a map without the metrics that have no contributor."""
    pairs = F.array(*(F.struct(F.lit(m).alias("key"), F.col(m).alias("value")) for m in METRICS))
    return averages.select("sector", F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("avg_metrics"))


def tickers_by_sector(members: DataFrame) -> DataFrame:
    return members.groupBy("sector").agg(F.array_sort(F.collect_list("ticker")).alias("tickers"))
