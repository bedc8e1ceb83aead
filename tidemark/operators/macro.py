"""Macro series: latest values, changes, spreads and stances. One row per series; ``as_of`` is an argument."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import period_slot
from tidemark.functions.numbers import or_missing, round_half_up
from tidemark.operators.asof import latest_value, nearest_value


def latest(df: DataFrame, as_of: Column, lookback_days: int = 90, digits: int = 4) -> DataFrame:
    out = latest_value(df, ["series"], "value", "date", as_of, lookback_days)
    return out.withColumn("value", round_half_up(F.col("value"), digits))


def yoy_nearest(df: DataFrame, as_of: Column) -> DataFrame:
    """Change of the last value against the one nearest to a year before ``as_of``, in percent.

    At least two observations within 400 days are needed; a zero base gives null.
    """
    known = df.where((F.col("date") <= as_of) & (F.col("date") >= F.date_sub(as_of, 400)) & F.col("value").isNotNull())
    now = known.groupBy("series").agg(F.max_by("value", "date").alias("cur"), F.count("*").alias("n"))
    past = nearest_value(known, ["series"], "value", "date", F.date_sub(as_of, 365)).withColumnRenamed("value", "past")
    change = F.when(F.col("n") >= 2, round_half_up((F.col("cur") - F.col("past")) / or_missing(F.col("past")) * 100, 1))
    return now.join(past, "series").select("series", change.alias("yoy"))


def yoy_same_period(df: DataFrame, as_of: Column, period: str) -> DataFrame:
    """Last value against the same month or quarter of the year before; the earliest observation of that slot counts."""
    known = df.where((F.col("date") <= as_of) & F.col("value").isNotNull())
    slot = lambda d: F.coalesce(period_slot(F.col(d), F.lit(period)), F.lit(-1))
    last = known.groupBy("series").agg(F.max_by("value", "date").alias("cur"), F.max("date").alias("d")).withColumn("y", F.year("d") - 1).withColumn("s", slot("d"))
    base = known.withColumn("y", F.year("date")).withColumn("s", slot("date")).groupBy("series", "y", "s").agg(F.min_by("value", "date").alias("past"))
    out = last.join(base, ["series", "y", "s"], "left")
    return out.select("series", F.when(F.col("s") >= 0, round_half_up((F.col("cur") - F.col("past")) / or_missing(F.col("past")) * 100, 1)).alias("yoy"))


def last_two(df: DataFrame, as_of: Column, lookback_days: int) -> DataFrame:
    """The last value and the one before it, by observation and not by calendar."""
    known = df.where((F.col("date") <= as_of) & (F.col("date") >= F.date_sub(as_of, lookback_days)) & F.col("value").isNotNull())
    w = Window.partitionBy("series").orderBy(F.desc("date"))
    top = known.withColumn("r", F.row_number().over(w)).where("r <= 2")
    return top.groupBy("series").agg(F.max(F.when(F.col("r") == 1, F.col("value"))).alias("cur"), F.max(F.when(F.col("r") == 2, F.col("value"))).alias("prev"))


def mom(df: DataFrame, as_of: Column) -> DataFrame:
    return last_two(df, as_of, 90).select("series", round_half_up((F.col("cur") - F.col("prev")) / or_missing(F.col("prev")) * 100, 1).alias("mom"))


def level_change(df: DataFrame, as_of: Column, lookback_days: int = 90) -> DataFrame:
    return last_two(df, as_of, lookback_days).select("series", round_half_up(F.col("cur") - F.col("prev")).alias("change"))


def bar_return(prices: DataFrame, as_of: Column, bars: int = 21, keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """Percent change over ``bars`` bars up to the last one known; fewer than bars+1 give no row."""
    w = Window.partitionBy(*keys).orderBy(F.desc("date"))
    known = prices.where(F.col("date") <= as_of).withColumn("r", F.row_number().over(w)).where(F.col("r") <= bars + 1)
    ends = known.groupBy(*keys).agg(F.max(F.when(F.col("r") == 1, F.col("close"))).alias("cur"), F.max(F.when(F.col("r") == bars + 1, F.col("close"))).alias("past"), F.max("r").alias("n"))
    return ends.where(F.col("n") > bars).select(*keys, round_half_up((F.col("cur") - F.col("past")) / or_missing(F.col("past")) * 100, 1).alias("return_pct"))


def stance(rate: Column, hawkish: float, dovish: float) -> Column:
    """hawkish from one bound up, dovish from the other down, else neutral; null without a rate."""
    return F.when(rate >= hawkish, "hawkish").when(rate <= dovish, "dovish").when(rate.isNotNull(), "neutral")


def spread(a: Column, b: Column, digits: int) -> Column:
    return round_half_up(a - b, digits)


def series_bounds(tokens: DataFrame, start: Column, end: Column) -> DataFrame:
    """First and last available date of every series, on parsed tokens."""
    return tokens.groupBy("series").agg(F.min(start).alias("first_date"), F.max(end).alias("last_date"))


def clamp(first: Column, last: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """A requested range cut to the available one; callers drop rows whose start lies after their end."""
    return F.greatest(first, low), F.least(last, high)


def _averages(bars: pd.DataFrame) -> pd.DataFrame:
    """Exponential averages of one ticker's bars: each value starts at the first bar that has one and moves by its share of the gap."""
    bars = bars.sort_values("date", kind="stable")
    ema = lambda x, alpha: x.ewm(alpha=alpha, adjust=False).mean()
    move = bars["close"].diff()
    macd = ema(bars["close"], 2 / 13) - ema(bars["close"], 2 / 27)
    up, down = ema(move.clip(lower=0), 1 / 14), ema((-move).clip(lower=0), 1 / 14)
    strength = 100 - 100 / (1 + up / down.where(down != 0))
    rsi = strength.where(down != 0, 100.0).where((down != 0) | (up != 0), 50.0).where(move.notna() | up.notna())
    return bars.assign(macd=macd, macd_signal=ema(macd, 2 / 10), rsi_14=rsi)


def technical_indicators(prices: DataFrame, keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """Rates of change, Bollinger bands (20), MACD (12, 26, 9), RSI (14) and stochastics (14, 3, 3) for every bar.

    Fixed look-backs are window frames. Exponential averages depend on all earlier bars, so each ticker's bars are one
    Arrow group and one pass (a ticker's history is bounded by its trading days).
    """
    w = Window.partitionBy(*keys).orderBy("date")
    back = lambda n: w.rowsBetween(-(n - 1), 0)
    bars = prices.select(*keys, "date", F.col("close").cast("double").alias("close"), F.col("high").cast("double").alias("high"), F.col("low").cast("double").alias("low"))
    own = ", ".join(f"`{n}` {k}" for n, k in bars.dtypes)
    df = bars.groupBy(*keys).applyInPandas(_averages, f"{own}, macd double, macd_signal double, rsi_14 double")
    df = df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("macd", "macd_signal", "rsi_14")})
    for n in (5, 10, 20, 30, 21, 63, 126, 252):
        df = df.withColumn(f"roc_{n}", F.try_divide(F.col("close"), or_missing(F.lag("close", n).over(w))) * 100 - 100)
    mid, sd = F.avg("close").over(back(20)), F.stddev_pop("close").over(back(20))
    full = F.count("*").over(back(20)) == 20
    df = df.withColumns({"bb_mid": F.when(full, mid), "bb_high": F.when(full, mid + 2 * sd), "bb_low": F.when(full, mid - 2 * sd)})
    low, high = F.min("low").over(back(14)), F.max("high").over(back(14))
    df = df.withColumn("stoch_raw", F.try_divide(F.col("close") - low, or_missing(high - low)) * 100)
    return df.withColumn("stoch_k", F.avg("stoch_raw").over(back(3))).withColumn("stoch_d", F.avg("stoch_k").over(back(3))).drop("stoch_raw")
