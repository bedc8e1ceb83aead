"""As-of cuts, latest-N, staleness bounds and source priority. Ties are always broken by the caller's order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_yyyymmdd


def as_of_cut(df: DataFrame, as_of: Column, available: str = "date", lag_days: int = 0) -> DataFrame:
    """Rows known on ``as_of``. The comparison stays on the bare column where there is no lag, so scans can use it."""
    return df.where(F.col(available) <= (F.date_sub(as_of, lag_days) if lag_days else as_of))


def latest_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each key in ``order``; Spark limits each group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def latest_value(df: DataFrame, keys: Sequence[str], value: str, date: str, as_of: Column, lookback_days: int | None = None) -> DataFrame:
    """Newest non-null value on or before ``as_of``, within a lookback: a partial aggregate, no sort."""
    rows = df.where((F.col(date) <= as_of) & F.col(value).isNotNull())
    if lookback_days is not None:
        rows = rows.where(F.col(date) >= F.date_sub(as_of, lookback_days))
    return rows.groupBy(*keys).agg(F.max_by(value, date).alias(value), F.max(date).alias(date))


def newest_snapshot(df: DataFrame, keys: Sequence[str], date: str, as_of: Column, max_age_days: int | None) -> DataFrame:
    """All rows of each key's newest snapshot on or before ``as_of``; none if that is older than the bound."""
    newest = df.where(F.col(date) <= as_of).groupBy(*keys).agg(F.max(date).alias("_newest"))
    if max_age_days is not None:
        newest = newest.where(F.datediff(as_of, "_newest") <= max_age_days)
    return df.join(newest.select(*keys, F.col("_newest").alias(date)), [*keys, date])


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str, values: Sequence[str], max_age_days: int | None = None) -> DataFrame:
    """For every left row the newest right row of its keys on or before its date.

    Both sides go through one shuffle on the keys: a union sorted by date, then the last values carried forward. No
    range join, so long histories do not multiply. Left rows without a match keep nulls; rows of equal date match.
    """
    pick = F.struct(F.col(right_date).alias("d"), *(F.col(v).alias(v) for v in values))
    r = right.select(*keys, F.col(right_date).alias("_at"), F.lit(0).alias("_side"), pick.alias("_right"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("s")).schema["s"].dataType).alias("_left"))
    lft = left.select(*keys, F.col(left_date).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(r.schema["_right"].dataType).alias("_right"), F.struct(*left.columns).alias("_left"))
    w = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = r.unionByName(lft).withColumn("_m", F.last("_right", ignorenulls=True).over(w)).where("_side = 1")
    ok = F.lit(True) if max_age_days is None else F.datediff(F.col("_at"), F.col("_m.d")) <= max_age_days
    return out.select("_left.*", F.when(ok, F.col("_m.d")).alias(f"matched_{right_date}"), *(F.when(ok, F.col(f"_m.{v}")).alias(v) for v in values))


def nearest_value(df: DataFrame, keys: Sequence[str], value: str, date: str, target: Column) -> DataFrame:
    """Value nearest in days to ``target``; of two at the same distance the later."""
    order = F.abs(F.datediff(date, target)).cast("bigint") * 10_000_000 - F.unix_date(date)  # one number: no sort
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(value))


def first_source(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Ordered fallback: each key's rows come from the first source that has any; adds ``source_rank``."""
    tagged = [s.withColumn("source_rank", F.lit(i)) for i, s in enumerate(sources)]
    rows = tagged[0]
    for t in tagged[1:]:
        rows = rows.unionByName(t, allowMissingColumns=True)
    best = rows.groupBy(*keys).agg(F.min("source_rank").alias("source_rank"))
    return rows.join(best, [*keys, "source_rank"])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return latest_n(df, keys, order, 1)


def last_of_month(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Each key's last date in every calendar month."""
    return df.groupBy(*keys, F.trunc(date, "MM").alias("month")).agg(F.max(date).alias(date))


def missing_combinations(expected: Sequence[DataFrame], present: DataFrame) -> DataFrame:
    """Combinations of small dimension tables that ``present`` lacks."""
    grid = expected[0]
    for e in expected[1:]:
        grid = grid.crossJoin(e)  # names times dates: bounded by the calendar, not by the data
    return grid.join(present.select(*grid.columns).distinct(), grid.columns, "left_anti")


def look_ahead(df: DataFrame, available: str, as_of: Column) -> DataFrame:
    """Rows that break the point-in-time promise; a correct result has none."""
    return df.where(F.col(available) > as_of)


def price_window(prices: DataFrame, as_of: Column, bars: int, days_per_bar: float, least_days: int = 0) -> DataFrame:
    """Last ``bars`` bars per ticker within the calendar days that a source is asked for: int(days_per_bar * bars) back."""
    start = F.date_sub(as_of, max(int(days_per_bar * bars), least_days))
    return latest_n(prices.where(F.col("date").between(start, as_of)), ["ticker"], [F.desc("date")], bars)


def first_fresh(sources: Sequence[tuple[DataFrame, int | None]], keys: Sequence[str], date: str, as_of: Column) -> DataFrame:
    """Ordered snapshot sources with a staleness bound each: a key's newest snapshot from the first source that is fresh enough."""
    return first_source([newest_snapshot(df, keys, date, as_of, age) for df, age in sources], keys)


def stale_fallback(fresh: DataFrame, cache: DataFrame, keys: Sequence[str], date: str, as_of: Column) -> DataFrame:
    """Fresh rows, and for keys without any the newest cached ones on or before ``as_of``, however old; adds ``is_stale``."""
    kept = newest_snapshot(cache, keys, date, as_of, None)
    return first_source([fresh, kept], keys).withColumn("is_stale", F.col("source_rank") == 1).drop("source_rank")


def compact_date_cut(df: DataFrame, as_of: Column, available: str) -> DataFrame:
    """Rows whose YYYYMMDD text is a date on or before ``as_of``. Missing and malformed dates are known never, rather than always."""
    return df.withColumn("_known", parse_yyyymmdd(F.col(available))).where(F.col("_known") <= as_of).drop("_known")
