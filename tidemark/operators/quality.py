"""Data-quality checks as one table (check, entity, status, detail, metrics), and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEVERITY = {"ok": 0, "degraded": 1, "failed": 2}


def check_rows(df: DataFrame, check: str, entity: Column, failed: Sequence[tuple[Column, str]], degraded: Sequence[tuple[Column, str]] = (), metrics: dict[str, Column] | None = None) -> DataFrame:
    """A row per entity: the first rule that holds names the detail."""
    status, detail = F.lit("ok"), F.lit("")
    for rules, level in ((list(degraded), "degraded"), (list(failed), "failed")):
        for cond, name in reversed(rules):
            hit = F.coalesce(cond, F.lit(False))
            status, detail = F.when(hit, level).otherwise(status), F.when(hit, name).otherwise(detail)
    pairs = F.map_from_arrays(F.array(*(F.lit(k) for k in metrics)), F.array(*(v.cast("double") for v in metrics.values()))) if metrics else F.create_map().cast("map<string,double>")
    return df.select(F.lit(check).alias("check"), entity.cast("string").alias("entity"), status.alias("status"), detail.alias("detail"), pairs.alias("metrics"))


def check_prices(universe: DataFrame, prices: DataFrame, as_of: Column) -> DataFrame:
    """Failed when a ticker has no bars, bars of the future, or two bars on one date."""
    p = prices.groupBy("ticker").agg(F.count("*").alias("n"), F.max("date").alias("last"), F.count_distinct("date").alias("dates"))
    rows = universe.select("ticker").join(p, "ticker", "left")
    return check_rows(rows, "prices", F.col("ticker"), [(F.coalesce("n", F.lit(0)) == 0, "empty"), (F.col("last") > as_of, "future_date"), (F.col("dates") < F.col("n"), "duplicate_date")])


def check_sorted(rows: DataFrame, key: str, position: str, date: str) -> DataFrame:
    """Whether each key's dates ascend in the order given, and whether they are in order in either direction."""
    w = Window.partitionBy(key).orderBy(position)
    before = F.lag(date).over(w)
    steps = rows.withColumn("up", F.col(date) >= before).withColumn("down", F.col(date) <= before)
    up, down = (F.coalesce(F.bool_and(c), F.lit(True)) for c in ("up", "down"))
    return steps.groupBy(key).agg(up.alias("is_sorted"), (up | down).alias("either_way"))


def check_fundamentals(universe: DataFrame, quarters: DataFrame, as_of: Column, available: str = "report_date") -> DataFrame:
    q = quarters.groupBy("ticker").agg(F.count("*").alias("n"), F.max(available).alias("last"))
    rows = universe.select("ticker").join(q, "ticker", "left")
    return check_rows(rows, "fundamentals", F.col("ticker"), [(F.coalesce("n", F.lit(0)) == 0, "empty"), (F.col("last") > as_of, "future_report_date")])


def check_filings(universe: DataFrame, filings: DataFrame, as_of: Column) -> DataFrame:
    rows = universe.select("ticker").join(filings, "ticker", "left")
    blank = F.coalesce(F.trim("business_overview"), F.lit("")) == ""
    return check_rows(rows, "filing", F.col("ticker"), [(blank, "missing_business_overview"), (F.col("filing_date") > as_of, "future_filing_date")])


def check_news(news: DataFrame, audit: DataFrame, fields: Sequence[str], as_of: Column, lookback_days: int = 30) -> DataFrame:
    """News against the crawl's own records, position by position, then the window and repeated addresses."""
    place = lambda d: d.withColumn("pos", F.row_number().over(Window.partitionBy("ticker").orderBy("seq")))
    n = place(news).select("ticker", "pos", F.struct(*fields).alias("a"), "date", "url")
    m = place(audit).select("ticker", "pos", F.struct(*fields).alias("b"))
    start = F.date_sub(as_of, lookback_days - 1)
    g = n.join(m, ["ticker", "pos"], "full_outer").groupBy("ticker").agg(
        F.count("a").alias("n"), F.count("b").alias("m"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differ"), F.count_if(~F.col("date").between(start, as_of)).alias("outside"),
        F.count(F.nullif("url", F.lit(""))).alias("urls"), F.count_distinct(F.nullif("url", F.lit(""))).alias("distinct_urls"),
    )
    rules = [(F.col("n") != F.col("m"), "audit_count_mismatch"), (F.col("differ") > 0, "record_mismatch"), (F.col("outside") > 0, "date_out_of_window"), (F.col("urls") > F.col("distinct_urls"), "duplicate_url")]
    return check_rows(g, "news", F.col("ticker"), rules)


def check_coverage(universe: DataFrame, coverage: DataFrame, window_days: int | None = None) -> DataFrame:
    """Failed without coverage or when its days do not add up to the window; degraded unless its status is ok."""
    rows = universe.select("ticker").join(coverage, "ticker", "left")
    metrics = {"captured_days": F.col("captured_days"), "missing_days": F.size("missing_days"), "capped_days": F.size("capped_days")}
    failed = [(F.col("status").isNull(), "missing")]
    if window_days is not None:
        failed.append((F.col("captured_days") + F.size("missing_days") != window_days, "window_mismatch"))
    return check_rows(rows, "news_coverage", F.col("ticker"), failed, [(F.col("status") != "ok", "incomplete")], metrics)


def check_snapshot(snapshot: DataFrame, universe: DataFrame, expected_date: Column, sections: Sequence[str] = ("benchmark", "macro")) -> DataFrame:
    """One row per decision date: its date and number of tickers must be those asked for; empty market tables degrade it.

    ``snapshot``: decision_date, n_tickers and a count ``n_<section>`` for each market table.
    """
    size = universe.agg(F.count("*").alias("n_universe"))
    rows = snapshot.join(F.broadcast(size))  # one row
    empty = [(F.coalesce(F.col(f"n_{s}"), F.lit(0)) == 0, f"empty_{s}") for s in sections]
    return check_rows(rows, "snapshot", F.col("decision_date"), [(F.col("decision_date") != expected_date, "decision_date_mismatch"), (F.col("n_tickers") != F.col("n_universe"), "size_mismatch")], empty)


def check_outputs(spark: SparkSession, paths: dict[str, str], status: str | None = None, status_path: str | None = None) -> DataFrame:
    """One row per dataset: failed when it is absent, unreadable or empty; with a status file, that must say ``status``."""
    rows = []
    for name, path in paths.items():
        try:
            n = spark.read.parquet(path).limit(1).count()
            rows.append((name, "" if n else "empty"))
        except AnalysisException:
            rows.append((name, "missing"))
    if status_path is not None:
        try:
            said = spark.read.json(status_path).select("status").first()
        except AnalysisException:
            said = None
        rows.append(("summary", "" if said and said[0] == status else "status"))
    found = spark.createDataFrame(rows, "name string, problem string")
    return check_rows(found, "outputs", F.col("name"), [(F.col("problem") == p, p) for p in ("missing", "empty", "status")])


def preflight(universe: DataFrame, quarters: DataFrame, caps: DataFrame, need: Sequence[str]) -> DataFrame:
    """Per ticker, with one quarter and one cap each: failed without a quarter, degraded with the names of missing fields."""
    rows = universe.select("ticker").join(quarters, "ticker", "left").join(caps, "ticker", "left")
    gone = F.array_join(F.filter(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in need)), lambda x: x.isNotNull()), ",")
    return rows.select("ticker", F.when(F.col("fiscal_quarter").isNull(), "failed").when(gone != "", "degraded").otherwise("ok").alias("status"), gone.alias("missing"))


def summarize(checks: DataFrame) -> DataFrame:
    return checks.groupBy("check").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "degraded").alias("degraded"))


def roll_up(steps: DataFrame, capped: Sequence[str] = ("us",)) -> DataFrame:
    """Worst status of all steps; steps of the capped groups count as degraded at most."""
    level = F.create_map(*(x for k, v in SEVERITY.items() for x in (F.lit(k), F.lit(v))))[F.col("status")]
    held = F.when(F.col("step_group").isin(list(capped)), F.least(level, F.lit(1))).otherwise(level)
    worst = F.coalesce(F.max(held), F.lit(0))
    return steps.agg(F.when(worst == 2, "failed").when(worst == 1, "degraded").otherwise("ok").alias("status"), (F.when(worst == 2, 1).when(worst == 1, 2).otherwise(0)).alias("exit_code"))


def passes(checks: DataFrame) -> bool:
    """The gate: no failed check (degraded ones pass). Stops at the first."""
    return checks.where("status = 'failed'").limit(1).count() == 0


def field_coverage(quarters: DataFrame, fields: Sequence[str]) -> DataFrame:
    """How many tickers have each field in their latest quarter."""
    return quarters.agg(F.count("*").alias("tickers"), *(F.count(f).alias(f) for f in fields))


def complete(coverage: DataFrame, universe_size: int, fields: Sequence[str], share: float = 0.5) -> DataFrame:
    floor = int(universe_size * share)
    return coverage.select(F.lit(floor).alias("floor"), *((F.col(f) >= floor).alias(f"{f}_ok") for f in fields))


def warnings(coverage: DataFrame, fields: Sequence[str]) -> DataFrame:
    """A message for every field that nobody has."""
    return coverage.select(F.explode(F.filter(F.array(*(F.when(F.col(f) == 0, F.lit(f"no ticker has {f}")) for f in fields)), lambda m: m.isNotNull())).alias("warning"))


def failure_histogram(failures: DataFrame) -> DataFrame:
    """Distinct tickers per market and reason with the smallest ticker as the example."""
    return failures.groupBy("market", "reason").agg(F.count_distinct("ticker").alias("tickers"), F.min("ticker").alias("example"))


def output_rows(df: DataFrame) -> DataFrame:
    """Files and rows of a written dataset."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows")).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))
