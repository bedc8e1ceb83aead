"""What is written, and the checks on it: snapshots, bundles, partitions, batches, caches, gates, with their checks in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import sinks
from tidemark.operators import asof, quality
from tidemark.plans.market import AS_OF, day

from tidemark.sources import adapters as A
from tidemark.sources import readers
from tidemark.sources.adapters import with_tables
from tidemark.storage import scratch_path
from tidemark.streaming import catalog as streams

_FIELDS = ["revenue", "total_assets", "current_assets", "issued_shares"]


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    known = asof.as_of_cut(A.statements(spark, sf), day(), "report_date")
    return asof.latest_n(known, ["ticker"], [F.desc("report_date")], 1).withColumn("issued_shares", F.lit(None).cast("double"))


def snapshot_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Compressed snapshot lines without null fields, and their metadata file, read again."""
    q = _latest(spark, sf).select("ticker", "fiscal_quarter", "revenue", "current_assets", "issued_shares")
    path, meta = scratch_path(spark, "snapshot"), scratch_path(spark, "snapshot-meta")
    sinks.write_snapshot(q, path)
    sinks.write_snapshot_metadata(q, meta, AS_OF)
    rows = spark.read.schema("as_of string, rows bigint").json(meta)
    lines = spark.read.text(path)
    found = lines.select("value", F.from_json("value", "ticker bigint, fiscal_quarter string, revenue double, current_assets double").alias("q"))
    names = F.array_join(F.array_sort(F.json_object_keys("value")), ",")
    return found.select("q.*", names.alias("names")).join(F.broadcast(rows))  # one row of metadata


def bundle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest and summary of a bundle as one JSON object, read again."""
    prices = asof.as_of_cut(A.prices(spark, sf), day())
    series = A.macro(spark, sf).select(F.when(F.col("series") < "3", "rates").otherwise("trade").alias("category"), F.col("series").alias("key"))
    row = sinks.bundle(A.universe(spark, sf), _latest(spark, sf), prices, series, _FIELDS, "2", F.lit("ok"))
    path = scratch_path(spark, "bundle")
    sinks.write_report(row, path)
    kind = "bundle_version string, status string, universe bigint, with_prices bigint, bars bigint, tickers bigint, revenue bigint, total_assets bigint, current_assets bigint, issued_shares bigint, warnings array<string>, bars_by_ticker map<string,bigint>, macro_keys map<string,bigint>"
    back = spark.read.schema(kind).json(path)
    listed = F.array_join(F.transform(F.array_sort(F.map_entries("macro_keys")), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), ",")
    return back.select("bundle_version", "status", "universe", "with_prices", "bars", "tickers", *_FIELDS, F.array_join("warnings", ";").alias("warnings"), F.size("bars_by_ticker").alias("listed"), F.aggregate(F.map_values("bars_by_ticker"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("listed_bars"), listed.alias("macro_keys"))


def caps_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Caps in a folder per market and year, one market written twice, read again."""
    caps = A.market_caps(spark, sf).select("ticker", "market", F.year("month").alias("year"), "trade_date", "market_cap")
    path = scratch_path(spark, "caps")
    sinks.write_partitions(caps, path, ["market", "year"], "ticker")
    sinks.write_partitions(caps.where("market = 'ASIA' and year = 1999").withColumn("market_cap", F.lit(1).cast("bigint")), path, ["market", "year"], "ticker")
    return readers.dated_snapshots(spark, path).groupBy("market", "year").agg(F.count("*").alias("n"), F.sum("market_cap").alias("total"))


def index_frames(spark: SparkSession, sf: str) -> DataFrame:
    """An index table under its stored names, stamped with the date of the request."""
    path = scratch_path(spark, "index")
    sinks.write_dated_frame(A.benchmark_prices(spark, sf), path, {"date": "날짜", "close": "종가"}, day())
    return spark.read.parquet(path).select(F.col("날짜").alias("date"), F.floor(F.col("종가") * 100 + 0.5).cast("bigint").alias("cents"), "as_of")


def stamped_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that were written with the time of collection; an empty table is not written."""
    path, none = scratch_path(spark, "stamped"), scratch_path(spark, "stamped-none")
    u = A.universe(spark, sf).select("ticker", "market")
    written = sinks.write_stamped(u, path)
    skipped = sinks.write_stamped(u.limit(0), none)
    return spark.read.parquet(path).select("ticker", "market", F.col("collected_at").isNotNull().alias("stamped"), F.lit(written).alias("written"), F.lit(skipped).alias("empty_written"))


def batch_state(spark: SparkSession, sf: str) -> DataFrame:
    """State after three batches, one of them written again."""
    path, u = scratch_path(spark, "batches"), A.universe(spark, sf)
    put = lambda where, batch, state: sinks.append_batch(u.where(where).select("ticker", F.lit(state).alias("state")), path, batch)
    put("true", 0, "queued")
    put("ticker % 2 = 0", 1, "failed")
    put("ticker % 2 = 0", 1, "done")
    put("ticker % 6 = 0", 2, "checked")
    return sinks.merge_batches(spark.read.parquet(path), ["ticker"])


def run_cursor(spark: SparkSession, sf: str) -> DataFrame:
    """Where a run resumes, per market: how many items are done and the next one."""
    u = A.universe(spark, sf).select("market", "ticker")
    return sinks.resume_cursor(u, u.where("ticker % 3 = 0"), ["market"], "ticker")


def checkpoint_triggers(spark: SparkSession, sf: str) -> DataFrame:
    """Why state is written after each item of a run of 1000 items, four seconds each."""
    e = A.table(spark, sf, "events").select("event_id")
    done = F.col("event_id") % 1000 + 1
    return e.select("event_id", sinks.checkpoint_due(done, done % 100 * 4, F.lit(1000)).alias("trigger"))


def response_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Answers put into a cache that has some of them, then one month taken out."""
    e = A.table(spark, sf, "events").select(F.concat_ws(":", F.lit("m"), "event_type", F.col("event_id").cast("string")).alias("key"), F.col("props").alias("answer"), "event_id")
    store = e.where("event_id % 2 = 0").select("key", F.lit("kept").alias("answer"))
    return sinks.cache_invalidate(sinks.cache_put(store, e.select("key", "answer")), ":click:")


def dq_filing(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf)
    filings = u.where("ticker % 4 <> 0").select("ticker", F.when(F.col("ticker") % 3 != 0, F.col("name")).otherwise("  ").alias("business_overview"), F.date_add(day(), F.when(F.col("ticker") % 5 == 0, 1).otherwise(-1)).alias("filing_date"))
    return quality.check_filings(u, filings, day()).drop("metrics")


def dq_news_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage of a 20-day window per ticker as a check; some tickers have none, some a wrong window."""
    from tidemark.operators import news
    from tidemark.plans.news import _captures, at

    meta = news.day_status(_captures(spark, sf))
    tickers = A.news(spark, sf).select("ticker").distinct()
    cover = news.coverage(tickers.where("ticker % 4 <> 0"), meta, A.news(spark, sf), at(), 20).withColumn("captured_days", F.col("captured_days") + F.when(F.col("ticker") % 9 == 0, 1).otherwise(0))
    out = quality.check_coverage(tickers, cover, 20)
    return out.select("check", "entity", "status", "detail", F.col("metrics")["missing_days"].alias("missing_days"))


def dq_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of four dates against the one asked for, the universe's size and their market tables."""
    u = A.universe(spark, sf)
    dates = u.groupBy().agg(F.count("*").alias("n")).select("n", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    snaps = dates.select(F.date_sub(day(), F.when(F.col("k") == 1, 1).otherwise(0)).alias("decision_date"), (F.col("n") - F.when(F.col("k") == 2, 1).otherwise(0)).alias("n_tickers"), F.col("k").alias("n_benchmark"), F.lit(5).alias("n_macro"))
    return quality.check_snapshot(snaps, u, day()).drop("metrics")


def _outputs(spark: SparkSession, sf: str, status: str) -> tuple[dict[str, str], str]:
    paths = {k: scratch_path(spark, f"out-{k}") for k in ("prices", "quarters", "news", "macro")}
    A.universe(spark, sf).write.parquet(paths["prices"])
    A.universe(spark, sf).write.parquet(paths["quarters"])
    A.universe(spark, sf).limit(0).write.parquet(paths["news"])
    summary = scratch_path(spark, "out-summary")
    sinks.write_report(spark.range(1).select(F.lit(status).alias("status")), summary)
    return paths, summary


def dq_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Four datasets of which one is empty and one absent."""
    return quality.check_outputs(spark, _outputs(spark, sf, "ok")[0]).drop("metrics")


def dq_us_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a summary that does not say ok."""
    paths, summary = _outputs(spark, sf, "degraded")
    return quality.check_outputs(spark, paths, "ok", summary).drop("metrics")


def dq_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The gate over two sets of checks: degraded ones pass, a failed one does not."""
    checks = dq_outputs(spark, sf)
    fine = checks.withColumn("status", F.lit("degraded"))
    return spark.range(1).select(F.lit(quality.passes(checks)).alias("with_failures"), F.lit(quality.passes(fine)).alias("degraded_only"))


def stale_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Last caps per ticker where the source answered, else what an earlier run had cached."""
    caps = A.market_caps(spark, sf).select("ticker", "trade_date", "market_cap")
    fresh = asof.newest_snapshot(caps.where("ticker % 3 <> 0"), ["ticker"], "trade_date", day(), 31)
    return asof.stale_fallback(fresh, caps.where("trade_date < date'1999-06-01'"), ["ticker"], "trade_date", day())


def stream_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events per type and hour, counted as a stream over several files."""
    source = scratch_path(spark, "stream-source")
    events = A.table(spark, sf, "events").select("ts", "event_type")
    events.repartition(4, "event_type").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    counts = streams.drained(streams.windowed_counts(stream), scratch_path(spark, "stream-counts"), scratch_path(spark, "stream-state"))
    return counts.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


def stream_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """News of two crawls merged into the catalog as a stream: what came first stays."""
    source, out = scratch_path(spark, "crawl-source"), scratch_path(spark, "crawl-catalog")
    rows = A.news(spark, sf).withColumn("crawl_date", F.col("date"))
    rows.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    streams.ingest(stream, out, scratch_path(spark, "crawl-state")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{out}/v0").groupBy("ticker").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


def output_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a written dataset."""
    path = scratch_path(spark, "rows")
    A.universe(spark, sf).write.parquet(path)
    return quality.output_rows(spark.read.parquet(path)).select("rows")


QUERIES = {
    f.__name__: f
    for f in (
        snapshot_round_trip, bundle_manifest, caps_by_partition, index_frames, stamped_rows, batch_state, run_cursor, checkpoint_triggers, response_cache, dq_filing, dq_news_coverage, dq_snapshot, dq_outputs, dq_us_outputs, dq_gate, stale_cache,
        stream_window_counts, stream_catalog, output_rows,
    )
}

_LQ = f", lq AS (SELECT * FROM st WHERE report_date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY report_date DESC) = 1)"
_OUT = """SELECT 'outputs' AS "check", unnest(['prices', 'quarters', 'news', 'macro']) AS entity, unnest(['ok', 'ok', 'failed', 'failed']) AS status, unnest(['', '', 'empty', 'missing']) AS detail"""

SQL = {
    "snapshot_round_trip": with_tables("st", _LQ + f" SELECT ticker, fiscal_quarter, revenue, current_assets, CASE WHEN current_assets IS NULL THEN 'fiscal_quarter,revenue,ticker' ELSE 'current_assets,fiscal_quarter,revenue,ticker' END AS names, '{AS_OF}' AS as_of, (SELECT count(*) FROM lq) AS rows FROM lq"),
    "bundle_manifest": with_tables(
        "px uni st mac",
        _LQ + f", p AS (SELECT * FROM px WHERE date <= DATE '{AS_OF}') SELECT '2' AS bundle_version, 'ok' AS status, (SELECT count(*) FROM uni) AS universe, (SELECT count(DISTINCT ticker) FROM p) AS with_prices, (SELECT count(*) FROM p) AS bars, count(*) AS tickers, count(revenue) AS revenue, count(total_assets) AS total_assets, count(current_assets) AS current_assets, 0::BIGINT AS issued_shares, 'no ticker has issued_shares' AS warnings,"
        " (SELECT count(DISTINCT ticker) FROM p)::INT AS listed, (SELECT count(*) FROM p) AS listed_bars, (SELECT string_agg(c || '=' || n, ',' ORDER BY c) FROM (SELECT CASE WHEN series < '3' THEN 'rates' ELSE 'trade' END AS c, count(DISTINCT series) AS n FROM mac GROUP BY 1)) AS macro_keys FROM lq",
    ),
    "caps_by_partition": with_tables("cap", " SELECT market, year(month)::INT AS year, count(*) AS n, sum(CASE WHEN market = 'ASIA' AND year(month) = 1999 THEN 1 ELSE market_cap END)::BIGINT AS total FROM cap GROUP BY 1, 2"),
    "index_frames": with_tables("idx", f" SELECT date, floor(close * 100 + 0.5)::BIGINT AS cents, DATE '{AS_OF}' AS as_of FROM idx"),
    "stamped_rows": with_tables("uni", " SELECT ticker, market, true AS stamped, true AS written, false AS empty_written FROM uni"),
    "batch_state": with_tables("uni", " SELECT ticker, CASE WHEN ticker % 6 = 0 THEN 'checked' WHEN ticker % 2 = 0 THEN 'done' ELSE 'queued' END AS state FROM uni"),
    "run_cursor": with_tables("uni", " SELECT market, count(*) FILTER (ticker % 3 = 0) AS done, min(ticker) FILTER (ticker % 3 <> 0) AS next FROM uni GROUP BY 1"),
    "checkpoint_triggers": "WITH d AS (SELECT event_id, event_id % 1000 + 1 AS n FROM events) SELECT event_id, CASE WHEN n >= 1000 THEN 'end' WHEN n % 25 = 0 THEN 'count' WHEN n % 100 * 4 >= 300 THEN 'time' END AS trigger FROM d",
    "response_cache": "SELECT 'm:' || event_type || ':' || event_id AS key, CASE WHEN event_id % 2 = 0 THEN 'kept' ELSE props END AS answer FROM events WHERE event_type <> 'click'",
    "dq_filing": with_tables("uni", """, d AS (SELECT ticker, CASE WHEN ticker % 4 = 0 OR ticker % 3 = 0 THEN 'missing_business_overview' WHEN ticker % 5 = 0 THEN 'future_filing_date' ELSE '' END AS detail FROM uni) SELECT 'filing' AS "check", ticker::VARCHAR AS entity, CASE WHEN detail = '' THEN 'ok' ELSE 'failed' END AS status, detail FROM d"""),
    "dq_snapshot": f"""SELECT 'snapshot' AS "check", unnest(['{AS_OF}', (DATE '{AS_OF}' - 1)::VARCHAR, '{AS_OF}', '{AS_OF}']) AS entity, unnest(['degraded', 'failed', 'failed', 'ok']) AS status, unnest(['empty_benchmark', 'decision_date_mismatch', 'size_mismatch', '']) AS detail""",
    "dq_outputs": _OUT,
    "dq_us_outputs": _OUT + " UNION ALL SELECT 'outputs', 'summary', 'failed', 'status'",
    "dq_gate": "SELECT false AS with_failures, true AS degraded_only",
    "stale_cache": with_tables("cap", f", f AS (SELECT ticker, max(trade_date) AS trade_date, arg_max(market_cap, trade_date) AS market_cap FROM cap WHERE trade_date <= DATE '{AS_OF}' GROUP BY 1), o AS (SELECT ticker, max(trade_date) AS trade_date, arg_max(market_cap, trade_date) AS market_cap FROM cap WHERE trade_date < DATE '1999-06-01' GROUP BY 1), g AS (SELECT * FROM f WHERE ticker % 3 <> 0 AND DATE '{AS_OF}' - trade_date <= 31) SELECT *, false AS is_stale FROM g UNION ALL SELECT *, true FROM o WHERE ticker NOT IN (SELECT ticker FROM g)"),
    "stream_window_counts": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_catalog": "WITH k AS (SELECT user_id AS ticker, min(event_id) AS seq FROM events GROUP BY user_id, ts::DATE, props) SELECT ticker, count(*) AS n, sum(seq)::BIGINT AS seqs FROM k GROUP BY 1",
    "output_rows": with_tables("uni", " SELECT count(*) AS rows FROM uni"),
}


def _from_news() -> None:
    from tidemark.plans.news import SQL as NEWS

    inner = NEWS["news_window_coverage"]
    SQL["dq_news_coverage"] = f"""WITH c AS ({inner}), t AS (SELECT DISTINCT user_id AS ticker FROM events), j AS (SELECT t.ticker, c.status AS s, n_missing, captured_days + CASE WHEN t.ticker % 9 = 0 THEN 1 ELSE 0 END + n_missing AS days FROM t LEFT JOIN c ON t.ticker = c.ticker AND t.ticker % 4 <> 0)
 SELECT 'news_coverage' AS "check", ticker::VARCHAR AS entity, CASE WHEN s IS NULL OR days <> 20 THEN 'failed' WHEN s <> 'ok' THEN 'degraded' ELSE 'ok' END AS status, CASE WHEN s IS NULL THEN 'missing' WHEN days <> 20 THEN 'window_mismatch' WHEN s <> 'ok' THEN 'incomplete' ELSE '' END AS detail, CASE WHEN s IS NOT NULL THEN n_missing END::DOUBLE AS missing_days FROM j"""


_from_news()
