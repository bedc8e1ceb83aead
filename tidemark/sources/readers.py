"""Readers of stored inputs: universes, listings, statements, reports, news catalogs, snapshots by date in their path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.dates import parse_yyyymmdd
from tidemark.functions.numbers import parse_number
from tidemark.functions.text import normalize_ticker
from tidemark.operators.asof import keep_first
from tidemark.operators.universe import clean_tickers

# The column names of bars in both languages.
BAR_NAMES = {"open": ["시가", "Open"], "high": ["고가", "High"], "low": ["저가", "Low"], "close": ["종가", "Close"], "volume": ["거래량", "Volume"], "date": ["날짜", "Date"]}
CAP_NAMES = {"ticker": ["종목코드", "Code"], "name": ["종목명", "Name"], "market": ["시장", "Market"], "close": ["종가", "Close"], "market_cap": ["시가총액", "Marcap"], "issued_shares": ["상장주식수", "Stocks"]}
SECTOR_NAMES = {"ticker": ["종목코드", "Code"], "name": ["종목명", "Name"], "sector": ["업종명", "Sector"], "market": ["시장", "Market"]}
VALUATION_NAMES = {"ticker": ["종목코드", "Code"], "bps": ["BPS"], "per": ["PER"], "pbr": ["PBR"], "eps": ["EPS"], "div": ["DIV"], "dps": ["DPS"]}
INDEX_CODES = {"1001": "KOSPI", "2001": "KOSDAQ", "1028": "KOSPI200"}
#: What bulk extracts hold beside the date they are of.
BULK = {
    "market_cap": schemas.MARKET_CAP,
    "valuation": schemas.VALUATION,
    "investor_trading": "ticker string, date date, institutions double, corporations double, individuals double, foreigners double",
    "shorting": "ticker string, date date, short_volume double, total_volume double, short_ratio double",
    "foreign_holding": "ticker string, date date, listed_shares double, held_shares double, held_ratio double, limit_ratio double",
    "index": "index_code string, date date, open double, high double, low double, close double, volume double",
    "etf": "ticker string, date date, close double, nav double, volume double",
    "ticker_meta": schemas.UNIVERSE,
}


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def canonicalize(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Rename each canonical column's first known alias; decided on the schema alone."""
    found = {next(a for a in names if a in df.columns): c for c, names in aliases.items() if c not in df.columns and any(a in df.columns for a in names)}
    return df.withColumnsRenamed(found)


def bars(df: DataFrame, null_is_zero: bool) -> DataFrame:
    """Canonical daily bars: prices at two digits, volume as it is, nulls as zero where the market's source means that."""
    out = require_columns(canonicalize(df, BAR_NAMES), ["date", "open", "high", "low", "close"])
    fill = (lambda c: F.coalesce(c, F.lit(0.0))) if null_is_zero else (lambda c: c)
    price = lambda c: F.floor(fill(F.col(c).cast("double")) * 100 + 0.5) / 100
    volume = fill(F.col("volume").cast("double")) if "volume" in out.columns else F.lit(0.0)
    return out.withColumns({**{c: price(c) for c in ("open", "high", "low", "close")}, "volume": volume, "date": F.col("date").cast("date")})


def universe_csv(spark: SparkSession, path: str, pad: bool = True) -> DataFrame:
    """ticker, market, sector, name; never inferred, so leading zeros stay. Blank tickers go, the last row of one wins."""
    head = [c.strip() for c in spark.read.text(path).first()[0].lstrip(chr(0xFEFF)).split(",")]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in head])
    df = spark.read.csv(path, header=True, schema=schema).withColumn("_at", F.monotonically_increasing_id())
    clean = clean_tickers(df.select(*(F.trim(c).alias(c) for c in head), "_at"), pad)
    return keep_first(clean, ["ticker"], [F.desc("_at")]).drop("_at")


def statements_json(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """One JSON document per ticker, in a file or a line of its own: its quarters as rows of the canonical statement table."""
    quarter = ", ".join(f"{c}:double" for c in schemas.INCOME + schemas.BALANCE + schemas.CASH)
    kind = f"ticker string, fundamentals struct<quarters:array<struct<fiscal_quarter:string,report_date:date,{quarter}>>>, filing struct<filing_date:date,filing_type:string,business_overview:string,risks:string,mda:string,governance:string>"
    return spark.read.schema(kind).json(path, multiLine=one_per_file)


def quarters_of(docs: DataFrame) -> DataFrame:
    return docs.select(normalize_ticker(F.col("ticker")).alias("ticker"), F.explode("fundamentals.quarters").alias("q")).select("ticker", "q.*")


def filings_of(docs: DataFrame, as_of: Column) -> DataFrame:
    """Filings known on the date; a later one leaves its ticker with nulls."""
    known = F.col("filing.filing_date") <= as_of
    names = ["filing_date", "filing_type", "business_overview", "risks", "mda", "governance"]
    return docs.select(normalize_ticker(F.col("ticker")).alias("ticker"), *(F.when(known, F.col(f"filing.{n}")).alias(n) for n in names))


def macro_lines(df: DataFrame, series: Column, period: Column) -> DataFrame:
    """External observations (TIME, DATA_VALUE as text) to series, date, value; unreadable ones go."""
    from tidemark.functions.dates import parse_period

    out = require_columns(df, ["TIME", "DATA_VALUE"]).select(series.alias("series"), parse_period(F.col("TIME"), period).alias("date"), parse_number(F.col("DATA_VALUE")).alias("value"))
    return out.where("date is not null and value is not null")


def catalog_entries(spark: SparkSession, path: str) -> DataFrame:
    """Day files of the news catalog (JSON lines, gzip or not) under day=/ticker= folders."""
    kind = "published_at timestamp, source string, headline string, summary string, url string, crawl_date date, seq bigint, day date, ticker string"
    return spark.read.schema(kind).json(path).withColumn("date", F.col("day"))


def dated_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Parquet partitioned by (market, trade_date): the date of a snapshot is in its path, so pruning needs no read."""
    return spark.read.parquet(path)


def snapshot_dates_from_names(df: DataFrame) -> DataFrame:
    """For folders of files named ..._YYYYMMDD.parquet: the file's date as a column."""
    name = F.regexp_extract(F.input_file_name(), r"(\d{8})\.parquet$", 1)
    return df.withColumn("snapshot_date", parse_yyyymmdd(name))


def authoritative(df: DataFrame, banned: Sequence[str] = ("Industry", "ListingDate")) -> bool:
    """Whether a sector snapshot comes from the official source, by its columns; which ones rule it out is a parameter."""
    return not set(banned) & set(df.columns)


def json_body(c: Column, schema: str) -> Column:
    """A JSON object in text, with or without a byte-order mark; null when it does not start with a brace."""
    text = F.trim(F.regexp_replace(c, f"^{chr(0xFEFF)}", ""))
    return F.when(text.startswith("{"), F.from_json(text, schema))


def cik_map(c: Column) -> Column:
    """{"0": {"cik_str": n, "ticker": t}, ...} as a map of upper-case ticker to ten-digit number."""
    values = F.map_values(F.from_json(c, "map<string,struct<cik_str:bigint,ticker:string>>"))
    return F.map_from_entries(F.transform(values, lambda v: F.struct(F.upper(v["ticker"]), F.lpad(v["cik_str"].cast("string"), 10, "0"))))


def annual_filings(index: DataFrame, as_of: Column) -> DataFrame:
    """First 10-K or 10-K/A in list order that was known on the date, one per filer."""
    known = index.where(F.col("form").isin("10-K", "10-K/A") & (F.col("filing_date") <= as_of))
    return keep_first(known, ["cik"], [F.asc("position")])


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A source that has nothing, in the right shape."""
    return spark.createDataFrame([], schema)


def stock_code_lookup(df: DataFrame, corps: DataFrame) -> DataFrame:
    """Company code per padded ticker; the first match stands, unknown ones stay null."""
    one = corps.select(normalize_ticker(F.col("stock_code")).alias("ticker"), "corp_code").groupBy("ticker").agg(F.min("corp_code").alias("corp_code"))
    return df.join(one, "ticker", "left")


def index_symbols(df: DataFrame, code: str = "index_code") -> DataFrame:
    mapping = F.create_map(*(F.lit(x) for kv in INDEX_CODES.items() for x in kv))
    return df.withColumn("index_name", mapping[F.col(code)])


def bulk(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A bulk extract as it was stored, in its known shape; columns that it lacks are an error."""
    names = [c.split(" ")[0] for c in BULK[kind].split(", ")]
    return require_columns(spark.read.parquet(path), names).select(*names)


def series_scan(table: DataFrame, series: Sequence[str], start: Column, end: Column) -> DataFrame:
    """Observations of some series in a range of dates; both conditions reach the scan."""
    return table.where(F.col("series").isin(list(series)) & F.col("date").between(start, end)).select("series", "date", "value")


def until_short_page(rows: DataFrame, keys: Sequence[str], page: str, page_size: int) -> DataFrame:
    """Rows of a paginated source up to its first page that is not full: what comes after is never asked for."""
    pages = rows.groupBy(*keys, page).agg(F.count("*").alias("_n"))
    short = pages.where(F.col("_n") < page_size).groupBy(*keys).agg(F.min(page).alias("_last"))
    return rows.join(short, list(keys), "left").where(F.col("_last").isNull() | (F.col(page) <= F.col("_last"))).drop("_last")


def valuation_snapshot(df: DataFrame) -> DataFrame:
    """Ratios of a whole market; a frame without all of their columns is refused."""
    return require_columns(canonicalize(df, VALUATION_NAMES), list(VALUATION_NAMES)).select(*VALUATION_NAMES)


def market_listing(listing: DataFrame, market: str) -> DataFrame:
    return listing.where(F.col("market") == market).select("ticker", "market").orderBy("ticker")


def sector_snapshot(snapshots: Sequence[tuple[str, DataFrame]], as_of: str, official_only: bool = False) -> DataFrame | None:
    """The newest usable snapshot (date, frame) on or before ``as_of``: with a ticker and a sector, not empty, and from the official source if asked for."""
    for date, frame in sorted(snapshots, key=lambda x: x[0], reverse=True):
        named = canonicalize(frame, SECTOR_NAMES)
        usable = {"ticker", "sector"} <= set(named.columns) and (authoritative(frame) or not official_only)
        if date <= as_of and usable and named.limit(1).count():
            return named.select(normalize_ticker(F.col("ticker").cast("string")).alias("ticker"), "sector", F.to_date(F.lit(date)).alias("as_of_date"))
    return None


def month_or_day(token: Column) -> Column:
    """The date in a file name: YYYYMMDD, or YYYYMM for the month's last day."""
    return F.coalesce(parse_yyyymmdd(token), F.when(token.rlike(r"^\d{6}$"), F.last_day(F.try_to_timestamp(token, F.lit("yyyyMM")).cast("date"))))


def monthly_caps(df: DataFrame, token: str, as_of: Column, warn_days: int = 45) -> DataFrame:
    """Rows of the newest monthly cap file on or before ``as_of``, the last source date of a ticker once.

    An old file is used all the same; ``stale`` says that it is older than ``warn_days``.
    """
    dated = df.withColumn("file_date", month_or_day(F.col(token))).where(F.col("file_date") <= as_of)
    newest = dated.groupBy("market").agg(F.max("file_date").alias("file_date"))
    rows = dated.join(newest, ["market", "file_date"])
    one = keep_first(rows, ["market", "ticker"], [F.desc("source_trade_date")])
    return one.withColumn("stale", F.datediff(as_of, "file_date") > warn_days).drop(token)


def filing_stub(tickers: DataFrame, description: str, as_of: Column) -> DataFrame:
    """A filing made of a company's description, dated on the decision day."""
    return tickers.select("ticker", as_of.alias("filing_date"), F.lit("description").alias("filing_type"), F.nullif(F.trim(description), F.lit("")).alias("business_overview"))


def listed_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """Links of an HTML list in page order: (.., seq, url, headline); the first of an address stays."""
    anchor = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    found = F.arrays_zip(F.regexp_extract_all(html, F.lit(anchor), F.lit(1)).alias("url"), F.regexp_extract_all(html, F.lit(anchor), F.lit(2)).alias("title"))
    rest = [c for c in pages.columns if c != html]
    rows = pages.select(*rest, F.posexplode(found).alias("seq", "a")).select(*rest, "seq", F.col("a.url").alias("url"), F.trim(F.regexp_replace("a.title", r"<[^>]+>|\s+", " ")).alias("headline"))
    return keep_first(rows.where("url <> ''"), [*rest, "url"], [F.asc("seq")])


def archive_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of an archive page: link, headline, source and its YYYY.MM.DD[ HH:MM] text, in page order."""
    row = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>\s*<td[^>]*class="info"[^>]*>(.*?)</td>\s*<td[^>]*class="date"[^>]*>(.*?)</td>'
    parts = F.arrays_zip(*(F.regexp_extract_all(html, F.lit(row), F.lit(i + 1)).alias(n) for i, n in enumerate(("url", "headline", "source", "when"))))
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, F.posexplode(parts).alias("seq", "r")).select(*rest, "seq", *(F.trim(F.col(f"r.{n}")).alias(n) for n in ("url", "headline", "source", "when")))


_CAP_BODY = "array<struct<TRD_DT:string,J_PRC:string,MKT_CAP:string>>"
_BAND_BODY = "array<struct<TRD_DT:string,J_PRC:string,E3:string,B3:string>>"


def daily_cap_json(bodies: DataFrame, start: Column, end: Column) -> DataFrame:
    """Daily caps of a chart's JSON body per ticker: readable rows of a range, caps in whole money, implied shares.

    Months that only have a label (the first of a month) are dated by ``month_ends`` later; see ``relabel_months``.
    """
    from tidemark.operators.fundamentals import implied_shares

    rows = bodies.select("ticker", F.explode(json_body(F.col("body"), f"CHART {_CAP_BODY}")["CHART"]).alias("c"))
    plain = rows.select("ticker", parse_yyyymmdd(F.replace("c.TRD_DT", F.lit("/"), F.lit(""))).alias("date"), parse_number(F.col("c.J_PRC")).alias("close"), parse_number(F.col("c.MKT_CAP")).alias("cap"))
    return implied_shares(plain.where(F.col("date").between(start, end)), "close", "cap").drop("cap")


def relabel_months(rows: DataFrame, month_ends: DataFrame, date: str = "date") -> DataFrame:
    """The trading day that ends each row's month as ``source_trade_date``; months without one go."""
    ends = month_ends.select(F.trunc("date", "MM").alias("_month"), F.col("date").alias("source_trade_date"))
    return rows.join(ends, F.trunc(date, "MM") == F.col("_month")).drop("_month")


def monthly_valuation_json(bodies: DataFrame) -> DataFrame:
    """Last row of each month of a band chart's JSON body, un-banded: eps, bps, per and pbr; ``e_name`` and ``b_name`` are the bands' names."""
    from tidemark.functions.text import multiplier
    from tidemark.operators.fundamentals import unband_valuation

    rows = bodies.select("ticker", "e_name", "b_name", F.explode(json_body(F.col("body"), f"CHART {_BAND_BODY}")["CHART"]).alias("c"))
    plain = rows.select("ticker", "e_name", "b_name", parse_yyyymmdd(F.replace("c.TRD_DT", F.lit("/"), F.lit(""))).alias("date"), *(parse_number(F.col(f"c.{n}")).alias(n) for n in ("J_PRC", "E3", "B3")))
    last = keep_first(plain.where("date is not null").withColumn("month", F.trunc("date", "MM")), ["ticker", "month"], [F.desc("date")])
    out = unband_valuation(last, F.col("J_PRC"), F.col("E3"), multiplier(F.col("e_name")), F.col("B3"), multiplier(F.col("b_name")))
    return out.select("ticker", "date", F.date_format("month", "yyyy-MM").alias("source_month"), "eps", "bps", "per", "pbr")


def saved_snapshots(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Snapshot lines that were written earlier, plain or compressed."""
    return spark.read.schema(schema).json(path)


def seed_cache(store: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Cache entries of old snapshots by (ticker, month); what the store has stays."""
    new = keep_first(snapshots.select("ticker", "month", "payload"), ["ticker", "month"], [F.asc("payload")])
    return store.unionByName(new.join(store.select("ticker", "month"), ["ticker", "month"], "left_anti"))


def filing_chain(tickers: DataFrame, ciks: DataFrame, index: DataFrame, pages: DataFrame, as_of: Column, sections: Column, base: str) -> DataFrame:
    """Ticker to filer number to address to page to sections; a step without a match leaves nulls and never drops the ticker."""
    from tidemark.functions.text import filing_url

    known = annual_filings(index, as_of).select("cik", "filing_date", filing_url(F.lit(base), F.col("cik"), F.col("accession"), F.col("document")).alias("url"))
    out = tickers.select("ticker").join(ciks, "ticker", "left").join(known, "cik", "left").join(pages.select("url", sections.alias("sections")), "url", "left")
    return out.select("ticker", "cik", "filing_date", "url", *(F.col("sections")[n].alias(n) for n in ("business_overview", "risks", "mda", "governance")))


def us_news(items: DataFrame, as_of: Column) -> DataFrame:
    """JSON items, nested under ``content`` or flat: title, time (epoch or ISO, else the decision day) and address."""
    from tidemark.functions.dates import parse_epoch_or_iso

    first = lambda *paths: F.coalesce(*(F.nullif(F.get_json_object("body", p), F.lit("")) for p in paths))
    iso, epoch = first("$.content.pubDate", "$.pubDate"), first("$.providerPublishTime").try_cast("bigint")
    when = F.coalesce(F.timestamp_seconds(epoch), F.try_to_timestamp(iso)).cast("timestamp_ntz")
    rest = [c for c in items.columns if c != "body"]
    return items.select(*rest, parse_epoch_or_iso(epoch, iso, as_of).alias("date"), when.alias("published_at"), first("$.content.title", "$.title").alias("headline"), first("$.content.canonicalUrl.url", "$.link").alias("url"))
