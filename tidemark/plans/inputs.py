"""Stored and remote inputs: bars, caps, listings, filings, pages, JSON bodies, catalogs, with their checks in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas, sinks
from tidemark.functions import text as T
from tidemark.functions.dates import is_month_end_build, parse_yyyymmdd
from tidemark.functions.numbers import round_half_up
from tidemark.operators import asof, fundamentals, news, universe
from tidemark.plans.market import AS_OF, day
from tidemark.plans.news import NEWS_DAY, at
from tidemark.sources import adapters as A
from tidemark.sources import readers
from tidemark.sources.adapters import with_tables
from tidemark.storage import scratch_path

_BARS = ["ticker", "date", "open", "high", "low", "close", "volume"]


def _ticker(c: str = "ticker") -> Column:
    return F.lpad(F.col(c).cast("string"), 6, "0")


def us_price_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Last 60 bars within 96 calendar days; missing volumes stay missing."""
    raw = A.prices(spark, sf).withColumn("volume", F.when(F.col("ticker") % 3 != 0, F.col("volume"))).withColumnsRenamed({c: c.title() for c in _BARS[1:]})
    return asof.price_window(readers.bars(raw, null_is_zero=False), day(), 60, 1.6).select(_BARS)


def kr_price_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Last 10 bars within 30 calendar days under Korean names; nulls are zeros."""
    raw = A.prices(spark, sf).withColumn("volume", F.when(F.col("ticker") % 3 != 0, F.col("volume"))).withColumnsRenamed({c: readers.BAR_NAMES[c][0] for c in _BARS[1:]})
    return asof.price_window(readers.bars(raw, null_is_zero=True), day(), 10, 1.8, 30).select(_BARS)


def price_history_slices(spark: SparkSession, sf: str) -> DataFrame:
    """One long history per ticker (6000 bars), cut by each consumer."""
    history = asof.latest_n(asof.as_of_cut(A.prices(spark, sf), day()), ["ticker"], [F.desc("date")], 6000)
    cut = lambda n: asof.latest_n(history, ["ticker"], [F.desc("date")], n).groupBy("ticker").agg(F.count("*").alias(f"bars_{n}"), F.min("date").alias(f"first_{n}"))
    return cut(300).join(cut(20), "ticker")


def index_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Index bars from the public source where it has the index, else from the authenticated one, under their known names."""
    code = F.when(F.col("market") == "AFRICA", "1001").when(F.col("market") == "AMERICA", "2001").when(F.col("market") == "ASIA", "1028")
    firms = A.universe(spark, sf).select("ticker", code.alias("index_code")).where("index_code is not null")
    bars = A.prices(spark, sf).join(firms, "ticker").groupBy("index_code", "date").agg((F.sum(F.col("close").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("close"))
    best = asof.first_source([bars.where("index_code = '2001'"), bars], ["index_code"])
    return readers.index_symbols(best).groupBy("index_code", "index_name", "source_rank").agg(F.count("*").alias("n"), F.max("date").alias("last"), round_half_up(F.max_by("close", "date"), 2).alias("close"))


def market_listing(spark: SparkSession, sf: str) -> DataFrame:
    return readers.market_listing(A.universe(spark, sf), "ASIA")


def universe_order(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every ticker in the order of (market, ticker)."""
    ordered = universe.in_order(A.universe(spark, sf).select("market", "ticker"))
    return ordered.withColumn("place", F.row_number().over(Window.orderBy("market", "ticker")))  # a universe is small


def all_listed_tickers(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf)
    return universe.all_tickers([u.where("ticker % 2 = 0"), u.where("ticker % 3 = 0"), u.where("ticker % 5 <> 0").withColumn("ticker", F.concat(F.lit("A"), F.col("ticker")))])


def index_members(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf)
    table = u.select(F.concat(F.lit(" s"), F.col("ticker").cast("string"), F.lit(".b")).alias("ticker"), "name", "sector")
    return universe.index_members(table, table.limit(0))


def market_cap_route(spark: SparkSession, sf: str) -> DataFrame:
    """Caps of a local file up to 7 days old, else of a listing up to 45 days old, else of the authenticated source."""
    caps = A.market_caps(spark, sf).select("ticker", "trade_date", "market_cap")
    return asof.first_fresh([(caps.where("ticker % 3 = 0"), 7), (caps.where("ticker % 3 <> 2"), 45), (caps, None)], ["ticker"], "trade_date", day())


def monthly_cap_file(spark: SparkSession, sf: str) -> DataFrame:
    """The newest monthly file of each market, by YYYYMMDD or YYYYMM in its name; old ones are used and marked."""
    month = F.col("month")
    token = F.when(F.month(month) % 2 == 0, F.date_format(month, "yyyyMM")).otherwise(F.date_format(F.last_day(month), "yyyyMMdd"))
    files = A.market_caps(spark, sf).select("ticker", "market", token.alias("token"), F.col("trade_date").alias("source_trade_date"), "market_cap")
    return readers.monthly_caps(files, "token", F.lit("2002-03-01").cast("date"))


def valuation_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf)
    frame = u.select(F.col("ticker").alias("종목코드"), F.col("market_cap").alias("BPS"), *((F.col("market_cap") * k).alias(n) for k, n in enumerate(("PER", "PBR", "EPS", "DIV", "DPS"), 2)))
    return readers.valuation_snapshot(frame)


def sector_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The newest official snapshot of sectors: later ones are unofficial, empty or of the future."""
    u = A.universe(spark, sf)
    good = u.select(F.col("ticker").alias("종목코드"), F.col("sector").alias("업종명"))
    return readers.sector_snapshot([("1999-12-01", good), ("1999-12-20", good.withColumn("Industry", F.lit("x"))), ("1999-12-25", good.limit(0)), ("1999-11-01", good.limit(1)), ("2000-02-01", good)], AS_OF, official_only=True)


def live_sector_map(spark: SparkSession, sf: str) -> DataFrame:
    """Industry, else sector, else General, of the markets with a prefix."""
    u = A.universe(spark, sf)
    listing = u.select(F.col("ticker").cast("string").alias("ticker"), "market", F.when(F.col("ticker") % 3 == 0, " ").otherwise(F.col("sector")).alias("industry"), F.when(F.col("ticker") % 2 == 0, F.col("market")).alias("sector"))
    return universe.listing_labels(listing, ["A"]).select("ticker", "market", "sector")


def universe_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "universe-csv")
    sinks.write_universe_csv(A.universe(spark, sf), path, ["ticker", "market", "sector", "name"])
    return readers.universe_csv(spark, path)


def statement_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Consolidated lines where a report has them, else separate ones."""
    s = A.statements(spark, sf).select(F.col("ticker").alias("corp"), F.col("fy").alias("bsns_year"), F.col("fq").alias("reprt_code"), F.col("revenue").alias("amount"))
    both = s.withColumn("fs_div", F.lit("OFS")).unionByName(s.where("(corp + reprt_code) % 3 = 0").select("corp", "bsns_year", "reprt_code", (F.col("amount") * 2).alias("amount"), F.lit("CFS").alias("fs_div")))
    return fundamentals.prefer_consolidated(both).select("corp", "bsns_year", "reprt_code", "fs_div", "amount")


def three_statements(spark: SparkSession, sf: str) -> DataFrame:
    s = A.statements(spark, sf)
    of = lambda where, *cols: s.where(where).select("ticker", "period_end", *cols)
    return fundamentals.three_statements(of("true", "revenue", "net_income"), of("ticker % 3 <> 0", "total_assets"), of("fq % 2 = 0", "operating_cash_flow"))


def corp_codes(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf).select(_ticker().alias("ticker"), F.col("ticker").alias("n"))
    corps = u.where("n % 4 <> 0").select(F.col("n").cast("string").alias("stock_code"), F.concat(F.lit("C"), F.col("n")).alias("corp_code"))
    twice = corps.union(corps.where("cast(stock_code as int) % 2 = 0").select("stock_code", F.concat(F.lit("D"), F.col("stock_code"))))
    return readers.stock_code_lookup(u.select("ticker"), twice)


def annual_filing_index(spark: SparkSession, sf: str) -> DataFrame:
    """First 10-K or 10-K/A of every filer in list order that was known on the date, with its address."""
    o = A.table(spark, sf, "orders")
    form = F.element_at(F.array(*map(F.lit, ("10-K", "10-K/A", "8-K"))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    index = o.select(F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"), form.alias("form"), F.col("o_orderdate").cast("date").alias("filing_date"), (-F.col("o_orderkey")).alias("position"), F.concat(F.lit("0000-"), F.col("o_orderkey")).alias("accession"))
    return readers.annual_filings(index, day()).select("cik", "form", "filing_date", T.filing_url(F.lit("https://archive"), F.col("cik"), F.col("accession"), F.lit("a.htm")).alias("url"))


def cik_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Ticker to ten-digit number from one JSON object of entries."""
    n = A.table(spark, sf, "nation")
    entry = F.struct((F.col("n_nationkey") * 1001).alias("cik_str"), F.lower("n_name").alias("ticker"))
    body = n.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), entry)))).alias("body"))
    return body.select(F.explode(readers.cik_map(F.col("body"))).alias("ticker", "cik"))


def series_scan(spark: SparkSession, sf: str) -> DataFrame:
    return readers.series_scan(A.macro(spark, sf), ["1-URGENT", "2-HIGH"], F.lit("1998-01-01").cast("date"), day())


def paged_source(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of two rows; what follows a page that is not full is never asked for."""
    rows = A.news(spark, sf).select("ticker", (F.floor(F.col("seq") / 100)).cast("int").alias("page"), "seq")
    return readers.until_short_page(rows, ["ticker"], "page", 2)


def news_list_items(spark: SparkSession, sf: str) -> DataFrame:
    """First 15 links of every page in page order."""
    items = readers.listed_items(A.table(spark, sf, "pages").select(F.col("page_id").alias("ticker"), "html"))
    return news.page_order_items(items, 15)


def archive_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of archive tables: link, headline, source and date text."""
    e = A.table(spark, sf, "events")
    row = F.concat(F.lit('<tr><td class="title"><a class="t" href="/n?id='), F.col("event_id"), F.lit('">'), F.col("event_type"), F.lit('</a></td>\n<td class="info">wire</td><td class="date"> '), F.date_format("ts", "yyyy.MM.dd HH:mm"), F.lit("</td></tr>"))
    row = F.replace(row, F.lit('</a></td>\n<td class="info">'), F.lit('</a>\n<td class="info">'))
    page = e.groupBy((F.floor(F.col("event_id") / 20)).cast("int").alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", row.alias("r")))), lambda x: x["r"]), "\n").alias("html"))
    return readers.archive_rows(page)


def archive_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """Items that a crawl of five-row pages reads: it ends at the first page that reaches before the window or brings nothing new."""
    r = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("published_at"), F.desc("seq"))) - 1
    rows = A.news(spark, sf).withColumn("seq", r).withColumn("page", F.floor(F.col("seq") / 5).cast("int")).select("ticker", "page", "seq", "date", "url")
    return news.archive_pages(rows, F.date_sub(at(), 19))


def us_news_items(spark: SparkSession, sf: str) -> DataFrame:
    """Newest 15 items of a window from nested or flat JSON items."""
    e = A.table(spark, sf, "events")
    nested = F.to_json(F.struct(F.struct(F.col("event_type").alias("title"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("pubDate"), F.struct(F.col("props").alias("url")).alias("canonicalUrl")).alias("content")))
    flat = F.to_json(F.struct(F.col("event_type").alias("title"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("providerPublishTime"), F.col("props").alias("link")))
    body = F.when(F.col("event_id") % 2 == 0, nested).otherwise(flat)
    items = readers.us_news(e.select(F.col("user_id").alias("ticker"), F.col("event_id").alias("seq"), body.alias("body")), at())
    return news.top_items(news.window(items, at(), 30, inclusive_start=True), 15).select("ticker", "seq", "date", "headline", "url")


def filing_stub(spark: SparkSession, sf: str) -> DataFrame:
    u = A.universe(spark, sf).select("ticker", F.when(F.col("ticker") % 3 != 0, F.col("name")).otherwise(" ").alias("about"))
    return readers.filing_stub(u, "about", day())


def backfilled_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Statements stored as one JSON document per ticker, cut again to what was known when they are read."""
    q = F.struct("fiscal_quarter", "report_date", "revenue", "total_assets")
    docs = A.statements(spark, sf).groupBy(_ticker().alias("ticker")).agg(F.struct(F.collect_list(q).alias("quarters")).alias("fundamentals"))
    path = scratch_path(spark, "statements-json")
    docs.write.json(path)
    read = readers.quarters_of(readers.statements_json(spark, path, one_per_file=False))
    return asof.as_of_cut(read, day(), "report_date").select("ticker", "fiscal_quarter", "report_date", "revenue", "total_assets")


def catalog_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog entries written by day and read again."""
    entries = A.news(spark, sf).select(F.col("date").alias("day"), F.col("ticker").cast("string").alias("ticker"), F.col("published_at").cast("timestamp").alias("published_at"), "headline", "url", "seq")
    path = scratch_path(spark, "catalog")
    sinks.write_catalog_days(entries, path, by=["day"])
    return readers.catalog_entries(spark, path).groupBy("ticker", "date").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.count_distinct("url").alias("urls"))


def catalog_meta_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.plans.news import news_day_status

    path = scratch_path(spark, "catalog-meta")
    sinks.write_catalog_meta(news_day_status(spark, sf), path)
    return spark.read.schema("ticker bigint, day date, status string, n_crawls int, first_crawl date").json(path)


def _cap_bodies(spark: SparkSession, sf: str) -> DataFrame:
    row = F.struct(F.date_format("date", "yyyy/MM/dd").alias("TRD_DT"), F.format_number("close", 2).alias("J_PRC"), F.col("volume").cast("int").cast("string").alias("MKT_CAP"))
    return A.prices(spark, sf).groupBy("ticker").agg(F.concat(F.lit(chr(0xFEFF)), F.to_json(F.struct(F.collect_list(row).alias("CHART")))).alias("body"))


def daily_cap_json(spark: SparkSession, sf: str) -> DataFrame:
    """Caps and implied shares of 1999 out of each ticker's chart body."""
    return readers.daily_cap_json(_cap_bodies(spark, sf), F.lit("1999-01-01").cast("date"), F.lit("1999-12-31").cast("date"))


def cap_month_relabel(spark: SparkSession, sf: str) -> DataFrame:
    ends = asof.last_of_month(A.benchmark_prices(spark, sf), [], "date").select("date")
    return readers.relabel_months(A.market_caps(spark, sf).select("ticker", F.col("month").alias("date"), "market_cap"), ends)


def monthly_valuation_json(spark: SparkSession, sf: str) -> DataFrame:
    row = F.struct(F.date_format("date", "yyyy/MM/dd").alias("TRD_DT"), F.format_number("close", 2).alias("J_PRC"), F.col("volume").cast("int").cast("string").alias("E3"), F.when(F.col("ticker") % 4 != 0, F.format_number("high", 2)).alias("B3"))
    bodies = A.prices(spark, sf).groupBy("ticker").agg(F.to_json(F.struct(F.collect_list(row).alias("CHART"))).alias("body"))
    named = bodies.withColumn("e_name", F.concat(F.lit("PER "), (F.col("ticker") % 4).cast("string"), F.lit(".5X"))).withColumn("b_name", F.lit("PBR 2X"))
    out = readers.monthly_valuation_json(named)
    return out.select("ticker", "date", "source_month", *(round_half_up(F.col(c), 4).alias(c) for c in ("eps", "bps", "per", "pbr")))


def bulk_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the eight bulk extracts, each stored with a column too many and read back in its own shape."""
    p, caps, u = A.prices(spark, sf), A.market_caps(spark, sf), A.universe(spark, sf)
    frames = {"market_cap": caps, "valuation": caps, "investor_trading": p, "shorting": p, "foreign_holding": p, "index": A.benchmark_prices(spark, sf), "etf": p.where("ticker % 10 = 0"), "ticker_meta": u}
    out = None
    for kind, frame in frames.items():
        path = scratch_path(spark, f"bulk-{kind}")
        fields = [c.split(" ") for c in readers.BULK[kind].split(", ")]
        shaped = frame.select(*((F.col(n) if n in frame.columns else F.lit(None)).cast(t).alias(n) for n, t in fields))
        sinks.write_stamped(shaped, path)
        back = readers.bulk(spark, path, kind)
        n = back.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.lit(len(back.columns)).alias("width"))
        out = n if out is None else out.unionByName(n)
    return out


def null_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Sources that have nothing, in every canonical shape."""
    kinds = {"prices": schemas.PRICES, "financials": schemas.FINANCIALS, "filings": schemas.FILINGS, "news": schemas.NEWS, "macro": schemas.MACRO}
    out = [readers.empty(spark, s).agg(F.lit(k).alias("kind"), F.count("*").alias("n")) for k, s in kinds.items()]
    for x in out[1:]:
        out[0] = out[0].unionByName(x)
    return out[0]


def saved_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Old snapshot lines put into a cache that has some of them already."""
    caps = A.market_caps(spark, sf).select(_ticker().alias("ticker"), F.date_format("month", "yyyy-MM").alias("month"), F.col("market_cap").cast("string").alias("payload"), F.col("ticker").alias("n"))
    path = scratch_path(spark, "snapshots")
    sinks.write_snapshot(caps.drop("n"), path)
    store = caps.where("n % 3 = 0").select("ticker", "month", F.lit("kept").alias("payload"))
    return readers.seed_cache(store, readers.saved_snapshots(spark, path, "ticker string, month string, payload string"))


def filing_chain(spark: SparkSession, sf: str) -> DataFrame:
    """From ticker to sections; a missing step leaves nulls."""
    n = A.table(spark, sf, "nation").select(F.col("n_name").alias("ticker"), F.col("n_nationkey").alias("k"))
    ciks = n.where("k % 5 <> 0").select("ticker", F.lpad((F.col("k") + 1).cast("string"), 10, "0").alias("cik"))
    index = n.select(F.lpad((F.col("k") + 1).cast("string"), 10, "0").alias("cik"), F.lit("10-K").alias("form"), F.date_add(F.lit("1999-12-20").cast("date"), F.col("k").cast("int")).alias("filing_date"), F.lit(1).alias("position"), F.lit("00-1").alias("accession"), F.lit("a.htm").alias("document"))
    body = F.concat(F.lit("<h2>Item 1. Business</h2><p>"), F.expr("repeat('word ', 40 + cast(k as int) * 5)"), F.lit("</p><h2>Item 2. Other</h2>"))
    pages = n.where("k % 3 <> 0").select(F.concat(F.lit("u/"), (F.col("k") + 1).cast("string"), F.lit("/001/a.htm")).alias("url"), body.alias("html"))
    out = readers.filing_chain(n, ciks, index, pages, day(), T.us_sections(F.col("html")), "u")
    return out.select("ticker", "cik", "filing_date", "url", F.length("business_overview").alias("business_chars"), F.length("risks").alias("risk_chars"))


def html_to_text_us(spark: SparkSession, sf: str) -> DataFrame:
    """Text of every page by a markup parser (a parser has no SQL form)."""
    return A.table(spark, sf, "pages").select("page_id", T.html_text(F.col("html")).alias("text"))


def json_bodies(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    body = F.when(F.col("event_id") % 5 == 0, "<html>").when(F.col("event_id") % 2 == 0, F.concat(F.lit(chr(0xFEFF)), F.col("props"))).otherwise(F.col("props"))
    return e.select("event_id", readers.json_body(body, "k int")["k"].alias("k"))


def compact_dates(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders")
    raw = F.when(F.col("o_orderkey") % 5 == 0, "19990230").when(F.col("o_orderkey") % 5 == 1, "1999-01-01").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select("o_orderkey", parse_yyyymmdd(raw).alias("d"))


def receipt_date_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Reports received on or before the date; those without a receipt date, or with none that exists, are not."""
    r = A.report_list(spark, sf)
    odd = F.when(F.col("rcept_no") % 7 == 0, None).when(F.col("rcept_no") % 7 == 1, "19990231").when(F.col("rcept_no") % 7 == 2, "").otherwise(F.col("rcept_dt"))
    return asof.compact_date_cut(r.withColumn("rcept_dt", odd), day(), "rcept_dt").select("corp", "rcept_no", "rcept_dt")


def month_end_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Trading days on which a monthly build is due."""
    days = A.prices(spark, sf).select("date").distinct()
    return days.where(is_month_end_build(F.col("date")))


def charset_sniff(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes under a declared, a wrong or no character set back to text."""
    k, text = F.col("doc_id") % 3, F.col("text")
    raw = F.when(k == 0, F.encode(text, "UTF-16")).otherwise(F.encode(text, "UTF-8"))
    header = F.when(k == 0, "text/html; charset=UTF-16").when(k == 1, "text/html; charset=no-such-set")
    return A.table(spark, sf, "documents").select("doc_id", T.sniff_charset(raw, header).alias("text"))


def templates(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    return e.select("event_id", T.fill_template("{who} did {what}: {what}", {"who": F.col("user_id"), "what": F.col("event_type")}).alias("line"))


def login_pages(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    body = F.when(F.col("event_id") % 7 == 0, "<title>Login</title>").when(F.col("event_id") % 7 == 1, "status=400 LOGOUT").when(F.col("event_id") % 7 == 2, "로그인 하세요").otherwise(F.col("event_type"))
    return e.select("event_id", T.is_login_page(body).alias("is_login"))


def synthetic_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Generated bars, seeded by ticker."""
    from tidemark.sources import synthetic

    return synthetic.prices(A.universe(spark, sf).select(_ticker().alias("ticker")), day(), 60)


QUERIES = {
    f.__name__: f
    for f in (
        us_price_scan, kr_price_scan, price_history_slices, index_fallback, market_listing, universe_order, all_listed_tickers, index_members, market_cap_route, monthly_cap_file, valuation_snapshot, sector_snapshot,
        live_sector_map, universe_csv_round_trip, statement_choice, three_statements, corp_codes, annual_filing_index, cik_lookup, series_scan, paged_source, news_list_items, archive_rows, archive_crawl, us_news_items,
        filing_stub, backfilled_statements, catalog_round_trip, catalog_meta_round_trip, daily_cap_json, cap_month_relabel, monthly_valuation_json, bulk_extracts, null_sources, saved_snapshots, filing_chain, html_to_text_us,
        json_bodies, compact_dates, receipt_date_cut, month_end_gate, charset_sniff, templates, login_pages, synthetic_prices,
    )
}

_ANCHOR = """(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>"""
_PAD = "lpad(ticker::VARCHAR, 6, '0')"

SQL = {
    "us_price_scan": with_tables("px", f" SELECT * REPLACE (CASE WHEN ticker % 3 <> 0 THEN volume END AS volume) FROM px WHERE date BETWEEN DATE '{AS_OF}' - 96 AND DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 60"),
    "kr_price_scan": with_tables("px", f" SELECT * REPLACE (CASE WHEN ticker % 3 <> 0 THEN volume ELSE 0 END AS volume) FROM px WHERE date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 10"),
    "price_history_slices": with_tables("px", f", r AS (SELECT ticker, date, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS r FROM px WHERE date <= DATE '{AS_OF}') SELECT ticker, count(*) FILTER (r <= 300) AS bars_300, min(date) FILTER (r <= 300) AS first_300, count(*) FILTER (r <= 20) AS bars_20, min(date) FILTER (r <= 20) AS first_20 FROM r GROUP BY 1"),
    "index_fallback": with_tables(
        "px uni",
        ", c AS (SELECT ticker, CASE market WHEN 'AFRICA' THEN '1001' WHEN 'AMERICA' THEN '2001' WHEN 'ASIA' THEN '1028' END AS index_code FROM uni), b AS (SELECT index_code, date, sum(close::DECIMAL(18,2))::DOUBLE / count(*) AS close FROM px JOIN c USING (ticker) WHERE index_code IS NOT NULL GROUP BY 1, 2)"
        " SELECT index_code, CASE index_code WHEN '1001' THEN 'KOSPI' WHEN '2001' THEN 'KOSDAQ' ELSE 'KOSPI200' END AS index_name, CASE index_code WHEN '2001' THEN 0 ELSE 1 END::INT AS source_rank, count(*) AS n, max(date) AS last, floor(arg_max(close, date) * 100 + 0.5) / 100 AS close FROM b GROUP BY 1, 2, 3",
    ),
    "market_listing": with_tables("uni", " SELECT ticker, market FROM uni WHERE market = 'ASIA'"),
    "universe_order": with_tables("uni", " SELECT market, ticker, (row_number() OVER (ORDER BY market, ticker))::INT AS place FROM uni"),
    "all_listed_tickers": with_tables("uni", f" SELECT DISTINCT {_PAD} AS ticker FROM uni WHERE ticker % 2 = 0 OR ticker % 3 = 0 OR ticker % 5 <> 0"),
    "index_members": with_tables("uni", " SELECT 'S' || ticker || '-B' AS ticker, name, sector FROM uni"),
    "market_cap_route": with_tables("cap", f", n AS (SELECT ticker, max(trade_date) AS trade_date, arg_max(market_cap, trade_date) AS market_cap FROM cap WHERE trade_date <= DATE '{AS_OF}' GROUP BY 1) SELECT *, CASE WHEN ticker % 3 = 0 AND DATE '{AS_OF}' - trade_date <= 7 THEN 0 WHEN ticker % 3 <> 2 AND DATE '{AS_OF}' - trade_date <= 45 THEN 1 ELSE 2 END::INT AS source_rank FROM n"),
    "monthly_cap_file": with_tables("cap", ", m AS (SELECT market, max(month) AS month FROM cap GROUP BY 1) SELECT ticker, market, last_day(month) AS file_date, trade_date AS source_trade_date, market_cap, DATE '2002-03-01' - last_day(month) > 45 AS stale FROM cap JOIN m USING (market, month)"),
    "valuation_snapshot": with_tables("uni", " SELECT ticker, market_cap AS bps, market_cap * 2 AS per, market_cap * 3 AS pbr, market_cap * 4 AS eps, market_cap * 5 AS div, market_cap * 6 AS dps FROM uni"),
    "sector_snapshot": with_tables("uni", f" SELECT {_PAD} AS ticker, sector, DATE '1999-12-01' AS as_of_date FROM uni"),
    "live_sector_map": with_tables("uni", f" SELECT {_PAD} AS ticker, market, CASE WHEN ticker % 3 <> 0 THEN sector WHEN ticker % 2 = 0 THEN market ELSE 'General' END AS sector FROM uni WHERE market LIKE 'A%'"),
    "universe_csv_round_trip": with_tables("uni", f" SELECT {_PAD} AS ticker, market, sector, name FROM uni"),
    "statement_choice": with_tables("st", " SELECT ticker AS corp, fy AS bsns_year, fq AS reprt_code, CASE WHEN (ticker + fq) % 3 = 0 THEN 'CFS' ELSE 'OFS' END AS fs_div, CASE WHEN (ticker + fq) % 3 = 0 THEN revenue * 2 ELSE revenue END AS amount FROM st"),
    "three_statements": with_tables("st", " SELECT ticker, period_end, revenue, net_income, CASE WHEN ticker % 3 <> 0 THEN total_assets END AS total_assets, CASE WHEN fq % 2 = 0 THEN operating_cash_flow END AS operating_cash_flow FROM st"),
    "corp_codes": with_tables("uni", f" SELECT {_PAD} AS ticker, CASE WHEN ticker % 4 <> 0 THEN 'C' || ticker END AS corp_code FROM uni"),
    "annual_filing_index": f"""WITH k AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 2 AND o_orderdate::DATE <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
 SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, CASE o_orderkey % 3 WHEN 0 THEN '10-K' ELSE '10-K/A' END AS form, o_orderdate::DATE AS filing_date, 'https://archive/' || CASE WHEN o_custkey = 0 THEN '' ELSE o_custkey::VARCHAR END || '/0000' || o_orderkey || '/a.htm' AS url FROM k""",
    "cik_lookup": "SELECT upper(n_name) AS ticker, lpad((n_nationkey * 1001)::VARCHAR, 10, '0') AS cik FROM nation",
    "series_scan": with_tables("mac", f" SELECT * FROM mac WHERE series IN ('1-URGENT', '2-HIGH') AND date BETWEEN DATE '1998-01-01' AND DATE '{AS_OF}'"),
    "paged_source": with_tables("nw", ", r AS (SELECT ticker, (seq // 100)::INT AS page, seq FROM nw), p AS (SELECT ticker, page, count(*) AS n FROM r GROUP BY 1, 2), s AS (SELECT ticker, min(page) AS last FROM p WHERE n < 2 GROUP BY 1) SELECT r.* FROM r LEFT JOIN s USING (ticker) WHERE last IS NULL OR page <= last"),
    "news_list_items": f"""WITH a AS (SELECT page_id AS ticker, unnest(range(len(u))) AS seq, unnest(u) AS url, unnest(t) AS title FROM (SELECT page_id, regexp_extract_all(html, '{_ANCHOR}', 1) AS u, regexp_extract_all(html, '{_ANCHOR}', 2) AS t FROM pages)),
 f AS (SELECT ticker, seq::INT AS seq, url, trim(regexp_replace(title, '<[^>]+>|\\s+', ' ', 'g')) AS headline FROM a WHERE url <> '' QUALIFY row_number() OVER (PARTITION BY ticker, url ORDER BY seq) = 1) SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY seq) <= 15""",
    "archive_rows": "SELECT (event_id // 20)::INT AS page, (row_number() OVER (PARTITION BY event_id // 20 ORDER BY event_id) - 1)::INT AS seq, '/n?id=' || event_id AS url, event_type AS headline, 'wire' AS source, strftime(ts, '%Y.%m.%d %H:%M') AS \"when\" FROM events",
    "archive_crawl": with_tables(
        "nw",
        f""", r0 AS (SELECT ticker, date, url, (row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, seq DESC) - 1)::INT AS seq FROM nw), r AS (SELECT ticker, (seq // 5)::INT AS page, seq, date, url FROM r0), f AS (SELECT *, row_number() OVER (PARTITION BY ticker, url ORDER BY page, seq) = 1 AS fresh FROM r WHERE seq // 5 < 200),
 p AS (SELECT ticker, page, NOT bool_or(fresh) OR min(date) < DATE '{NEWS_DAY}' - 19 AS ended FROM f GROUP BY 1, 2), e AS (SELECT ticker, min(page) AS last FROM p WHERE ended GROUP BY 1)
 SELECT f.ticker, page, seq, date, url FROM f LEFT JOIN e USING (ticker) WHERE fresh AND (last IS NULL OR page <= last) AND date >= DATE '{NEWS_DAY}' - 19""",
    ),
    "us_news_items": with_tables("nw", f" SELECT ticker, seq, date, headline, url FROM nw WHERE date BETWEEN DATE '{NEWS_DAY}' - 30 AND DATE '{NEWS_DAY}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date_trunc('second', published_at) DESC, headline DESC, seq DESC) <= 15"),
    "filing_stub": with_tables("uni", f" SELECT ticker, DATE '{AS_OF}' AS filing_date, 'description' AS filing_type, CASE WHEN ticker % 3 <> 0 THEN name END AS business_overview FROM uni"),
    "backfilled_statements": with_tables("st", f" SELECT {_PAD} AS ticker, fiscal_quarter, report_date, revenue, total_assets FROM st WHERE report_date <= DATE '{AS_OF}'"),
    "catalog_round_trip": with_tables("nw", " SELECT ticker::VARCHAR AS ticker, date, count(*) AS n, min(seq) AS first_seq, count(DISTINCT url) AS urls FROM nw GROUP BY 1, 2"),
    "daily_cap_json": with_tables("px", " SELECT ticker, date, close, floor(volume::INT * 1e8 + 0.5)::BIGINT AS market_cap, floor(floor(volume::INT * 1e8 + 0.5)::BIGINT / close + 0.5)::BIGINT AS issued_shares FROM px WHERE date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' AND close > 0 AND volume::INT > 0"),
    "cap_month_relabel": with_tables("cap", ", e AS (SELECT date_trunc('month', date)::DATE AS month, max(date) AS source_trade_date FROM px GROUP BY 1) SELECT ticker, month AS date, market_cap, source_trade_date FROM cap JOIN e USING (month)"),
    "monthly_valuation_json": with_tables(
        "px",
        ", l AS (SELECT * FROM px QUALIFY row_number() OVER (PARTITION BY ticker, date_trunc('month', date) ORDER BY date DESC) = 1), v AS (SELECT ticker, date, close, volume::INT / nullif(ticker % 4 + 0.5::DOUBLE, 0) AS eps, CASE WHEN ticker % 4 <> 0 THEN high / 2 END AS bps FROM l)"
        " SELECT ticker, date, strftime(date, '%Y-%m') AS source_month, floor(eps * 10000 + 0.5) / 10000 AS eps, floor(bps * 10000 + 0.5) / 10000 AS bps, floor(close / nullif(eps, 0) * 10000 + 0.5) / 10000 AS per, floor(close / nullif(bps, 0) * 10000 + 0.5) / 10000 AS pbr FROM v",
    ),
    "bulk_extracts": with_tables(
        "idx cap",
        " SELECT kind, n, width::INT AS width FROM (SELECT 'market_cap' AS kind, (SELECT count(*) FROM cap) AS n, 7 AS width UNION ALL SELECT 'valuation', (SELECT count(*) FROM cap), 7 UNION ALL SELECT 'investor_trading', (SELECT count(*) FROM px), 6 UNION ALL SELECT 'shorting', (SELECT count(*) FROM px), 5"
        " UNION ALL SELECT 'foreign_holding', (SELECT count(*) FROM px), 6 UNION ALL SELECT 'index', (SELECT count(*) FROM idx), 7 UNION ALL SELECT 'etf', (SELECT count(*) FROM px WHERE ticker % 10 = 0), 5 UNION ALL SELECT 'ticker_meta', (SELECT count(*) FROM uni), 4)",
    ),
    "null_sources": "SELECT unnest(['prices', 'financials', 'filings', 'news', 'macro']) AS kind, 0::BIGINT AS n",
    "saved_snapshots": with_tables("cap", f" SELECT {_PAD} AS ticker, strftime(month, '%Y-%m') AS month, CASE WHEN ticker % 3 = 0 THEN 'kept' ELSE market_cap::VARCHAR END AS payload FROM cap"),
    "filing_chain": f"""WITH s AS (SELECT n_name AS ticker, n_nationkey AS k, CASE WHEN n_nationkey % 5 <> 0 THEN lpad((n_nationkey + 1)::VARCHAR, 10, '0') END AS cik FROM nation), f AS (SELECT *, CASE WHEN cik IS NOT NULL AND DATE '1999-12-20' + k::INT <= DATE '{AS_OF}' THEN DATE '1999-12-20' + k::INT END AS filing_date FROM s),
 u AS (SELECT *, CASE WHEN filing_date IS NOT NULL THEN 'u/' || (k + 1) || '/001/a.htm' END AS url FROM f) SELECT ticker, cik, filing_date, url, CASE WHEN url IS NOT NULL AND k % 3 <> 0 AND (40 + k * 5) * 5 - 1 > 300 THEN (40 + k * 5) * 5 - 1 END::INT AS business_chars, NULL::INT AS risk_chars FROM u""",
    "json_bodies": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN json_extract_string(props, '$.k')::INT END AS k FROM events",
    "compact_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 1 THEN o_orderdate::DATE END AS d FROM orders",
    "receipt_date_cut": with_tables("rl", f" SELECT corp, rcept_no, rcept_dt FROM rl WHERE rcept_no % 7 > 2 AND rcept_dt <= '{AS_OF.replace('-', '')}'"),
    "month_end_gate": with_tables("px", " SELECT DISTINCT date FROM px WHERE date = (last_day(date) - greatest(isodow(last_day(date)) - 5, 0)::INT)::DATE"),
    "charset_sniff": "SELECT doc_id, text FROM documents",
    "templates": "SELECT event_id, user_id || ' did ' || event_type || ': ' || event_type AS line FROM events",
    "login_pages": "SELECT event_id, event_id % 7 < 3 AS is_login FROM events",
}


def _from_news() -> None:
    from tidemark.plans.news import SQL as NEWS

    SQL["catalog_meta_round_trip"] = NEWS["news_day_status"]


_from_news()
