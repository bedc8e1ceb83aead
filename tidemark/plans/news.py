"""News, catalog, filings text and checks, with their checks in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import numbers as N
from tidemark.functions import text as T
from tidemark.operators import news, quality
from tidemark.plans.market import AS_OF, day
from tidemark.sources import adapters as A
from tidemark.sources.adapters import with_tables

NEWS_DAY = "2024-01-25"


def at() -> Column:
    return F.lit(NEWS_DAY).cast("date")



def news_window_30(spark: SparkSession, sf: str) -> DataFrame:
    return news.window(A.news(spark, sf), at(), 20).select("ticker", "date", "seq")


def news_window_31(spark: SparkSession, sf: str) -> DataFrame:
    return news.window(A.news(spark, sf), at(), 20, inclusive_start=True).select("ticker", "date", "seq")


def news_dedupe_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return news.dedupe_first_seen(A.news(spark, sf), ["ticker", "url"], [F.asc("date"), F.asc("seq")]).select("ticker", "url", "seq")


def news_top15(spark: SparkSession, sf: str) -> DataFrame:
    return news.top_items(news.window(A.news(spark, sf), at(), 30), 15).select("ticker", "published_at", "headline", "seq")


def news_epoch_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates from epoch seconds, else ISO text, else the as-of date."""
    n = A.news(spark, sf)
    epoch = F.when(F.col("seq") % 3 == 0, F.unix_timestamp(F.col("published_at").cast("timestamp")))
    iso = F.when(F.col("seq") % 3 == 1, F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss"))
    return n.select("seq", D.parse_epoch_or_iso(epoch, iso, at()).alias("d"))


def news_props_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Nested optional JSON fields with fallbacks."""
    e = A.table(spark, sf, "events")
    k = F.get_json_object("props", "$.missing")
    return e.select("event_id", F.coalesce(k, F.get_json_object("props", "$.k")).try_cast("int").alias("k"))


def _captures(spark: SparkSession, sf: str) -> DataFrame:
    """A crawl per user and day with events: some hit the page cap; a third of the users are never crawled after mid-month."""
    n = A.news(spark, sf).where("not (ticker % 3 = 0 and date > date'2024-01-15')")
    per = n.groupBy("ticker", F.col("date").alias("crawl_date")).agg(F.count("*").alias("n"), F.max("date").alias("d"))
    cap = (F.col("ticker") + F.dayofmonth("crawl_date")) % 4 == 0
    return per.select("ticker", "crawl_date", F.date_sub("crawl_date", 3).alias("required_start"), cap.alias("page_cap"), F.when(cap, F.date_sub("crawl_date", 1)).alias("last_in_window"))


def news_day_status(spark: SparkSession, sf: str) -> DataFrame:
    out = news.day_status(_captures(spark, sf))
    return out.select("ticker", "day", "status", F.size("crawl_dates").alias("n_crawls"), F.element_at("crawl_dates", 1).alias("first_crawl"))


def news_catalog_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog of the first half merged with a crawl of the second that sees some items again."""
    n = A.news(spark, sf).withColumn("crawl_date", F.col("date"))
    old, new = n.where("seq % 2 = 0"), n.where("seq % 3 <> 1").withColumn("crawl_date", F.date_add("date", 1))
    return news.merge_catalog(old, new).select("ticker", "date", "url", "crawl_date", "seq")


def news_window_coverage(spark: SparkSession, sf: str) -> DataFrame:
    tickers = A.news(spark, sf).select("ticker").distinct()
    out = news.coverage(tickers, news.day_status(_captures(spark, sf)), A.news(spark, sf), at(), 20)
    return out.select("ticker", "captured_days", F.size("missing_days").alias("n_missing"), F.element_at(F.concat("missing_days", F.array(F.lit(None).cast("date"))), 1).alias("first_missing"), F.size("capped_days").alias("n_capped"), "raw_count", "status")


def calendar_densify(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of every user's span with its number of events, zeros included."""
    n = A.news(spark, sf)
    span = n.groupBy("ticker").agg(F.min("date").alias("a"), F.max("date").alias("b")).select("ticker", F.explode(D.days(F.col("a"), F.col("b"))).alias("date"))
    counts = n.groupBy("ticker", "date").agg(F.count("*").alias("c"))
    return span.join(counts, ["ticker", "date"], "left").select("ticker", "date", F.coalesce("c", F.lit(0)).alias("n"))


def news_date_trackers(spark: SparkSession, sf: str) -> DataFrame:
    """Oldest kept date, and the oldest date of the last page (of 20 items) that contributed to the window."""
    n = news.window(A.news(spark, sf), at(), 10).withColumn("page", F.floor(F.col("seq") / 20))
    page = n.groupBy("ticker", "page").agg(F.min("date").alias("d"))
    last = page.groupBy("ticker").agg(F.min("d").alias("oldest_kept"), F.max_by("d", "page").alias("last_page_oldest"))
    return last


def dq_prices(spark: SparkSession, sf: str) -> DataFrame:
    p = A.prices(spark, sf).where("ticker % 4 <> 0 and (ticker % 3 = 0 or date <= date'1999-12-31')")
    out = quality.check_prices(A.universe(spark, sf), p, day())
    return out.select("check", "entity", "status", "detail")


def dq_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    s = A.statements(spark, sf).where("ticker % 5 <> 0 and (ticker % 3 = 0 or report_date <= date'1999-12-31')")
    return quality.check_fundamentals(A.universe(spark, sf), s, day()).select("check", "entity", "status", "detail")


def dq_news(spark: SparkSession, sf: str) -> DataFrame:
    n = A.news(spark, sf).where("ticker % 2 = 0 or date between date'2024-01-06' and date'2024-01-25'")
    audit = n.where("ticker % 5 <> 0 or seq % 7 <> 0").withColumn("headline", F.when((F.col("ticker") % 7 == 0) & (F.col("seq") % 3 == 0), "edited").otherwise(F.col("headline")))
    return quality.check_news(n, audit, ["headline", "date"], at(), 20).select("check", "entity", "status", "detail")


def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.summarize(dq_prices(spark, sf).unionByName(dq_fundamentals(spark, sf)))


def dq_roll_up(spark: SparkSession, sf: str) -> DataFrame:
    steps = dq_prices(spark, sf).unionByName(dq_fundamentals(spark, sf)).select("status", F.when(F.col("check") == "prices", "us").otherwise("kr").alias("step_group"))
    return quality.roll_up(steps)


def price_order_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "orders").select(F.col("o_custkey").alias("ticker"), F.col("o_orderkey").alias("pos"), F.col("o_orderdate").cast("date").alias("date"))
    return quality.check_sorted(rows, "ticker", "pos", "date")


def failure_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Failure messages made from events: normalized reasons, distinct tickers, smallest ticker."""
    e = A.table(spark, sf, "events")
    message = F.when(F.col("event_id") % 5 == 0, "Invalid Symbol given").when(F.col("event_id") % 5 == 1, "request: status=400 LOGOUT").otherwise(F.concat(F.lit("source: "), F.col("event_type")))
    market = F.when(F.col("user_id") % 2 == 0, "KR").otherwise("US")
    return quality.failure_histogram(e.select(market.alias("market"), T.failure_reason(message).alias("reason"), F.col("user_id").alias("ticker")))


def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "pages").select("page_id", F.md5(T.markup_to_text(F.col("html")).cast("binary")).alias("text_md5"))


def filing_text_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Texts longer than both gates, cut to the section limit."""
    d = A.table(spark, sf, "documents")
    us, kr = T.gated(F.col("text"), T.US_LEAST), T.gated(F.col("text"), T.KR_LEAST)
    return d.select("doc_id", F.length(kr).alias("n"), us.isNotNull().alias("us_ok"), kr.isNotNull().alias("kr_ok")).where("kr_ok")


def filing_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sections of annual reports made of document texts under headings, contents entries first."""
    d = A.table(spark, sf, "documents").select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), r"[<>&\s]+", " ").alias("text"))
    page = F.concat(F.lit("<p>Item 1. Business</p>\n<p>Item 1A. Risk Factors</p>\n<h2>Item 1. Business</h2>\n"), "text", F.lit("\n<h2>Item 1A. Risk Factors</h2>\n"), "text", F.lit("\nItem 8. End"))
    return d.select("doc_id", T.us_sections(page).alias("s")).select("doc_id", F.size("s").alias("n"), F.length(F.col("s")["business_overview"]).alias("business_chars"), F.length(F.col("s")["risks"]).alias("risk_chars"))


def kr_filing_sections(spark: SparkSession, sf: str) -> DataFrame:
    d = A.table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    one = F.regexp_replace("text", r"[<>&\s]+", " ")
    page = F.concat(F.lit("<b>사업의 내용</b>"), one, F.lit("<b>위험 요소</b> short"), F.lit("<b>MD&amp;A</b>"), one)
    return d.select("doc_id", T.kr_sections(page).alias("s")).select("doc_id", F.size("s").alias("n"), F.length(F.col("s")["business_overview"]).alias("business_chars"), F.length(F.col("s")["mda"]).alias("mda_chars"))


def parse_amounts(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders")
    cents = F.format_number("o_totalprice", 2)
    raw = F.when(F.col("o_orderkey") % 7 == 0, F.lit("-")).when(F.col("o_orderkey") % 7 == 1, F.concat(F.lit("("), cents, F.lit(")"))).when(F.col("o_orderkey") % 7 == 2, F.lit("n.m.")).otherwise(cents)
    texts, c = o.select("o_orderkey", raw.alias("raw")), F.col("raw")
    return texts.select("o_orderkey", N.parse_amount(c).alias("amount"), N.parse_eps(c).alias("eps"), N.parse_number(c).alias("number"))


def normalize_ticker(spark: SparkSession, sf: str) -> DataFrame:
    c = A.table(spark, sf, "customer")
    raw = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("A"), F.col("c_custkey"))).when(F.col("c_custkey") % 4 == 1, F.col("c_mktsegment")).otherwise((F.col("c_custkey") * 12347).cast("string"))
    return c.select("c_custkey", T.normalize_ticker(raw).alias("ticker"))


def parse_news_dates(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    k, d = F.col("event_id") % 6, F.col("ts")
    raw = (
        F.when(k == 0, F.date_format(d, "yyyy.MM.dd HH:mm")).when(k == 1, F.date_format(d, "MM/dd")).when(k == 2, F.concat((F.col("event_id") % 59).cast("string"), F.lit("분전")))
        .when(k == 3, F.concat((F.col("event_id") % 23).cast("string"), F.lit("시간전"))).when(k == 4, F.concat((F.col("event_id") % 9).cast("string"), F.lit("일전"))).otherwise("2024.13.40")
    )
    return e.select("event_id", D.parse_headline_date(raw, at()).alias("d"), D.parse_headline_time(raw, at()).cast("timestamp_ntz").alias("t"))


def ecos_period_parse(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    period = F.element_at(F.array(*map(F.lit, "DMQA")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    token = F.when(period == "D", F.date_format("d", "yyyyMMdd")).when(period == "M", F.date_format("d", "yyyyMM")).when(period == "Q", D.fiscal_quarter(F.col("d"))).otherwise(F.year("d").cast("string"))
    bad = F.when(F.col("o_orderkey") % 9 == 0, "19991399").otherwise(token)
    rows = o.select("o_orderkey", period.alias("period"), bad.alias("token"), "d")
    return rows.select("o_orderkey", "period", D.parse_period(F.col("token"), F.col("period")).alias("first_day"), D.period_start_token(F.col("d"), F.col("period")).alias("from_token"), D.period_end_token(F.col("d"), F.col("period")).alias("to_token"))


def business_month_calendar(spark: SparkSession, sf: str) -> DataFrame:
    months = spark.sql("SELECT explode(sequence(DATE'1995-01-01', DATE'2001-12-01', INTERVAL 1 MONTH)) AS m")
    m = F.col("m")
    return months.select(m.alias("month"), D.first_business_day(m).alias("first_day"), D.last_business_day(m).alias("decision_date"), D.first_business_day(D.next_month(m)).alias("execution_date"), D.previous_business_day(m).alias("day_before"), D.is_month_end_build(F.last_day(m)).alias("ends_on_weekday"))


def report_names(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    p = T.report_period(F.concat(F.lit("report ("), F.date_format("d", "yyyy.MM"), F.lit(")")))
    return o.select("o_orderkey", p.alias("p")).where("p is not null").select("o_orderkey", "p.year", "p.code")


def cache_keys(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    stock = F.when(F.col("user_id") % 3 != 0, F.col("user_id").cast("string"))
    return e.select("event_id", T.cache_key(F.lit("m"), F.col("event_type"), stock, F.date_format("ts", "yyyy-MM"), F.substring(F.md5(F.col("props").cast("binary")), 1, 8)).alias("key"))


QUERIES = {
    f.__name__: f
    for f in (
        news_window_30, news_window_31, news_dedupe_keep_first, news_top15, news_epoch_dates, news_props_fallback, news_day_status, news_catalog_merge, news_window_coverage, calendar_densify, news_date_trackers,
        dq_prices, dq_fundamentals, dq_news, dq_summary, dq_roll_up, price_order_check, failure_histogram, html_to_text, filing_text_gate, filing_sections, kr_filing_sections, parse_amounts, normalize_ticker,
        parse_news_dates, ecos_period_parse, business_month_calendar, report_names, cache_keys,
    )
}

_D = f"DATE '{NEWS_DAY}'"
_CAPT = ", ca AS (SELECT ticker, date AS crawl_date, (ticker + day(date)) % 4 = 0 AS page_cap FROM nw WHERE NOT (ticker % 3 = 0 AND date > DATE '2024-01-15') GROUP BY ticker, date)"
_STATUS = (
    _CAPT + ", cd AS (SELECT ticker, crawl_date, page_cap, unnest(generate_series(CASE WHEN page_cap THEN crawl_date - 1 ELSE crawl_date - 3 END, crawl_date, INTERVAL 1 DAY))::DATE AS day FROM ca),"
    " ds AS (SELECT ticker, day, CASE WHEN max(CASE WHEN page_cap AND day = crawl_date - 1 THEN 1 ELSE 2 END) = 2 THEN 'ok' ELSE 'partial' END AS status, count(DISTINCT crawl_date)::INT AS n_crawls, min(crawl_date) AS first_crawl FROM cd GROUP BY 1, 2)"
)
_KEY = "CASE WHEN coalesce(url, '') <> '' THEN 'url|' || url ELSE 'headline|' || headline || '|' || published_at::VARCHAR END"
_DQP = f"""p AS (SELECT ticker, count(*) AS n, max(date) AS last FROM px WHERE ticker % 4 <> 0 AND (ticker % 3 = 0 OR date <= DATE '1999-12-31') GROUP BY 1),
 dp AS (SELECT 'prices' AS "check", ticker::VARCHAR AS entity, CASE WHEN n IS NULL OR last > DATE '{AS_OF}' THEN 'failed' ELSE 'ok' END AS status, CASE WHEN n IS NULL THEN 'empty' WHEN last > DATE '{AS_OF}' THEN 'future_date' ELSE '' END AS detail FROM uni LEFT JOIN p USING (ticker))"""
_DQF = f"""f AS (SELECT ticker, count(*) AS n, max(report_date) AS last FROM st WHERE ticker % 5 <> 0 AND (ticker % 3 = 0 OR report_date <= DATE '1999-12-31') GROUP BY 1),
 df AS (SELECT 'fundamentals' AS "check", ticker::VARCHAR AS entity, CASE WHEN n IS NULL OR last > DATE '{AS_OF}' THEN 'failed' ELSE 'ok' END AS status, CASE WHEN n IS NULL THEN 'empty' WHEN last > DATE '{AS_OF}' THEN 'future_report_date' ELSE '' END AS detail FROM uni LEFT JOIN f USING (ticker))"""
_MARKUP = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', chr(10), 'g'), '&nbsp;', ' '), '&#160;', ' '), '&amp;', '&'), chr(13), chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g'), '^\\s+', ''), '\\s+$', '')"

_ONE = "regexp_replace(coalesce(text, ''), '[<>&\\t\\n\\x0B\\f\\r ]+', ' ', 'g')"
_GATED = "CASE WHEN length({0}) > {1} THEN length({0}) END::INT"

SQL = {
    "filing_sections": f"WITH c AS (SELECT doc_id, substr(trim({_ONE}), 1, 8000) AS b FROM documents) SELECT doc_id, (CASE WHEN length(b) > 300 THEN 2 ELSE 0 END)::INT AS n, {_GATED.format('b', 300)} AS business_chars, {_GATED.format('b', 300)} AS risk_chars FROM c",
    "kr_filing_sections": f"""WITH o AS (SELECT doc_id, {_ONE} AS t FROM documents), c AS (SELECT doc_id, substr(trim(t), 1, 8000) AS b, trim(substr(t, 1, 7999)) AS m FROM o)
 SELECT doc_id, (CASE WHEN length(b) > 60 THEN 1 ELSE 0 END + CASE WHEN length(m) > 60 THEN 1 ELSE 0 END)::INT AS n, {_GATED.format('b', 60)} AS business_chars, {_GATED.format('m', 60)} AS mda_chars FROM c""",
    "news_window_30": with_tables("nw", f" SELECT ticker, date, seq FROM nw WHERE date BETWEEN {_D} - 19 AND {_D}"),
    "news_window_31": with_tables("nw", f" SELECT ticker, date, seq FROM nw WHERE date BETWEEN {_D} - 20 AND {_D}"),
    "news_dedupe_keep_first": with_tables("nw", " SELECT ticker, url, seq FROM nw QUALIFY row_number() OVER (PARTITION BY ticker, url ORDER BY date, seq) = 1"),
    "news_top15": with_tables("nw", f" SELECT ticker, published_at, headline, seq FROM nw WHERE date BETWEEN {_D} - 29 AND {_D} QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, headline DESC, seq DESC) <= 15"),
    "news_epoch_dates": with_tables("nw", f" SELECT seq, CASE WHEN seq % 3 = 2 THEN {_D} ELSE date END AS d FROM nw"),
    "news_props_fallback": "SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events",
    "news_day_status": with_tables("nw", _STATUS + " SELECT * FROM ds"),
    "news_catalog_merge": with_tables("nw", f", r AS (SELECT *, 0 AS nw, date AS crawl_date FROM nw WHERE seq % 2 = 0 UNION ALL SELECT *, 1, date + 1 FROM nw WHERE seq % 3 <> 1) SELECT ticker, date, url, crawl_date, seq FROM r QUALIFY row_number() OVER (PARTITION BY ticker, date, {_KEY} ORDER BY nw, crawl_date, seq) = 1"),
    "news_window_coverage": with_tables(
        "nw",
        _STATUS + f", sp AS (SELECT ticker, unnest(generate_series({_D} - 19, {_D}, INTERVAL 1 DAY))::DATE AS day FROM (SELECT DISTINCT ticker FROM nw)), g AS (SELECT ticker, count(status) AS captured_days, count(*) FILTER (status IS NULL)::INT AS n_missing, min(day) FILTER (status IS NULL) AS first_missing, count(*) FILTER (status = 'partial')::INT AS n_capped FROM sp LEFT JOIN ds USING (ticker, day) GROUP BY 1),"
        f" n AS (SELECT ticker, count(*) AS c FROM nw WHERE date BETWEEN {_D} - 19 AND {_D} GROUP BY 1) SELECT g.*, coalesce(c, 0) AS raw_count, CASE WHEN n_missing = 0 AND n_capped = 0 THEN 'ok' ELSE 'degraded' END AS status FROM g LEFT JOIN n USING (ticker)",
    ),
    "calendar_densify": with_tables("nw", ", s AS (SELECT ticker, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM nw GROUP BY 1), c AS (SELECT ticker, date, count(*) AS c FROM nw GROUP BY 1, 2) SELECT ticker, date, coalesce(c, 0) AS n FROM s LEFT JOIN c USING (ticker, date)"),
    "news_date_trackers": with_tables("nw", f", p AS (SELECT ticker, seq // 20 AS page, min(date) AS d FROM nw WHERE date BETWEEN {_D} - 9 AND {_D} GROUP BY 1, 2) SELECT ticker, min(d) AS oldest_kept, arg_max(d, page) AS last_page_oldest FROM p GROUP BY 1"),
    "dq_prices": with_tables("px uni", f", {_DQP} SELECT * FROM dp"),
    "dq_fundamentals": with_tables("uni st", f", {_DQF} SELECT * FROM df"),
    "dq_news": with_tables(
        "nw",
        f""", n AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY seq) AS pos FROM nw WHERE ticker % 2 = 0 OR date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'),
 m AS (SELECT ticker, CASE WHEN ticker % 7 = 0 AND seq % 3 = 0 THEN 'edited' ELSE headline END AS h, date AS dt, row_number() OVER (PARTITION BY ticker ORDER BY seq) AS pos FROM n WHERE ticker % 5 <> 0 OR seq % 7 <> 0),
 g AS (SELECT ticker, count(n.headline) AS n, count(m.h) AS m, count(*) FILTER (n.headline IS DISTINCT FROM m.h OR n.date IS DISTINCT FROM m.dt) AS differ, count(*) FILTER (n.date NOT BETWEEN {_D} - 19 AND {_D}) AS outside, count(url) AS urls, count(DISTINCT url) AS du FROM n FULL JOIN m USING (ticker, pos) GROUP BY 1),
 d AS (SELECT ticker, CASE WHEN n <> m THEN 'audit_count_mismatch' WHEN differ > 0 THEN 'record_mismatch' WHEN outside > 0 THEN 'date_out_of_window' WHEN urls > du THEN 'duplicate_url' ELSE '' END AS detail FROM g)
 SELECT 'news' AS "check", ticker::VARCHAR AS entity, CASE WHEN detail = '' THEN 'ok' ELSE 'failed' END AS status, detail FROM d""",
    ),
    "dq_summary": with_tables("px uni st", f""", {_DQP}, {_DQF} SELECT "check", count(*) AS n, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'degraded') AS degraded FROM (FROM dp UNION ALL FROM df) GROUP BY 1"""),
    "dq_roll_up": with_tables("px uni st", f""", {_DQP}, {_DQF}, s AS (SELECT max(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS l FROM dp UNION ALL SELECT max(CASE WHEN status = 'failed' THEN 2 ELSE 0 END) FROM df)
 SELECT CASE max(l) WHEN 2 THEN 'failed' WHEN 1 THEN 'degraded' ELSE 'ok' END AS status, (CASE max(l) WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 0 END)::INT AS exit_code FROM s"""),
    "price_order_check": "WITH s AS (SELECT o_custkey AS ticker, o_orderdate::DATE >= lag(o_orderdate::DATE) OVER w AS up, o_orderdate::DATE <= lag(o_orderdate::DATE) OVER w AS down FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) SELECT ticker, coalesce(bool_and(up), true) AS is_sorted, coalesce(bool_and(up), true) OR coalesce(bool_and(down), true) AS either_way FROM s GROUP BY 1",
    "failure_histogram": "WITH f AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'KR' ELSE 'US' END AS market, CASE event_id % 5 WHEN 0 THEN 'invalid symbol or no data' WHEN 1 THEN 'status=400 LOGOUT' ELSE event_type END AS reason, user_id FROM events) SELECT market, reason, count(DISTINCT user_id) AS tickers, min(user_id) AS example FROM f GROUP BY 1, 2",
    "html_to_text": f"SELECT page_id, md5({_MARKUP}) AS text_md5 FROM pages",
    "filing_text_gate": "SELECT doc_id, length(substr(text, 1, 8000))::INT AS n, length(substr(text, 1, 8000)) > 300 AS us_ok, true AS kr_ok FROM documents WHERE length(text) > 60",
    "parse_amounts": """WITH o AS (SELECT o_orderkey, o_orderkey % 7 AS k, round(o_totalprice, 2) AS v FROM orders), a AS (SELECT o_orderkey, k, CASE WHEN k IN (0, 2) THEN NULL WHEN k = 1 THEN -v ELSE v END AS v FROM o)
 SELECT o_orderkey, floor(v / 1000 * 10 + 0.5) / 10 AS amount, floor(v * 100 + 0.5) / 100 AS eps, CASE WHEN k <> 1 THEN v END AS number FROM a""",
    "normalize_ticker": "WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'A' || c_custkey WHEN c_custkey % 4 = 1 THEN c_mktsegment ELSE (c_custkey * 12347)::VARCHAR END AS t FROM customer), d AS (SELECT *, regexp_replace(t, '[^0-9]', '', 'g') AS n FROM r) SELECT c_custkey, CASE WHEN n = '' THEN t WHEN length(n) < 6 THEN lpad(n, 6, '0') ELSE n END AS ticker FROM d",
    "parse_news_dates": f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN ts::DATE WHEN 1 THEN CASE WHEN ts::DATE > {_D} THEN (ts - INTERVAL 1 YEAR)::DATE ELSE ts::DATE END WHEN 2 THEN {_D} WHEN 3 THEN {_D} WHEN 4 THEN {_D} - (event_id % 9)::INT END AS d,
 CASE event_id % 6 WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN CASE WHEN ts::DATE > {_D} THEN (ts - INTERVAL 1 YEAR)::DATE ELSE ts::DATE END WHEN 2 THEN {_D} WHEN 3 THEN {_D} WHEN 4 THEN {_D} - (event_id % 9)::INT END::TIMESTAMP AS t FROM events""",
    "ecos_period_parse": """WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, substr('DMQA', (o_orderkey % 4 + 1)::INT, 1) AS period, o_orderkey % 9 = 0 AS bad FROM orders)
 SELECT o_orderkey, period, CASE WHEN bad THEN NULL WHEN period = 'D' THEN d WHEN period = 'M' THEN date_trunc('month', d) WHEN period = 'Q' THEN date_trunc('quarter', d) ELSE date_trunc('year', d) END::DATE AS first_day,
 CASE period WHEN 'D' THEN strftime(d - 730, '%Y%m%d') WHEN 'M' THEN (year(d) - 4) || '01' WHEN 'Q' THEN (year(d) - 6) || 'Q1' ELSE (year(d) - 10)::VARCHAR END AS from_token,
 CASE period WHEN 'D' THEN strftime(d, '%Y%m%d') WHEN 'M' THEN strftime(d, '%Y%m') WHEN 'Q' THEN year(d) || 'Q' || quarter(d) ELSE year(d)::VARCHAR END AS to_token FROM o""",
    "business_month_calendar": """WITH m AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH))::DATE AS m), c AS (SELECT unnest(generate_series(DATE '1994-12-01', DATE '2002-02-28', INTERVAL 1 DAY))::DATE AS d), w AS (SELECT d, date_trunc('month', d)::DATE AS m FROM c WHERE isodow(d) <= 5),
 b AS (SELECT m, min(d) AS a, max(d) AS z FROM w GROUP BY 1) SELECT m.m AS month, b.a AS first_day, b.z AS decision_date, n.a AS execution_date, (SELECT max(d) FROM w WHERE w.d < m.m) AS day_before, b.z = last_day(m.m) AS ends_on_weekday FROM m JOIN b ON m.m = b.m JOIN b n ON n.m = (m.m + INTERVAL 1 MONTH)::DATE""",
    "report_names": "SELECT o_orderkey, year(o_orderdate)::VARCHAR AS year, CASE month(o_orderdate) WHEN 3 THEN '11013' WHEN 6 THEN '11012' WHEN 9 THEN '11014' ELSE '11011' END AS code FROM orders WHERE month(o_orderdate) % 3 = 0",
    "cache_keys": "SELECT event_id, 'm:' || event_type || ':' || CASE WHEN user_id % 3 <> 0 THEN user_id::VARCHAR ELSE '__MARKET__' END || ':' || strftime(ts, '%Y-%m') || ':' || substr(md5(props), 1, 8) AS key FROM events",
}
