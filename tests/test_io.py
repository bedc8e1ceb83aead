import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark import sinks, snapshot
from tidemark.operators import quality, universe
from tidemark.sources import adapters as A
from tidemark.sources import readers, synthetic
from tidemark.streaming import catalog

d = dt.date


def test_universe_csv(spark, tmp_path):
    p = tmp_path / "u.csv"
    p.write_text("ticker,market,sector,name\n5930,KOSPI,Old,x\n 660 ,KOSDAQ,Chips,y\n,KOSPI,s,z\n5930,KOSPI,New,x\n")
    got = {r.ticker: r.sector for r in readers.universe_csv(spark, str(p)).collect()}
    assert got == {"005930": "New", "000660": "Chips"}


def test_bars_and_aliases(spark):
    df = spark.createDataFrame([(d(2024, 1, 2), 1.005, 2.0, 0.5, None, 10.0)], "`날짜` date, `시가` double, `고가` double, `저가` double, `종가` double, `거래량` double")
    r = readers.bars(df, null_is_zero=True).first()
    assert (r["open"], r["close"], r["volume"]) == (1.0, 0.0, 10.0)
    assert readers.bars(df, null_is_zero=False).first()["close"] is None
    try:
        readers.bars(df.drop("종가"), True)
        raise AssertionError
    except ValueError as e:
        assert "close" in str(e)


def test_statement_json_is_cut(spark, tmp_path):
    body = {"ticker": "5930", "fundamentals": {"quarters": [{"fiscal_quarter": "2025Q3", "report_date": "2025-11-14", "revenue": 1.5}, {"fiscal_quarter": "2025Q4", "report_date": "2026-03-01", "revenue": 2.5}]}, "filing": {"filing_date": "2026-03-01", "business_overview": "b"}}
    (tmp_path / "a.json").write_text(json.dumps(body))
    docs = readers.statements_json(spark, str(tmp_path))
    at = F.lit(d(2025, 12, 31))
    q = readers.quarters_of(docs).where(F.col("report_date") <= at).collect()
    assert [(r.ticker, r.fiscal_quarter, r.revenue) for r in q] == [("005930", "2025Q3", 1.5)]
    assert readers.filings_of(docs, at).first()["business_overview"] is None


def test_small_readers(spark):
    r = spark.createDataFrame([(chr(0xFEFF) + '{"a": 1}',), ("<html>",)], "c string").select(readers.json_body(F.col("c"), "a int").alias("x")).collect()
    assert r[0].x.a == 1 and r[1].x is None
    m = spark.range(1).select(readers.cik_map(F.lit('{"0": {"cik_str": 320193, "ticker": "aapl"}}')).alias("m")).first().m
    assert m == {"AAPL": "0000320193"}
    o = spark.createDataFrame([("202401", "1,200.5"), ("2024", "x")], "TIME string, DATA_VALUE string")
    assert [(x.date, x.value) for x in readers.macro_lines(o, F.lit("s"), F.lit("M")).collect()] == [(d(2024, 1, 1), 1200.5)]
    assert readers.empty(spark, "a int").count() == 0


def test_partitions_and_batches(spark, tmp_path):
    df = spark.createDataFrame([("K", d(2024, 1, 31), "2", 5), ("K", d(2024, 1, 31), "1", 4), ("Q", d(2024, 1, 31), "3", 6)], "market string, trade_date date, ticker string, cap int")
    p = str(tmp_path / "caps")
    sinks.write_partitions(df, p, ["market", "trade_date"], "ticker")
    sinks.write_partitions(df.where("market = 'Q'").withColumn("cap", F.lit(9)), p, ["market", "trade_date"], "ticker")
    back = readers.dated_snapshots(spark, p)
    assert sorted((r.ticker, r.cap) for r in back.collect()) == [("1", 4), ("2", 5), ("3", 9)]
    assert quality.output_rows(back).first()["rows"] == 3
    b = str(tmp_path / "batches")
    for k, cap in ((0, 1), (1, 2), (1, 3)):
        sinks.append_batch(df.where("ticker = '1'").withColumn("cap", F.lit(cap)), b, k)
    assert [r.cap for r in sinks.merge_batches(spark.read.parquet(b), ["ticker"]).collect()] == [3]
    assert not sinks.write_stamped(df.limit(0), str(tmp_path / "none"))
    assert [r.ticker for r in sinks.remaining(df, df.where("market = 'K'"), ["ticker"]).collect()] == ["3"]


def test_cache(spark):
    s = spark.createDataFrame([("m:a", "1")], "key string, value string")
    out = sinks.cache_put(s, spark.createDataFrame([("m:a", "2"), ("m:b", "3")], "key string, value string"))
    assert sorted(map(tuple, out.collect())) == [("m:a", "1"), ("m:b", "3")]
    assert sinks.cache_invalidate(out, ":a").count() == 1


def test_snapshot(spark, tmp_path):
    u = synthetic.universe(spark, 6)
    at = F.lit(d(2024, 6, 28))
    prices = synthetic.prices(u, at, 320)
    tables = snapshot.Tables(u, prices, synthetic.fundamentals(u, at), readers.empty(spark, "ticker string, filing_date date, business_overview string"), synthetic.news(u, at), spark.createDataFrame([("rates", "base", d(2024, 6, 1), 3.5)], "category string, key string, date date, value_num double"), prices.where("ticker = '000000'"))
    parts = snapshot.build(tables, at)
    assert parts["prices"].groupBy("ticker").count().where("count <> 300").count() == 0
    assert parts["quarters"].where(F.col("report_date") > at).count() == 0
    assert parts["sector_averages"].count() == 6
    again = snapshot.build(tables, at)
    assert snapshot.content_hashes(parts).first() == snapshot.content_hashes(again).first()
    rows = snapshot.nested(parts, u)
    sinks.write_snapshot(rows, str(tmp_path / "s"))
    one = json.loads(spark.read.text(str(tmp_path / "s")).first()[0])
    assert len(one["prices"]) == 300 and "filing_date" not in one
    assert sinks.manifest(parts["quarters"], parts["prices"], u, ["revenue", "eps"]).first()["warnings"] == []


def test_stream_ingest_equals_one_merge(spark, tmp_path):
    n = A.news(spark, SMALL).withColumn("crawl_date", F.col("date")).where("seq < 300")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    n.where("seq < 150").coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema(n.schema).option("maxFilesPerTrigger", 1).parquet(src)
    catalog.ingest(stream(), out, str(tmp_path / "cp")).awaitTermination()
    n.where("seq >= 100").coalesce(1).write.mode("append").parquet(src)
    catalog.ingest(stream(), out, str(tmp_path / "cp")).awaitTermination()
    got = sorted(r.seq for r in spark.read.parquet(f"{out}/v1").collect())
    assert got == sorted(r.seq for r in n.dropDuplicates(["ticker", "date", "url"]).collect()) or len(got) == n.select("ticker", "date", "url").distinct().count()


def test_stream_windows(spark):
    e = spark.read.parquet(f"{SMALL}/events.parquet")
    out = catalog.windowed_counts(e)
    assert out.agg(F.sum("n")).first()[0] == e.count()


def test_profiles(spark):
    full, none = (snapshot.Tables(*(spark.range(k) for _ in range(7))) for k in (2, 0))
    assert snapshot.tables_of("official", full, none).news.count() == 2
    safe = snapshot.tables_of("ci_safe", full, none, quarters=spark.range(5))
    assert (safe.universe.count(), safe.prices.count(), safe.quarters.count()) == (2, 0, 5)
    try:
        snapshot.tables_of("other", full, none)
        raise AssertionError
    except ValueError as e:
        assert "ci_safe" in str(e)


def test_charsets(spark):
    from tidemark.functions.text import sniff_charset

    rows = [("한글".encode("euc-kr"), None), ("한글".encode("euc-kr"), "text/html; charset=EUC-KR"), ("한글".encode(), "text/html; charset=ascii"), ("한글".encode("utf-16"), "x; charset=utf-16"), (None, None), (b"", "text/html")]
    got = spark.createDataFrame(rows, "b binary, h string").select(sniff_charset(F.col("b"), F.col("h")).alias("t")).collect()
    assert [r.t for r in got] == ["한글", "한글", "한글", "한글", None, ""]


def test_page_text_against_a_plain_parser(spark):
    """The registered query equals a plain reading of the markup on all pages."""
    import html as H
    import re

    from tidemark.plans.inputs import html_to_text_us

    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in html_to_text_us(spark, SMALL).collect():
        page = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", "", raw[r.page_id])
        words = H.unescape(re.sub(r"(?s)</?[a-zA-Z][^>]*>", " ", page)).split()
        assert (r.text or "").split() == words


def test_sector_snapshot_without_a_usable_one(spark):
    df = spark.createDataFrame([("1", "x")], "Code string, Other string")
    assert readers.sector_snapshot([("1999-01-01", df)], "1999-12-31") is None


def test_index_members_fall_back(spark):
    shape = "ticker string, name string, sector string"
    none, some = spark.createDataFrame([], shape), spark.createDataFrame([("brk.b", "B", "F")], shape)
    assert [r.ticker for r in universe.index_members(none, some).collect()] == ["BRK-B"]


def test_scratch_folder():
    """The session's folder; a temporary one only where there is none and all runs in one process."""
    from types import SimpleNamespace

    from tidemark.storage import scratch_path

    def session(master, folder=None):
        context = SimpleNamespace(master=master, applicationId=master, getConf=lambda: SimpleNamespace(get=lambda _: folder))
        return SimpleNamespace(conf=SimpleNamespace(get=lambda _, other: other), sparkContext=context)

    assert scratch_path(session("yarn", "hdfs:///work/"), "x").startswith("hdfs:///work/x-")
    assert scratch_path(session("local[*]"), "x").startswith("file:///")
    try:
        scratch_path(session("yarn"), "x")
        raise AssertionError
    except RuntimeError as e:
        assert "checkpoint" in str(e)
