"""Small inputs with known outcomes for readers, routes and output checks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import sinks
from tidemark.operators import asof, fundamentals, news, quality, universe
from tidemark.sources import readers

d = dt.date


def at(*ymd):
    return F.lit(d(*ymd))


def test_daily_caps_drop_odd_rows(spark):
    rows = [("2024/01/31", "71,200", "4250000"), ("2024/02/01", "0", "1"), ("2024/02/02", "10", "0"), ("2019/01/02", "5", "5"), ("x", "5", "5")]
    body = chr(0xFEFF) + json.dumps({"CHART": [dict(zip(("TRD_DT", "J_PRC", "MKT_CAP"), r, strict=True)) for r in rows]})
    got = readers.daily_cap_json(spark.createDataFrame([("1", body), ("2", "<html>")], "ticker string, body string"), at(2024, 1, 1), at(2024, 12, 31)).collect()
    assert [(r.date, r.market_cap, r.issued_shares) for r in got] == [(d(2024, 1, 31), 425_000_000_000_000, round(425_000_000_000_000 / 71_200))]


def test_month_labels_become_trading_days(spark):
    ends = spark.createDataFrame([(d(2024, 2, 29),)], "date date")
    rows = spark.createDataFrame([("1", d(2024, 2, 1)), ("1", d(2024, 3, 1))], "ticker string, date date")
    assert [(r.date, r.source_trade_date) for r in readers.relabel_months(rows, ends).collect()] == [(d(2024, 2, 1), d(2024, 2, 29))]


def test_monthly_valuation_reads_decimal_multiples(spark):
    chart = [{"TRD_DT": "2024/01/30", "J_PRC": "1", "E3": "1", "B3": "1"}, {"TRD_DT": "2024/01/31", "J_PRC": "1,000", "E3": "250", "B3": "0"}]
    rows = spark.createDataFrame([("1", "PER 12.5X", "PBR 2X", json.dumps({"CHART": chart}))], "ticker string, e_name string, b_name string, body string")
    r = readers.monthly_valuation_json(rows).first()
    assert (r.date, r.source_month, r.eps, r.per, r.bps, r.pbr) == (d(2024, 1, 31), "2024-01", 20.0, 50.0, 0.0, None)


def test_listings_unite_in_order(spark):
    a = spark.createDataFrame([("5930",), ("660",)], "ticker string")
    b = spark.createDataFrame([("000660",), ("A035720",)], "ticker string")
    assert [r.ticker for r in universe.all_tickers([a, b]).collect()] == ["000660", "005930", "035720"]
    u = spark.createDataFrame([("B", "1"), ("A", "9"), ("A", "2")], "market string, ticker string")
    assert [tuple(r) for r in universe.in_order(u).collect()] == [("A", "2"), ("A", "9"), ("B", "1")]


def test_cap_route_by_age(spark):
    local = spark.createDataFrame([("a", d(2024, 1, 24), 1), ("b", d(2024, 1, 23), 1)], "ticker string, trade_date date, cap int")
    public = spark.createDataFrame([("b", d(2023, 12, 17), 2), ("c", d(2023, 12, 16), 2)], "ticker string, trade_date date, cap int")
    rest = spark.createDataFrame([("c", d(2020, 1, 1), 3), ("a", d(2024, 2, 1), 3)], "ticker string, trade_date date, cap int")
    got = asof.first_fresh([(local, 7), (public, 45), (rest, None)], ["ticker"], "trade_date", at(2024, 1, 31)).collect()
    assert sorted((r.ticker, r.cap) for r in got) == [("a", 1), ("b", 2), ("c", 3)]


def test_price_window_is_bounded_by_days_and_bars(spark):
    rows = [("a", d(2024, 1, 1) + dt.timedelta(i), float(i)) for i in range(40)] + [("b", d(2023, 1, 1), 1.0)]
    p = spark.createDataFrame(rows, "ticker string, date date, close double")
    got = asof.price_window(p, at(2024, 1, 31), 5, 1.6).collect()
    assert sorted(r.close for r in got) == [26.0, 27.0, 28.0, 29.0, 30.0]
    assert asof.price_window(p, at(2024, 1, 31), 30, 0.5, 3).count() == 16 and asof.price_window(p, at(2024, 1, 31), 2, 0.1, 3).count() == 2


def test_statements_and_reports(spark):
    lines = spark.createDataFrame([("1", 2024, "11011", "CFS", 5.0), ("1", 2024, "11011", "OFS", 4.0), ("1", 2023, "11011", "OFS", 3.0)], "corp string, bsns_year int, reprt_code string, fs_div string, amount double")
    assert sorted((r.bsns_year, r.amount) for r in fundamentals.prefer_consolidated(lines).collect()) == [(2023, 3.0), (2024, 5.0)]
    of = lambda rows, c: spark.createDataFrame(rows, f"ticker string, period_end date, {c} double")
    out = fundamentals.three_statements(of([("a", d(2024, 3, 31), 1.0)], "revenue"), of([("a", d(2024, 3, 31), 2.0), ("a", d(2023, 3, 31), 9.0)], "total_assets"), of([], "operating_cash_flow")).collect()
    assert [(r.revenue, r.total_assets, r.operating_cash_flow) for r in out] == [(1.0, 2.0, None)]
    reports = spark.createDataFrame([("1", None), ("2", "20240131"), ("3", "20240201"), ("4", "20240230")], "n string, rcept_dt string")
    assert [r.n for r in asof.compact_date_cut(reports, at(2024, 1, 31), "rcept_dt").collect()] == ["2"]


def test_archive_pages_stop(spark):
    page = lambda k, *days: [("t", k, i, d(2026, 3, x), f"u{x}") for i, x in enumerate(days)]
    rows = spark.createDataFrame([*page(0, 12, 11), *page(1, 11, 1), *page(2, 1, 28), *page(3, 5, 4)], "ticker string, page int, seq int, date date, url string")
    got = news.archive_pages(rows, at(2026, 3, 1)).collect()
    assert sorted(r.url for r in got) == sorted(["u12", "u11", "u1", "u28", "u5", "u4"])
    early = news.archive_pages(rows, at(2026, 3, 5)).collect()  # page 1 reaches before the window
    assert sorted(r.url for r in early) == ["u11", "u12"]
    again = spark.createDataFrame([*page(0, 12), *page(1, 12), *page(2, 11)], rows.schema)  # page 1 brings nothing new
    assert [r.url for r in news.archive_pages(again, at(2026, 3, 1)).collect()] == ["u12"]
    gap = spark.createDataFrame([*page(0, 12), *page(2, 11)], rows.schema)  # page 1 is empty
    assert [r.url for r in news.archive_pages(gap, at(2026, 3, 1)).collect()] == ["u12"]
    assert news.archive_pages(rows, at(2026, 3, 1), most_pages=1).count() == 2


def test_list_items_in_page_order(spark):
    html = '<a href="/1">One <b>x</b></a> <A class=q HREF="/2">Two</A><a href="/1">again</a><a href="">none</a>'
    items = readers.listed_items(spark.createDataFrame([("t", html)], "ticker string, html string"))
    assert [(r.seq, r.url, r.headline) for r in news.page_order_items(items, 2).orderBy("seq").collect()] == [(0, "/1", "One  x"), (1, "/2", "Two")]
    assert [r.url for r in news.page_order_items(items, 1).collect()] == ["/1"]


def test_pages_end_at_a_short_one(spark):
    rows = spark.createDataFrame([("a", p, i) for p, n in ((0, 2), (1, 1), (2, 2)) for i in range(n)] + [("b", 0, 0), ("b", 0, 1)], "k string, page int, i int")
    got = readers.until_short_page(rows, ["k"], "page", 2).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {"a": 3, "b": 2}


def test_monthly_files_are_used_when_old(spark):
    rows = [("K", "1", "202401", d(2024, 1, 30), 1), ("K", "1", "202401", d(2024, 1, 31), 2), ("K", "1", "20231229", d(2023, 12, 29), 9), ("K", "1", "202403", d(2024, 3, 29), 9)]
    df = spark.createDataFrame(rows, "market string, ticker string, token string, source_trade_date date, cap int")
    r = readers.monthly_caps(df, "token", at(2024, 3, 20)).collect()
    assert [(x.cap, x.file_date, x.stale) for x in r] == [(2, d(2024, 1, 31), True)]


def test_columns_that_are_missing(spark):
    with pytest.raises(ValueError, match="dps"):
        readers.valuation_snapshot(spark.createDataFrame([(1, 1.0)], "Code int, BPS double").selectExpr("*", "1 PER", "1 PBR", "1 EPS", "1 DIV"))


def test_old_snapshots_seed_a_cache(spark):
    store = spark.createDataFrame([("1", "2024-01", "old")], "ticker string, month string, payload string")
    new = spark.createDataFrame([("1", "2024-01", "new"), ("2", "2024-01", "b"), ("2", "2024-01", "a")], store.schema)
    assert sorted(tuple(r) for r in readers.seed_cache(store, new).collect()) == [("1", "2024-01", "old"), ("2", "2024-01", "a")]


def test_either_direction(spark):
    rows = [("up", 0, d(2024, 1, 1)), ("up", 1, d(2024, 1, 2)), ("down", 0, d(2024, 1, 2)), ("down", 1, d(2024, 1, 1)), ("mixed", 0, d(2024, 1, 1)), ("mixed", 1, d(2024, 1, 3)), ("mixed", 2, d(2024, 1, 2)), ("one", 0, None)]
    got = quality.check_sorted(spark.createDataFrame(rows, "k string, pos int, date date"), "k", "pos", "date").collect()
    assert {r.k: (r.is_sorted, r.either_way) for r in got} == {"up": (True, True), "down": (False, True), "mixed": (False, False), "one": (True, True)}


def test_outputs_are_there(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/a")
    spark.range(0).write.parquet(f"{tmp_path}/b")
    got = quality.check_outputs(spark, {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b", "c": f"{tmp_path}/c"}, "ok", f"{tmp_path}/none").collect()
    assert {r.entity: (r.status, r.detail) for r in got} == {"a": ("ok", ""), "b": ("failed", "empty"), "c": ("failed", "missing"), "summary": ("failed", "status")}


def test_checkpoint_reasons(spark):
    rows = spark.createDataFrame([(0, 0), (24, 10), (25, 10), (26, 300), (100, 0)], "n int, s int")
    got = [r[0] for r in rows.select(sinks.checkpoint_due(F.col("n"), F.col("s"), F.lit(100))).collect()]
    assert got == [None, None, "count", "time", "end"]


def test_cursor(spark):
    items = spark.createDataFrame([("K", 1), ("K", 2), ("Q", 1)], "market string, ticker int")
    got = sinks.resume_cursor(items, items.where("market = 'Q' or ticker = 1"), ["market"], "ticker").collect()
    assert {r.market: (r.done, r.next) for r in got} == {"K": (1, 2), "Q": (1, None)}


def test_stale_answers(spark):
    fresh = spark.createDataFrame([("a", d(2024, 1, 30), 1)], "ticker string, date date, v int")
    cache = spark.createDataFrame([("a", d(2024, 1, 31), 2), ("b", d(2020, 1, 1), 3), ("b", d(2024, 2, 1), 4)], fresh.schema)
    got = asof.stale_fallback(fresh, cache, ["ticker"], "date", at(2024, 1, 31)).collect()
    assert sorted((r.ticker, r.v, r.is_stale) for r in got) == [("a", 1, False), ("b", 3, True)]
