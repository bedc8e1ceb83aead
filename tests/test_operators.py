import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import asof, fundamentals, macro, news, quality, sectors, universe

d = dt.date


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_uncumulate_and_gap(spark):
    s = spark.createDataFrame([("A", 2024, 1, 100.0, 10.0, 5.0), ("A", 2024, 2, 260.0, 26.0, 5.0), ("A", 2024, 3, 420.0, 42.0, 6.0), ("A", 2024, 4, 600.0, 60.0, 7.0), ("B", 2024, 1, 50.0, 1.0, 1.0), ("B", 2024, 3, 90.0, 2.0, 1.0)], "ticker string, fy int, fq int, revenue double, eps double, total_assets double")
    got = rows(fundamentals.uncumulate(s, ["revenue", "eps"], digits=1), "ticker", "fq", "revenue", "eps", "total_assets")
    assert got == [("A", 1, 100.0, 10.0, 5.0), ("A", 2, 160.0, 16.0, 5.0), ("A", 3, 160.0, 16.0, 6.0), ("A", 4, 180.0, 18.0, 7.0), ("B", 1, 50.0, 1.0, 1.0), ("B", 3, None, None, 1.0)]


def test_amendment(spark):
    r = spark.createDataFrame([("A", "2024", "Q2", "20240815", "1"), ("A", "2024", "Q2", "20240901", "2"), ("A", "2024", "Q2", "20240901", "3")], "corp string, y string, q string, rcept_dt string, rcept_no string")
    assert rows(fundamentals.latest_amendment(r, ["corp", "y", "q"], "rcept_dt", "rcept_no"), "rcept_no") == [("3",)]


def test_staleness_bound(spark):
    caps = spark.createDataFrame([("K", d(2024, 1, 10), 1), ("Q", d(2024, 1, 9), 2), ("X", d(2024, 1, 20), 3)], "market string, trade_date date, cap int")
    at = F.lit(d(2024, 1, 17))
    assert rows(asof.newest_snapshot(caps, ["market"], "trade_date", at, 7), "market") == [("K",)]
    assert rows(asof.newest_snapshot(caps, ["market"], "trade_date", at, None), "market") == [("K",), ("Q",)]


def test_as_of_join(spark):
    left = spark.createDataFrame([("A", d(2024, 1, 5)), ("A", d(2024, 1, 1)), ("B", d(2024, 1, 5)), ("A", d(2024, 3, 1))], "t string, day date")
    right = spark.createDataFrame([("A", d(2024, 1, 2), 1.0), ("A", d(2024, 1, 5), 2.0)], "t string, at date, v double")
    got = rows(asof.as_of_join(left, right, ["t"], "day", "at", ["v"], 30), "t", "day", "v")
    assert got == [("A", d(2024, 1, 1), None), ("A", d(2024, 1, 5), 2.0), ("A", d(2024, 3, 1), None), ("B", d(2024, 1, 5), None)]


def test_nearest_tie_is_later(spark):
    s = spark.createDataFrame([("s", d(2023, 1, 9), 1.0), ("s", d(2023, 1, 11), 2.0)], "series string, date date, value double")
    assert rows(asof.nearest_value(s, ["series"], "value", "date", F.lit(d(2023, 1, 10))), "value") == [(2.0,)]


def test_first_source_and_missing(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "k string, v int")
    assert rows(asof.first_source([a, b], ["k"]), "k", "v", "source_rank") == [("x", 1, 0), ("y", 3, 1)]
    got = asof.missing_combinations([b.select("k"), spark.createDataFrame([(1,), (2,)], "m int")], spark.createDataFrame([("x", 1), ("x", 2), ("y", 2)], "k string, m int"))
    assert rows(got, "k", "m") == [("y", 1)]


def test_sector_average(spark):
    q = spark.createDataFrame([("A", 100.0, 40.0, 15.0, 10.0, 200.0, 100.0, 80.0, 40.0, 50.0, 2.0, 80.0), ("B", 0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], "ticker string, revenue double, gross_profit double, operating_income double, net_income double, total_assets double, total_equity double, current_assets double, current_liabilities double, total_debt double, eps double, last_close double")
    m = spark.createDataFrame([("A", "S"), ("B", "S"), ("C", "E")], "ticker string, sector string")
    got = {r["sector"]: r["avg_metrics"] for r in sectors.as_metric_map(sectors.sector_averages(m, q)).collect()}
    assert got == {"S": {"roa": 0.05, "roe": 0.1, "gross_margin": 0.4, "operating_margin": 0.15, "net_margin": 0.1, "current_ratio": 2.0, "debt_to_equity": 0.5, "asset_turnover": 0.5, "pe_ttm": 10.0}, "E": {}}


def test_merge_market(spark):
    s = spark.createDataFrame([("A", "2024Q1", 10.0, None), ("A", "2023Q4", 0.0, None), ("B", "2024Q1", 5.0, 1.0)], "ticker string, fiscal_quarter string, net_income double, eps double")
    m = spark.createDataFrame([("A", 500.0, None, 1000.0)], "ticker string, market_cap double, last_close double, issued_shares double")
    p = spark.createDataFrame([("A", 71200.0), ("B", 3.0)], "ticker string, last_close double")
    got = rows(fundamentals.merge_market(s, m, p), "ticker", "fiscal_quarter", "eps", "issued_shares", "market_cap", "last_close_price")
    assert got == [("A", "2023Q4", None, 1000.0, 500.0, 71200.0), ("A", "2024Q1", 10000.0, 1000.0, 500.0, 71200.0), ("B", "2024Q1", 1.0, None, None, 3.0)]


def test_accounts(spark):
    s = spark.createDataFrame([("A", "영업수익 합계", 5.0, 1), ("A", "매출액", 7.0, 2), ("A", "자산총계", None, 3), ("A", "유동자산", 2.0, 4)], "corp string, name string, amount double, row int")
    r = fundamentals.map_accounts(s, ["corp"], "name", "amount", "row", fundamentals.KR_ACCOUNTS).first()
    assert (r["revenue"], r["total_assets"], r["current_assets"]) == (7.0, None, 2.0)
    w = spark.createDataFrame([("A", float("nan"), 3.0)], "ticker string, `Total Revenue` double, `Operating Revenue` double")
    assert fundamentals.map_wide_accounts(w, ["ticker"], fundamentals.US_ACCOUNTS).first()["revenue"] == 3.0


def test_bar_return_needs_22(spark):
    def bars(n):
        return spark.createDataFrame([("A", d(2024, 1, 1) + dt.timedelta(i), 100.0 + i) for i in range(n)], "ticker string, date date, close double")

    at = F.lit(d(2024, 12, 31))
    assert macro.bar_return(bars(21), at).count() == 0
    assert rows(macro.bar_return(bars(22), at), "return_pct") == [(21.0,)]


def test_indicators(spark):
    closes = [10.0, 11.0, 10.5, 12.0, 11.0, 13.0, 12.5, 12.0, 14.0, 15.0, 14.5, 14.0, 15.5, 16.0, 15.0, 17.0, 18.0, 17.5, 18.5, 19.0, 18.0, 20.0]
    df = spark.createDataFrame([("A", d(2024, 1, 1) + dt.timedelta(i), c, c, c) for i, c in enumerate(closes)], "ticker string, date date, close double, high double, low double")
    got = sorted(macro.technical_indicators(df).collect(), key=lambda r: r["date"])
    ema = lambda xs, a: [x := xs[0]] + [x := x + a * (v - x) for v in xs[1:]]  # noqa: E731, F841
    fast, slow = ema(closes, 2 / 13), ema(closes, 2 / 27)
    assert abs(got[-1]["macd"] - (fast[-1] - slow[-1])) < 1e-9
    assert abs(got[-1]["bb_mid"] - sum(closes[-20:]) / 20) < 1e-9
    assert got[18]["bb_mid"] is None and 0 <= got[-1]["rsi_14"] <= 100
    assert abs(got[-1]["roc_5"] - (closes[-1] / closes[-6] * 100 - 100)) < 1e-9


def test_stance_and_clamp(spark):
    r = spark.createDataFrame([(3.5,), (1.5,), (2.0,), (None,)], "r double").select(macro.stance(F.col("r"), 3.5, 1.5).alias("s"))
    assert [x.s for x in r.collect()] == ["hawkish", "dovish", "neutral", None]


def test_capture_with_page_cap(spark):
    c = spark.createDataFrame([("A", d(2026, 3, 12), d(2026, 3, 10), True, d(2026, 3, 10))], "ticker string, crawl_date date, required_start date, page_cap boolean, last_in_window date")
    meta = news.day_status(c)
    assert rows(meta, "day", "status") == [(d(2026, 3, 10), "partial"), (d(2026, 3, 11), "ok"), (d(2026, 3, 12), "ok")]
    t = spark.createDataFrame([("A",), ("B",)], "ticker string")
    items = spark.createDataFrame([], "ticker string, date date")
    cov = {r["ticker"]: r for r in news.coverage(t, meta, items, F.lit(d(2026, 3, 12)), 3).collect()}
    assert (cov["A"]["missing_days"], cov["A"]["capped_days"], cov["A"]["status"]) == ([], [d(2026, 3, 10)], "degraded")
    assert len(cov["B"]["missing_days"]) == 3
    again = news.merge_day_meta(meta, meta.withColumn("status", F.lit("ok")))
    assert {r.status for r in again.collect()} == {"ok"}


def test_catalog_keeps_existing(spark):
    s = "ticker string, date date, published_at timestamp_ntz, headline string, url string, crawl_date date, seq long"
    old = spark.createDataFrame([("A", d(2024, 1, 1), None, "h", "u1", d(2024, 1, 1), 1), ("A", d(2024, 1, 1), None, "h", None, d(2024, 1, 1), 2)], s)
    new = spark.createDataFrame([("A", d(2024, 1, 1), None, "other", "u1", d(2024, 1, 2), 3), ("A", d(2024, 1, 1), None, "h", "", d(2024, 1, 2), 4)], s)
    assert rows(news.merge_catalog(old, new), "seq") == [(1,), (2,)]


def test_universe(spark):
    listing = spark.createDataFrame([("1",), ("2",), ("3",)], "ticker string")
    caps = spark.createDataFrame([("1", 500.0), ("2", -3.0), ("3", 500.0), ("9", 900.0)], "ticker string, market_cap double")
    assert [r.ticker for r in universe.top_by_cap(listing, caps, 5).collect()] == ["1", "3"]
    m = universe.manifest([spark.createDataFrame([("1", "K", "300"), ("2", "K", "n/a")], "ticker string, market string, market_cap string"), spark.createDataFrame([("3", "Q", "500"), ("1", "Q", "100")], "ticker string, market string, market_cap string")], spark.createDataFrame([("1", "one", "S")], "ticker string, name string, sector string"), 10)
    assert rows(m, "rank", "ticker", "market", "name") == [(1, "3", "Q", None), (2, "1", "K", "one")]
    raw = spark.createDataFrame([("660", "KOSDAQ GLOBAL", "", "Chips"), ("5930", "KOSPI", "Electronics", "x"), ("7", "KONEX", "a", "b")], "ticker string, market string, industry string, sector string")
    assert rows(universe.listing_labels(raw, ["KOSPI", "KOSDAQ"]), "ticker", "sector") == [("000660", "Chips"), ("005930", "Electronics")]


def test_checks(spark):
    u = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "ticker string")
    p = spark.createDataFrame([("A", d(2024, 1, 1)), ("B", d(2025, 1, 1)), ("D", d(2024, 1, 1)), ("D", d(2024, 1, 1))], "ticker string, date date")
    c = quality.check_prices(u, p, F.lit(d(2024, 6, 1)))
    assert rows(c, "entity", "status", "detail") == [("A", "ok", ""), ("B", "failed", "future_date"), ("C", "failed", "empty"), ("D", "failed", "duplicate_date")]
    assert not quality.passes(c) and quality.passes(c.where("entity = 'A'"))
    steps = spark.createDataFrame([("kr", "ok"), ("us", "failed")], "step_group string, status string")
    assert quality.roll_up(steps).first()["status"] == "degraded"
