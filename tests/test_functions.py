import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import numbers as N
from tidemark.functions import text as T
from tidemark.functions.hashing import counts_json, md5_seed, short_sha256

d = dt.date


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()) or ["id"])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("1,234,567", 1234.6), ("(2,500)", -2.5), ("-", None), ("N/A", None), ("", None), (" 12 345 ", 12.3), ("abc", None), ("nan", None), ("None", None)],
)
def test_parse_amount(spark, raw, want):
    assert one(spark, N.parse_amount(F.col("c")), c=raw) == want


def test_parse_eps_and_floor(spark):
    assert one(spark, N.parse_eps(F.col("c")), c="(1,234.567)") == -1234.57
    assert one(spark, N.coverage_floor(F.col("c")), c=7) == 3


def test_zero_is_missing(spark):
    rows = spark.createDataFrame([(0.0,), (None,), (1.0,)], "c double").select(N.truthy(F.col("c")).alias("t")).collect()
    assert [r.t for r in rows] == [False, False, True]


@pytest.mark.parametrize(("day", "first", "last"), [(d(2024, 6, 10), d(2024, 6, 3), d(2024, 6, 28)), (d(2024, 2, 1), d(2024, 2, 1), d(2024, 2, 29)), (d(2023, 12, 31), d(2023, 12, 1), d(2023, 12, 29))])
def test_business_days(spark, day, first, last):
    assert one(spark, D.first_business_day(F.col("c")), c=day) == first
    assert one(spark, D.last_business_day(F.col("c")), c=day) == last


@pytest.mark.parametrize(("day", "want"), [(d(2024, 6, 10), d(2024, 6, 7)), (d(2024, 6, 9), d(2024, 6, 7)), (d(2024, 6, 8), d(2024, 6, 7)), (d(2024, 6, 7), d(2024, 6, 6))])
def test_previous_business_day(spark, day, want):
    assert one(spark, D.previous_business_day(F.col("c")), c=day) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("2026.03.11 09:15", d(2026, 3, 11)), ("03/10", d(2026, 3, 10)), ("12/31", d(2025, 12, 31)), ("5분전", d(2026, 3, 12)), ("3시간전", d(2026, 3, 12)), ("2일전", d(2026, 3, 10)), ("2026.02.30", None), ("02/30", None), ("", None), ("soon", None)],
)
def test_headline_dates(spark, raw, want):
    assert one(spark, D.parse_headline_date(F.col("c"), F.lit(d(2026, 3, 12))), c=raw) == want


@pytest.mark.parametrize(("token", "period", "want"), [("20240229", "D", d(2024, 2, 29)), ("20230229", "D", None), ("202413", "M", None), ("202402", "M", d(2024, 2, 1)), ("2024Q3", "Q", d(2024, 7, 1)), ("2024Q5", "Q", None), ("2024", "A", d(2024, 1, 1)), ("x", "A", None)])
def test_periods(spark, token, period, want):
    assert one(spark, D.parse_period(F.col("t"), F.col("p")), t=token, p=period) == want


def test_days_and_epoch(spark):
    assert one(spark, F.size(D.days(F.lit(d(2024, 1, 1)), F.lit(d(2024, 1, 3))))) == 3
    assert one(spark, F.size(D.days(F.lit(d(2024, 1, 4)), F.lit(d(2024, 1, 3))))) == 0
    assert one(spark, D.parse_epoch_or_iso(F.lit(None).cast("bigint"), F.lit("bad"), F.lit(d(2024, 1, 1)))) == d(2024, 1, 1)
    assert one(spark, D.parse_yyyymmdd(F.lit("20240230"))) is None


@pytest.mark.parametrize(("raw", "want"), [("5930", "005930"), ("A005930", "005930"), ("ABC", "ABC"), ("1234567", "1234567"), ("", "")])
def test_tickers(spark, raw, want):
    assert one(spark, T.normalize_ticker(F.col("c")), c=raw) == want


def test_report_period(spark):
    p = one(spark, T.report_period(F.lit("사업보고서 (2024.12)")))
    assert (p.year, p.code) == ("2024", "11011")
    assert one(spark, T.report_period(F.lit("보고서 (2024.11)"))) is None
    assert one(spark, T.report_period(F.lit("보고서"))) is None


def test_small_texts(spark):
    assert one(spark, T.multiplier(F.lit("12.5X"))) == 12.5
    assert one(spark, T.multiplier(F.lit("none"))) is None
    for raw, want in {"x: Has No Data": "invalid symbol or no data", "a status=400 LOGOUT": "status=400 LOGOUT", "src: late : reply": "late : reply", " plain ": "plain"}.items():
        assert one(spark, T.failure_reason(F.col("c")), c=raw) == want
    assert one(spark, T.cache_key(F.lit("m"), F.lit("a"), F.lit(None).cast("string"), F.lit("2024-01"), F.lit("h"))) == "m:a:__MARKET__:2024-01:h"
    assert one(spark, T.filing_url(F.lit("u"), F.lit("000320"), F.lit("00-1-2"), F.lit("d.htm"))) == "u/320/0012/d.htm"
    assert one(spark, T.fill_template("{a} and {b}", {"a": F.lit(1), "b": F.lit("x")})) == "1 and x"


def test_markup(spark):
    raw = "<p>A &amp; B</p>\r<br><br><br>c&nbsp;&nbsp;d"
    assert one(spark, T.markup_to_text(F.lit(raw))) == "A & B\n\nc d"
    assert one(spark, T.html_text(F.lit("<script>x</script><b>A&eacute;</b>&nbsp;z"))) == "Aé\n z"


def test_us_sections_skip_contents():
    body = "x" * 400
    page = f"<p>Item 1. Business</p><p>Item 1A. Risk Factors</p><p>Item 1. Business</p><p>{body}</p><p>Item 1A. Risk Factors</p><p>{body}y</p><p>Item 7. Management's Discussion</p><p>short</p>"
    got = T.page_sections(page)
    assert got["business_overview"] == body
    assert got["risks"] == body + "y"
    assert "mda" not in got
    assert T.page_sections(None) == {}


def test_kr_sections(spark):
    page = "회사의 개요 " + "가" * 70 + " 위험 요소 짧음 MD&A " + "나" * 9000
    got = one(spark, T.kr_sections(F.lit(page)))
    assert got == {"business_overview": "가" * 70, "mda": "나" * 7999}
    assert one(spark, T.kr_sections(F.lit("nothing"))) == {}


def test_hashes(spark):
    import hashlib
    import json

    want = json.dumps({"a": 1, "b": 2})
    kv = F.array(F.struct(F.lit("b").alias("key"), F.lit(2).alias("value")), F.struct(F.lit("a").alias("key"), F.lit(1).alias("value")))
    assert one(spark, counts_json(kv)) == want
    assert one(spark, short_sha256(counts_json(kv))) == hashlib.sha256(want.encode()).hexdigest()[:16]
    assert one(spark, md5_seed(F.lit("AAPL"))) == int(hashlib.md5(b"AAPL").hexdigest()[:8], 16) % 2**31
