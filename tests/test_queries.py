"""Every query of the engine against its SQL, at the smallest scale."""

import decimal
import math

import pytest

from tests.conftest import SMALL
from tidemark.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    want = duck.sql(SQL[name])
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_sections_of_short_and_long_texts(spark, tmp_path):
    """Every document has a row; only the operators' own gates (60 and 300 characters) leave sections out."""
    sizes = {0: None, 1: 0, 2: 1, 3: 60, 4: 61, 5: 99, 6: 300, 7: 301, 8: 400, 9: 3000, 10: 3001, 11: 7999, 12: 8000, 13: 8001, 14: 200_000}
    word = lambda n: ("abcdefghi " * (n // 10 + 1))[: max(n - 1, 0)] + "z" * (n > 0)
    spark.createDataFrame([(d, None if n is None else word(n)) for d, n in sizes.items()], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name, least, chars, cut in (("filing_sections", 300, "risk_chars", 8000), ("kr_filing_sections", 60, "mda_chars", 7999)):
        got = {r.doc_id: (r.n, r.business_chars, r[chars]) for r in QUERIES[name](spark, str(tmp_path)).collect()}
        gate = lambda n, most: min(n, most) if min(n, most) > least else None  # noqa: E731, B023
        want = {d: (gate(n or 0, 8000), gate(n or 0, cut)) for d, n in sizes.items()}
        assert got == {d: (sum(x is not None for x in w), *w) for d, w in want.items()}


def test_indicators_start_before_the_returned_bars(spark, monkeypatch):
    """The 60 returned bars follow 240 earlier ones: averages are seeded there and no rate of change is missing."""
    from datetime import date, timedelta

    from tidemark.plans import market

    closes = [100.0 + (i * 37 % 101) / 3 for i in range(400)]
    rows = [(1, date(1998, 1, 1) + timedelta(i), c, c + 1, c - 1) for i, c in enumerate(closes)]
    monkeypatch.setattr(market.A, "prices", lambda *_: spark.createDataFrame(rows, "ticker bigint, date date, close double, high double, low double"))
    got = sorted(market.technical_indicator_bars(spark, SMALL).collect(), key=lambda r: r.date)
    assert [r.date for r in got] == [r[1] for r in rows[-60:]]
    fast = slow = closes[100]
    macd = [0.0]
    for c in closes[101:]:
        fast, slow = fast + 2 / 13 * (c - fast), slow + 2 / 27 * (c - slow)
        macd.append(fast - slow)
    for r, m, i in zip(got, macd[-60:], range(340, 400), strict=True):
        assert abs(r.macd - m) < 1e-5 and abs(r.roc_20 - (closes[i] / closes[i - 20] * 100 - 100)) < 1e-5 and r.bb_mid is not None
