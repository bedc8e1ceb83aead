"""Calendar rules: weekday-only business days, period tokens, dates in headlines. The date of interest is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_business_day(d: Column) -> Column:
    """Last weekday of the month of ``d``; there is no holiday calendar."""
    end = F.last_day(d)
    return F.date_sub(end, F.greatest(F.weekday(end) - 4, F.lit(0)))


def first_business_day(d: Column) -> Column:
    start = F.trunc(d, "MM")
    return F.date_add(start, F.when(F.weekday(start) >= 5, 7 - F.weekday(start)).otherwise(0))


def next_month(d: Column) -> Column:
    return F.add_months(F.trunc(d, "MM"), 1).cast("date")


def previous_business_day(d: Column) -> Column:
    """Last weekday strictly before ``d``."""
    back = F.when(F.weekday(d) == 0, 3).when(F.weekday(d) == 6, 2).otherwise(1)
    return F.date_sub(d, back)


def months_between_inclusive(first: Column, last: Column) -> Column:
    """First days of all months from one to the other."""
    return F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))


def is_month_end_build(as_of: Column) -> Column:
    return as_of == last_business_day(as_of)


def fiscal_quarter(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def parse_yyyymmdd(c: Column) -> Column:
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))


def _ymd(y: Column, m: Column, d: Column) -> Column:
    """A date from numbers; null when there is no such day."""
    return F.try_to_timestamp(F.format_string("%04d%02d%02d", y, m, d), F.lit("yyyyMMdd")).cast("date")


def parse_period(token: Column, period: Column) -> Column:
    """First day of a period token: D yyyyMMdd, M yyyyMM, Q yyyyQn, A yyyy; null when malformed."""
    t = F.trim(token)
    part = lambda a, n: F.substring(t, a, n).try_cast("int")
    one = F.lit(1)
    return (
        F.when((period == "D") & t.rlike(r"^\d{8}$"), _ymd(part(1, 4), part(5, 2), part(7, 2)))
        .when((period == "M") & t.rlike(r"^\d{6}$"), _ymd(part(1, 4), part(5, 2), one))
        .when((period == "Q") & t.rlike(r"^\d{4}Q[1-4]$"), _ymd(part(1, 4), part(6, 1) * 3 - 2, one))
        .when((period == "A") & t.rlike(r"^\d{4}$"), _ymd(part(1, 4), one, one))
    )


def period_start_token(as_of: Column, period: Column) -> Column:
    """Where the history of a series begins: 730 days, 4, 6 or 10 years back."""
    y = F.year(as_of)
    return (
        F.when(period == "D", F.date_format(F.date_sub(as_of, 730), "yyyyMMdd"))
        .when(period == "M", F.concat((y - 4).cast("string"), F.lit("01")))
        .when(period == "Q", F.concat((y - 6).cast("string"), F.lit("Q1")))
        .when(period == "A", (y - 10).cast("string"))
    )


def period_end_token(as_of: Column, period: Column) -> Column:
    return (
        F.when(period == "D", F.date_format(as_of, "yyyyMMdd"))
        .when(period == "M", F.date_format(as_of, "yyyyMM"))
        .when(period == "Q", fiscal_quarter(as_of))
        .when(period == "A", F.year(as_of).cast("string"))
    )


def period_slot(d: Column, period: Column) -> Column:
    """What must agree a year apart: the month, the quarter, or nothing (0); null for daily series."""
    return F.when(period == "M", F.month(d)).when(period == "Q", F.quarter(d)).when(period == "A", F.lit(0))


def parse_headline_date(c: Column, as_of: Column) -> Column:
    """``YYYY.MM.DD[ HH:MM]``, ``MM/DD`` (rolled back a year if after ``as_of``), or minutes, hours, days ago."""
    t = F.trim(c)
    num = lambda p, g: F.regexp_extract(t, p, g).try_cast("int")
    full, short = r"^(\d{4})\.(\d{2})\.(\d{2})", r"^(\d{1,2})/(\d{1,2})"
    m, d = num(short, 1), num(short, 2)
    this = _ymd(F.year(as_of), m, d)
    return (
        F.when(t.rlike(full), _ymd(num(full, 1), num(full, 2), num(full, 3)))
        .when(t.rlike(short), F.when(this > as_of, _ymd(F.year(as_of) - 1, m, d)).otherwise(this))
        .when(t.rlike(r"\d+분전"), as_of)
        .when(t.rlike(r"\d+시간전"), as_of)
        .when(t.rlike(r"\d+일전"), F.date_sub(as_of, num(r"(\d+)일전", 1)))
    )


def parse_headline_time(c: Column, as_of: Column) -> Column:
    """The same as a timestamp: the stated HH:MM, else midnight."""
    day = parse_headline_date(c, as_of)
    clock = F.regexp_extract(F.trim(c), r"^\d{4}\.\d{2}\.\d{2}\s+(\d{2}:\d{2})", 1)
    return F.try_to_timestamp(F.concat(day.cast("string"), F.lit(" "), F.when(clock != "", clock).otherwise("00:00")), F.lit("yyyy-MM-dd HH:mm"))


def parse_epoch_or_iso(epoch: Column, iso: Column, as_of: Column) -> Column:
    """UTC date of an epoch in seconds, else of an ISO text, else ``as_of``."""
    return F.coalesce(F.timestamp_seconds(epoch).cast("date"), F.try_to_timestamp(iso).cast("date"), as_of)


def days(first: Column, last: Column) -> Column:
    """Every day of an inclusive span; no days when it is reversed."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
