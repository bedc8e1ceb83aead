"""Number rules: zero as missing, rounding, amounts in text. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for no value.
NO_VALUE = ["", "-", "N/A", "nan", "None"]


def truthy(c: Column) -> Column:
    """Neither null nor zero: several measures count 0 as unavailable."""
    return c.isNotNull() & (c != 0)


def or_missing(c: Column) -> Column:
    return F.when(truthy(c), c)


def round_half_up(c: Column, digits: int = 0) -> Column:
    """floor(x * 10^k + 0.5) / 10^k, which every engine computes alike."""
    k = float(10**digits)
    return F.floor(c * F.lit(k) + F.lit(0.5)).cast("double") / F.lit(k)


def safe_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def parse_number(c: Column, parentheses: bool = False) -> Column:
    """A number in text; commas and blanks go; with ``parentheses`` ``(x)`` is negative. Null when it is none."""
    text = F.trim(c.cast("string"))
    bare = F.regexp_replace(text, "[, ]", "")
    if not parentheses:
        value = bare.try_cast("double")
    else:
        inner = F.regexp_extract(bare, r"^\((.*)\)$", 1)
        value = F.when(bare.rlike(r"^\(.*\)$"), -inner.try_cast("double")).otherwise(bare.try_cast("double"))
    return F.when(text.isin(NO_VALUE), F.lit(None).cast("double")).otherwise(nan_to_null(value))


def parse_amount(c: Column, unit_scale: float = 1000.0, digits: int = 1) -> Column:
    """A statement amount in millions when the text counts in thousands (``unit_scale`` 1000)."""
    return round_half_up(parse_number(c, parentheses=True) / F.lit(unit_scale), digits)


def parse_eps(c: Column) -> Column:
    return round_half_up(parse_number(c, parentheses=True), 2)


def coverage_floor(n: Column, share: float = 0.5) -> Column:
    """The least number of covered names that still counts as complete."""
    return F.floor(n * F.lit(share)).cast("bigint")
