"""Content hashes and seeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_sha256(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def counts_json(keys_and_values: Column) -> Column:
    """Key-sorted JSON object of an array<struct<key string, value ...>>, with ", " and ": " between parts."""
    parts = F.transform(F.array_sort(keys_and_values), lambda x: F.concat(F.lit('"'), x["key"], F.lit('": '), x["value"].cast("string")))
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))


def md5_seed(c: Column) -> Column:
    """First eight hex digits of the MD5, below 2^31."""
    return F.pmod(F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(2147483648))
