"""Writers: dated partitions, snapshots as JSON, manifests, catalogs by day, resumable batches, a key-value cache."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality


def write_partitions(df: DataFrame, path: str, by: Sequence[str], sort: str) -> None:
    """One folder per combination of ``by``, rows sorted; only the combinations that ``df`` has are replaced.

    Rows are spread by the partition columns and a hash of the sort key, so a large partition is written by several tasks.
    """
    spread = df.repartition(*by, F.pmod(F.xxhash64(sort), F.lit(4)))
    spread.sortWithinPartitions(*by, sort).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_stamped(df: DataFrame, path: str) -> bool:
    """Parquet with the time of collection; nothing is written for an empty table."""
    if df.limit(1).count() == 0:
        return False
    df.withColumn("collected_at", F.current_timestamp()).write.mode("overwrite").parquet(path)
    return True


def snapshot_json(df: DataFrame) -> DataFrame:
    """Each row as JSON with sorted keys; null fields and empty arrays are left out."""
    cols = sorted(df.columns)
    slim = [F.when(F.size(c) > 0, F.col(c)).alias(c) if kind.startswith("array") else F.col(c) for c in cols for kind in [dict(df.dtypes)[c]]]
    return df.select(F.to_json(F.struct(*slim)).alias("value"))


def write_snapshot(df: DataFrame, path: str) -> None:
    """Snapshot lines, compressed, by decision date where there is one."""
    body = snapshot_json(df)
    body.write.mode("overwrite").option("compression", "gzip").text(path)


def write_snapshot_metadata(df: DataFrame, path: str, as_of: str) -> None:
    """What a snapshot holds, beside it: its date, rows, and a hash of its sorted lines."""
    body = snapshot_json(df)
    digest = F.md5(F.array_join(F.array_sort(F.collect_list(F.md5(F.col("value").cast("binary")))), "").cast("binary"))  # a universe's worth of hashes
    body.agg(F.lit(as_of).alias("as_of"), F.count("*").alias("rows"), digest.alias("content")).coalesce(1).write.mode("overwrite").json(path)


def bundle(universe: DataFrame, quarters: DataFrame, prices: DataFrame, macro: DataFrame, fields: Sequence[str], version: str, status: Column) -> DataFrame:
    """A bundle's manifest and summary: version, status, sizes, field coverage, warnings, bars per ticker and keys per macro category.

    Counts per ticker are a map, so a bundle is for a universe of thousands of tickers, not millions.
    """
    per_ticker = prices.groupBy("ticker").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("ticker").cast("string"), "n")))).alias("bars_by_ticker"))
    keys = macro.groupBy("category").agg(F.count_distinct("key").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("macro_keys"))
    row = manifest(quarters, prices, universe, fields).crossJoin(per_ticker).crossJoin(keys)  # single rows
    return row.select(F.lit(version).alias("bundle_version"), status.alias("status"), "*")


def write_report(row: DataFrame, path: str) -> None:
    """A single JSON object, such as a manifest, a summary or a run's report."""
    row.limit(1).coalesce(1).write.mode("overwrite").json(path)


def write_dated_frame(df: DataFrame, path: str, names: dict[str, str], as_of: Column) -> None:
    """Index and sector tables: columns renamed and the date of the request stamped on."""
    df.withColumnsRenamed(names).withColumn("as_of", as_of).write.mode("overwrite").parquet(path)


def checkpoint_due(done: Column, seconds: Column, total: Column, every: int = 25, most_seconds: int = 300) -> Column:
    """Why a run's state is written now: the work is over, enough items are done, or enough time has passed; else null."""
    return F.when(done >= total, "end").when((done > 0) & (done % every == 0), "count").when(seconds >= most_seconds, "time")


def manifest(quarters: DataFrame, prices: DataFrame, universe: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: sizes, field coverage and the fields that nobody has."""
    size = universe.agg(F.count("*").alias("universe"))
    bars = prices.agg(F.count_distinct("ticker").alias("with_prices"), F.count("*").alias("bars"))
    cover = quality.field_coverage(quarters, fields)
    row = size.crossJoin(bars).crossJoin(cover)  # three single rows
    absent = F.filter(F.array(*(F.when(F.col(f) == 0, F.lit(f)) for f in fields)), lambda x: x.isNotNull())
    return row.withColumn("warnings", F.transform(absent, lambda f: F.concat(F.lit("no ticker has "), f)))


def write_catalog_days(entries: DataFrame, path: str, by: Sequence[str] = ("day", "ticker")) -> None:
    """Day files of the news catalog, in a folder per day and ticker or per day; days that are written again are replaced, others stay."""
    entries.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy(*by).json(path)


def write_catalog_meta(meta: DataFrame, path: str) -> None:
    """The state of every captured day beside the entries, one JSON line each; days that are written again are replaced."""
    meta.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").json(path)


def write_universe_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """A single CSV file in rank order; a universe has few rows."""
    df.select(*columns).orderBy(columns[0]).coalesce(1).write.mode("overwrite").csv(path, header=True)


def remaining(wanted: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work that is still to be done: resumption and skip-if-present are the same anti join."""
    return wanted.join(done.select(*keys).distinct(), list(keys), "left_anti")


def resume_cursor(wanted: DataFrame, done: DataFrame, group: Sequence[str], item: str) -> DataFrame:
    """Per group: how many items are done and the next one in order; null when none is left."""
    marked = wanted.select(*group, item).join(done.select(*group, item).distinct().withColumn("_done", F.lit(True)), [*group, item], "left")
    return marked.groupBy(*group).agg(F.count("_done").alias("done"), F.min(F.when(F.col("_done").isNull(), F.col(item))).alias("next"))


def append_batch(df: DataFrame, path: str, batch: int) -> None:
    """A batch under its number; writing it again replaces it."""
    df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def merge_batches(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after all batches: a later batch's row replaces an earlier one's."""
    rest = [c for c in df.columns if c not in {*keys, "batch"}]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_s"))
    return last.select(*keys, *(F.col(f"_s.{c}").alias(c) for c in rest))


def cache_put(store: DataFrame, new: DataFrame) -> DataFrame:
    """Insert if absent: what the store has stays."""
    return store.unionByName(new.join(store.select("key"), "key", "left_anti"))


def cache_invalidate(store: DataFrame, part: str) -> DataFrame:
    return store.where(~F.col("key").contains(part))
