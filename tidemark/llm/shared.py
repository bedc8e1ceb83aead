"""What the operators share: tables kept in the cluster's shared folder, bounded broadcasts, components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definition: \x20 and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"

#: A side may be broadcast up to so many rows and bytes of data, both counted.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20
#: Bytes of an Arrow batch in jobs that write working tables.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share; a temporary one only where the session names none and runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId  # a running session takes no new spark.checkpoint.dir
        if app not in _OWN:
            _OWN[app] = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        found = _OWN[app]
    return found.rstrip("/")


#: Temporary folders of sessions in one process that name no shared one.
_OWN: dict[str, str] = {}
#: Paths made inside the open ``scratch`` blocks, innermost last.
_MADE: list[list[str]] = []


def fresh_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    if _MADE:
        _MADE[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table in whatever store it is; nothing happens where there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that operators keep inside the block are deleted at its end; what is needed later must be written elsewhere before.

    Results are lazy and read such tables, so an operator alone cannot tell when they are done with.
    """
    _MADE.append([])
    try:
        yield
    finally:
        for path in _MADE.pop():
            delete(spark, path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_BYTES in the jobs of the block, so that memory outside the heaps does not follow the texts' sizes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def keep(df: DataFrame, what: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, what)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes of data a row holds."""

    def of(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        return F.coalesce(F.size(c), F.lit(0)) * 16 + 8 if kind.startswith(("array", "map")) else F.lit(8)

    return sum((of(*x) for x in df.dtypes), F.lit(0)).cast("bigint")


def small_or_plain(df: DataFrame, most_rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when counts prove that the side is small in rows and bytes; else leave the join to the planner."""
    n, size = df.limit(most_rows + 1).agg(F.count("*"), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if n <= most_rows and size <= most_bytes else df


def give_back() -> None:
    """Buffers of a Python task go back to the system: workers live on, and their heaps would keep what is freed."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def sliced(batches: Iterator, rows: int = 1000) -> Iterator:
    """Arrow batches in slices, so that few texts at a time become Python objects."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text, as an array without empty strings; null counts as empty."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(F.octet_length(inner) == 0, F.array().cast("array<string>")).otherwise(F.split(inner, "[ \\t-\\r]+"))


def connected_components(edges: DataFrame, what: str = "components", most_rounds: int = 60) -> DataFrame:
    """Smallest reachable id for every id in ``edges(a, b)``: returns (id, component).

    Alternates large-star and small-star steps; each round is written to the shared folder. Hubs are safe: minima
    are partial aggregates, and they are written too, so that Spark can split the joins at an id with very many edges.
    """
    a, b = F.col("a"), F.col("b")
    edges = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    cur = keep(edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).distinct(), what)
    state = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
    mark = state(cur)
    for _ in range(most_rounds):
        both = cur.select(F.col("x").alias("u"), F.col("y").alias("v")).union(cur.select("y", "x"))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        low = keep(low.select("u", F.least("u", "low").alias("m")), what)
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("x"), F.col("m").alias("y"))
        large = large.where("x <> y")
        low2 = keep(large.groupBy("x").agg(F.min("y").alias("m")), what)
        small = large.join(low2, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        nxt = keep(small.union(low2.select("x", F.col("m").alias("y"))).distinct(), what)
        now = state(nxt)
        cur = nxt
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("y").alias("id"), F.col("y").alias("component")).distinct()
    return cur.select(F.col("x").alias("id"), F.col("y").alias("component")).union(roots)


def with_least(components: DataFrame, members: DataFrame) -> DataFrame:
    """``components`` of numbered members (id, least) named by the smallest ``least`` among a component's members."""
    own = components.withColumnRenamed("component", "root")
    names = own.join(members.select("id", "least"), "id").groupBy("root").agg(F.min("least").alias("component"))
    return own.join(names, "root").select("id", "component")
