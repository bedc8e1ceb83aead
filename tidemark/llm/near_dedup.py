"""MinHash near-dedup by SetSketch registers: band them, estimate jointly by likelihood, confirm on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import connected_components, give_back, keep, small_or_plain, table, with_least

WORDS, SIMILARITY = 5, 0.75
#: Registers, their base and largest value; registers in a band; estimates below CUT are no candidates.
#: With this base two disjoint sets of equal size agree in a register with a chance of 0.0013, in a band of 3e-12, so
#: that strangers do not meet in buckets up to 10^10 documents; a pair at 0.75 shares no band with a chance of 5e-6.
REGISTERS, BASE, TOP, BAND, CUT = 128, 1.005, (1 << 16) - 2, 4, 0.58
_REGISTER = np.dtype("<u2")
#: Members of a cluster that are compared in one block.
BLOCK = 2048

_RNG = np.random.default_rng(20240615)
_MUL = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: bytes | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; bytes.lower() and .split() are the word definition."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - size + 1
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = (h ^ w[i : i + n]) * _STEP[i % len(_STEP)]
        h ^= h >> np.uint64(29)
    return np.unique(_mix(h))


def sketch(items: np.ndarray) -> np.ndarray:
    """SetSketch registers: floor(1 - log_base of the least exponential value), cut to 0..TOP+1; unions take the maximum.

    The values' rate (16) keeps the registers of even a single item above 0, where cut values would agree by chance.
    """
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(items), 256):
        least = np.minimum(least, (items[lo : lo + 256, None] * _MUL + _ADD).min(axis=0))
    u = (least.astype(np.float64) + 1.0) / 2.0**64
    value = -np.log1p(-np.minimum(u, 1 - 1e-16))
    return np.clip(np.floor(1 - np.log(value / 16.0) / np.log(BASE)), 0, TOP + 1).astype(_REGISTER)


def likely(more: np.ndarray, less: np.ndarray, same: np.ndarray, n1: np.ndarray, n2: np.ndarray, at: float = CUT) -> np.ndarray:
    """Whether the joint maximum-likelihood estimate of the Jaccard similarity is ``at`` or more.

    Registers compare as >, < and = with chances p(u-vJ), p(v-uJ) and the rest, where u and v are the sets' shares of
    the summed sizes and p(x) = -log_b(1 - x(b-1)/b). The likelihood is concave in J: its slope at ``at`` tells the side.
    """
    u = n1 / (n1 + n2)
    v = 1 - u
    r = (BASE - 1) / BASE
    x, y = np.maximum(u - v * at, 1e-9), np.maximum(v - u * at, 1e-9)
    p, q = -np.log1p(-x * r) / np.log(BASE), -np.log1p(-y * r) / np.log(BASE)
    dp, dq = -v * r / (1 - x * r) / np.log(BASE), -u * r / (1 - y * r) / np.log(BASE)
    slope = more * dp / p + less * dq / q - same * (dp + dq) / np.maximum(1 - p - q, 1e-9)
    return (slope >= 0) & (np.minimum(n1, n2) >= at * np.maximum(n1, n2))


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: a hash of its text, the size of its shingle set, a 128-bit digest of the set, and its registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                sizes, digests, regs = [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle_set(text)
                    sizes.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    regs.append(sketch(s).tobytes() if len(s) else None)
                yield pa.record_batch([part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "text_key", "n", "digest", "regs"])
        give_back()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"), text_key().alias("text_key")).mapInArrow(run, "doc_id bigint, text_key bigint, n bigint, digest binary, regs binary")


def text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def shingle_sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                yield pa.record_batch([part.column(0), pa.array([shingle_set(t).tobytes() for t in part.column(1).to_pylist()], pa.binary())], ["id", "items"])
        give_back()

    return docs.select("id", F.col("text").cast("binary")).mapInArrow(run, "id bigint, items binary")


def estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose registers make the needed similarity likely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), _REGISTER).reshape(-1, REGISTERS) for i in (4, 5))
            n1, n2 = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 3))
            ok = likely((x > y).sum(1), (x < y).sum(1), (x == y).sum(1), n1, n2)
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

    left = reps.select(F.col("id").alias("a"), F.col("n").alias("n1"), F.col("regs").alias("r1"))
    right = reps.select(F.col("id").alias("b"), F.col("n").alias("n2"), F.col("regs").alias("r2"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "n1", "n2", "r1", "r2")
    return full.mapInArrow(run, "a bigint, b bigint")


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) with their sets' sizes of intersection and union checked in full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ok = []
                for p, q in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    x, y = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= round(100 * SIMILARITY) * (len(x) + len(y) - both))
                yield pa.record_batch([part.column(0), part.column(1), pa.array(ok, pa.bool_())], ["a", "b", "ok"])
        give_back()

    sets = keep(sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), reps, docs), "near-sets")
    left, right = (sets.select(F.col("id").alias(k), F.col("items").alias(f"{k}_items")) for k in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "a_items", "b_items").mapInArrow(run, "a bigint, b bigint, ok boolean")


def sets_of(ids: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Shingle sets of some representatives, each from one text of its class, which id and text hash name."""
    wanted = keep(ids.join(reps.select("id", "rep"), "id").select("id", F.col("rep.doc_id").alias("_tm_doc"), F.col("rep.text_key").alias("_tm_key")), "near-wanted")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"), "text")
    found = texts.join(small_or_plain(wanted), (F.col("doc_id") == F.col("_tm_doc")) & (F.col("text_key") == F.col("_tm_key")))
    return shingle_sets(found.dropDuplicates(["id"]))


def block_links(members: DataFrame) -> DataFrame:
    """Confirmed links between components within blocks; ``members``: cluster, i, j, chunk, id, comp, n, regs, items.

    Likely pairs are checked on their full sets where they are. A link joins its two components in the block, and two
    joined components need no second link, so a block returns fewer links than it has members.
    """

    def run(key: tuple, t: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        ids, comp, n, chunk = (t.column(c).to_numpy() for c in ("id", "comp", "n", "chunk"))
        comp = comp.copy()
        regs = np.frombuffer(b"".join(t.column("regs").to_pylist()), _REGISTER).reshape(-1, REGISTERS)
        sets = [np.frombuffer(b, np.uint64) for b in t.column("items").to_pylist()]
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        out: list[tuple[int, int]] = []
        for k in left:
            far = right[(comp[right] != comp[k]) & ((ids[right] > ids[k]) if i == j else True)]
            if not len(far):
                continue
            x, y = regs[k][None, :], regs[far]
            far = far[likely((x > y).sum(1), (x < y).sum(1), (x == y).sum(1), np.full(len(far), float(n[k])), n[far].astype(float))]
            if not len(far):
                continue
            own, items = sets[k], np.concatenate([sets[m] for m in far])
            at = np.minimum(np.searchsorted(own, items), len(own) - 1)
            both = np.add.reduceat((own[at] == items).astype(np.int64), np.concatenate([[0], np.cumsum(n[far])[:-1]]))
            for m in far[100 * both >= round(100 * SIMILARITY) * (n[k] + n[far] - both)]:
                if comp[m] != comp[k]:
                    out.append((min(ids[k], ids[m]), max(ids[k], ids[m])))
                    comp[comp == comp[m]] = comp[k]
        del regs, sets
        give_back()
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return members.groupBy("cluster", "i", "j").applyInArrow(run, "a bigint, b bigint")


def near_links(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between different texts that give all components.

    Round one pairs every member of a bucket with the bucket's smallest id, as many pairs as members. Round two takes
    the buckets that still hold several components, gathers each chain of such buckets into a cluster, and compares
    a cluster's members in blocks. Members of one component need no further link, so no group of copies is expanded
    into all its pairs, and blocks return links, not candidates.
    """
    width = BAND * _REGISTER.itemsize
    bands = reps.select("id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda i: F.xxhash64(i, F.substring("regs", i * width + 1, F.lit(width))))).alias("key"))
    buckets = keep(bands.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("leader")).where("size > 1"), "near-buckets")
    rows = keep(bands.join(buckets, "key"), "near-rows")
    stars = rows.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    first = keep(confirmed(keep(estimated(stars, reps), "near-pairs"), reps, docs), "near-first")
    links = first.where("ok").select("a", "b")
    comps = connected_components(links, "near-components")

    # a bucket of two is settled by its only pair
    wide = rows.where("size > 2").join(comps, "id", "left").select("key", "leader", "id", F.coalesce("component", "id").alias("comp"))
    # written, so that the join with a very large bucket can be split
    open_ = keep(wide.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key"), "near-unsettled")
    left = keep(wide.join(open_, "key", "left_semi").select("leader", "id", "comp").distinct(), "near-open")
    if left.limit(1).count() == 0:
        return links
    clusters = connected_components(left.select(F.col("leader").alias("a"), F.col("id").alias("b")), "near-clusters").withColumnRenamed("component", "cluster")
    clusters = keep(clusters, "near-clustered")
    g = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size")).select("cluster", g.alias("g"))
    members = clusters.join(sizes, "cluster").join(left.select("id", "comp").distinct(), "id").join(reps.select("id", "n", "regs"), "id").join(sets_of(clusters.select("id"), reps, docs), "id")
    members = members.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("g").cast("bigint")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    blocks = members.select("cluster", F.least("chunk", "o").alias("i"), F.greatest("chunk", "o").alias("j"), "chunk", "id", "comp", "n", "regs", "items")
    return links.union(keep(block_links(blocks), "near-second"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_key (xxhash64 of the text) for every row of ``docs``.

    Documents with equal shingle sets form a class, of which one text takes part in the search. Links are
    pairs with 100 * intersection >= 75 * union; each is confirmed on full sets of 64-bit shingle hashes. Texts that
    are null or without words have no shingles and no links; very long texts are taken whole. Rows with a null doc_id are
    linked with nothing and kept; rows that repeat a doc_id with other texts are documents of their own under one id; ties
    do not arise, as a component's name is its smallest doc_id; an empty table gives no rows; other columns are ignored.
    """
    all_rows = keep(sketches(docs), "near-sketches")
    good = all_rows.where("n > 0 and doc_id is not null")
    classes = good.groupBy("digest").agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), F.max("n").alias("n"), F.first("regs").alias("regs"))
    # numbers of their own, as different sets may share a doc_id
    classes = keep(classes.withColumn("id", F.monotonically_increasing_id()).withColumn("least", F.col("rep.doc_id")), "near-classes")
    # different sets of which one has two items or less reach 2/3 at most
    reps = classes.where("n > 2").select("id", "rep", "n", "regs")
    comps = with_least(connected_components(near_links(reps, docs), "near-components"), classes)
    named = classes.select("digest", "id", "least").join(comps, "id", "left").select("digest", F.coalesce("component", "least").alias("component"))
    out = all_rows.join(named, "digest", "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "text_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).drop("text_key")


#: All pairs with a common shingle, feasible at the checked size.
_ORACLE = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, md5(unnest(sh)) AS h FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(id, c) AS (SELECT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id), m AS (SELECT id, min(c) AS c FROM r GROUP BY 1)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM s LEFT JOIN m ON m.id = doc_id"""

QUERIES = {"op6_near_dedup": query}
SQL = {"op6_near_dedup": _ORACLE}
