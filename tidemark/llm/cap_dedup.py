"""Embedding near-dedup by spherical-cap filters: product codes list-decode each vector to the directions it exceeds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import connected_components, keep, table, with_least

THRESHOLD = 0.93
#: Wanted members of a filter and label, largest share of all vectors in a filter, members compared in one block.
BUCKET, MOST_SHARE, BLOCK = 500, 0.1, 2048
#: Pairs at the threshold that are simulated for a code's miss rate, and the miss rate allowed for all codes together.
TRIALS, MISS = 4000, 1e-5


@dataclass(frozen=True)
class Code:
    """Filters c1 x c2 over two halves of a rotated vector; a vector joins those with (x1.c1 + x2.c2)/sqrt(2) >= alpha."""

    rotation: np.ndarray
    left: np.ndarray
    right: np.ndarray
    alpha: float

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y, h = x @ self.rotation, self.left.shape[1]
        return y[:, :h] @ self.left.T, y[:, h:] @ self.right.T

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """Filters of each unit vector: for each left word only the right words that can still reach alpha."""
        a, b = self.halves(x)
        order = np.argsort(-b, axis=1)
        ranked, width, out = -np.take_along_axis(b, order, axis=1), b.shape[1], []
        for i in range(len(x)):
            n = np.searchsorted(ranked[i], a[i] - self.alpha * np.sqrt(2.0), side="right")
            ids = [k * width + order[i, : n[k]] for k in np.flatnonzero(n)]
            out.append(np.concatenate(ids) if ids else np.zeros(0, np.int64))
        return out


@dataclass(frozen=True)
class Caps:
    """Independent codes; a filter's number counts through all of them."""

    codes: tuple[Code, ...]

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        size = self.codes[0].left.shape[0] * self.codes[0].right.shape[0]
        found = [c.decode(x) for c in self.codes]
        return [np.sort(np.concatenate([f[i] + k * size for k, f in enumerate(found)])).astype(np.int64) for i in range(len(x))]


def _units(rng: np.random.Generator, n: int, dim: int) -> np.ndarray:
    x = rng.standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _code(rng: np.random.Generator, size: int, dim: int, alpha: float) -> Code:
    h = (dim + 1) // 2
    return Code(np.linalg.qr(rng.standard_normal((dim, dim)))[0], _units(rng, size, h), _units(rng, size, dim - h), alpha)


@dataclass(frozen=True)
class Plan:
    """What the filters are made from: workers draw the codes from the seed, so that no code is sent to them."""

    dim: int
    size: int
    codes: int
    alpha: float
    seed: int

    def caps(self) -> Caps:
        if self not in _CAPS:
            rng = np.random.default_rng([self.seed, self.dim])
            _CAPS[self] = Caps(tuple(_code(rng, self.size, self.dim, self.alpha) for _ in range(self.codes)))
        return _CAPS[self]

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        return self.caps().decode(x)


_CAPS: dict[Plan, Caps] = {}


def plan_caps(most_in_label: int, dim: int, threshold: float = THRESHOLD, seed: int = 7) -> Plan:
    """Choose the caps' height from the number of vectors, then words in a code and codes from simulated pairs.

    Higher caps for more vectors keep filters near BUCKET members. Rotations make codes independent for any fixed
    pair, so k codes miss a pair at the threshold with the k-th power of one code's rate; of the sizes that reach
    MISS the one with the least work for a vector is taken.
    """
    rng = np.random.default_rng(seed)
    dim = max(dim, 2)
    share = min(MOST_SHARE, BUCKET / max(most_in_label, 1))
    base = _code(rng, 200, dim, 0.0)
    probe = _units(rng, 20_000, dim)
    a, b = base.halves(probe)
    alpha = float(np.quantile((a + b[:, rng.permutation(b.shape[1])]) / np.sqrt(2.0), 1 - share))
    x, z = _units(rng, TRIALS, dim), _units(rng, TRIALS, dim)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * z
    best, worse = (np.inf, 0, 0), 0
    for size in (4, 6, 8, 11, 16, 22, 32, 45, 64, 90, 128, 180, 256, 360, 512):
        code = _code(rng, size, dim, alpha)
        sides = [code.halves(v) for v in (x, y)]
        missed, step = 0, max(1, 2_000_000 // size**2)
        for lo in range(0, TRIALS, step):
            on = [p[lo : lo + step, :, None] + q[lo : lo + step, None, :] >= alpha * np.sqrt(2.0) for p, q in sides]
            missed += int((~(on[0] & on[1]).any(axis=(1, 2))).sum())
        rate = (missed + 1) / (TRIALS + 1)
        if rate >= 0.98:
            continue
        codes = int(np.ceil(np.log(MISS) / np.log(rate)))
        cost = codes * (size**2 * share + 1)  # filters of a vector, and a rotation counted like one
        if cost < best[0]:
            best, worse = (cost, size, codes), 0
        else:
            worse += 1
            if worse == 3:
                break
    if not best[2]:
        raise ValueError(f"no code finds pairs at cosine {threshold} among {most_in_label} vectors of {dim} numbers")
    return Plan(dim, best[1], best[2], alpha, seed)


def vec_type(vectors: DataFrame) -> np.dtype:
    """Single precision is carried as it is; cosines are always computed in double precision."""
    return np.dtype("<f4") if dict(vectors.dtypes)["embedding"] == "array<float>" else np.dtype("<f8")


def prepare(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, digest and the vector's bytes; the last three are null for vectors that link with nothing."""
    kind = vec_type(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, digests, blobs = [], [], []
            for v, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x = None if not v or label is None or None in v else np.array(v, kind) + kind.type(0)
                if x is None or not np.isfinite(x).all() or not x.any():
                    dims, digests, blobs = [*dims, None], [*digests, None], [*blobs, None]
                    continue
                blob = x.tobytes()
                dims.append(len(x))
                digests.append(xxhash.xxh3_128_digest(blob))
                blobs.append(blob)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(blobs, pa.binary())], ["vec_id", "label", "dim", "digest", "vec"])

    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"), F.col("label").cast("bigint"))
    return rows.mapInArrow(run, "vec_id bigint, label bigint, dim int, digest binary, vec binary")


def _first_shared(f: int, a: list[np.ndarray], b: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Pairs (p, q) whose least common filter is ``f``, so that each pair counts in one filter only."""
    ea, eb = ([x[x < f] for x in s] for s in (a, b))
    if len(p) <= 50_000:
        sa, sb = {i: set(ea[i].tolist()) for i in set(p.tolist())}, {i: eb[i].tolist() for i in set(q.tolist())}
        return np.fromiter((sa[i].isdisjoint(sb[j]) for i, j in zip(p.tolist(), q.tolist(), strict=True)), bool, len(p))
    names = np.unique(np.concatenate([*ea, *eb]))
    shared = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, len(names), 512):
        part = names[lo : lo + 512]
        on = [np.stack([np.isin(part, x, assume_unique=True) for x in s]).astype(np.float32) for s in (ea, eb)]
        shared += on[0] @ on[1].T
    return shared[p, q] == 0


def _roots(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Least index of each node's component."""
    lab = np.arange(n)
    while True:
        new = lab.copy()
        np.minimum.at(new, p, lab[q])
        np.minimum.at(new, q, lab[p])
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def block_links(members: DataFrame, threshold: float, kind: np.dtype) -> DataFrame:
    """Per block of a filter: (id, links, root), where links counts copies of the partners found here for the first time.

    Blocks compare by one matrix product and return a row per linked member, never the pairs.
    """

    def run(key: tuple, t: pa.Table) -> pa.Table:
        f, i, j = key[0].as_py(), key[3].as_py(), key[4].as_py()
        chunk, ids, cnt = (t.column(c).to_numpy() for c in ("chunk", "id", "cnt"))
        x = np.frombuffer(b"".join(t.column("vec").to_pylist()), kind).reshape(len(ids), -1).astype(np.float64)
        norm = np.sqrt((x * x).sum(1))
        lists = [np.frombuffer(b, np.int32) for b in t.column("filters").to_pylist()]
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        cos = (x[left] @ x[right].T) / (norm[left, None] * norm[None, right])
        hit = cos >= threshold
        if i == j:
            hit = np.triu(hit, 1)
        p, q = np.nonzero(hit)
        ok = _first_shared(f, [lists[k] for k in left], [lists[k] for k in right], p, q) if len(p) else np.zeros(0, bool)
        p, q = left[p[ok]], right[q[ok]]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, p, cnt[q])
        np.add.at(links, q, cnt[p])
        rank = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[rank] = np.arange(len(ids))
        root = ids[rank[_roots(len(ids), place[p], place[q])]][place] if len(p) else ids
        some = links > 0
        return pa.table({"id": pa.array(ids[some], pa.int64()), "links": pa.array(links[some]), "root": pa.array(root[some], pa.int64())})

    return members.groupBy("filter", "label", "dim", "i", "j").applyInArrow(run, "id bigint, links bigint, root bigint")


def filter_rows(classes: DataFrame, plans: dict[int, Plan], kind: np.dtype) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "label", "dim", "cnt", "vec"]
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                dims = part.column(2).to_numpy()
                found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(dims)
                for d in set(dims.tolist()):
                    rows = np.flatnonzero(dims == d)
                    x = np.frombuffer(b"".join(part.column(4).take(pa.array(rows)).to_pylist()), kind).reshape(len(rows), d).astype(np.float64)
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x = x / np.linalg.norm(x, axis=1, keepdims=True)
                    for r, ids in zip(rows, plans[d].decode(np.pad(x, ((0, 0), (0, max(0, 2 - d))))), strict=True):
                        found[r] = ids
                n = np.array([len(x) for x in found])
                at = pa.array(np.repeat(np.arange(len(n)), n))
                lists = pa.array([x.astype(np.int32).tobytes() for x in found], pa.binary())
                yield pa.record_batch([pa.array(np.concatenate(found), pa.int64()), *(part.column(k).take(at) for k in range(5)), lists.take(at)], ["filter", *names, "filters"])

    return classes.select("id", "label", "dim", "cnt", "vec").mapInArrow(run, "filter bigint, id bigint, label bigint, dim int, cnt bigint, vec binary, filters binary")


def cap_dedup(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of equal label and length link when their cosine in double precision is ``threshold`` or more. Equal
    vectors form a class; its copies are counted, not compared. Two vectors meet in each filter that both exceed; the
    number of filters is set so that a pair at the threshold is missed with a chance of 1e-5 (nearer pairs less still). Null, empty, zero and non-finite vectors, null labels and null vec_ids link with nothing; rows that
    repeat a vec_id are vectors of their own under one id, each with its own links; ties do not arise, as a component's
    name is its smallest vec_id; vectors of any length are compared whole; an empty table gives no rows; other columns
    are ignored.
    """
    rows = keep(prepare(vectors), "cap-vectors")
    good = rows.where("digest is not null and vec_id is not null")
    classes = good.groupBy("label", "dim", "digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("cnt"), F.first("vec").alias("vec"))
    # numbers of their own, as different vectors may share a vec_id
    classes = keep(classes.withColumn("id", F.monotonically_increasing_id()), "cap-classes")
    # one number per vector length
    sizes = classes.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("n")).collect()
    plans = {r["dim"]: plan_caps(r["n"], r["dim"], threshold) for r in sizes}
    members = filter_rows(classes, plans, vec_type(vectors))
    g_of = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    members = keep(members, "cap-members")
    large = members.groupBy("filter", "label", "dim").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK).select("filter", "label", "dim", g_of.alias("g"))
    split = members.join(large, ["filter", "label", "dim"], "left").withColumn("g", F.coalesce("g", F.lit(1)))
    split = split.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("g").cast("bigint")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    blocks = split.select("filter", "label", "dim", F.least("chunk", "o").alias("i"), F.greatest("chunk", "o").alias("j"), "chunk", "id", "cnt", "vec", "filters")
    found = keep(block_links(blocks, threshold, vec_type(vectors)), "cap-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comps = connected_components(found.select(F.col("root").alias("a"), F.col("id").alias("b")), "cap-components")
    named = classes.select("label", "dim", "digest", "id", "least", "cnt").join(links, "id", "left").join(with_least(comps, classes), "id", "left")
    named = named.select("label", "dim", "digest", (F.coalesce("links", F.lit(0)) + F.col("cnt") - 1).alias("n_links"), F.coalesce("component", "least").alias("component"))
    out = rows.drop("vec").join(named, ["label", "dim", "digest"], "left")
    own = F.col("vec_id").isNotNull()
    component = F.when(own, F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(own, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_dedup(table(spark, sf_dir, "embeddings"))


#: The exact self-join within labels, feasible at the checked size.
_ORACLE = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(id, c) AS (SELECT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
m AS (SELECT id, min(c) AS c FROM r GROUP BY 1), n AS (SELECT a AS id, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(m.c, vec_id) AS component_id, coalesce(m.c, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN m ON m.id = vec_id LEFT JOIN n ON n.id = vec_id"""

QUERIES = {"op2_cap_dedup": query}
SQL = {"op2_cap_dedup": _ORACLE}
