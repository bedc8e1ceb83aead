"""LM scoring by cross-entropy difference: target and background bigram models over one shared vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import give_back, keep, small_or_plain, table

#: Keys of a text's start and end and of the unknown word (of a vocabulary that was asked to be small).
START, END, UNKNOWN = (xxhash.xxh3_64_intdigest(x, 4) for x in (b"start", b"end", b"unknown"))
#: A bigram's key is its context's key times this, plus its word's, modulo 2^64.
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Weight of the unigram model in a bigram's probability, and the pseudo-count of every word.
BACKOFF, PSEUDO = 20.0, 1.0
#: Bytes of text in a part of the corpus, in a compressed slice of a part, and for which there is one range of keys.
PART_BYTES, SLICE_BYTES, RANGE_BYTES = 6 << 20, 1 << 20, 8 << 20
_COUNTS = ("u1", "<u2", "<u4", "<u8")


def _hashes(text: bytes | None) -> np.ndarray:
    words = (text or b"").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _sequences(texts: list[bytes | None], known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word keys of all texts between a start and an end, whether each is a text's start, and the keys of each text (0 or words + 2)."""
    start, end = (np.array([x], np.uint64) for x in (START, END))
    parts, n = [], []
    for text in texts:
        words = _hashes(text)
        if len(words):
            parts += [start, words, end]
        n.append(len(words) + 2 if len(words) else 0)
    flat, sizes = np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(n, np.int64)
    first = np.zeros(len(flat), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    if known is not None and len(flat):
        inner = ~first
        inner[(np.cumsum(sizes) - 1)[sizes > 0]] = False
        flat[inner & ~np.isin(flat, known)] = UNKNOWN
    return flat, first, sizes


def _pairs(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Keys of the bigrams that end at each key but a text's first."""
    return (flat[:-1] * _STEP + flat[1:])[~first[1:]]


class Tally:
    """Counts by key of what a task has seen, summed up whenever PENDING rows wait; so memory follows distinct keys."""

    PENDING = 1_000_000

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, keys: np.ndarray, target: np.ndarray) -> None:
        names, at = np.unique(keys, return_inverse=True)
        self.parts.append((names, np.bincount(at, minlength=len(names)), np.bincount(at, target, len(names)).astype(np.int64)))
        self.pending += len(names)
        if self.pending > self.PENDING:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.parts) != 1:
            keys, n, good = (np.concatenate([p[k] for p in self.parts] or [np.zeros(0, np.int64)]) for k in range(3))
            names, at = np.unique(keys, return_inverse=True)
            self.parts = [(names, *(np.bincount(at, c, len(names)).astype(np.int64) for c in (n, good)))]
        self.pending = 0
        return self.parts[0]


def word_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every word, and START once a text with words, in the corpus and in the target, summed within tasks and then over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                flat, _, sizes = _sequences(part.column(1).to_pylist(), None)
                target = np.repeat(part.column(2).to_numpy(zero_copy_only=False).astype(float), sizes)
                inner = flat != END
                tally.add(flat[inner], target[inner])
        names, n, good = tally.total()
        for lo in range(0, len(names), 200_000):
            yield pa.record_batch([pa.array(x[lo : lo + 200_000].view(np.int64)) for x in (names.astype(np.uint64), n, good)], ["word", "n", "n_target"])
        give_back()

    counts = docs.select("doc_id", F.col("text").cast("binary"), "is_target").mapInArrow(run, "word bigint, n bigint, n_target bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


def pack_counts(x: np.ndarray) -> bytes:
    """Counts in the narrowest unsigned type that holds them, compressed."""
    kind = int(np.searchsorted([1 << 8, 1 << 16, 1 << 32], int(x.max()) if len(x) else 0, side="right"))
    return zstandard.ZstdCompressor(level=1).compress(bytes([kind]) + x.astype(_COUNTS[kind]).tobytes())


def unpack_counts(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.frombuffer(raw, _COUNTS[raw[0]], offset=1).astype(np.int64)


def pack_keys(x: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of all of them, compressed."""
    planes = np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_keys(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def to_parts(docs: DataFrame) -> DataFrame:
    """The corpus in parts of about PART_BYTES of text, a row each: compressed slices of (doc_id, is_target, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, slices, size = TaskContext.get().partitionId() << 32, [], 0

        def row() -> pa.RecordBatch:
            return pa.record_batch([pa.array([part], pa.int64()), pa.array([size], pa.int64()), pa.array([slices], pa.list_(pa.binary()))], ["part", "n_bytes", "docs"])

        for batch in batches:
            at = np.cumsum([0 if t is None else len(t) for t in batch.column(2).to_pylist()])
            lo = 0
            while lo < batch.num_rows:
                before = int(at[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(at, before + SLICE_BYTES, side="right")))
                hi = min(hi, lo + 10_000)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(batch.slice(lo, hi - lo))
                slices.append(sink.getvalue().to_pybytes())
                size += int(at[hi - 1]) - before
                lo = hi
                if size >= PART_BYTES:
                    yield row()
                    part, slices, size = part + 1, [], 0
        if slices:
            yield row()

    return docs.select("doc_id", "is_target", F.col("text").cast("binary").alias("text")).mapInArrow(run, "part bigint, n_bytes bigint, docs array<binary>")


def _unpacked(slices: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in slices])


def key_counts(parts: DataFrame, ranges: int, known: np.ndarray | None) -> DataFrame:
    """Every part's words (kind 0) and bigrams (kind 1) in ``ranges`` ranges of keys, with counts in the part and in its target texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, part in enumerate(batch.column(0).to_pylist()):
                slices = batch.column(1)[i].as_py()
                tallies = (Tally(), Tally())
                for x in slices:
                    docs = _unpacked([x])
                    flat, first, sizes = _sequences(docs.column("text").to_pylist(), known)
                    target = np.repeat(docs.column("is_target").to_numpy().astype(float), sizes)
                    tallies[0].add(flat, target)
                    tallies[1].add(_pairs(flat, first), target[~first])
                rows: list[tuple] = []
                for kind, tally in enumerate(tallies):
                    names, n, good = tally.total()
                    names = names.astype(np.uint64)
                    of = (names >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
                    edges = np.searchsorted(of, np.arange(ranges + 1, dtype=np.uint64))
                    rows += [(part, kind, r, pack_keys(names[lo:hi]), pack_counts(n[lo:hi]), pack_counts(good[lo:hi])) for r, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if hi > lo]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 6, kinds, strict=True)], ["part", "kind", "range", "keys", "n", "n_target"])
        give_back()

    return parts.select("part", "docs").mapInArrow(run, "part bigint, kind int, range bigint, keys binary, n binary, n_target binary")


def totals(counts: DataFrame) -> DataFrame:
    """Totals over all parts, sent back to each part in the order of its keys; with part -1, a range's words, their sum and their sum in the target."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        kind, keys = key[0].as_py(), [unpack_keys(x) for x in t.column("keys").to_pylist()]
        edges = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
        names, at = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        sums = [np.bincount(at, np.concatenate([unpack_counts(x) for x in t.column(c).to_pylist()]), len(names)).astype(np.int64) for c in ("n", "n_target")]
        back = [[pack_counts(x[at[lo:hi]]) for lo, hi in zip(edges[:-1], edges[1:], strict=True)] for x in sums]
        parts, stats = t.column("part").to_pylist(), [0, 0, 0]
        if kind == 0:
            stats = [int((~np.isin(names, np.array([START, END], np.uint64))).sum()), *(int(x.sum()) for x in sums)]
            parts, back = [*parts, -1], [[*x, None] for x in back]
        give_back()
        cols = [pa.array(parts, pa.int64()), pa.array([kind] * len(parts), pa.int32()), pa.array([key[1].as_py()] * len(parts), pa.int64()), *(pa.array(x, pa.binary()) for x in back)]
        return pa.table([*cols, *(pa.array([0] * (len(parts) - 1) + [x], pa.int64()) for x in stats)], ["part", "kind", "range", "n", "n_target", "words", "total", "total_target"])

    return counts.groupBy("kind", "range").applyInArrow(run, "part bigint, kind int, range bigint, n binary, n_target binary, words bigint, total bigint, total_target bigint")


def lm_scores(docs: DataFrame, target_ids: DataFrame, vocabulary: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ce_target, ce_background and score (their difference; low is like the target) for every row.

    The background is all of ``docs``, the target its rows whose doc_id is in ``target_ids``; both models have the same
    vocabulary, order and smoothing. Every word of the corpus counts; with ``vocabulary`` only so many of the most
    frequent do and all others are one unknown word. Counts cover all documents: each part of the corpus (a bounded
    amount of text) sends its distinct words and bigrams (as 64-bit hashes, by range of keys), gets their totals back,
    and scores its own documents, so no model and, unless asked for, no vocabulary is collected or broadcast. However
    frequent a key is, a part sends it once. Texts that are null or without words have null cross-entropies; very long
    texts are parts of their own; null doc_ids are never target; repeated rows count and score as often as they occur,
    rows that share a doc_id by their own texts; an empty table gives no rows; other columns are ignored.
    """
    ids = small_or_plain(target_ids.select(F.col("doc_id").cast("bigint").alias("t_id")).where("t_id is not null").distinct())
    marked = docs.select(F.col("doc_id").cast("bigint"), "text").join(ids, F.col("doc_id") == F.col("t_id"), "left")
    marked = marked.select("doc_id", "text", F.col("t_id").isNotNull().alias("is_target"))
    known = None
    if vocabulary is not None:
        start = F.col("word") == F.lit(START - (1 << 64) if START >> 63 else START)
        top = word_counts(marked).where(~start).orderBy(F.desc("n"), "word").limit(vocabulary).collect()
        known = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    parts = keep(to_parts(marked), "lm-parts")
    ranges = max(1, -(-(parts.agg(F.sum("n_bytes")).first()[0] or 0) // RANGE_BYTES))
    back = keep(totals(key_counts(parts, ranges, known)), "lm-totals")
    seen = back.where("part = -1").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "total", "total_target"))).first()
    words, sums = seen[0] if known is None else len(known), {"n": seen[1], "n_target": seen[2]}
    of_part = back.where("part >= 0").groupBy("part").agg(F.sort_array(F.collect_list(F.struct("kind", "range", "n", "n_target"))).alias("back"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a part at a time
                slices, sent = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                docs_ = _unpacked(slices)
                flat, first, sizes = _sequences(docs_.column("text").to_pylist(), known)
                _, at_word = np.unique(flat, return_inverse=True)
                _, at_pair = np.unique(_pairs(flat, first), return_inverse=True)
                some, n_pairs = sizes > 0, sizes[sizes > 0] - 1
                context, word = at_word[:-1][~first[1:]], at_word[~first]
                means = []
                for c in ("n_target", "n"):
                    unigrams, bigrams = (np.concatenate([unpack_counts(x[c]) for x in sent or () if x["kind"] == kind] or [np.zeros(0)]).astype(float) for kind in (0, 1))
                    p = (unigrams + PSEUDO) / (sums[c] + PSEUDO * (words + 3))
                    loss = -np.log((bigrams[at_pair] + BACKOFF * p[word]) / (unigrams[context] + BACKOFF))
                    mean = np.full(len(sizes), np.nan)
                    if some.any():
                        mean[some] = np.add.reduceat(loss, np.cumsum(n_pairs) - n_pairs) / n_pairs
                    means.append(mean)
                cols = [pa.array(x, mask=~some) for x in (*means, means[0] - means[1])]
                del flat, first, at_word, at_pair, context, word, unigrams, bigrams, loss
                yield pa.record_batch([docs_.column("doc_id").combine_chunks(), pa.array(np.maximum(sizes - 2, 0)), *cols], ["doc_id", "n_tokens", "ce_target", "ce_background", "score"])
        give_back()

    return parts.join(of_part, "part", "left").select("docs", "back").mapInArrow(run, "doc_id bigint, n_tokens bigint, ce_target double, ce_background double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    out = lm_scores(table(spark, sf_dir, "documents"), target)
    six = lambda c: (F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c)  # noqa: E731  as the order of addition shows in later places
    return out.select("doc_id", "n_tokens", six("ce_target"), six("ce_background"), six("score"))


def _sql() -> str:
    """The same models token by token, feasible at the checked size."""
    p = "(u.{0} + " + str(PSEUDO) + ") / (t.{0} + " + str(PSEUDO) + " * (v + 3))"
    loss = lambda c: f"-ln((b.{c} + {BACKOFF} * {p.format(c)}) / (f.{c} + {BACKOFF}))"
    six = "floor(({0}) * 1e6 + 0.5) / 1e6"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w, (coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false))::INT AS is_t FROM documents),
q AS (SELECT r, is_t, list_concat(['start '], list_concat(w, ['end '])) AS q FROM d WHERE len(w) > 0), k AS (SELECT r, is_t, unnest(q) AS x FROM q),
u AS (SELECT x, count(*)::DOUBLE AS n, sum(is_t)::DOUBLE AS g FROM k GROUP BY 1), t AS (SELECT sum(n) AS n, sum(g) AS g, count(*) FILTER (x NOT IN ('start ', 'end ')) AS v FROM u),
h AS (SELECT r, is_t, unnest(q[:len(q) - 1]) AS a, unnest(q[2:]) AS z FROM q), b AS (SELECT a, z, count(*)::DOUBLE AS n, sum(is_t)::DOUBLE AS g FROM h GROUP BY 1, 2),
m AS (SELECT h.r, avg({loss("g")}) AS ct, avg({loss("n")}) AS cb FROM h JOIN b ON h.a = b.a AND h.z = b.z JOIN u f ON f.x = h.a JOIN u ON u.x = h.z CROSS JOIN t GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_tokens, {six.format("ct")} AS ce_target, {six.format("cb")} AS ce_background, {six.format("ct - cb")} AS score FROM d LEFT JOIN m USING (r)"""


QUERIES = {"op4_lm_scoring": query}
SQL = {"op4_lm_scoring": _sql()}
