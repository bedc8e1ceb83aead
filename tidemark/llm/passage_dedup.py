"""Passage dedup by winnowing over words: window minima of word n-grams are fingerprints; matched words lose later copies."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import BLANKS, give_back, keep, sliced, small_or_plain

#: A run of words counts as a passage from this many on.
MIN_WORDS = 50
_BLANK_BYTES = BLANKS.encode()
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_NONE = -(1 << 63)
#: Bits of a place that hold the word's place in its text; the others hold the text's rank among those with repeats.
_AT_BITS = 28
_SPANS = "array<struct<first:int,last:int>>"
#: Odd bases of the two window hashes and their inverses modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base, np.uint64)]), dtype=np.uint64)[:n]


class Grams:
    """Hashes of all runs of a fixed number of words: polynomials of the word hashes modulo 2^64, by prefix sums."""

    def __init__(self) -> None:
        self.grown = 0

    def __call__(self, words: np.ndarray, size: int, which: int) -> np.ndarray:
        n = len(words)
        if n > self.grown:
            self.grown = max(n, 2 * self.grown, 4096)
            self.up = [_powers(b, self.grown) for b in _BASES]
            self.down = [_powers(pow(b, -1, 1 << 64), self.grown) for b in _BASES]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.up[which][:n], dtype=np.uint64)])
        return (sums[size:] - sums[:-size]) * self.down[which][: n - size + 1]


def word_hashes(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def fingerprints(words: np.ndarray, grams: Grams, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs half as long as a passage, and the least of them in every run of ``min_words`` words.

    Equal runs have equal least hashes, so a run can only repeat where its least hash does.
    """
    short = (min_words + 1) // 2
    hashes = _mix(grams(words, short, 0))
    width, have, least = min_words - short + 1, 1, hashes
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return hashes, least


def marks_of(docs: DataFrame, min_words: int) -> DataFrame:
    """Distinct fingerprints of every document that holds a passage; ``again`` has those at two places of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in sliced(batches):
            docs_, keys, sizes, prints, again = [], [], [], [], []
            for doc, key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = word_hashes(text or b"")
                if len(words) < min_words:
                    continue
                hashes, least = fingerprints(words, grams, min_words)
                names = np.unique(least[np.flatnonzero(np.diff(least, prepend=~least[:1]))])
                ranked = np.sort(hashes)
                twice = ranked[1:][ranked[1:] == ranked[:-1]]
                docs_.append(doc)
                keys.append(key)
                sizes.append(len(words))
                prints.append(names.view(np.int64))
                again.append(np.intersect1d(names, twice).view(np.int64))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.record_batch([pa.array(c, k) for c, k in zip((docs_, keys, sizes, prints, again), kinds, strict=True)], ["doc_id", "text_key", "n_words", "prints", "again"])
        give_back()

    return docs.select("doc_id", "text_key", F.col("text").cast("binary")).mapInArrow(run, "doc_id bigint, text_key bigint, n_words int, prints array<bigint>, again array<bigint>")


def numbered(docs: DataFrame) -> DataFrame:
    """Adds ``rank``, the place of a row in the order of (doc_id, text_key): its place in a sorted partition and a prefix sum over partitions."""
    rows = keep(docs.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key").withColumn("m", F.monotonically_increasing_id()), "line-numbered")
    part = F.shiftright("m", 33)
    # one row per partition meets in one task and is broadcast
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    bases = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.withColumn("part", part).join(F.broadcast(bases), "part").withColumn("rank", F.col("base") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "base", "m")


def windows(docs: DataFrame, min_words: int) -> DataFrame:
    """Every run of ``min_words`` words whose fingerprint is in the document's ``shared``: its place and 128-bit hash.

    A place is the document's rank and the run's first word in one number, so that places compare like documents do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in sliced(batches):
            shared = batch.column(2)
            for i, (rank, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2)), strict=True)):
                words = word_hashes(text or b"")
                if len(words) >> _AT_BITS or rank >> 63 - _AT_BITS:
                    raise ValueError("a text or the corpus is too large for places of 64 bits")
                wanted = shared[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                at = np.flatnonzero(np.isin(fingerprints(words, grams, min_words)[1], wanted))
                a, b = grams(words, min_words, 0)[at], grams(_mix(words), min_words, 1)[at]
                place = (rank << _AT_BITS) + at
                for lo in range(0, len(at), 100_000):
                    cut = slice(lo, lo + 100_000)
                    yield pa.record_batch([pa.array(place[cut]), pa.array(a[cut].view(np.int64)), pa.array(b[cut].view(np.int64))], ["place", "a", "b"])
        give_back()

    return docs.select("rank", F.col("text").cast("binary"), "shared").mapInArrow(run, "place bigint, a bigint, b bigint")


def repeated_starts(wins: DataFrame) -> DataFrame:
    """First words of the runs that repeat an earlier one: (rank, starts).

    Origins are sums within tasks first; they are written, so that a run that very many texts share is a skewed join,
    which Spark splits.
    """
    origin = keep(wins.groupBy("a", "b").agg(F.min("place").alias("origin"), F.count("*").alias("n")).where("n > 1").select("a", "b", "origin"), "line-origins")
    later = wins.join(origin, ["a", "b"]).where("place <> origin")
    return later.groupBy(F.shiftright("place", _AT_BITS).alias("rank")).agg(F.array_sort(F.collect_list(F.col("place").bitwiseAND(F.lit((1 << _AT_BITS) - 1)).cast("int"))).alias("starts"))


def merged(starts: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Spans (first and last word) of the runs at sorted ``starts``; those that touch become one."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > min_words)
    first = starts[np.concatenate([[0], gap + 1])]
    last = starts[np.concatenate([gap, [len(starts) - 1]])] + min_words - 1
    return list(zip(first.tolist(), last.tolist(), strict=True))


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of ``spans``. Lines that lose all words go, and so do blank lines inside a span.

    Within a line the blanks after a deleted run go with it, or those before it where the line ends.
    """
    out, n, k, inside = [], 0, 0, False
    for line in text.split(b"\n"):
        at = [m.span() for m in _WORD.finditer(line)]
        while k < len(spans) and spans[k][1] < n:
            k += 1
        if not at:
            inside = k < len(spans) and spans[k][0] < n <= spans[k][1]
            if not inside:
                out.append(line)
            continue
        kept, j = [], k
        for i in range(len(at)):
            while j < len(spans) and spans[j][1] < n + i:
                j += 1
            if j == len(spans) or spans[j][0] > n + i:
                kept.append(i)
        n += len(at)
        if len(kept) == len(at):
            out.append(line)
        elif kept:
            parts = []
            for i in kept:
                end = at[i + 1][0] if i + 1 < len(at) else len(line)
                parts.append(line[at[i][0] : end])
            head = line[: at[0][0]] if kept[0] == 0 else b""
            tail = b"".join(parts)
            out.append(head + (tail if kept[-1] == len(at) - 1 else tail.rstrip(_BLANK_BYTES)))
    return b"\n".join(out)


def to_spans(starts: DataFrame, min_words: int) -> DataFrame:
    """(rank, starts) as (rank, spans): merged, so that what is joined to the texts stays small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        for batch in batches:
            own = [merged(batch.column(1)[i].values.to_numpy(zero_copy_only=False), min_words) for i in range(batch.num_rows)]
            yield pa.record_batch([batch.column(0), pa.array([[{"first": a, "last": b} for a, b in x] for x in own], kind)], ["rank", "spans"])

    return starts.mapInArrow(run, f"rank bigint, spans {_SPANS}")


def without_spans(text: Column, spans: Column) -> Column:
    """The text that is left; null where nothing goes."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, spans_: pa.Array) -> pa.Array:
        left = [cut(t.as_py(), [(x["first"], x["last"]) for x in own.as_py()]).decode() if t.is_valid and own.is_valid else None for t, own in zip(texts, spans_, strict=True)]
        out = pa.array(left, pa.string())
        del left
        give_back()
        return out

    return run(F.when(spans.isNotNull(), text.cast("binary")), spans)


def passage_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with repeated passages deleted, and ``n_lines``, ``n_removed``, ``removed`` (word spans).

    A word is deleted if and only if it lies in a run of ``min_words`` consecutive words that occurs earlier, wherever
    lines break; documents are ordered by doc_id (nulls first; texts of one doc_id by their hash; rows equal in both are
    one document and stay alike). Lines left without words go, and so do blank
    lines inside a deleted span; ``n_lines`` counts the lines before, ``n_removed`` the deleted words. Null texts stay
    null with no lines; texts of any length are read whole (up to 2^28 words); of equal runs the first in the order of
    documents stays; ``n_chars``, where present, follows the new text; columns of ``docs`` with an output's name are
    replaced; an empty table gives no rows.
    """
    own = ["n_lines", "n_removed", "removed"]
    rest = [c for c in docs.columns if c not in {*own, "text_key"}]
    keyed = docs.select(*rest).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    texts = keyed.select(F.col("doc_id").cast("bigint"), "text_key", "text")
    marks = keep(marks_of(texts, min_words), "line-marks")
    # all of a text that an earlier document holds as a whole goes; only its first document takes part in the matching
    one = marks.groupBy("text_key", "n_words").agg(F.min(F.coalesce("doc_id", F.lit(_NONE))).alias("d0"), F.count("*").alias("n")).where("n > 1").select(F.col("text_key").alias("k0"), F.col("n_words").alias("w0"), "d0")
    ranked = marks.join(small_or_plain(keep(one, "line-copied")), (F.col("text_key") == F.col("k0")) & (F.col("n_words") == F.col("w0")), "left").withColumn("is_copy", F.coalesce(F.coalesce("doc_id", F.lit(_NONE)) > F.col("d0"), F.lit(False)))
    first = ranked.where("not is_copy")
    prints = first.select("doc_id", "text_key", F.explode("prints").alias("fp"), "again").select("doc_id", "text_key", "fp", F.array_contains("again", F.col("fp")).alias("again"))
    prints = keep(prints, "line-prints")
    known = keep(prints.groupBy("fp").agg(F.count("*").alias("n"), F.bool_or("again").alias("again")).where("n > 1 or again").select("fp"), "line-known")
    shared = numbered(prints.join(small_or_plain(known), "fp").groupBy("doc_id", "text_key").agg(F.collect_set("fp").alias("shared")))
    shared = keep(shared, "line-shared")
    named = lambda df: df.withColumnsRenamed({"doc_id": "_tm_doc", "text_key": "_tm_key"})
    on = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_tm_doc")) & (F.col("text_key") == F.col("_tm_key"))
    # rows equal in id and text have one rank and equal places, so they are no repeats of each other
    source = texts.join(small_or_plain(named(shared)), on).select("rank", "text", "shared")
    wins = keep(windows(source, min_words), "line-windows")
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("n_words") - 1).alias("last")))
    copies = ranked.where("is_copy").select("doc_id", "text_key", whole.alias("spans")).distinct()
    found = shared.select("rank", "doc_id", "text_key").join(to_spans(repeated_starts(wins), min_words), "rank").select("doc_id", "text_key", "spans")
    spans = keep(found.unionByName(copies), "line-spans").select(F.col("doc_id").alias("_tm_doc"), F.col("text_key").alias("_tm_key"), F.col("spans").alias("_tm_spans"))
    out = keyed.join(small_or_plain(spans), on, "left").drop("_tm_doc", "_tm_key", "text_key")
    out = out.withColumn("_tm_cut", without_spans(F.col("text"), F.col("_tm_spans")))
    out = out.withColumn("n_lines", F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("bigint"))
    out = out.withColumn("removed", F.coalesce("_tm_spans", F.array().cast(_SPANS))).drop("_tm_spans")
    out = out.withColumn("n_removed", F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, s: a + s["last"] - s["first"] + 1))
    out = out.withColumn("text", F.when(F.size("removed") == 0, F.col("text")).otherwise(F.col("_tm_cut")))
    if "n_chars" in rest:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.size("removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*rest, *own)
