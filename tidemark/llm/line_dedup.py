"""Line dedup by winnowing: window minima over line hashes are fingerprints; matched runs lose their later copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.passage_dedup import passage_dedup
from tidemark.llm.shared import BLANKS, keep, small_or_plain, table

#: A run of lines counts as a passage from this many words on.
MIN_WORDS = 50
_WINDOWS = "doc_id bigint, text_key bigint, fp bigint, at int, win binary, first int, last int"
_BLANK_BYTES = BLANKS.encode()


def _lines(text: bytes) -> tuple[list[int], list[bytes]]:
    """Places (among the \\n-split lines) and stripped contents of the lines that hold a word."""
    at, kept = [], []
    for i, line in enumerate(text.split(b"\n")):
        if line := line.strip(_BLANK_BYTES):
            at.append(i)
            kept.append(line)
    return at, kept


def minimal_windows(sizes: list[int], min_words: int) -> set[tuple[int, int]]:
    """Shortest runs with ``min_words`` words: from every line forward, and back from every line.

    A longer run is covered line by line by those inside it, so matching these alone extends a match both ways.
    """
    found, total, a = set(), 0, 0
    for b, n in enumerate(sizes):  # back from b
        total += n
        while total - sizes[a] >= min_words:
            total -= sizes[a]
            a += 1
        if total >= min_words:
            found.add((a, b))
    total, b = 0, len(sizes) - 1
    for a in range(len(sizes) - 1, -1, -1):  # forward from a
        total += sizes[a]
        while total - sizes[b] >= min_words:
            total -= sizes[b]
            b -= 1
        if total >= min_words:
            found.add((a, b))
    return found


def windows(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per minimal window: its fingerprint (least line hash, last on ties), that line's place, its own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                at, lines = _lines(text or b"")
                sizes = [len(x.split()) for x in lines]
                if sum(sizes) < min_words:
                    continue
                hashes = [xxhash.xxh3_64_intdigest(x) for x in lines]
                packed = np.array(hashes, "<u8").tobytes()
                for a, b in sorted(minimal_windows(sizes, min_words)):
                    least = min(range(a, b + 1), key=lambda i: (hashes[i], -i))
                    value = (doc, key, hashes[least] - (1 << 63), at[least], xxhash.xxh3_128_digest(packed[8 * a : 8 * b + 8]), at[a], at[b])
                    for c, v in zip(cols, value, strict=True):
                        c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "text_key", "fp", "at", "win", "first", "last"])

    return docs.select("doc_id", "text_key", F.col("text").cast("binary")).mapInArrow(run, _WINDOWS)


def repeated_spans(wins: DataFrame) -> DataFrame:
    """Windows that repeat an earlier one, by (doc_id, text_key, line): (doc_id, text_key, first, last)."""
    marks = wins.select("fp", "doc_id", "text_key", "at").distinct().groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    near = wins.join(marks, "fp", "left_semi")
    place = lambda: F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.col("text_key").alias("k"), F.col("first").alias("f"))
    origin = near.groupBy("win").agg(F.min(place()).alias("origin"), F.count("*").alias("n")).where("n > 1").select("win", "origin")
    return near.join(origin, "win").where(place() != F.col("origin")).select("doc_id", "text_key", "first", "last")


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with repeated passages deleted, and ``n_lines``, ``n_removed``, ``removed`` (line spans).

    Lines are compared without surrounding blanks; lines without a word are no part of a run and go only when they
    stand inside a deleted span. A line is deleted if and only if it lies in a run of consecutive lines with at least
    ``min_words`` words in all that occurs earlier, documents being ordered by doc_id (nulls first; texts of one doc_id
    by their hash; rows equal in both are one document and stay alike); so one copy of everything stays. Null texts stay null with no lines; ``n_chars``, where
    present, follows the new text; columns of ``docs`` with an output's name are replaced; an empty table gives no rows.
    """
    own = ["n_lines", "n_removed", "removed"]
    rest = [c for c in docs.columns if c not in {*own, "text_key"}]
    keyed = docs.select(*rest).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    wins = keep(windows(keyed.select(F.col("doc_id").cast("bigint"), "text_key", "text"), min_words), "line-windows")
    spans = repeated_spans(wins).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("_tm_spans"))
    spans = keep(spans, "line-spans").select(F.col("doc_id").alias("_tm_doc"), F.col("text_key").alias("_tm_key"), "_tm_spans")
    on = F.col("doc_id").eqNullSafe(F.col("_tm_doc")) & (F.col("text_key") == F.col("_tm_key"))
    del_on = keyed.join(small_or_plain(spans, 100_000), on, "left").drop("_tm_doc", "_tm_key", "text_key")
    lines = F.split(F.col("text"), "\n")

    # spans are sorted by their first line: merge those that touch into runs
    merged = F.aggregate(
        F.col("_tm_spans"),
        F.array().cast("array<struct<first:int,last:int>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["last"] + 1 >= s["first"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], s["last"]).alias("last"))))).otherwise(
            F.concat(acc, F.array(F.struct(s["first"].alias("first"), s["last"].alias("last"))))
        ),
    )
    out = del_on.withColumn("removed", F.when(F.col("_tm_spans").isNull(), F.array().cast("array<struct<first:int,last:int>>")).otherwise(merged)).drop("_tm_spans")
    out = out.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("bigint")).withColumn("n_removed", F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, s: a + s["last"] - s["first"] + 1))
    kept = F.filter(lines, lambda _, i: ~F.exists(F.col("removed"), lambda s: (s["first"] <= i) & (i <= s["last"])))
    out = out.withColumn("text", F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(kept, "\n")))
    if "n_chars" in rest:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.size("removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*rest, *own)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passage_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), "[ \\t-\\r]+", " "))
    return out.select("doc_id", "n_lines", "n_removed", F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["first"], s["last"])), ";").alias("removed"), F.md5(words.cast("binary")).alias("words_md5"))


#: Every run of 50 words by its text, feasible at the checked size.
_ORACLE = f"""WITH w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {MIN_WORDS - 1}], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - {MIN_WORDS - 2})) AS i FROM w)),
g AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM x) WHERE k > 1),
b AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {MIN_WORDS} THEN 0 ELSE 1 END AS new FROM g),
s AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM b),
m AS (SELECT doc_id, min(i)::INT - 1 AS first, max(i)::INT + {MIN_WORDS - 2} AS last FROM s GROUP BY doc_id, n),
a AS (SELECT doc_id, list([first, last] ORDER BY first) AS removed, sum(last - first + 1)::BIGINT AS n FROM m GROUP BY doc_id)
SELECT w.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(a.n, 0) AS n_removed, coalesce(array_to_string(list_transform(removed, lambda s: s[1] || '-' || s[2]), ';'), '') AS removed,
 md5(array_to_string(list_transform(list_filter(list_zip(w, range(len(w))), lambda p: removed IS NULL OR len(list_filter(removed, lambda s: p[2] BETWEEN s[1] AND s[2])) = 0), lambda p: p[1]), ' ')) AS words_md5 FROM w LEFT JOIN a ON a.doc_id = w.doc_id"""

QUERIES = {"op5_line_dedup": query}
SQL = {"op5_line_dedup": _ORACLE}
