"""Packing by concatenate-and-cut: prefix sums over partition totals give each token its global place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import keep, table
from tidemark.llm.tokenizing import encoder, idle

_ENCODED = "part int, doc_id bigint, local_start bigint, n_tokens bigint, ids binary"
_PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def encode_partitions(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """First pass: ids of every document and its place within its own partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at, part = encoder(tokenizer_path), 0, TaskContext.get().partitionId()
        end, width = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                cut = batch.slice(lo, 1000)
                ids = [enc.encode_bytes(t) + end for t in cut.column(1).to_pylist()]
                n = np.array([len(x) // width for x in ids], np.int64)
                start = at + np.concatenate([[0], np.cumsum(n)[:-1]])
                at += int(n.sum())
                yield pa.record_batch(
                    [pa.array(np.full(len(ids), part, np.int32)), cut.column(0), pa.array(start), pa.array(n), pa.array(ids, pa.binary())],
                    ["part", "doc_id", "local_start", "n_tokens", "ids"],
                )
        idle()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _ENCODED)


def pack_concat(docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 1) -> DataFrame:
    """Concatenate all documents and cut the stream every ``seq_len`` tokens.

    Documents lie in the order of the scan's partitions. A document's ids (``end_id`` appended) are split wherever a
    window ends, so only the last sequence of all can be short. Returns one row per piece with its ids as unsigned
    32-bit little-endian integers; ``start`` is the piece's place in its document, ``offset`` in its sequence.
    Null or empty texts have the end id alone; very long texts are encoded whole and cut like others; null doc_ids are
    kept; repeated rows, and other texts under one doc_id, are packed once each; other columns are ignored; an empty
    table gives no rows.
    """
    wide = encoder(tokenizer_path).dtype
    encoded = keep(encode_partitions(docs, tokenizer_path, end_id), "packed-ids")
    totals = encoded.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the scan: this is all that meets in one task or is broadcast
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                out: list[list] = [[] for _ in range(7)]
                doc, at, n, blobs = (batch.column(i).slice(lo, 1000).to_pylist() for i in range(4))
                for d, g, total, blob in zip(doc, at, n, blobs, strict=True):
                    ids, s = np.frombuffer(blob, wide), 0
                    while s < total:
                        seq, off = divmod(g + s, seq_len)
                        k = min(seq_len - off, total - s)
                        row = (d, s, k, ids[s : s + k].astype("<u4").tobytes(), total, seq, off)
                        for col, v in zip(out, row, strict=True):
                            col.append(v)
                        s += k
                kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
                yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    placed = encoded.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("at"), "n_tokens", "ids")
    return placed.mapInArrow(cut, _PIECES)


def pack_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_digest(pack_concat(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {"op8_pack_concat": query}
SQL: dict[str, str] = {}
