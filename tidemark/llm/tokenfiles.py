"""Flat token files: unsigned ids, 64-bit document offsets and document ids, read back by memory map."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import fresh_path, keep, table
from tidemark.llm.tokenizing import encoder, idle

#: Stands for a null doc_id in the document file.
NULL_DOC = np.iinfo(np.int64).min
#: Bytes of text in a part on average, at most.
PART_BYTES = 256 << 20
_MANIFEST = "part int, path string, dtype string, n_docs bigint, n_tokens bigint"
_ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def _open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))


class Stored:
    """A file of numbers of which slices are read: memory-mapped where the store is a mounted folder, else by byte ranges."""

    def __init__(self, uri: str, dtype: str):
        from pyarrow import fs

        store, path = _open_fs(uri)
        self.dtype, self.mapped, self.file = np.dtype(dtype), None, None
        if isinstance(store, fs.LocalFileSystem):
            self.mapped = np.memmap(path, dtype, "r") if store.get_file_info(path).size else np.zeros(0, dtype)
        else:
            self.file = store.open_input_file(path)

    def __getitem__(self, places: slice) -> np.ndarray:
        lo, hi = int(places.start), int(places.stop)
        if self.mapped is not None:
            return self.mapped[lo:hi]
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((hi - lo) * width, lo * width), self.dtype)


def write_token_files(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write ids in ascending doc_id order and return the manifest, one row per part in that order.

    Part p owns three files: ``.bin`` with ids in the narrowest of 16 or 32 unsigned bits, ``.idx`` with n+1 unsigned
    64-bit offsets into it and ``.doc`` with the doc_ids. A task writes under a name of its own and renames at the
    end, so that a repeated task does no harm. Null texts are empty (end id alone); null doc_ids come first; rows with
    the same doc_id are all kept, side by side, by text; very long texts are encoded whole; other columns are ignored; an
    empty table has an empty manifest. The number of parts follows the bytes of text.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, tag = encoder(tokenizer_path), TaskContext.get().partitionId(), uuid.uuid4().hex
        store, root = _open_fs(out_dir)
        store.create_dir(root, recursive=True)
        end, width = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        sizes, doc_ids = [0], []
        names = {x: (f"{root}/part-{part:06d}.{x}.{tag}", f"{root}/part-{part:06d}.{x}") for x in ("bin", "idx", "doc")}
        with store.open_output_stream(names["bin"][0]) as out:
            for batch in batches:
                for lo in range(0, batch.num_rows, 1000):
                    cut = batch.slice(lo, 1000)
                    ids = [enc.encode_bytes(t) + end for t in cut.column(1).to_pylist()]
                    out.write(b"".join(ids))
                    sizes += [len(x) // width for x in ids]
                    doc_ids += [NULL_DOC if d is None else d for d in cut.column(0).to_pylist()]
        for x, a in (("idx", np.cumsum(np.array(sizes, "<u8"))), ("doc", np.array(doc_ids, "<i8"))):
            with store.open_output_stream(names[x][0]) as out:
                out.write(a.astype(a.dtype.newbyteorder("<")).tobytes())
        if not doc_ids:
            for x in names:
                store.delete_file(names[x][0])
            return
        for tmp, final in names.values():
            store.move(tmp, final)
        idle()
        yield pa.record_batch(
            [pa.array([part], pa.int32()), pa.array([f"{out_dir}/part-{part:06d}"]), pa.array([enc.dtype.str]), pa.array([len(doc_ids)], pa.int64()), pa.array([sum(sizes)], pa.int64())],
            ["part", "path", "dtype", "n_docs", "n_tokens"],
        )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    # texts break ties, so that every attempt of a task writes the same bytes
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = keep(ordered.mapInArrow(run, _MANIFEST), "token-manifest")
    # one row per part meets in one task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return keep(placed, "token-manifest-placed")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Read the files back: per document its first id's place among all ids and its ids (32-bit little-endian)."""
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, idx, docs = Stored(f"{row['path']}.bin", row["dtype"]), Stored(f"{row['path']}.idx", "<u8"), Stored(f"{row['path']}.doc", "<i8")
                for lo in range(0, row["n_docs"], 1000):
                    hi = min(lo + 1000, row["n_docs"])
                    at, names = idx[lo : hi + 1].astype(np.int64), docs[lo:hi].astype(np.int64)
                    blobs = [ids[p:q].astype("<u4").tobytes() for p, q in zip(at[:-1], at[1:], strict=True)]
                    yield pa.record_batch([pa.array(names, mask=names == NULL_DOC), pa.array(row["base"] + at[:-1]), pa.array(np.diff(at)), pa.array(blobs, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    # every part is a task of its own
    spread = manifest.withColumn("slot", F.row_number().over(Window.orderBy("part")) - 1).repartitionById(n, F.col("slot").cast("int")).drop("slot")
    return spread.mapInArrow(run, _ROWS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_token_files(table(spark, sf_dir, "documents"), fresh_path(spark, "token-files"), path)
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op3_token_files": query}
SQL: dict[str, str] = {}
