import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tidemark.llm import packing, tokenfiles, tokenizing
from tidemark.llm.shared import fresh_path
from tidemark.llm.tokenizing import TokenEncoder

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}
SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", " ", "endoftext", "a", "\n", ".", "É", "<|endof\u0301text|>"]
ENCODERS = {p: TokenEncoder(p, most_units=50) for p in (WORD, BYTE)}


def reference(path, texts):
    tok = Tokenizer.from_file(path)
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=150, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet="aZé ß'sdt\n\t.,!*12_\u00a0\x1f\u0301İ", max_size=60), st.lists(st.sampled_from(SPECIAL), max_size=8).map("".join)))
def test_encoder_equals_library(path, text):
    e = ENCODERS[path]
    assert np.frombuffer(e.encode_bytes(text), e.dtype).tolist() == LIBRARY[path].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_special_strings_are_the_library_s(path):
    text = "hello <|endoftext|> world"
    ids = reference(path, [text])[0]
    assert np.frombuffer(ENCODERS[path].encode_bytes(text), ENCODERS[path].dtype).tolist() == ids
    assert LIBRARY[path].token_to_id("<|endoftext|>") in ids


def test_idle_workers_forget():
    e = tokenizing.encoder(BYTE)
    before = e.encode_bytes("some words of a text")
    assert len(e)
    tokenizing.idle(0.05)
    time.sleep(0.6)
    assert not len(e) and tokenizing.encoder(BYTE).encode_bytes("some words of a text") == before
    tokenizing.idle(0.3)
    tokenizing.encoder(BYTE)  # a task that begins keeps the memory
    time.sleep(0.6)
    assert len(e)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.mark.parametrize("which", ["table", "odd"])
def test_token_files_round_trip(spark, odd_docs, which):
    docs = documents(spark) if which == "table" else odd_docs
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = tokenfiles.read_token_files(tokenfiles.write_token_files(docs, fresh_path(spark, "t"), WORD)).collect()
    got = sorted(got, key=lambda r: r.start)
    at = 0
    for (d, _), ids, r in zip(rows, reference(WORD, [t for _, t in rows]), got, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (d, at, len(ids) + 1)
        assert np.frombuffer(r.ids, "<u4").tolist() == [*ids, 1]
        at += len(ids) + 1


@pytest.mark.parametrize("which", ["table", "odd"])
def test_packing(spark, odd_docs, which):
    docs = documents(spark) if which == "table" else odd_docs
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted((d, tuple([*ids, 1])) for (d, _), ids in zip(rows, reference(BYTE, [t for _, t in rows]), strict=True) if d is not None)
    pieces = packing.pack_concat(docs, BYTE).collect()
    by_seq, by_doc = {}, {}
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault((p.doc_id, p.sequence_id * 2048 + p.offset - p.start), []).append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.doc_tokens))
    for k, v in by_seq.items():
        at = 0
        for off, n in sorted(v):
            assert off == at
            at += n
        assert at == 2048 or k == max(by_seq)
    got = []
    for (d, _), v in by_doc.items():
        ids = [i for _, x, _ in sorted(v) for i in x]
        assert [s for s, _, _ in sorted(v)] == np.cumsum([0, *(len(x) for _, x, _ in sorted(v))])[:-1].tolist()
        assert all(n == len(ids) for _, _, n in v)
        got.append((d, tuple(ids)))
    assert sorted(g for g in got if g[0] is not None) == want
    assert sorted(by_seq) == list(range(len(by_seq)))


def test_digest(spark):
    text = documents(spark).where("doc_id = 1").first().text
    got = packing.query(spark, SMALL).where("doc_id = 1").collect()
    ids = [*reference(BYTE, [text])[0], 1]
    assert all(r.ids_crc32 == crc(ids[r.start : r.start + r.length]) for r in got)
    assert tokenfiles.query(spark, SMALL).where("doc_id = 1").first().ids_crc32 == crc([*reference(WORD, [text])[0], 1])


def test_odd_rows(spark):
    """Special strings, rows of one id with other texts, and a store that is read by byte ranges."""
    rows = [(2, "a <|endoftext|> b"), (1, "x"), (1, "y z"), (1, "x"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted((d, tuple([*ids, 1])) for (d, _), ids in zip(rows, reference(WORD, [t for _, t in rows]), strict=True))
    got = tokenfiles.read_token_files(tokenfiles.write_token_files(docs, fresh_path(spark, "t"), WORD)).collect()
    assert sorted((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    packed = {}
    for p in sorted(packing.pack_concat(docs, BYTE).collect(), key=lambda p: (p.sequence_id, p.offset)):
        packed.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    ids = reference(BYTE, ["a <|endoftext|> b"])[0]
    assert packed[2] == [*ids, 1]


def test_stored_ranges(tmp_path):
    np.arange(100, dtype="<u2").tofile(tmp_path / "x.bin")
    stored = tokenfiles.Stored(f"file://{tmp_path}/x.bin", "<u2")
    mapped, stored.mapped = stored.mapped, None
    stored.file = tokenfiles._open_fs(f"file://{tmp_path}")[0].open_input_file(str(tmp_path / "x.bin"))
    assert stored[10:20].tolist() == mapped[10:20].tolist() == list(range(10, 20))


def test_empty(spark, no_docs):
    assert packing.pack_concat(no_docs, BYTE).count() == 0
    assert tokenfiles.read_token_files(tokenfiles.write_token_files(no_docs, fresh_path(spark, "t"), WORD)).count() == 0
