from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_near import brute_near
from tests.llm.test_rules_and_lines import base, brute_words
from tidemark.llm import mixing, shared
from tidemark.llm.passage_dedup import MIN_WORDS
from tidemark.llm.quality_rules import THRESHOLD
from tidemark.llm.quality_rules import query as rules_query


def test_stages_against_brute_force(spark, duck):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    outs, cur = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        cur = stage(spark, cur, SMALL).persist()
        outs[name] = cur
        if name != "packing":
            assert cur.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    llr = {r.doc_id: r.llr for r in rules_query(spark, SMALL).collect()}
    kept = {d: t for d, t in texts.items() if (b := base(t))[0] >= 10 and 100 * b[4] <= 20 * b[0] and llr[d] >= THRESHOLD}
    assert {r.doc_id for r in outs["quality_rules"].collect()} == set(kept)
    left = brute_words(sorted(kept.items()), MIN_WORDS)
    cut = {r.doc_id: r.text for r in outs["line_dedup"].collect()}
    assert {d: t.encode().split() for d, t in cut.items()} == {d: w for d, w in left.items() if len(w) >= 10}
    assert all(cut[d] == kept[d] for d, w in left.items() if w == kept[d].encode().split())
    _, comp = brute_near(sorted(cut.items()))
    one = {d: t for d, t in cut.items() if comp[d] == d}
    assert {r.doc_id for r in outs["near_dedup"].collect()} == set(one)
    duck.register("documents_now", outs["near_dedup"].toPandas())
    sql = mixing.SQL["op10_mix_to_targets"].replace("FROM documents)", "FROM documents_now)")
    mixed = {r[0] for r in duck.sql(f"SELECT doc_id FROM ({sql}) WHERE kept").fetchall()}
    assert {r.doc_id for r in outs["mixing"].collect()} == mixed
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    n = sum(len(tok.encode(cut[d], add_special_tokens=False).ids) + 1 for d in mixed)
    pieces = outs["packing"].collect()
    assert sum(p.length for p in pieces) == n
    assert len({p.sequence_id for p in pieces}) == int(np.ceil(n / 2048))


def test_run(spark, tmp_path, monkeypatch):
    """Only the result's table is left in the shared folder."""
    monkeypatch.setattr(shared, "shared_dir", lambda _: f"file://{tmp_path}")
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    assert [p.name.split("-")[1] for p in tmp_path.iterdir()] == ["packing"]


def test_rows_of_one_id(spark):
    """Another text under the id of a dropped copy stays."""
    x, y, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyu")
    rows = [(1, x), (8, x), (8, u), (9, x + " end"), (None, x), (3, None), (4, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect()), key=str)
    assert got == sorted([(1, x), (8, u), (None, x), (3, None), (4, "")], key=str)


def test_odd_input(spark, odd_docs, no_docs):
    """Every stage takes nulls, empty texts, repeated rows and an empty table."""
    for docs in (odd_docs, no_docs):
        docs = docs.select(corpus_pipeline.COLUMNS)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            n = out.count()
            assert n <= docs.count() or name == "packing"
            assert n > 0 or docs.count() == 0 or name == "quality_rules"


def test_batches_are_small_while_tables_are_written(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    with shared.small_batches(spark):
        assert int(spark.conf.get(key)) == shared.BATCH_BYTES
    assert spark.conf.get(key, None) == before


def test_shared_folder():
    """The session's folder; a temporary one only where there is none and all runs in one process."""

    def session(master, folder=None):
        context = SimpleNamespace(master=master, applicationId=master, getConf=lambda: SimpleNamespace(get=lambda _: folder))
        return SimpleNamespace(conf=SimpleNamespace(get=lambda _, other: other), sparkContext=context)

    assert shared.shared_dir(session("spark://host:7077", "hdfs:///work/")) == "hdfs:///work"
    assert shared.shared_dir(session("local[2]")) == shared.shared_dir(session("local[2]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            shared.shared_dir(session(master))
