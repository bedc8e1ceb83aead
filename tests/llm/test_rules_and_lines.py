import collections
import re

from tests.conftest import SMALL
from tidemark.llm import line_dedup as L
from tidemark.llm import quality_rules as Q
from tidemark.llm.passage_dedup import passage_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def judged(spark, docs):
    labels = spark.createDataFrame([(1,), (6,), (None,)], "doc_id bigint")
    return Q.quality_rules(docs, labels).collect()


def test_base_counts(spark, odd_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for d in (docs, odd_docs):
        for r in judged(spark, d):
            want = base(r.text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
            assert not (r.kept and r.base_failed)


def test_ratio_against_python(spark):
    import math

    import xxhash

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = {r.doc_id for r in Q.trusted_ids(spark, SMALL).collect()}
    texts = {r.doc_id: WORD.findall(r.text or "") for r in docs.collect()}

    def hashed(*grams):
        h = 42
        for g in grams:
            h = xxhash.xxh64_intdigest(g if isinstance(g, bytes) else g.encode(), h)
        return h

    def feats(w):
        ends = [hashed(x[-3:]).to_bytes(8, "little") for x in w]
        grams = [(0, hashed(x)) for x in w] + [(1, hashed(x[:4])) for x in w] + [(2, hashed(*p)) for p in zip(ends, ends[1:], strict=False)]
        return [kind * Q.BUCKETS + h % Q.BUCKETS for kind, h in grams]

    found = {d: feats(w) for d, w in texts.items()}
    raw, tgt = collections.Counter(), collections.Counter()
    for d, f in found.items():
        raw.update(f)
        tgt.update(f if d in good else [])
    n_raw, n_tgt = sum(raw.values()), sum(tgt.values())
    ratio = {k: math.log((tgt[k] + Q.SMOOTHING * n / n_raw) / (n_tgt + Q.SMOOTHING) / (n / n_raw)) for k, n in raw.items()}
    for r in Q.quality_rules(docs, Q.trusted_ids(spark, SMALL)).collect():
        f = found[r.doc_id]
        want = sum(map(ratio.get, f)) / len(f) if f else 0.0
        assert abs(r.llr - want) < 1e-9
        assert r.kept == (not r.base_failed and r.llr >= Q.THRESHOLD)


def test_unseen_labels_agree(spark):
    """Fitted on every other trusted document, the rules still keep the rest of them and reject the documents labelled bad."""
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    judged_ = Q.quality_rules(docs, labels.where("quality = 1").where(seen).select("doc_id")).join(labels, "doc_id").where(~seen & F.expr("not base_failed")).select("quality", "kept").collect()
    for quality in (0, 1):
        own = [r.kept == bool(quality) for r in judged_ if r.quality == quality]
        assert len(own) > 100 and sum(own) / len(own) >= 0.97


def test_labels_agree(spark):
    r = Q.query(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("not base_failed")
    assert r.where("kept and quality = 0").count() == 0
    assert r.where("not kept and quality = 1").count() == 0


def test_rules_edges(spark, odd_docs, no_docs):
    assert Q.quality_rules(no_docs, no_docs.select("doc_id")).count() == 0
    assert len(judged(spark, odd_docs)) == odd_docs.count()
    assert {r.llr for r in Q.quality_rules(odd_docs, no_docs.select("doc_id")).collect()} == {0.0}


def brute_lines(docs, least):
    seen, out = {}, {}
    for d, t in docs:
        parts = (t or "").split("\n")
        at = [i for i, x in enumerate(parts) if x.encode().strip(L._BLANK_BYTES)]
        lines = [parts[i].encode().strip(L._BLANK_BYTES) for i in at]
        size, gone = [len(x.split()) for x in lines], set()
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if sum(size[i : j + 1]) >= least:
                    if seen.setdefault(tuple(lines[i : j + 1]), (d, i)) != (d, i):
                        gone.update(range(at[i], at[j] + 1))
                    break
        for j in range(len(lines)):
            for i in range(j, -1, -1):
                if sum(size[i : j + 1]) >= least:
                    if seen.setdefault(tuple(lines[i : j + 1]), (d, i)) != (d, i):
                        gone.update(range(at[i], at[j] + 1))
                    break
        out[d] = "\n".join(x for i, x in enumerate(parts) if i not in gone)
    return out


def test_lines_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_lines(sorted((r.doc_id, r.text) for r in docs.collect()), L.MIN_WORDS)
    got = {r.doc_id: r for r in L.line_dedup(docs).collect()}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values() if r.n_removed)
    assert sum(r.n_removed for r in got.values()) > 0


def test_short_runs_make_a_passage(spark):
    a, b = "\n".join(f"l{i} " + "x " * 20 for i in range(4)), "l1 " + "x " * 20
    docs = spark.createDataFrame([(1, a), (2, "new\n" + a + "\nend"), (3, b)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in L.line_dedup(docs).collect()}
    assert (got[1].n_removed, got[2].text, got[3].n_removed) == (0, "new\nend", 0)


def test_lines_edges(spark, odd_docs, no_docs):
    assert L.line_dedup(no_docs).count() == 0
    got = L.line_dedup(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[6].text == "head\n\ntail" and by[2].text is None and by[8].n_removed == 0


def brute_words(docs, least):
    """Deleted words of every document: those in runs that occur earlier."""
    seen, out = {}, {}
    for d, t in docs:
        w, gone = (t or "").encode().split(), set()
        for i in range(len(w) - least + 1):
            if seen.setdefault(tuple(w[i : i + least]), (d, i)) != (d, i):
                gone.update(range(i, i + least))
        out[d] = [x for i, x in enumerate(w) if i not in gone]
    return out


def test_passages_inside_lines(spark):
    p = [f"p{i}" for i in range(54)]
    one, broken = " ".join(p), "\n".join(" ".join(p[i : i + 11]) for i in range(0, 54, 11))
    rows = [
        (1, f"a b {one} c d"), (2, f"e {one} f\ng"), (3, f"h\ni j {broken} k l\nm"), (4, " ".join(p[:49]) + " n"), (5, f"{one} q {broken}"), (6, "r " * 130), (7, f"s\n{broken}\n\n t"),
    ]
    got = {r.doc_id: r for r in passage_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = brute_words(rows, 50)
    assert {d: (r.text or "").encode().split() for d, r in got.items()} == want
    assert got[2].text == "e f\ng" and got[3].text == "h\ni j\nk l\nm" and got[4].n_removed == 0 and got[7].text == "s\n\n t"
    assert len(want[6]) == 1 and got[6].n_removed == 129


def test_words_against_brute_force(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**6 + r.doc_id, " ".join(["x", *(r.text or "").split()[7:90], "y"])) for r in docs.where("doc_id < 60").collect()], "doc_id bigint, text string")
    rows = docs.union(extra)
    got = {r.doc_id: (r.text or "").encode().split() for r in passage_dedup(rows).collect()}
    assert got == brute_words(sorted((r.doc_id, r.text) for r in rows.collect()), L.MIN_WORDS)


def test_passages_match_sql(spark, duck):
    want = duck.sql(f"SELECT doc_id, n_lines, n_removed, removed, words_md5 FROM ({L.SQL['op5_line_dedup']})").fetchall()
    got = [(r.doc_id, r.n_lines, r.n_removed, r.removed, r.words_md5) for r in L.query(spark, SMALL).collect()]
    assert sorted(got) == sorted(want) and any(r[2] for r in got)


def test_query_sees_passages_inside_lines(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute_words(sorted((r.doc_id, r.text) for r in docs.collect()), L.MIN_WORDS)
    gone = {r.doc_id: len((r.text or "").encode().split()) - len(want[r.doc_id]) for r in docs.collect()}
    assert {r.doc_id: r.n_removed for r in L.query(spark, SMALL).collect()} == gone and any(gone.values())


def test_passages_edges(spark, odd_docs, no_docs):
    assert passage_dedup(no_docs).count() == 0
    got = passage_dedup(odd_docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == odd_docs.count() and by[6].text == "head\n\ntail" and by[2].text is None and by[8].n_removed == 0
    assert by[7].text == "x" and len(by[5].text.split()) == 977 and by[5].n_chars == len(by[5].text)
