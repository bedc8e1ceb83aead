import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL
from tidemark.llm import cap_dedup as C
from tidemark.llm import near_dedup as N
from tidemark.llm.shared import connected_components


def forest(ids, links):
    par = {i: i for i in ids}

    def find(x):
        while par[x] != x:
            par[x] = par[par[x]]
            x = par[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (30, 31), (31, 32), (32, 33), (33, 34), (34, 35)]
    df = spark.createDataFrame([*edges, (None, 4)], "a bigint, b bigint")
    real = [e for e in edges if e[0] != e[1]]
    want = forest({x for e in real for x in e}, real)
    assert {r.id: r.component for r in connected_components(df).collect()} == want


def sets(docs):
    out = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        out[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute_near(docs):
    s = sets(docs)
    ids = sorted(s)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b])]
    return s, forest(ids, links)


def test_near_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    s, want = brute_near([(r.doc_id, r.text) for r in docs.collect()])
    for r in N.near_dedup(docs).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(s[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_matches_sql(spark, duck):
    want = duck.sql(f"SELECT doc_id, n_shingles, component_id, kept FROM ({N.SQL['op6_near_dedup']})").fetchall()
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.query(spark, SMALL).collect()]
    assert sorted(got) == sorted(want)


def test_chain_of_edits_and_borderline_families(spark):
    """Long chains link end to end; a family just under the bound stays apart."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    rows, cur = [], list(words)
    for k in range(12):
        rows.append((k, " ".join(cur)))
        cur = list(cur)
        cur[30 * k : 30 * k + 8] = [f"c{k}_{i}" for i in range(8)]
    for k in range(60):
        other = [f"q{i}" for i in range(200)]
        for i in rng.choice(40, 4 + k % 3, replace=False):
            other[5 * i] = f"z{k}_{i}"
        rows.append((100 + k, " ".join(other)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    _, want = brute_near(rows)
    assert {r.doc_id: r.component_id for r in N.near_dedup(docs).collect()} == want
    assert want[11] == 0


def test_near_edges(spark, odd_docs, no_docs):
    assert N.near_dedup(no_docs).count() == 0
    got = N.near_dedup(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[8].component_id == 1 and by[7].component_id == 1 and by[10].component_id == 9
    assert by[2].n_shingles == 0 and by[2].kept and by[None].component_id is None and by[None].kept


def test_rows_of_one_id_are_documents_of_their_own(spark):
    x, y = ([f"{c}{i}" for i in range(60)] for c in "xy")
    near = lambda w: " ".join([*w, "end"])
    rows = [(5, " ".join(x)), (5, " ".join(y)), (8, near(x)), (9, near(y)), (9, "something else of its own here")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(5, 56, 5, True), (5, 56, 5, True), (8, 57, 5, False), (9, 2, 9, True), (9, 57, 5, False)]


@settings(max_examples=60, deadline=None)
@given(st.integers(3, 400), st.integers(0, 100), st.integers(1, 10**6))
def test_sketches_merge_and_estimate(n, extra, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    b = np.unique(rng.integers(0, 1 << 63, extra, dtype=np.uint64))
    x, y = N.sketch(a), N.sketch(b) if len(b) else np.zeros(N.REGISTERS, np.uint8)
    assert (N.sketch(np.union1d(a, b)) == np.maximum(x, y)).all()


def test_estimate_keeps_similar_pairs():
    rng = np.random.default_rng(1)
    lost = 0
    for _ in range(400):
        both = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 1 << 63, 25, dtype=np.uint64)]) for _ in range(2))
        x, y = N.sketch(a)[None], N.sketch(b)[None]
        lost += not N.likely((x > y).sum(1), (x < y).sum(1), (x == y).sum(1), np.array([175.0]), np.array([175.0]))[0]
    assert lost == 0


def test_strangers_do_not_meet():
    """Registers of disjoint sets of equal size agree so rarely that a band of them has a chance under 1e-11."""
    rng = np.random.default_rng(4)
    regs = np.stack([N.sketch(rng.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(600)])
    same = np.mean([(regs[i] == regs[i + 1 :]).mean() for i in range(len(regs) - 1)])
    assert same**N.BAND < 1e-11


def test_pairs_at_the_bound_share_a_band():
    rng = np.random.default_rng(6)
    lost, agree = 0, []
    for _ in range(1500):
        both = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        x, y = (N.sketch(np.concatenate([both, rng.integers(0, 1 << 63, 25, dtype=np.uint64)])) for _ in range(2))
        bands = (x == y).reshape(-1, N.BAND).all(1)
        lost += not bands.any()
        agree.append(bands.mean())
    assert lost == 0 and (1 - np.mean(agree)) ** (N.REGISTERS // N.BAND) < 1e-4


def vectors(spark, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((40, 16))
    rows, k = [], 0
    for i, b in enumerate(base):
        for j in range(1 + i % 6):
            v = b + rng.standard_normal(16) * 0.28 * (j > 0)
            rows.append((k, [float(x) for x in v], i % 3))
            k += 1
    rows += [(k, rows[5][1], rows[5][2]), (k + 1, rows[5][1], (rows[5][2] + 1) % 3), (k + 2, None, 1), (k + 3, [0.0] * 16, 1), (k + 4, [float("nan")] * 16, 1), (k + 5, rows[7][1], None), (k + 6, [None] * 16, 2), (k + 7, [], 2), (k + 8, rows[9][1][:8], rows[9][2]), (None, rows[5][1], rows[5][2])]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


def test_caps_against_brute_force(spark):
    rows, df = vectors(spark)
    good = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [(a[0], b[0]) for k, a in enumerate(good) for b in good[k + 1 :] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= C.THRESHOLD]
    want = forest([r[0] for r in rows if r[0] is not None], links)
    got = {r.vec_id: r for r in C.cap_dedup(df).collect()}
    assert len(got) == len(rows) and len(links) > 20
    for i in want:
        assert (got[i].component_id, got[i].n_links, got[i].kept) == (want[i], sum(i in e for e in links), want[i] == i)
    assert got[None].n_links == 0 and got[None].kept


def test_caps_blocks_agree(spark, monkeypatch):
    _, df = vectors(spark, 8)
    whole = sorted(map(str, C.cap_dedup(df).collect()))
    monkeypatch.setattr(C, "BLOCK", 3)
    assert sorted(map(str, C.cap_dedup(df).collect())) == whole


def test_caps_recall():
    rng = np.random.default_rng(0)
    plan = C.plan_caps(20_000, 32)
    x = C._units(rng, 1500, 32)
    z = C._units(rng, 1500, 32)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    assert all(np.intersect1d(a, b).size for a, b in zip(plan.decode(x), plan.decode(y), strict=True))


def test_caps_of_one_id_are_vectors_of_their_own(spark):
    rng = np.random.default_rng(2)
    a, b = C._units(rng, 2, 16)
    near = lambda v, k: [float(x) for x in v + 0.01 * np.eye(16)[k]]
    rows = [(1, near(a, 0), 0), (1, near(b, 0), 0), (2, near(a, 1), 0), (3, near(b, 1), 0), (4, near(b, 2), 0)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, embedding array<float>, label int, digest string, id string")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in C.cap_dedup(df).collect())
    assert got == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 2, 1)]


def test_no_silent_plan(spark, monkeypatch):
    monkeypatch.setattr(C, "TRIALS", 200)
    with pytest.raises(ValueError, match="no code finds"):
        C.plan_caps(10**9, 64, threshold=0.0)


def test_caps_edges(spark):
    assert C.cap_dedup(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_caps_match_sql(spark, duck):
    want = {r[0]: r[1:] for r in duck.sql(f"SELECT vec_id, n_links, component_id, kept FROM ({C.SQL['op2_cap_dedup']})").fetchall()}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in C.query(spark, SMALL).collect()} == want
