import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, k string, ratio string, spans string, component_id string, ids string, quality string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and blank texts, ties, repeated rows, a very long text, clashing columns."""
    line = " ".join(f"w{i}" for i in range(60))
    texts = [
        (1, line), (2, None), (None, "a b c d e f"), (3, ""), (3, ""), (4, " \t\n "), (5, " ".join(f"v{i % 977}" for i in range(30_000))),
        (6, f"head\n{line}\n\ntail"), (7, f"{line} x"), (8, line.upper()), (9, "one two"), (10, "One  TWO"), (11, "naïve café\u00a0x\x1fy 'tis don't 12 !!"), (12, "r " * 40),
    ]
    rows = [(d, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", None if t is None else len(t), *(["x"] * 8)) for i, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
