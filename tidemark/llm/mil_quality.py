"""Quality classifier by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import table

#: Words of a passage, hashed trigram features, hidden units, attention units.
PASSAGE_WORDS, HASHED, HIDDEN, ATTENTION = 48, 512, 24, 16
#: Most labelled documents of each class that the model is fitted on, with all of their passages.
MOST_PER_CLASS = 1000
EPOCHS, BATCH, RATE, DECAY = 30, 64, 3e-3, 1e-4
KEEP = 0.7
#: Byte classes whose shares are features: capitals, symbols, digits, beyond ASCII, other punctuation.
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&|<>", b"0123456789", bytes(range(128, 256)), b"!?.,;:'\"()[]{}-_/\\@^~`+="]
WIDTH = HASHED + len(_CLASSES) + 2
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _k, _b in enumerate(_CLASSES):
    _CLASS[list(_b)] = _k


def encode_passages(text: bytes | None, words: int = PASSAGE_WORDS) -> np.ndarray:
    """A row of features for every passage of ``words`` words of a whole text (one row of zeros without words).

    Hashed byte trigrams by log counts at unit length, shares of the byte classes, the share of distinct trigrams and
    the mean word length. All passages are counted together.
    """
    b = np.frombuffer(text or b"", np.uint8)
    blank = _BLANK[b]
    starts = ~blank & np.concatenate([[True], blank[:-1]]) if len(b) else np.zeros(0, bool)
    n_words = int(starts.sum())
    if not n_words:
        return np.zeros((1, WIDTH), np.float32)
    n = (n_words - 1) // words + 1
    place = np.maximum(np.cumsum(starts) - 1, 0) // words
    x = b.astype(np.uint32)
    h = (x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    grams = np.bincount(place[: len(h)] * HASHED + (h >> np.uint32(23)).astype(np.int64), minlength=n * HASHED).reshape(n, HASHED)
    size = np.maximum(np.bincount(place, minlength=n), 1)[:, None]
    shares = np.bincount(place * (len(_CLASSES) + 1) + _CLASS[b], minlength=n * (len(_CLASSES) + 1)).reshape(n, -1)[:, :-1] / size
    distinct = (grams > 0).sum(1, keepdims=True) / np.maximum(np.minimum(grams.sum(1, keepdims=True), HASHED), 1)
    per_word = size / np.maximum(np.bincount(place[starts], minlength=n), 1)[:, None]
    logs = np.log1p(grams)
    logs /= np.maximum(np.linalg.norm(logs, axis=1, keepdims=True), 1e-9)
    return np.concatenate([logs, shares * 4, distinct * 2, np.minimum(per_word, 40) / 10], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class AttentionModel:
    """h = tanh(xW + b); weights softmax(w . (tanh(hV) * sigmoid(hU))); score sigmoid(c . sum(weights h) + d)."""

    p: dict[str, np.ndarray]

    def attend(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        h = np.tanh(x @ self.p["W"] + self.p["b"])
        t, s = np.tanh(h @ self.p["V"]), _sigmoid(h @ self.p["U"])
        return h, t, s, (t * s) @ self.p["w"]

    def score(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Score of one document and its passages' weights."""
        h, _, _, e = self.attend(x)
        a = np.exp(e - e.max())
        a /= a.sum()
        return float(_sigmoid(self.p["c"] @ (a @ h) + self.p["d"])[0]), a


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> AttentionModel:
    """Adam on the class-weighted cross-entropy of document labels; passages have no labels of their own."""
    rng = np.random.default_rng(seed)
    init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float64)
    p = {"W": init(WIDTH, HIDDEN) * 2, "b": np.zeros(HIDDEN), "V": init(HIDDEN, ATTENTION), "U": init(HIDDEN, ATTENTION), "w": init(ATTENTION), "c": init(HIDDEN), "d": np.zeros(1)}
    model, m, v, step = AttentionModel(p), {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    share = np.array([max((labels == k).sum() / max(len(labels), 1), 1e-6) for k in (0, 1)])
    # a good text lost costs more than a bad one kept
    weight = np.array([0.35, 0.65])[labels] / share[labels]
    for _ in range(EPOCHS if len(bags) else 0):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            rows = order[lo : lo + BATCH]
            n = np.array([len(bags[i]) for i in rows])
            x, seg = np.concatenate([bags[i] for i in rows]).astype(np.float64), np.repeat(np.arange(len(rows)), n)
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            h, t, s, e = model.attend(x)
            e = np.exp(e - np.maximum.reduceat(e, first)[seg])
            a = e / np.add.reduceat(e, first)[seg]
            z = np.add.reduceat(a[:, None] * h, first)
            dy = (_sigmoid(z @ p["c"] + p["d"]) - labels[rows]) * weight[rows] / len(rows)
            dz = dy[:, None] * p["c"]
            da = (h * dz[seg]).sum(1)
            de = a * (da - np.add.reduceat(a * da, first)[seg])
            g = de[:, None] * p["w"]
            dt, ds = g * s * (1 - t * t), g * t * s * (1 - s)
            dh = (a[:, None] * dz[seg] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
            grads = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ dy, "d": np.array([dy.sum()])}
            step += 1
            for k, gr in grads.items():
                gr = gr + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * gr
                v[k] = 0.999 * v[k] + 0.001 * gr * gr
                p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return AttentionModel({k: x.astype(np.float32) for k, x in p.items()})


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_bags(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[list[np.ndarray], np.ndarray]:
    """All passages of a bounded, balanced sample of the labelled documents that are not held out, first by a hash of the id."""
    usable = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picks = [usable.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    sample = picks[0].union(picks[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [encode_passages(text).astype(np.float16).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(bags, pa.binary()), batch.column(2)], ["doc_id", "bag", "quality"])

    # at most twice per_class documents; of rows that share an id the one with the smallest text
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = rows.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"), F.col("quality").cast("int"))
    got = sorted(rows.mapInArrow(run, "doc_id bigint, bag binary, quality int").collect(), key=lambda r: (r["doc_id"], bytes(r["bag"])))
    return [np.frombuffer(r["bag"], np.float16).reshape(-1, WIDTH) for r in got], np.array([r["quality"] for r in got], np.int64)


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = MOST_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages and top_passage (the one that weighs most) for every row of ``docs``.

    Only ``text`` enters a score; labels (doc_id, quality) of documents that are not held out train the model. Texts
    that are null or without words are one passage of zeros and get the model's score for it; very long texts have all
    of their passages scored; of passages that weigh the same the first is ``top_passage``. Null doc_ids are not held
    out; repeated rows score alike, and of rows that share a sampled id the smallest text is fitted on; without any usable
    labels scores come from the untrained model; an empty table gives no rows; other columns are ignored.
    """
    model = fit(*training_bags(docs, labels, per_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, counts, tops = [], [], []
            for lo in range(0, batch.num_rows, 1000):
                for text in batch.column(2).slice(lo, 1000).to_pylist():
                    y, a = model.score(encode_passages(text))
                    scores.append(y)
                    counts.append(len(a))
                    tops.append(int(a.argmax()))
            y = np.array(scores)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(y, pa.float64()), pa.array((y >= KEEP).astype(np.int32)), pa.array(counts, pa.int64()), pa.array(tops, pa.int64())], ["doc_id", "held_out", "score", "predicted", "n_passages", "top_passage"])

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, n_passages bigint, top_passage bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_mil_quality": query}
SQL: dict[str, str] = {}
