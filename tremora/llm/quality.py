"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with a temperature.

A word counts as its letters in lower case and as its shape (signs by kind, runs as one); both are hashed to rows of
one table. Random indexing: each row has a sparse random index vector, and its word vector is the sum of its own and those
of its contexts in the sample, the words and the shapes within WINDOW words. A document is the mean of its words' vectors
and that of its shapes' vectors. The network is fitted on part of the sample, and the temperature that divides its output
on the rest.

The sample has at most SAMPLE texts of each label, which bounds the model whatever the corpus; all else is per text.

Defined cases: columns other than doc_id and text are not looked at; null and blank texts are the zero vector and get the network's output for it; equal rows get equal scores;
without labels of both kinds every score is the share of label 1, or 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, small_batches
from .labelled import WordCache, sample

SAMPLE = 4000
WORDS, SHAPES, DIM, NONZERO, WINDOW = 1 << 15, 1 << 11, 64, 6, 2
POOLED = 2 * DIM + 3
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 3e-3, 1e-4
#: Score from which a document is predicted to have label 1.
GOOD = 0.3
SEED = 11

_LETTERS = re.compile(r"[\W\d_]+")
_RUNS = ((re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a"), (re.compile(r"\d+"), "9"), (re.compile(r"([^\w])\1+"), r"\1\1"))


def codes(word: str) -> int:
    """word row * SHAPES + shape row."""
    shape = word
    for pattern, to in _RUNS:
        shape = pattern.sub(to, shape)
    return zlib.crc32(_LETTERS.sub("", word.lower()).encode()) % WORDS * SHAPES + zlib.crc32(shape.encode()) % SHAPES


def word_codes(text: str | None, cache: WordCache) -> np.ndarray:
    words = (text or "").split()
    return np.fromiter(map(cache.__getitem__, words), np.int32, len(words))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero components of each row's index vector."""
    rng = np.random.default_rng(SEED)
    n = WORDS + SHAPES
    return rng.integers(0, DIM, (n, NONZERO)), rng.choice([-1.0, 1.0], (n, NONZERO))


def random_indexing(texts: list[np.ndarray]) -> np.ndarray:
    """Vectors of all rows, at length 1 or 0, from the codes of the sample's texts."""
    place, sign = index_vectors()
    out = np.zeros((WORDS + SHAPES) * DIM)

    def add(rows: np.ndarray, near: np.ndarray) -> None:
        for k in range(NONZERO):
            out[:] += np.bincount(rows * DIM + place[near, k], sign[near, k], len(out))

    for a in range(0, len(texts), 500):  # some texts at a time, for memory
        part = texts[a : a + 500]
        all_codes = np.concatenate(part).astype(np.int64) if part else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(part)), [len(t) for t in part])
        word, shape = all_codes // SHAPES, WORDS + all_codes % SHAPES
        add(word, word)
        add(shape, shape)
        for d in range(1, WINDOW + 1):
            same = doc[d:] == doc[:-d]
            for x, y in ((slice(d, None), slice(None, -d)), (slice(None, -d), slice(d, None))):
                add(word[x][same], word[y][same])
                add(word[x][same], shape[y][same])
                add(shape[x][same], shape[y][same])
    out = out.reshape(-1, DIM)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pool(text_codes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The two mean vectors, their lengths (near 1 if few words make up the text), and the share of distinct words."""
    if not len(text_codes):
        return np.zeros(POOLED, np.float32)
    word, shape = vectors[text_codes // SHAPES].mean(0), vectors[WORDS + text_codes % SHAPES].mean(0)
    more = np.sqrt(word @ word), np.sqrt(shape @ shape), len(np.unique(text_codes)) / len(text_codes)
    return np.concatenate([word, shape, np.array(more, np.float32)])


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    prior: float | None = None

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return (np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2)[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        return 0.5 * (1 + np.tanh(0.5 * self.logit(x) / self.temperature))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """A tanh layer and a logistic one, by Adam on weighted log loss."""
    rng = np.random.default_rng(SEED)
    p = [rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, 1)) / np.sqrt(HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for a in range(0, len(x), BATCH):
            at = order[a : a + BATCH]
            h = np.tanh(x[at] @ p[0] + p[1])
            d = ((0.5 * (1 + np.tanh(0.5 * (h @ p[2] + p[3])[:, 0])) - y[at]) * weight[at] / len(at))[:, None]
            back = d @ p[2].T * (1 - h * h)
            step += 1
            for i, g in enumerate((x[at].T @ back + DECAY * p[0], back.sum(0), h.T @ d + DECAY * p[2], d.sum(0))):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return p


def calibrate(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The temperature of least weighted log loss."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
    loss = [np.sum(weight * (np.logaddexp(0, logit / t) - y * logit / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def _sampled_codes(texts: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(codes)
        for batch in batches:
            packed = [word_codes(t, cache).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], ["doc_id", "y", "codes"])

    return texts.select("doc_id", "text", "y").mapInArrow(rows, "doc_id long, y int, codes binary")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Model:
    """The model from labels (doc_id, quality) of the documents whose crc32 modulo 5 is not 0."""
    texts, counts = sample(docs, labels, "quality", fold("doc_id", 5) != 0, per_class)
    got = _sampled_codes(texts).orderBy("doc_id", F.xxhash64("codes")).collect()  # at most 2 * per_class rows
    y = np.array([r.y for r in got], np.float64)
    n = {k: int((y == k).sum()) for k in (0, 1)}
    if not n[0] or not n[1]:
        empty = np.zeros((WORDS + SHAPES, DIM), np.float32)
        return Model(empty, np.zeros(POOLED), np.ones(POOLED), [], 1.0, float(y.mean()) if len(y) else 0.5)
    texts_codes = [np.frombuffer(r.codes, np.int32) for r in got]
    rest = np.array([zlib.crc32(f"hold:{r.doc_id}".encode()) % 5 == 0 for r in got])
    if any(len(set(y[part])) < 2 for part in (rest, ~rest)):
        rest = np.zeros(len(y), bool)
    vectors = random_indexing([t for t, r in zip(texts_codes, rest) if not r])
    x = np.stack([pool(t, vectors) for t in texts_codes]).astype(np.float64)
    mean, scale = x[~rest].mean(0), x[~rest].std(0) + 1e-3
    total = counts[0] + counts[1]
    weight = np.array([counts[k] / total / n[k] for k in (0, 1)])[y.astype(int)] * len(y)
    model = Model(vectors, mean, scale, train((x[~rest] - mean) / scale, y[~rest], weight[~rest]), 1.0)
    if rest.any():
        model.temperature = calibrate(model.logit(x[rest]), y[rest], weight[rest])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(codes)
        for batch in batches:
            x = [pool(word_codes(t, cache), model.vectors) for t in batch.column(1).to_pylist()]
            p = model.probability(np.stack(x).astype(np.float64)) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= GOOD).astype(np.int32))], ["doc_id", "score", "predicted"])

    small_batches(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
