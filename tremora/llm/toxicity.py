"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity has the grades 0 to 3, and P(grade > k) = sigmoid(w.x - t_k) with one weight vector for the ordered thresholds
t_0 < t_1 < t_2. x counts, for each hashed feature, the distinct words of the text that have it: words themselves and
their beginnings. A text's w.x is thus a sum over its distinct words, each worth a fixed number.

The labels are binary. Of a toxic text, the grade is 1, 2 from GRADES[0] or 3 from GRADES[1] distinct words on that have
a feature which is typical for toxic texts. The model is fitted on at most SAMPLE texts of each label.

Defined cases: null and blank texts have no feature, and so the severity of a text without any sign; equal rows get equal
scores; without toxic labels (or without clean ones) nothing can be learned and every text has severity 0.
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

from .common import small_batches
from .labelled import WordCache, sample

FEATURES = 1 << 20
#: Texts of each label that the model is fitted on, at most.
SAMPLE = 4000
GRADES = (2, 5)
#: Least z-score of a feature's log odds between toxic and clean texts.
Z = 3.5
#: A text with a sign is toxic if P(grade > 0) is at least this: a missed text costs more than a clean one. Without any
#: sign no text is rejected, however common toxic texts are among the labels.
REJECT = 0.2

_TRIM = re.compile(r"^\W+|\W+$")


def features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: the word in lower case without outer punctuation, and its first 4, 5 and 6 letters."""
    w = _TRIM.sub("", word.lower())
    if not w:
        return ()
    return tuple(zlib.crc32(x.encode()) % FEATURES for x in (f"w:{w}", *(f"p:{w[:n]}" for n in (4, 5, 6) if len(w) >= n)))


@dataclass
class Model:
    """Weights of the features that have any, and the thresholds between grades."""

    ids: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def __post_init__(self) -> None:
        self.by_id = dict(zip(self.ids.tolist(), self.weights.tolist()))

    def word(self, word: str) -> float:
        return sum(self.by_id.get(f, 0.0) for f in features(word))

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and k."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])

    def rejects(self, scores: np.ndarray) -> np.ndarray:
        return (scores > 0) & (self.above(scores)[:, 0] >= REJECT)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(x: tuple[np.ndarray, np.ndarray, np.ndarray], shape: tuple[int, int], y: np.ndarray, weight: np.ndarray, grades: int = 4, steps: int = 400, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model by Adam; x: (row, column, value) of a sparse matrix.

    Thresholds are a first value and positive steps, so their order holds throughout.
    """
    rows, cols, vals = x
    # from thresholds near the shares of the grades, so that texts without features start right
    share = np.clip([np.average(y <= k, weights=weight) for k in range(grades - 1)], 0.01, 0.999)
    start = np.log(share / (1 - share))
    p = np.r_[np.zeros(shape[1]), start[0], np.log(np.maximum(np.diff(start), 1e-2))]
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, gaps = p[: shape[1]], np.exp(p[shape[1] + 1 :])
        t = p[shape[1]] + np.r_[0, np.cumsum(gaps)]
        s = np.bincount(rows, vals * w[cols], shape[0])
        edges = np.c_[np.full(len(y), -np.inf), np.tile(t, (len(y), 1)), np.full(len(y), np.inf)]
        at = np.arange(len(y))
        hi, lo = _sigmoid(edges[at, y + 1] - s), _sigmoid(edges[at, y] - s)
        prob = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / prob, lo * (1 - lo) / prob
        d_s = weight * (d_hi - d_lo)  # of the negative log likelihood
        d_t = np.array([np.sum(weight * (np.where(y + 1 == k, -d_hi, 0) + np.where(y == k, d_lo, 0))) for k in range(1, grades)])
        g_w = np.bincount(cols, vals * d_s[rows], shape[1]) / weight.sum() + decay * w
        g_gap = np.cumsum(d_t[::-1])[::-1][1:] * gaps
        g = np.r_[g_w, d_t.sum() / weight.sum(), g_gap / weight.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[: shape[1]], p[shape[1]] + np.r_[0, np.cumsum(np.exp(p[shape[1] + 1 :]))]


def _sampled_features(texts: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(features)
        for batch in batches:
            packed = []
            for text in batch.column(1).to_pylist():
                words = [cache[w] for w in sorted(set((text or "").split()))]
                packed.append((np.array([f for w in words for f in w], np.int32).tobytes(), np.array([len(w) for w in words], np.int8).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([a for a, _ in packed], pa.binary()), pa.array([b for _, b in packed], pa.binary())], ["doc_id", "y", "f", "n"])

    return texts.select("doc_id", "text", "y").mapInArrow(rows, "doc_id long, y int, f binary, n binary")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, learn: str = "true") -> Model:
    """The model from labels (doc_id, toxic) of the documents for which the condition `learn` on doc_id holds."""
    texts, counts = sample(docs, labels, "toxic", F.expr(learn), per_class)
    got = _sampled_features(texts).orderBy("doc_id", F.xxhash64("f")).collect()  # at most 2 * per_class rows
    y = np.array([r.y for r in got], np.int64)
    if not (y == 0).any() or not (y == 1).any():
        return Model(np.zeros(0, np.int64), np.zeros(0), np.full(3, 50.0))
    ids = [np.frombuffer(r.f, np.int32) for r in got]
    df = np.zeros((2, FEATURES), np.int32)
    for i, k in zip(ids, y):
        df[k, np.unique(i)] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()], np.float64)[:, None]
    often = np.flatnonzero(df[1] >= 3)
    seen = df[:, often].astype(np.float64)
    odds = np.log((seen + 0.5) / (n - seen + 0.5))
    z = (odds[1] - odds[0]) / np.sqrt((1 / (seen + 0.5)).sum(0) + (1 / (n - seen + 0.5)).sum(0))
    # features that no clean text has count from 3 toxic texts on: rare ones reach no high z, however clear they are
    chosen = often[(z >= Z) | (seen[0] == 0)]  # signs of clean texts excuse nothing
    typical = np.zeros(FEATURES, bool)
    typical[chosen] = True
    n = n[:, 0]
    place = np.full(FEATURES, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    grade = np.zeros(len(y), np.int64)
    rows, cols = [], []
    for i, (r, f) in enumerate(zip(got, ids)):
        owner = np.repeat(np.arange(len(r.n)), np.frombuffer(r.n, np.int8))
        if y[i]:
            grade[i] = 1 + np.searchsorted(GRADES, len(np.unique(owner[typical[f]])), "right")
        c = place[f]
        cols.append(c[c >= 0])
        rows.append(np.full(len(cols[-1]), i))
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    total = counts.get(0, 0) + counts.get(1, 0)
    weight = np.array([counts[k] / total / n[k] for k in (0, 1)])[y] * len(y)
    w, t = fit_ordinal((rows, cols, np.ones(len(rows))), (len(y), len(chosen)), grade, weight)
    return Model(chosen, w, t)


def _scores(model: Model, texts: pa.Array, cache: WordCache) -> np.ndarray:
    return np.array([sum(map(cache.__getitem__, set(t.split()))) if t else 0.0 for t in texts.to_pylist()], np.float64)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, p_toxic, toxic): the expected grade, P(grade > 0), and whether that rejects the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(model.word)
        for batch in batches:
            scores = _scores(model, batch.column(1), cache)
            above = model.above(scores)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(model.rejects(scores))], ["doc_id", "severity", "p_toxic", "toxic"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, severity double, p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, whose text the model does not reject."""
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(model.word)
        for batch in batches:
            yield batch.filter(pa.array(~model.rejects(_scores(model, batch.column(at), cache))))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(rows, docs.schema)
