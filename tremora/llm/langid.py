"""Language identification as mixture inference: the proportions of languages in each document by expectation-maximisation.

Each language has a character trigram model of words with hashed counts. A document is a mixture: a word comes from
language l with the proportion of l, and EM finds the proportions from the words' likelihoods. Which languages count is
chosen by penalised likelihood: from the largest proportion down, each of the k languages in the set has to raise
log likelihood - PENALTY * k * log(words). However small its proportion, a language is tried.

The models are fitted on about SAMPLE documents of each language, chosen by a hash, and have CELLS counts at most: up to
512 languages have BUCKETS buckets each, twice as many languages half of that.

Defined cases: a text that is null or has no letter is `und` with score 0, as is every text if nothing could be learned;
words without letters don't count; equal rows get equal results; ties go to the first language in code point order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, small_batches

SAMPLE = 1500
BUCKETS, CELLS = 1 << 16, 1 << 25
ROUNDS = 8
PENALTY = 2.0
_SMOOTH = 0.05


def clean(word: str) -> str:
    """The letters of a word in lower case."""
    w = word.lower()
    return w if w.isalpha() else "".join(filter(str.isalpha, w))


_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def buckets_for(languages: int) -> int:
    """Buckets of each language's model: a power of two, BUCKETS at most, and CELLS of all languages."""
    return min(BUCKETS, 1 << max(8, (CELLS // max(1, languages)).bit_length() - 1))


def grams(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of padded words, their hashed contexts (the first two signs), and where each word's begin."""
    text = np.frombuffer("".join(f"  {w} " for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths + 3)
    whole = np.ones(max(0, len(text) - 2), bool)
    for back in (1, 2):  # trigrams that run into the next word
        at = ends[:-1] - back
        whole[at[at < len(whole)]] = False
    ctx = text[:-2] * _A + text[1:-1] * _B
    spread = lambda x: ((x ^ (x >> np.uint64(29))) * _C >> np.uint64(40)).astype(np.int64) % buckets
    return spread(ctx * _B + text[2:] * _C)[whole], spread(ctx)[whole], np.cumsum(lengths + 1) - (lengths + 1)


@dataclass
class Model:
    languages: list[str]
    #: By hashed trigram and by hashed context, a column a language: log counts with some mass for unseen ones.
    tri: np.ndarray
    ctx: np.ndarray

    def words(self, words: list[str]) -> np.ndarray:
        """Likelihood of each (clean, non-empty) word in each language, relative to its greatest."""
        t, c, starts = grams(words, len(self.tri))
        ll = np.add.reduceat(self.tri[t] - self.ctx[c], starts, axis=0)
        return np.maximum(np.exp(ll - ll.max(1, keepdims=True)), 1e-30).astype(np.float32)


class Likelihoods:
    """Rows of likelihoods for words, kept for up to `most` of them; row 0 stands for words without letters."""

    def __init__(self, model: Model, most: int = 400_000):
        self.model, self.most, self.rows = model, most, {}
        #: Grows by doubling; `used` rows of it count.
        self.table, self.used = np.ones((1024, max(1, len(model.languages))), np.float32), 1

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For each text, the rows of its words with letters."""
        if len(self.rows) > self.most:
            self.rows, self.used = {}, 1
        new = [w for w in dict.fromkeys(w for words in texts for w in words) if w not in self.rows]
        letters = [clean(w) for w in new]
        fresh = [w for w in letters if w]
        at = self.used
        for w, c in zip(new, letters):
            self.rows[w] = at if c else 0
            at += bool(c)
        if fresh:
            if at > len(self.table):
                grown = np.empty((max(at, 2 * len(self.table)), self.table.shape[1]), np.float32)
                grown[: self.used] = self.table[: self.used]
                self.table = grown
            self.table[self.used : at] = self.model.words(fresh)
            self.used = at
        out = [np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words)) for words in texts]
        return [r[r > 0] for r in out]


def _em(like: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions and log likelihood of a mixture of the columns."""
    n, k = like.shape
    p = np.full(k, 1 / k)
    for _ in range(ROUNDS if k > 1 else 0):
        p = p * ((1 / (like @ p)) @ like) / n
    return p, float(np.log(like @ p).sum())


def proportions(like: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Proportions in each of several texts whose words' likelihoods lie end to end, by the same EM on all at once."""
    starts, k = np.cumsum(sizes) - sizes, like.shape[1]
    p = np.full((len(sizes), k), 1 / k, np.float32)
    for _ in range(ROUNDS):
        mine = like * np.repeat(p, sizes, axis=0)
        p = np.add.reduceat(mine / mine.sum(1, keepdims=True), starts, axis=0) / sizes[:, None]
    return p


def choose(p: np.ndarray, like: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Proportions and the chosen set, largest first, from the proportions over all languages and the words' likelihoods."""
    order = [int(i) for i in np.argsort(-p, kind="stable") if p[i] > 0]
    if len(order) < 2:
        return p, [int(np.argmax(p))]
    n, penalty = len(like), PENALTY * np.log(len(like) + 1)

    def most() -> np.ndarray:
        """What each language can add to the log likelihood at most: it is concave, so no more than along its slope."""
        slope = (1 / (like[:, chosen] @ parts)).astype(np.float32) @ like - n
        return np.maximum(slope, slope[chosen].max())

    chosen, parts, ll = order[:1], *_em(like[:, order[:1]].astype(np.float64))
    gain = most()
    for i in order[1:]:
        if gain[i] <= penalty:
            continue
        q, more = _em(like[:, [*chosen, i]].astype(np.float64))
        if more - ll > penalty:
            chosen, parts, ll = [*chosen, i], q, more
            gain = most()
    if len(chosen) == 1:
        return p, chosen
    out = np.zeros(len(p))
    out[chosen] = parts
    return out, [chosen[i] for i in np.argsort(-parts, kind="stable")]


def fit(docs: DataFrame, learn: Column, per_language: int = SAMPLE) -> Model:
    """The model from text and non-null lang of the documents for which the condition on doc_id holds."""
    known = docs.where(F.col("lang").isNotNull()).where(learn)
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row a language
    buckets = buckets_for(len(counts))
    if not counts:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((BUCKETS, 0)))
    languages = sorted(r.lang for r in counts)
    # a share of each language's documents by hash: about per_language of them, or all
    share = F.element_at(F.create_map(*(F.lit(x) for r in counts for x in (r.lang, min(1.0, per_language / r.n)))), F.col("lang"))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if words := [c for w in (text or "").split() if (c := clean(w))]:
                    for kind, found in zip(counts.setdefault(lang, [np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)]), grams(words, buckets)):
                        kind += np.bincount(found, minlength=buckets)
        for lang, (tri, ctx) in counts.items():
            yield pa.RecordBatch.from_pylist([{"lang": lang, "tri": tri.tobytes(), "ctx": ctx.tobytes()}])

    # the sample is bounded, and so is what a few tasks count of it
    found = chosen.repartition(8).mapInArrow(rows, "lang string, tri binary, ctx binary")
    tri, ctx = np.zeros((len(languages), buckets)), np.zeros((len(languages), buckets))
    for r in found.toLocalIterator():
        i = languages.index(r.lang)
        tri[i] += np.frombuffer(r.tri, np.int64)
        ctx[i] += np.frombuffer(r.ctx, np.int64)
    seen = np.maximum((tri > 0).sum(1, keepdims=True), 1)
    # unseen trigrams get a little of the context's mass
    log = lambda x: np.ascontiguousarray(np.log(x).T, np.float32)
    return Model(languages, log(tri + _SMOOTH), log(ctx + _SMOOTH * np.sqrt(seen)))


OUT = "doc_id long, lang_pred string, score double, languages array<string>, proportions array<double>"


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, languages, proportions); languages: the chosen set, score: the largest proportion."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())), ("proportions", pa.list_(pa.float64()))])
        cache = Likelihoods(model)

        def flush(texts: list[list[str]]) -> list[tuple]:
            found = cache.of(texts) if model.languages else [np.zeros(0, np.int64)] * len(texts)
            some = [i for i, f in enumerate(found) if len(f)]
            out: list[tuple] = [("und", 0.0, [], [])] * len(texts)
            if some:
                sizes = np.array([len(found[i]) for i in some])
                like = cache.table[np.concatenate([found[i] for i in some])]
                ends = np.cumsum(sizes)
                for i, p, end, n in zip(some, proportions(like, sizes), ends.tolist(), sizes.tolist()):
                    p, chosen = choose(p, like[end - n : end])
                    out[i] = (model.languages[chosen[0]], float(min(1.0, p[chosen[0]])), [model.languages[c] for c in chosen], [float(p[c]) for c in chosen])
            return out

        for batch in batches:
            out, texts, held = [], [], 0
            for text in batch.column(1).to_pylist():
                texts.append((text or "").split())
                held += len(texts[-1])
                if held > 300_000:  # words at a time, for memory
                    out += flush(texts)
                    texts, held = [], 0
            out += flush(texts)
            out = [(i, *o) for i, o in zip(batch.column(0).to_pylist(), out)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, OUT)


def identify(docs: DataFrame) -> DataFrame:
    """Fits on the documents whose crc32 modulo 3 is not 1, and predicts for all; held_out marks the others."""
    model = fit(docs, fold("doc_id", 3) != 1)
    out = predict(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages", "proportions")
