"""Toxicity, quality and language: held-out accuracy on a fixture, the parts against plain versions, awkward rows."""

import random
import zlib

import numpy as np
import pytest
from helpers import DOCS, awkward_docs
from pyspark.sql import functions as F

from tremora.llm import langid, quality, toxicity
from tremora.llm.common import table

LABELS = "doc_id long, quality int, toxic int"
BAD = ["snarkle", "grumbet", "vexling", "dorfus"]
SYLLABLES = {"xx": "ka lo mi ta ru ne".split(), "yy": "sch ung pfe tzo ber gri".split(), "zz": "eau oi que ment ré ai".split()}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(600):
        lang = rng.choice(sorted(SYLLABLES))
        w = text_of(rng, lang, rng.randrange(10, 80)).split()
        toxic, good = int(rng.random() < 0.2), int(rng.random() < 0.7)
        if toxic:
            for _ in range(rng.randrange(1, 6)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        if not good:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x + rng.choice(["%%%", "&&&"]) for x in w]
        docs.append((i, " ".join(w), lang, f"s{i % 3}", 0))
        labels.append((i, good, toxic))
    return docs, labels


def test_toxicity_held_out(spark, corpus):
    docs, labels = (spark.createDataFrame(d, s) for d, s in zip(corpus, (DOCS, LABELS)))
    model = toxicity.fit(docs, labels, learn="doc_id % 4 > 0")
    out = toxicity.score(docs, model).join(labels, "doc_id").where("doc_id % 4 = 0").collect()
    truth = {r.doc_id: t for r in out for d, _, t in [corpus[1][r.doc_id]] if d == r.doc_id}
    assert all(r[3] == bool(truth[r.doc_id]) for r in out)
    kept = toxicity.keep_clean(docs.withColumn("y", F.lit("clash")), model)
    assert kept.columns == [*docs.columns, "y"]
    assert {r.doc_id for r in kept.collect()} == {d for d, _, t in corpus[1] if not t}


def test_severity_grows_with_signs(spark, corpus):
    docs, labels = (spark.createDataFrame(d, s) for d, s in zip(corpus, (DOCS, LABELS)))
    model = toxicity.fit(docs, labels)
    base = text_of(random.Random(1), "xx", 30)
    probe = spark.createDataFrame([(k, " ".join([base, *BAD[:k]]), None, None, None) for k in range(5)], DOCS)
    severity = [r.severity for r in toxicity.score(probe, model).orderBy("doc_id").collect()]
    assert severity == sorted(severity) and severity[0] < 0.3 < 1.5 < severity[4] <= 3


def test_ordinal_fit_recovers_order():
    """Thresholds come out in order, and the weight of the informative feature is the largest."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, (800, 3)).astype(float)
    latent = 2.0 * x[:, 0] + rng.logistic(size=800)
    y = np.searchsorted([1.0, 2.5, 4.0], latent)
    rows, cols = np.nonzero(x)
    w, t = toxicity.fit_ordinal((rows, cols, x[rows, cols]), (800, 3), y, np.ones(800))
    assert (np.diff(t) > 0).all()
    assert w[0] == pytest.approx(2.0, abs=0.4) and abs(w[1]) < 0.3 and abs(w[2]) < 0.3
    assert t == pytest.approx([1.0, 2.5, 4.0], abs=0.5)


def test_quality_held_out(spark, corpus):
    docs, labels = (spark.createDataFrame(d, s) for d, s in zip(corpus, (DOCS, LABELS)))
    out = quality.score(docs, quality.fit(docs, labels)).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    truth = {d: g for d, g, _ in corpus[1]}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_random_indexing_is_context():
    """Words among words of like shapes have like vectors, whatever their spelling."""
    rng = random.Random(3)
    cache = {}
    code = lambda w: cache.setdefault(w, quality.codes(w))
    texts = []
    for _ in range(300):
        for group in (["alpha", "beta"], ["gamma", "delta"]):
            near = [f"near{rng.randrange(4)}" if group[0] == "alpha" else f"NEAR{'!' * rng.randrange(3)}" for _ in range(4)]
            texts.append(np.array([code(w) for w in (*near[:2], rng.choice(group), *near[2:])], np.int32))
    v = quality.random_indexing(texts)
    of = lambda w: v[quality.codes(w) // quality.SHAPES]
    assert of("alpha") @ of("beta") > of("alpha") @ of("gamma") + 0.2
    assert np.linalg.norm(of("alpha")) == pytest.approx(1.0, abs=1e-5)


def test_temperature_minimises_loss():
    rng = np.random.default_rng(4)
    true = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-true))).astype(float)
    assert quality.calibrate(3.0 * true, y, np.ones(4000)) == pytest.approx(3.0, rel=0.15)


def test_language_held_out(spark, corpus):
    docs = spark.createDataFrame(corpus[0], DOCS)
    out = langid.identify(docs).collect()
    assert {r.doc_id for r in out if r.held_out} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1}
    truth = {d: lang for d, _, lang, *_ in corpus[0]}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out if r.held_out]) >= 0.98
    assert all(0 <= r.score <= 1 for r in out)


def test_mixtures_have_their_proportions(spark, corpus):
    rng = random.Random(6)
    mixed = [(1000 + k, text_of(rng, "xx", 100 - 10 * k) + " " + text_of(rng, "yy", 10 * k), None, None, None) for k in (0, 3, 7)]
    docs = spark.createDataFrame(corpus[0] + mixed, DOCS)
    got = {r.doc_id: r for r in langid.identify(docs).where("doc_id >= 1000").collect()}
    assert got[1000].languages == ["xx"]
    assert got[1003].languages == ["xx", "yy"] and got[1007].languages == ["yy", "xx"]
    assert got[1003].proportions[0] == pytest.approx(0.7, abs=0.08) and got[1007].score == pytest.approx(0.7, abs=0.08)


def test_em_on_all_texts_is_em_on_each():
    rng = np.random.default_rng(2)
    sizes = np.array([3, 1, 40, 7])
    like = rng.random((sizes.sum(), 3)).astype(np.float32) + 0.01
    together = langid.proportions(like, sizes)
    at = 0
    for p, n in zip(together, sizes):
        assert p == pytest.approx(langid._em(like[at : at + n].astype(float))[0], abs=1e-4)
        at += n


def test_grams_of_words_do_not_touch():
    together = langid.grams(["ab", "c", "défg"])
    alone = [langid.grams([w]) for w in ("ab", "c", "défg")]
    for k in (0, 1):
        assert together[k].tolist() == [x for a in alone for x in a[k].tolist()]
    assert together[2].tolist() == [0, 3, 5]


def test_awkward_rows(spark, sf):
    """Every row comes back once, with defined values; whatever is null."""
    data = awkward_docs()
    docs = spark.createDataFrame(data, DOCS).withColumn("y", F.lit(1)).withColumn("label", F.lit("clash"))
    labels = table(spark, sf, "labels").unionByName(spark.createDataFrame([(0, None, None), (None, 1, 1), (0, 1, 1), (0, 0, 0), (2, 1, 0), (3, 0, 1)], LABELS))
    tox = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    qual = quality.score(docs, quality.fit(docs, labels)).collect()
    lang = langid.identify(docs).collect()
    for out in (tox, qual, lang):
        assert sorted(map(repr, (r.doc_id for r in out))) == sorted(map(repr, (d for d, *_ in data)))
    und = {r.doc_id for r in lang if r.lang_pred == "und"}
    assert {3, 4, 5, 50} <= und and all(r.score == 0 for r in lang if r.lang_pred == "und")
    assert not any(r.held_out for r in lang if r.doc_id is None)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame(awkward_docs(), DOCS)
    for labels in (spark.createDataFrame([], LABELS), spark.createDataFrame([(1, 1, 0)], LABELS)):
        assert {r.toxic for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {False}
        assert len({r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}) == 1
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    empty = spark.createDataFrame([], DOCS)
    assert langid.identify(empty).collect() == [] and toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []


@pytest.mark.parametrize("few", [0, 100, 300])
def test_small_parts_of_long_texts_are_found(few):
    """100 or 300 words of the third language in 20,000, behind a larger proportion that the words don't bear out."""
    like = np.full((20_000, 4), 1e-6, np.float32)
    like[:, 0], like[:, 1] = 1, 0.5
    like[:few] = [1e-4, 1e-6, 1, 1e-6]
    p, chosen = langid.choose(langid.proportions(like, np.array([len(like)]))[0], like)
    assert chosen == ([0, 2] if few else [0])
    if few:
        assert p[2] == pytest.approx(few / len(like), rel=0.05)
