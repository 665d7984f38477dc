"""The pipeline: each stage against a plain version on what its predecessor kept, and what run() returns."""

import os
import random
import re
from collections import Counter

import pytest
from helpers import DOCS, awkward_docs, edited, prose
from pyspark.sql import functions as F
from test_joins import plain_components, plain_tiles

import corpus_pipeline as pipeline
from tremora.llm import toxicity
from tremora.llm.common import materialize, table

COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf):
    """What each stage got and gave."""
    docs, out = table(spark, sf, "documents"), []
    for name, stage in pipeline.STAGES:
        after = materialize(stage(spark, docs, sf), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_are_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]


def test_columns(steps):
    assert all(after.columns == COLS for _, _, after in steps[:-1])


def test_toxic_documents_go(spark, sf, steps):
    _, before, after = steps[0]
    model = toxicity.fit(before, table(spark, sf, "labels"))
    want = {r.doc_id for r in toxicity.score(before, model).where("not toxic").collect()}
    assert {r.doc_id for r in after.collect()} == want
    clean = {r.doc_id for r in table(spark, sf, "labels").where("toxic = 0").collect()}
    assert clean & {r.doc_id for r in before.collect()} <= want


def test_one_of_each_component_stays(steps):
    _, before, after = steps[1]
    data = [tuple(r) for r in before.select(*COLS).collect()]
    assert sorted(r.doc_id for r in after.collect()) == [d for d, _, c in sorted(plain_components(data)) if d == c]


def test_contaminated_documents_go(spark, sf, steps):
    _, before, after = steps[2]
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    kept = {r.doc_id for r in after.collect()}
    seeds = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for i in range(len(w) - 4)}
    for r in before.collect():
        # tiling by the book only where a shared seed lets it find anything
        hits = [t for t in items if seeds(r.text) & seeds(t)]
        covered = [plain_tiles(r.text, t) for t in hits if len(r.text) < 4000]
        if any(c >= 0.5 * n for c, n in covered):
            assert r.doc_id not in kept
        elif not hits:
            assert r.doc_id in kept


def test_mix_repeats_and_drops(steps):
    from tremora.llm import mixing

    _, before, after = steps[3]
    want = {r.doc_id: r.epochs + (r.extra > 0) for r in mixing.mix(before).collect() if r.taken}
    got = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == want and any(n > 1 for n in got.values())


def test_sharding_keeps_all(steps):
    _, before, after = steps[4]
    assert after.count() == before.count()
    assert {r.law for r in after.select("law").distinct().collect()} == {"bytes"}


def test_run_is_the_stages(spark, sf, steps):
    assert sorted(map(tuple, pipeline.run(spark, sf).collect())) == sorted(map(tuple, steps[-1][2].collect()))


def test_awkward_rows(spark, tmp_path):
    """Nulls, repeats, long and empty texts pass through all stages."""
    for name, data, schema in (("documents", awkward_docs(), DOCS), ("labels", [(1, 1, 0), (2, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int"), ("benchmark", [(1, "one two three four five six seven"), (2, None)], "item_id long, text string")):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(os.fspath(tmp_path / f"{name}.parquet"))
    out = pipeline.run(spark, os.fspath(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {d for d, *_ in awkward_docs()} and out


def plain_similar(data):
    """Of each component the least of (no id, id, digest of the text), one row of it."""
    import hashlib

    ranked = [((r[0] is None, r[0] if r[0] is not None else 0, hashlib.md5((r[1] or "").encode()).hexdigest()), r) for r in data]
    names = sorted({k for k, _ in ranked})
    number = {k: i for i, k in enumerate(names)}
    low = {d: c for d, _, c in plain_components([(number[k], r[1]) for k, r in ranked])}
    best = {}
    for k, r in sorted(ranked, key=lambda x: (x[0], (x[1][2] is not None, x[1][2] or ""), (x[1][3] is not None, x[1][3] or ""))):
        if low[number[k]] == number[k]:
            best.setdefault(k, r)
    return sorted(best.values(), key=repr)


def test_rows_without_id(spark):
    a, b = (prose(random.Random(i), 30) for i in (1, 2))
    keep = lambda data: sorted((tuple(r) for r in pipeline.drop_similar(spark, spark.createDataFrame(data, DOCS), "").collect()), key=repr)
    row = lambda i, t: (i, t, None, None, None)
    assert keep([row(5, a), row(None, a), row(None, b)]) == [row(5, a), row(None, b)]
    assert keep([row(5, a), row(None, a)]) == [row(5, a)]
    assert keep([row(None, a), row(None, a), row(None, b), row(-3, b), row(2**62, b)]) == sorted([row(None, a), row(-3, b)], key=repr)
    rng = random.Random(7)
    data = [(i if rng.random() < 0.6 else None, edited(rng, t, rng.randrange(2)), rng.choice(["en", None]), rng.choice(["s", None]), None) for i, t in enumerate([a, b] * 8)]
    data += [*awkward_docs(), *data[:5]]
    assert keep(data) == plain_similar(data)


def test_other_columns_stay(spark, sf, tmp_path):
    """Columns with the names that stages use inside come through each stage as they are, null ids and repeats too."""
    names = ["copies", "copy", "t_", "i_", "s_", "place_", "kept_id_", "place", "kept", "mixed_id", "mixed_source", "mixed_tie", "tie", "bucket", "key", "taken", "extra", "n"]
    for name, data, schema in (("labels", [(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int"), ("benchmark", [(1, "one two three four five six seven")], "item_id long, text string")):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(os.fspath(tmp_path / f"{name}.parquet"))
    plain = spark.createDataFrame(awkward_docs(), DOCS)
    more = plain.withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for n in names})
    for _, stage in pipeline.STAGES[:-1]:
        got = stage(spark, more, os.fspath(tmp_path))
        assert got.columns == more.columns
        got = got.collect()
        assert Counter(tuple(r)[:5] for r in got) == Counter(map(tuple, stage(spark, plain, os.fspath(tmp_path)).collect()))
        assert all(r[n] == f"{n}{'' if r.doc_id is None else r.doc_id}" for r in got for n in names)
    assert pipeline.deal_shards(spark, more, "").count() == plain.count()


def test_stages_of_no_rows(spark, sf):
    none = spark.createDataFrame([], DOCS)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, sf).collect() == []
