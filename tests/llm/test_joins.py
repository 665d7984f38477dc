"""Near-duplicate operators and decontamination against brute force, with cells, blocks and buckets made small."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import DOCS, Find, awkward_docs, edited, prose, words
from pyspark.sql import functions as F

from tremora.llm import decontamination, embedding_dedup, ngram_join
from tremora.llm.common import components, shingles, table, text_chunks


def shingle_set(text):
    w = words(text)
    return frozenset(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(data):
    sets = [(d, shingle_set(t)) for d, t, *_ in data]
    find = Find()
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            n = len(a & b)
            if a and b and 100 * n >= 80 * (len(a) + len(b) - n):
                find.join(i, j)
    low = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        if s and d is not None:
            low[find(i)].append(d)
    return sorted(((d, len(s), min(low[find(i)], default=None) if s else d) for i, (d, s) in enumerate(sets)), key=repr)


def found(spark, data, **kw):
    return sorted((tuple(r) for r in ngram_join.similar_sets(spark.createDataFrame(data, DOCS), **kw).collect()), key=repr)


def family(seed=3, bases=8, copies=12):
    """Families of near copies, chains of copies of copies, a passage that all share, and loners."""
    rng = random.Random(seed)
    passage, out = prose(rng, 30), []
    for _ in range(bases):
        text = prose(rng, rng.randrange(20, 160))
        for k in range(copies):
            text = edited(rng, text, rng.randrange(0, 3)) if k % 3 else text
            out.append(text if rng.random() < 0.7 else f"{passage} {text}")
    out += [prose(rng, 50) for _ in range(10)] + [passage] * 5
    rng.shuffle(out)
    return [(i, t, None, None, None) for i, t in enumerate(out)]


def test_similar_sets(spark):
    data = family()
    assert found(spark, data) == plain_components(data)


def test_similar_sets_in_blocks(spark):
    """Cells far above the limit go through block pairs, and give the same components."""
    data = family(4, 2, 60)
    assert found(spark, data, cell=8, bucket=500) == plain_components(data)


def chain(n, size=60, shared=50):
    """Sets that share shingles with the one before and after, none of them enough to link."""
    step = size - shared // 2
    return [(i, " ".join(f"w{i * step + j}" for j in range(size)), None, None, None) for i in range(n)]


def test_chains_make_no_large_groups(spark):
    """Neighbours in a long chain share rare shingles, and no two link: lists stay short, whatever the chain's length."""
    data = chain(400, 30, 29)
    assert found(spark, data) == plain_components(data)
    data = [(i, " ".join(f"w{3 * i + j}" for j in range(20)), None, None, None) for i in range(3000)]
    assert found(spark, data) == sorted(((i, 16, i) for i, *_ in data), key=repr)


def plain_links(data):
    sets = [(d, shingle_set(t)) for d, t, *_ in data]
    near = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    return sorted(((d, sum(bool(near(a, b)) for j, (_, b) in enumerate(sets) if i != j)) for i, (d, a) in enumerate(sets)), key=repr)


@pytest.mark.parametrize("cell", [4096, 8])
def test_links_are_counted(spark, cell):
    data = [*family(6, 3, 20), *awkward_docs()]
    got = ngram_join.similar_sets(spark.createDataFrame(data, DOCS), cell=cell, links=True).select("doc_id", "n_links").collect()
    assert sorted(map(tuple, got), key=repr) == plain_links(data)


def test_classes_that_share_a_number(spark):
    """With 3 bits almost all classes share their number with others."""
    data = [*family(7, 4, 10), *awkward_docs()]
    assert found(spark, data, bits=3) == plain_components(data)


def test_hot_shingles(spark):
    data = family(8)
    assert found(spark, data, hot=20, bucket=300) == plain_components(data)


@pytest.mark.parametrize("buckets", [1, 12, 256, 300, 65536, 1_000_003])
def test_shingles_keep_all_bits(buckets):
    """A shingle's bucket and the bytes that it keeps there say which it was."""
    rng = np.random.default_rng(1)
    tokens = np.concatenate([rng.integers(0, 2**64, 1000, dtype=np.uint64), np.array([0, 2**64 - 1, 2**32, 2**48, 2**48 + 5], np.uint64)])
    for t in tokens.tolist():
        b = ((t >> 32) * buckets) >> 32
        rest = t - ngram_join._start(b, buckets)
        assert 0 <= rest < 1 << 8 * ngram_join._width(buckets)
    assert ngram_join._width(256) == 7 and ngram_join._width(65536) == 6


def test_joins_ignore_other_columns(spark):
    """Extra columns with the names that the operators use inside change nothing."""
    names = ["cls", "check", "token", "component", "label", "copies", "n", "tokens", "cell", "rep"]
    data = [*family(9, 3, 8), *awkward_docs()]
    docs = spark.createDataFrame(data, DOCS)
    more = docs.withColumns({n: F.lit("x") for n in names})
    assert sorted(map(tuple, ngram_join.similar_sets(more).collect()), key=repr) == plain_components(data)


def test_tables_between_jobs_go(spark):
    """Only the result's table is left in the shared folder, and none after an error."""
    from pathlib import Path

    from tremora.llm import common

    at = Path(common.shared_dir(spark).removeprefix("file:")) / "tremora"
    before = set(at.glob("*"))
    out = ngram_join.similar_sets(spark.createDataFrame(family(9, 2, 4), DOCS))
    assert len(set(at.glob("*")) - before) == 1 and out.count() > 0
    common.forget(out)
    with pytest.raises(RuntimeError), common.workspace():
        common.materialize(spark.range(3), "x")
        raise RuntimeError
    assert set(at.glob("*")) == before


def test_similar_sets_awkward(spark):
    data = awkward_docs()
    assert found(spark, data) == plain_components(data)


def test_similar_sets_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, None, None, None)]) == [(1, 0, 1)]


@pytest.mark.parametrize("overlap, linked", [(80, True), (79, False)])
def test_threshold_is_exact(spark, overlap, linked):
    """Sets of 90 shingles, 80 of them shared: 80 of 100. One less misses the threshold."""
    rng = random.Random(1)
    a = [f"a{i}" for i in range(94)]
    b = a[: overlap + 4] + [f"b{rng.random()}" for _ in range(90 - overlap)]
    got = found(spark, [(1, " ".join(a), None, None, None), (2, " ".join(b), None, None, None)])
    assert got == [(1, 90, 1), (2, 90, 1 if linked else 2)]


def test_tree_links_span_all_links():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, rng.integers(5, 80), dtype=np.uint64)
        for _ in range(rng.integers(1, 6)):
            s = base.copy()
            s[rng.integers(0, len(s), len(s) // 12)] = rng.integers(0, 2**63)
            sets.append(np.unique(s))
    sizes = np.array([len(s) for s in sets])
    want, got = Find(), Find()
    for i, a in enumerate(sets):
        for j in range(i):
            n = len(np.intersect1d(a, sets[j]))
            if 180 * n >= 80 * (len(a) + len(sets[j])):
                want.join(i, j)
    for i, j in ngram_join.tree_links(sets, sizes):
        assert 180 * len(np.intersect1d(sets[i], sets[j])) >= 80 * (sizes[i] + sizes[j])
        got.join(i, j)
    assert [got(i) for i in range(len(sets))] == [want(i) for i in range(len(sets))]


def test_shingles_are_words(spark):
    """Hashed sets have the sizes of real ones, whatever the white space and however runs are cut."""
    import pyarrow as pa

    texts = ["The quick\tBROWN\x0bfox jumps over", None, "", "a\x1cb c", "é É x y z w", *[t for _, t, *_ in awkward_docs()]]
    got = [len(s) for limit in (1 << 21, 50) for _, _, d, o in text_chunks(pa.array(texts), limit) for s in shingles(d, o)]
    assert got == [len(shingle_set(t)) for t in texts] * 2


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    find = Find()
    for a, b in edges:
        find.join(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


@pytest.mark.parametrize("few", [0, 150, 1 << 18])
def test_components_by_rounds_and_in_the_driver(spark, few):
    """Rounds, the driver after some rounds, and the driver alone agree; few edges take few jobs, however long their chain."""
    edges = [(i * 7 % 499, (i + 1) * 7 % 499) for i in range(400)] + [(2000 + i, 2000) for i in range(50)] + [(3, 3)]
    find = Find()
    for a, b in edges:
        find.join(a, b)
    frame = spark.createDataFrame(edges, "a long, b long")
    spark.sparkContext.setJobGroup(f"components-{few}", "")
    out = components(frame, few=few)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"components-{few}"))
    spark.sparkContext.setJobGroup("", "")
    assert {r.id: r.component for r in out.collect()} == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert few <= 150 or jobs <= 8
    assert components(frame.where("a = b"), few=few).collect() == []


def plain_vectors(data):
    keep = [i for i, (_, v) in enumerate(data) if v and None not in v and np.isfinite(v).all() and np.any(np.array(v))]
    unit = {i: np.array(data[i][1], float) / np.linalg.norm(np.array(data[i][1], float)) for i in keep}
    find, n = Find(), defaultdict(int)
    for x, i in enumerate(keep):
        for j in keep[:x]:
            if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                find.join(i, j)
                n[i] += 1
                n[j] += 1
    low = defaultdict(list)
    for i in keep:
        if data[i][0] is not None:
            low[find(i)].append(data[i][0])
    return sorted(((d, n[i], min(low[find(i)], default=None) if i in unit else d) for i, (d, _) in enumerate(data)), key=repr)


VEC = "vec_id long, embedding array<float>, label int"


def linked(spark, data, **kw):
    df = spark.createDataFrame([(i, v, None) for i, v in data], VEC)
    out = embedding_dedup.near_duplicates(df, **kw).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=repr)


def clouds(seed, groups, size, spread, dim=16):
    rng = np.random.default_rng(seed)
    return [np.float32(c + spread * rng.standard_normal(dim)).tolist() for c in rng.standard_normal((groups, dim)) for _ in range(size)]


def test_near_duplicates(spark):
    data = list(enumerate(clouds(1, 30, 8, 0.05) + clouds(2, 60, 1, 0.0) + clouds(3, 1, 20, 0.0)))
    assert linked(spark, data) == plain_vectors(data)


def test_near_duplicates_in_blocks(spark):
    data = list(enumerate(clouds(5, 2, 60, 0.02)))
    assert linked(spark, data, block=16) == plain_vectors(data)


@pytest.mark.parametrize("kw", [{"small": 1, "block": 16}, {"small": 4}, {"small": 1000}, {"id_bits": 3}])
def test_near_duplicates_in_buckets_of_all_sizes(spark, kw):
    """Pairs of small buckets and vectors in large ones give the same links, each once, and class numbers may clash."""
    data = list(enumerate(clouds(6, 12, 9, 0.05) + clouds(7, 30, 1, 0.0) + clouds(8, 1, 40, 0.01)))
    assert linked(spark, data, **kw) == plain_vectors(data)


def test_near_duplicates_ignore_other_columns(spark):
    data = list(enumerate(clouds(9, 6, 4, 0.05)))
    df = spark.createDataFrame([(i, v, None) for i, v in data], VEC)
    for name in ("cls", "t", "code", "copies", "vector", "component", "n_links", "check"):
        df = df.withColumn(name, F.lit("x"))
    out = embedding_dedup.near_duplicates(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=repr) == plain_vectors(data)


def test_near_duplicates_awkward(spark):
    v = [1.0, 2.0, 3.0]
    data = [(1, v), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [1.0, float("nan"), 3.0]), (8, [float("inf"), 0.0, 0.0]), (1, v), (None, v), (9, [1.0, 2.0]), (10, [-1.0, -2.0, -3.0]), (None, [5.0, 0.0, 0.0]), (11, [1e-30, 2e-30, 3e-30])]
    assert linked(spark, data) == plain_vectors(data)
    assert linked(spark, []) == []


def test_recall_at_the_threshold(spark):
    """Of pairs just above the threshold, at least 0.95 are found."""
    rng = np.random.default_rng(9)
    data = []
    for i in range(400):
        a = rng.standard_normal(32)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(32)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        data += [(2 * i, a.tolist()), (2 * i + 1, (0.905 * a + np.sqrt(1 - 0.905**2) * b).tolist())]
    got = linked(spark, data)
    want = plain_vectors(data)
    assert sum(n for _, n, _ in got) >= 0.95 * sum(n for _, n, _ in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def plain_tiles(text, item, k=5):
    """Greedy string tiling as first published: scan for the longest matches of unmarked words, mark, repeat."""
    low = lambda t: re.findall(r"[^\W_]+|[^\x00-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    a, b = low(text), low(item)
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best, at = k - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best:
                    best, at = n, [(j, i)]
                elif n == best and n >= k:
                    at.append((j, i))
        if not at:
            return covered, len(b)
        j, i = min(at)
        for n in range(best):
            free_a[i + n] = free_b[j + n] = False
        covered += best


def test_tiling(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randrange(12, 30), 500)) for i in range(6)] + [(90, None), (91, "too short"), (92, "a a a a a a a a")]
    texts = []
    for i, (_, t) in enumerate(items[:6]):
        w = t.split()
        cut = len(w) // 2
        texts += [prose(rng, 20, 500) + " " + t.upper().replace(" ", ", ") + "!", " ".join(w[cut:] + ["between"] + w[:cut]), " ".join(w[: 4 + i]), prose(rng, 40, 500)]
    texts += [None, "", "a a a a a a a a a a a a"]
    docs = [(100 + i, t, None, None, None) for i, t in enumerate(texts)]
    got = decontamination.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {}
    for d, t, *_ in docs:
        for i, item in items:
            covered, n = plain_tiles(t, item)
            if n and covered and covered >= 0.5 * n:
                want[d, i] = covered / n
    assert {(r.doc_id, r.item_id): r.coverage for r in got} == pytest.approx(want)
    assert sum((100 + 4 * i + 1, i) in want for i in range(6)) == 6  # halves in reverse order


def test_tiling_in_blocks(spark, sf):
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    one = sorted(map(tuple, decontamination.leaks(docs, bench).collect()))
    assert sorted(map(tuple, decontamination.leaks(docs, bench, block=200).collect())) == one
    whole, parts = (sorted(map(tuple, decontamination.keep_clean(docs, bench, block=b).collect()), key=repr) for b in (10**9, 200))
    assert whole == parts
    kept = decontamination.keep_clean(docs.withColumn("extra", F.lit(1)), bench)
    assert kept.columns == [*docs.columns, "extra"]
    assert kept.count() == docs.count() - len({r[0] for r in one})


def test_tiling_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(spark.createDataFrame(awkward_docs(), DOCS), none).collect() == []
    assert decontamination.leaks(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect() == []


def test_many_pairs_of_places_are_followed(monkeypatch):
    """Texts that repeat a sentence of the item, whole or with noise, give the same tiles either way."""
    import pyarrow as pa

    rng = random.Random(4)
    sentence = prose(rng, 11, 100)
    item = " ".join([sentence] * 12 + [prose(rng, 20)] + [sentence] * 5)
    noisy = " ".join(f"{sentence} {prose(rng, rng.randrange(3), 50)}" for _ in range(30))
    texts = pa.array([" ".join([sentence] * 40), noisy, prose(rng, 200), "a " * 300, item, sentence])
    index = decontamination.Index([(1, item), (2, "a " * 50), (3, prose(rng, 30)), (4, sentence)])
    light = list(decontamination._found(index, texts, 0.2))
    monkeypatch.setattr(decontamination, "HITS", 3)
    assert list(decontamination._found(index, texts, 0.2)) == light and len(light) > 5
    plain = {(r, i): c for r, i, c, *_ in light}
    for r, t in enumerate(texts.to_pylist()):
        covered, n = plain_tiles(t, item)
        assert plain.get((r, 0), 0) == pytest.approx(covered / n if covered >= 0.2 * n else 0)


def test_a_repetitive_text_takes_little_memory():
    import tracemalloc

    import pyarrow as pa

    sentence = "the cat sat on a mat near the door and slept"
    index = decontamination.Index([(1, " ".join([sentence] * 110))])
    texts = pa.array([" ".join([sentence] * 10_000)])
    tracemalloc.start()
    found = list(decontamination._found(index, texts, 0.5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0][2] == 1.0 and peak < 100e6
