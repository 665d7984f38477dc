"""Clustering and evaluation in numpy against definitions, and as grouped functions."""

import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tremora.operators import density, evaluate, models
from tremora.plans.catalogue import _vectors


def blobs(seed, centres, size=25, spread=0.08):
    rng = np.random.default_rng(seed)
    return np.concatenate([c + spread * rng.standard_normal((size, 4)) for c in centres])


CENTRES = [np.zeros(4), np.full(4, 2.0), np.array([4.0, 0, 0, 0])]


def same_partition(a, b):
    return {frozenset(np.flatnonzero(a == c)) for c in set(a) - {-1}} == {frozenset(np.flatnonzero(b == c)) for c in set(b) - {-1}}


def plain_dbscan(x, eps, least):
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    core = (d <= eps).sum(1) >= least
    label = np.full(len(x), -1)
    k = 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            todo = {i}
            while todo:
                j = todo.pop()
                label[j] = k
                if core[j]:
                    todo |= {int(n) for n in np.flatnonzero(d[j] <= eps) if label[n] < 0}
            k += 1
    return label


@pytest.mark.parametrize("seed", range(4))
def test_dbscan(seed):
    x = np.concatenate([blobs(seed, CENTRES), np.random.default_rng(seed).uniform(-1, 5, (20, 4))])
    assert (density.dbscan(x, 0.3, 3) == plain_dbscan(x, 0.3, 3)).all()


@given(st.permutations(range(30)))
@settings(max_examples=20, deadline=None)
def test_clusters_do_not_depend_on_order(order):
    x = blobs(1, CENTRES, 10)
    p = np.array(order)
    for fit in (lambda y: density.dbscan(y, 0.4, 3), lambda y: density.hdbscan(y, 5, 3)[0]):
        label, back = fit(x), np.empty(30, int)
        back[p] = fit(x[p])
        assert same_partition(label, back)


def test_core_distance_counts_the_point():
    x = np.array([[0.0], [1.0], [3.0]])
    assert density.core_distances(x, 1).tolist() == [0, 0, 0]
    assert density.core_distances(x, 2).tolist() == [1, 1, 2]
    assert density.core_distances(x, 9).tolist() == [3, 2, 3]


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((7, 2))
    core = density.core_distances(x, 2)
    d = np.maximum(np.maximum(np.linalg.norm(x[:, None] - x[None], axis=2), core[:, None]), core[None])
    best = math.inf
    edges = list(itertools.combinations(range(7), 2))
    for tree in itertools.combinations(edges, 6):
        up = list(range(7))
        def find(i):
            while up[i] != i:
                i = up[i]
            return i
        for a, b in tree:
            if find(a) == find(b):
                break
            up[find(a)] = find(b)
        else:
            best = min(best, sum(d[e] for e in tree))
    assert density.spanning_tree(x, core)[:, 2].sum() == pytest.approx(best)


def test_hdbscan_finds_blobs_and_noise():
    x = np.concatenate([blobs(2, CENTRES), [[20.0] * 4, [-20.0] * 4]])
    label, prob = density.hdbscan(x, 5, 3)
    assert len(set(label)) == 4 and (label[-2:] == -1).all() and (prob[-2:] == 0).all()
    assert all(len(set(label[i : i + 25]) - {-1}) == 1 for i in (0, 25, 50))
    assert ((prob >= 0) & (prob <= 1)).all() and prob[label >= 0].max() == 1.0


def test_hdbscan_small_and_equal_points():
    assert density.hdbscan(np.zeros((2, 4)), 3, 2)[0].tolist() == [-1, -1]
    assert density.hdbscan(np.zeros((0, 4)))[0].tolist() == []
    label, prob = density.hdbscan(np.zeros((9, 4)), 3, 2)
    assert set(label) == {0} and (prob == 1).all()


def test_one_cluster_is_allowed():
    label, _ = density.hdbscan(blobs(3, CENTRES[:1], 60), 10, 5)
    assert set(label) <= {-1, 0} and (label == 0).sum() > 30


def test_dbcv():
    x = blobs(4, CENTRES)
    truth = np.repeat([0, 1, 2], 25)
    score, reason = density.dbcv(x, truth)
    assert reason == "VALID_DBCV_SCORE" and score > 0.7
    mixed, _ = density.dbcv(x, np.tile([0, 1, 2], 25))
    assert mixed < 0
    with_noise, _ = density.dbcv(x, np.where(np.arange(75) % 5 == 0, -1, truth))
    assert with_noise < score  # noise stays in the denominator
    assert density.dbcv(x, np.full(75, -1)) == (None, "NO_PRODUCTIVE_CLUSTERS")
    assert density.dbcv(x, np.zeros(75, int)) == (None, "DBCV_REQUIRES_AT_LEAST_TWO_CLUSTERS")
    assert density.dbcv(x, np.r_[0, np.ones(74, int)]) == (None, "INSUFFICIENT_CLUSTER_SAMPLES")


def test_silhouette():
    x, y = np.array([[0.0], [1.0], [10.0], [11.0]]), np.array([0, 0, 1, 1])
    assert density.silhouette(x, y) == pytest.approx(np.mean([(10.5 - 1) / 10.5, (9.5 - 1) / 9.5] * 2))
    assert density.silhouette(x, np.zeros(4, int)) is None


def test_adjusted_rand():
    a = np.array([0, 0, 1, 1, 2, 2])
    assert density.adjusted_rand(a, np.array([5, 5, 3, 3, 9, 9])) == 1.0
    assert density.adjusted_rand(a, np.array([0, 1, 0, 1, 0, 1])) < 0
    assert density.adjusted_rand(np.zeros(4), np.zeros(4)) == 1.0


def test_omori_recovers_its_exponent():
    for p in (0.8, 1.0, 1.3):
        k, c = 40.0, 0.5
        t = np.linspace(0, 2000, 400_001)
        n = density.omori_count(t, k, c, p)
        times = np.interp(np.arange(1, int(n[-1]) + 1), n, t)
        fit = density.fit_omori(times)
        assert fit["omori_p"] == pytest.approx(p, abs=0.05) and fit["omori_fit_metric"] > 0.999


def test_omori_is_smooth_at_one():
    t = np.array([0.1, 1.0, 100.0])
    mid = density.omori_count(t, 10, 0.1, 1.0)
    assert mid == pytest.approx(10 * np.log((t + 0.1) / 0.1))
    step = 1e-6
    left, right = (density.omori_count(t, 10, 0.1, 1 + s) for s in (-step, step))
    assert (left + right) / 2 == pytest.approx(mid, rel=1e-9)


def test_omori_takes_five():
    assert density.fit_omori(np.array([1.0, 2, 3, 4]))["reason"] == "METRIC_INSUFFICIENT_MEMBERS"
    assert density.fit_omori(np.array([-1.0, 0, 1, 2, 3, 4]))["n"] == 4


def test_models_on_windows(spark, sf):
    v = _vectors(spark, sf)
    n = v.count()
    for config in (models.ModelConfig("WINDOW"), models.ModelConfig("DBSCAN", eps=0.12), models.ModelConfig("HDBSCAN_GLOBAL", min_samples=2), models.ModelConfig("HDBSCAN_ADAPTIVE")):
        m = models.cluster_windows(v, config)
        assert m.count() == n
        s = models.summarize(m)
        failed = s.where("window_result_status = 'FAILED'")
        assert failed.where("sequence_member_count is not null or failure_reason_code is null").isEmpty()
        groups = {r.plot_group for r in models.plot_groups(m).select("plot_group").distinct().collect()}
        assert groups <= {"MAINSHOCK", "NOISE", "AFTERSHOCK", "FORESHOCK", "OTHER_CLUSTER"}
    same = models.cluster_windows(v.repartition(3).orderBy(F.rand(1)), models.ModelConfig("DBSCAN", eps=0.12))
    again = models.cluster_windows(v, models.ModelConfig("DBSCAN", eps=0.12))
    assert sorted(map(str, same.collect())) == sorted(map(str, again.collect()))


def test_stability_without_jitter_is_perfect(spark, sf):
    out = evaluate.stability(_vectors(spark, sf), models.ModelConfig("DBSCAN", eps=0.12), repeats=3, sigma=0.0).collect()
    assert {(r.mean_jaccard, r.min_ari, r.valid_pairs) for r in out} == {(1.0, 1.0, 3)}
    with pytest.raises(ValueError):
        evaluate.stability(_vectors(spark, sf), models.ModelConfig(), repeats=1)


def test_supervised_metrics_are_refused():
    evaluate.refuse_supervised(["dbcv"])
    with pytest.raises(ValueError):
        evaluate.refuse_supervised(["Accuracy"])


def test_sweep(spark, sf):
    out = models.sweep(_vectors(spark, sf), [models.ModelConfig("DBSCAN", eps=e) for e in (0.05, 0.2)])
    noise = {r.config_index: r.n for r in out.groupBy("config_index").agg(F.avg("noise_ratio").alias("n")).collect()}
    assert set(noise) == {0, 1}


def plain_dbcv(x, labels):
    """The index from the paper's definitions, by full matrices; the tree grows by the first of equal edges."""
    dim, parts = x.shape[1], {}
    for c in sorted(set(labels.tolist()) - {-1}):
        p = x[labels == c]
        d = np.linalg.norm(p[:, None] - p[None], axis=2)
        core = np.array([(sum(d[i, j] ** -dim for j in range(len(p)) if j != i) / (len(p) - 1)) ** (-1 / dim) for i in range(len(p))])
        reach = np.maximum(np.maximum(d, core[:, None]), core[None])
        inside, tree = [0], []
        while len(inside) < len(p):
            _, j, i = min((reach[i, j], j, i) for i in inside for j in range(len(p)) if j not in inside)
            tree.append((i, j))
            inside.append(j)
        inner = [i for i in range(len(p)) if sum(i in e for e in tree) > 1]
        parts[c] = p[inner], core[inner], max(reach[e] for e in tree if set(e) <= set(inner))
    total = 0.0
    for c, (p, a, sparse) in parts.items():
        gap = min(max(np.linalg.norm(u - v), s, t) for o, (q, b, _) in parts.items() if o != c for u, s in zip(p, a) for v, t in zip(q, b))
        total += (labels == c).sum() / len(x) * (gap - sparse) / max(gap, sparse)
    return total


@pytest.mark.parametrize("seed", range(5))
def test_dbcv_is_the_papers(seed):
    x = np.concatenate([blobs(seed, CENTRES, 12, 0.5), np.random.default_rng(seed).uniform(-1, 5, (6, 4))])
    labels = np.r_[np.repeat([0, 1, 2], 12), np.full(6, -1)]
    assert density.dbcv(x, labels) == (pytest.approx(plain_dbcv(x, labels), abs=1e-4), "VALID_DBCV_SCORE")


def test_dbcv_of_equal_points_and_pairs():
    assert density.dbcv(np.zeros((6, 4)), np.repeat([0, 1], 3)) == (None, "METRIC_FIT_FAILED")
    score, reason = density.dbcv(np.array([[0.0, 0], [1, 0], [9, 0], [10, 0]]), np.array([0, 0, 1, 1]))
    assert reason == "VALID_DBCV_SCORE" and score == pytest.approx(8 / 9, abs=1e-4)  # the first point stands for a pair


def test_distances_by_runs(monkeypatch):
    x = np.concatenate([blobs(7, CENTRES), np.random.default_rng(7).uniform(-1, 5, (20, 4))])
    whole = density.dbscan(x, 0.3, 3), density.dbcv(x, density.dbscan(x, 0.3, 3)), density.core_distances(x, 3).tolist()
    monkeypatch.setattr(density, "HELD", 300)
    assert (density.dbscan(x, 0.3, 3) == whole[0]).all()
    assert (density.dbcv(x, whole[0]), density.core_distances(x, 3).tolist()) == whole[1:]


@pytest.mark.parametrize("p", [0.2, 0.9999999, 1.0, 1.7, 2.5])
def test_omori_count_is_the_integral(p):
    t, k, c = np.array([0.0, 1e-3, 1.0, 5e4]), 7.0, 1e-4
    closed = k * np.log(1 + t / c) if abs(1 - p) < 1e-6 else k * ((t + c) ** (1 - p) - c ** (1 - p)) / (1 - p)
    assert density.omori_count(t, k, c, p) == pytest.approx(closed, rel=1e-5 if abs(1 - p) < 1e-5 else 1e-9)


def _window_rows(spark, x, shock=0, mag=8.0):
    rows = [(shock, i, "MAINSHOCK" if i == shock else "POST", mag, *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "mainshock_event_id long, candidate_event_id long, relative_time_role string, mainshock_magnitude double, x_scaled double, y_scaled double, time_scaled double, magnitude_scaled double")


def test_stability_takes_the_windows_own_parameters(spark):
    from tremora.operators.features import VECTOR

    x = np.concatenate([blobs(5, CENTRES[:1], 4, 0.05), blobs(6, CENTRES[1:], 60, 0.6)])
    rows = _window_rows(spark, x).toDF("mainshock_event_id", "candidate_event_id", "relative_time_role", "mainshock_magnitude", *VECTOR)
    every = {a: models.ModelConfig(a, min_samples=2) for a in ("HDBSCAN_GLOBAL", "HDBSCAN_ADAPTIVE")}
    labels = {a: sorted((r.candidate_event_id, r.cluster_id) for r in models.cluster_windows(rows, c).collect()) for a, c in every.items()}
    assert labels["HDBSCAN_GLOBAL"] != labels["HDBSCAN_ADAPTIVE"]
    found = {a: evaluate.stability(rows, c, sigma=0.2).drop("mainshock_event_id").first() for a, c in every.items()}
    assert found["HDBSCAN_GLOBAL"] != found["HDBSCAN_ADAPTIVE"]
    # by hand: size and samples of 124 candidates and magnitude 8, draws in the order of ids without the mainshock
    size = min(25, int(3 + 1.5 * math.log(125) + 2.5))
    runs = []
    for r in range(5):
        rng, y = np.random.RandomState(42 + 100 * r), x.copy()
        for i in range(1, len(y)):
            for j in range(4):
                y[i, j] += rng.normal(0.0, 0.2)
        label, _ = density.hdbscan(y, size, int(0.6 * size))
        runs.append((label, set(np.flatnonzero((label == label[0]) & (label >= 0)))))
    pairs = list(itertools.combinations(runs, 2))
    assert found["HDBSCAN_ADAPTIVE"].mean_ari == pytest.approx(np.mean([density.adjusted_rand(a, b) for (a, _), (b, _) in pairs]))
    assert found["HDBSCAN_ADAPTIVE"].mean_jaccard == pytest.approx(np.mean([density.jaccard(a, b) for (_, a), (_, b) in pairs]))


def test_stability_without_the_mainshock(spark):
    from tremora.operators.features import VECTOR

    rows = _window_rows(spark, blobs(5, CENTRES[:1], 9)).toDF("mainshock_event_id", "candidate_event_id", "relative_time_role", "mainshock_magnitude", *VECTOR)
    got = evaluate.stability(rows.where("candidate_event_id > 0"), models.ModelConfig("DBSCAN")).first()
    assert (got.reason, got.valid_repeats, got.failed_repeats, got.mean_jaccard) == ("METRIC_NOT_APPLICABLE", 0, 0, None)
