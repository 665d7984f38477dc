"""Density clustering and its evaluation in numpy, for one window at a time; memory grows with the points, not their square.

Distances are taken in blocks of at most HELD. Everything is deterministic, and independent of the order of rows where ids break ties.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np

#: Distances that are held at a time.
HELD = 1 << 22


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between two sets of points, summed up a coordinate at a time."""
    out = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T):
        out += np.subtract.outer(x, y) ** 2
    return np.sqrt(out, out=out)


def _blocks(x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Distances of runs of points to all points."""
    step = max(1, HELD // max(1, len(x)))
    for a in range(0, len(x), step):
        part = x[a : a + step]
        yield slice(a, a + len(part)), distances(part, x)


def dbscan(x: np.ndarray, eps: float = 0.5, least: int = 3) -> np.ndarray:
    """Cluster labels from 0 in the order of the points, -1 for noise. A point counts among its own neighbours.

    Core points within eps are one cluster; a border point joins the first cluster with a core point near it. Neighbours
    are found again in each of three passes (count, connect, attach borders) and never held for all points.
    """
    n = len(x)
    core = np.zeros(n, bool)
    for at, d in _blocks(x):
        core[at] = (d <= eps).sum(1) >= least
    top = np.arange(n)

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = int(top[i])
        return i

    for at, d in _blocks(x):
        for i in np.flatnonzero(core[at]).tolist():
            roots = {find(int(r)) for r in np.unique(top[(d[i] <= eps) & core])}
            top[list(roots)] = min(roots)
    label = np.full(n, -1)
    firsts = [find(i) for i in np.flatnonzero(core).tolist()]
    number = {r: c for c, r in enumerate(sorted(set(firsts)))}  # a root is the first of its cluster's core points
    label[core] = [number[r] for r in firsts]
    by_cluster = np.where(core, label, n)
    for at, d in _blocks(x):
        border = np.flatnonzero(~core[at])
        if len(border):
            first = np.where(d[border] <= eps, by_cluster, n).min(1)
            label[at.start + border] = np.where(first < n, first, -1)
    return label


def core_distances(x: np.ndarray, k: int) -> np.ndarray:
    """Distance to the k-th nearest point, the point itself being the first."""
    out = np.zeros(len(x))
    k = min(k, len(x))
    for at, d in _blocks(x):
        out[at] = np.partition(d, k - 1, axis=1)[:, k - 1]
    return out


def spanning_tree(x: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Edges (a, b, weight) of a minimum spanning tree of mutual reachability, by Prim with one row of distances at a time.

    It grows from the first point. Equal edges are common, as core distances bound them: of these the first free point
    joins, at the first point of the tree that is as near.
    """
    n = len(x)
    best, parent, out = np.full(n, np.inf), np.zeros(n, int), np.zeros((max(n - 1, 0), 3))
    free = np.ones(n, bool)
    cur = 0
    for e in range(n - 1):
        free[cur] = False
        d = np.maximum(np.maximum(np.sqrt(((x - x[cur]) ** 2).sum(1)), core), core[cur])
        closer = free & ((d < best) | (d == best) & (cur < parent))
        best[closer], parent[closer] = d[closer], cur
        nxt = int(np.argmin(np.where(free, best, np.inf)))
        out[e] = parent[nxt], nxt, best[nxt]
        cur = nxt
    return out


def hdbscan(x: np.ndarray, least_cluster: int = 3, least_samples: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(labels, probabilities): excess of mass over the condensed hierarchy (Campello, Moulavi, Sander), one cluster allowed.

    With fewer points than a cluster needs, all are noise. A probability is a point's density on leaving its cluster,
    relative to the densest in it.
    """
    n = len(x)
    if n < max(2, least_cluster):
        return np.full(n, -1), np.zeros(n)
    edges = spanning_tree(x, core_distances(x, least_samples))
    edges = edges[np.argsort(edges[:, 2], kind="stable")]
    # single linkage: node n + i joins two nodes at a height
    top, sizes, left, right, height = list(range(n)), [1] * n, [], [], []

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for a, b, w in edges:
        i, j, new = find(int(a)), find(int(b)), len(top)
        left.append(i), right.append(j), height.append(w)
        top.append(new)
        top[i] = top[j] = new
        sizes.append(sizes[i] + sizes[j])

    def points(node: int) -> list[int]:
        out, stack = [], [node]
        while stack:
            k = stack.pop()
            if k < n:
                out.append(k)
            else:
                stack += [left[k - n], right[k - n]]
        return out

    # condensed: a cluster goes on through splits that shed fewer points than a cluster needs
    born, parents, exits = [0.0], [-1], []  # exits: (cluster, point, density, points)
    children: list[list[tuple[int, float, int]]] = [[]]
    stack = [(2 * n - 2, 0)]
    while stack:
        node, c = stack.pop()
        if node < n:
            continue
        h = height[node - n]
        density = 1.0 / h if h > 0 else np.inf
        parts = [left[node - n], right[node - n]]
        large = [p for p in parts if sizes[p] >= least_cluster]
        for p in parts:
            if p not in large:
                exits += [(c, q, density) for q in points(p)]
        if len(large) == 2:
            for p in large:
                born.append(density), parents.append(c), children.append([])
                children[c].append((len(born) - 1, density, sizes[p]))
                stack.append((p, len(born) - 1)) if p >= n else exits.append((len(born) - 1, p, density))
        elif large:
            stack.append((large[0], c)) if large[0] >= n else exits.append((c, large[0], density))
    stable = np.zeros(len(born))
    finite = [d for _, _, d in exits if np.isfinite(d)]
    most = 2 * max(finite, default=1.0)  # equal points leave at infinite density
    level = lambda d: d if np.isfinite(d) else most
    for c, _, d in exits:
        stable[c] += level(d) - level(born[c])
    for c, kids in enumerate(children):
        for _, d, size in kids:
            stable[c] += (level(d) - level(born[c])) * size
    chosen = np.ones(len(born), bool)
    for c in range(len(born) - 1, -1, -1):
        if kids := [k for k, _, _ in children[c]]:
            below = sum(stable[k] for k in kids)
            if below > stable[c]:
                chosen[c], stable[c] = False, below
    owner = np.full(len(born), -1)  # the topmost chosen cluster above each
    for c in range(len(born)):
        up = owner[parents[c]] if parents[c] >= 0 else -1
        owner[c] = up if up >= 0 else c if chosen[c] else -1
    label, prob = np.full(n, -1), np.zeros(n)
    at, density = np.full(n, -1), np.zeros(n)
    for c, q, d in exits:
        at[q], density[q] = owner[c], level(d)
    kept = [c for c in sorted(set(at)) if c >= 0]
    if kept == [0]:
        # a single cluster at the root keeps what is as dense as its last split (or its densest points)
        splits = [level(d) for _, d, _ in children[0]]
        floor = max(splits) if splits else 0.0
        at[(at == 0) & (density < floor)] = -1
    for new, c in enumerate(kept):
        mine = at == c
        label[mine] = new
        peak = density[mine].max() if mine.any() else 0.0
        prob[mine] = np.minimum(density[mine], peak) / peak if peak > 0 else 1.0
    return label, np.clip(prob, 0.0, 1.0)


def all_points_core(p: np.ndarray) -> np.ndarray:
    """Core distances of Moulavi et al. (2014): the mean of (1 / d)^D over the other points, to the power of -1 / D.

    Equal points add nothing to the mean; where nothing is added the distance is 0.
    """
    dim, out = p.shape[1], np.zeros(len(p))
    for at, d in _blocks(p):
        power = np.divide(1.0, d, out=np.zeros_like(d), where=d > 0) ** dim
        mean = power.sum(1) / (len(p) - 1)
        out[at] = np.divide(1.0, mean, out=np.zeros_like(mean), where=mean > 0) ** (1.0 / dim)
    return out


def _skeleton(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """A cluster's inner points, their core distances, and its density sparseness.

    Inner are points with two edges or more of the minimum spanning tree of mutual reachability; the sparseness is the
    longest edge between inner points. Without such points (two points) the first one stands for the cluster, without
    such an edge the longest one counts.
    """
    core = all_points_core(p)
    tree = spanning_tree(p, core)
    ends, length = tree[:, :2].astype(int), tree[:, 2]
    inner = np.bincount(ends.ravel(), minlength=len(p)) > 1
    between = inner[ends].all(1)
    points = np.flatnonzero(inner) if inner.any() else np.zeros(1, int)
    return p[points], core[points], float((length[between] if between.any() else length).max())


def _separation(a: tuple, b: tuple) -> float:
    """The least mutual reachability between inner points of two clusters."""
    (p, p_core, _), (q, q_core, _) = a, b
    step = max(1, HELD // len(q))
    runs = (slice(i, i + step) for i in range(0, len(p), step))
    return min(float(np.maximum(distances(p[r], q), np.maximum.outer(p_core[r], q_core)).min()) for r in runs)


def dbcv(x: np.ndarray, labels: np.ndarray) -> tuple[float | None, str]:
    """Density-based validity (Moulavi et al. 2014) over all points, noise in the denominator; None with a reason."""
    size = {int(c): int(n) for c, n in zip(*np.unique(labels[labels >= 0], return_counts=True))}
    if len(size) < 2:
        return None, "DBCV_REQUIRES_AT_LEAST_TWO_CLUSTERS" if size else "NO_PRODUCTIVE_CLUSTERS"
    if min(size.values()) < 2:
        return None, "INSUFFICIENT_CLUSTER_SAMPLES"
    shape = {c: _skeleton(x[labels == c]) for c in size}
    nearest = dict.fromkeys(size, math.inf)
    for a, b in itertools.combinations(size, 2):
        apart = _separation(shape[a], shape[b])
        nearest[a], nearest[b] = min(nearest[a], apart), min(nearest[b], apart)
    score = 0.0
    for c, n in size.items():
        gap, sparse = nearest[c], shape[c][2]
        if not 0 < max(gap, sparse) < math.inf:
            return None, "METRIC_FIT_FAILED"
        score += n / len(x) * (gap - sparse) / max(gap, sparse)
    return round(score, 4), "VALID_DBCV_SCORE"


def silhouette(x: np.ndarray, labels: np.ndarray) -> float | None:
    """Mean silhouette of the points in clusters; None with fewer than two clusters. Lone points count 0."""
    keep = labels >= 0
    x, labels = x[keep], labels[keep]
    names, index = np.unique(labels, return_inverse=True)
    if len(names) < 2:
        return None
    size = np.bincount(index)
    member = np.eye(len(names))[index]
    total = 0.0
    for at, d in _blocks(x):
        sums, own = d @ member, index[at]
        i = np.arange(len(own))
        a = sums[i, own] / np.maximum(size[own] - 1, 1)
        means = sums / size
        means[i, own] = np.inf
        b = means.min(1)
        total += np.where(size[own] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0).sum()
    return float(total / len(x))


def adjusted_rand(a: np.ndarray, b: np.ndarray) -> float:
    """Agreement of two labelings beyond chance; 1.0 where nothing can disagree."""
    _, i = np.unique(a, return_inverse=True)
    _, j = np.unique(b, return_inverse=True)
    pairs = lambda c: float((c * (c - 1) / 2).sum())
    both = pairs(np.unique(i * (j.max() + 1 if len(j) else 1) + j, return_counts=True)[1].astype(float))
    x, y, n = pairs(np.bincount(i).astype(float)), pairs(np.bincount(j).astype(float)), len(a)
    if n < 2:
        return 1.0
    expected = x * y / (n * (n - 1) / 2)
    most = (x + y) / 2
    return 1.0 if most == expected else (both - expected) / (most - expected)


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(48)


def omori_count(t: np.ndarray, k: float, c: float, p: float) -> np.ndarray:
    """Expected events until t at the rate k / (t + c)^p.

    With s + c = c e^v the integral over time is k c^(1-p) times that of e^((1-p) v) over log time, v from 0 to
    ln(1 + t / c). This is smooth in p, at 1 too, and Gauss-Legendre quadrature takes it to machine precision within the
    bounds of the fit, where the exponent stays under about 30.
    """
    end = np.log1p(np.maximum(t, 0.0) / c)
    v = np.multiply.outer(end, (_NODES + 1) / 2)
    return k * c ** (1.0 - p) * end / 2 * (np.exp((1.0 - p) * v) @ _WEIGHTS)


#: Bounds of (K, c, p), and how few events allow a fit.
OMORI_LOW, OMORI_HIGH, OMORI_LEAST = np.array([1e-3, 1e-4, 0.2]), np.array([1e6, 100.0, 2.5]), 5


def fit_omori(hours: np.ndarray, least: int = OMORI_LEAST) -> dict:
    """Least squares of the cumulative count by Levenberg-Marquardt on (ln K, ln c, p), clipped to the bounds."""
    t = np.sort(np.asarray(hours, float))
    t = t[t > 0]
    out = {"omori_k": None, "omori_c": None, "omori_p": None, "omori_fit_metric": None, "reason": None, "n": len(t)}
    if len(t) < least:
        return out | {"reason": "METRIC_INSUFFICIENT_MEMBERS"}
    seen = np.arange(1, len(t) + 1, dtype=float)
    free = lambda q: np.array([math.exp(q[0]), math.exp(q[1]), q[2]])
    low, high = np.r_[np.log(OMORI_LOW[:2]), OMORI_LOW[2]], np.r_[np.log(OMORI_HIGH[:2]), OMORI_HIGH[2]]
    miss = lambda q: omori_count(t, *free(q)) - seen
    best = None
    for c0, p0 in ((0.1, 1.0), (1.0, 1.2), (10.0, 0.8)):
        q, damp = np.clip(np.array([math.log(len(t)), math.log(c0), p0]), low, high), 1e-2
        r = miss(q)
        for _ in range(300):
            step = 1e-6
            jac = np.stack([(miss(q + step * e) - miss(q - step * e)) / (2 * step) for e in np.eye(3)], 1)
            normal, grad = jac.T @ jac, jac.T @ r
            try:
                move = np.linalg.solve(normal + damp * (np.diag(np.diag(normal)) + 1e-12 * np.eye(3)), -grad)
            except np.linalg.LinAlgError:
                break
            new = np.clip(q + move, low, high)
            r_new = miss(new)
            if r_new @ r_new < r @ r:
                done = r @ r - r_new @ r_new < 1e-12 * (r @ r)
                q, r, damp = new, r_new, max(damp / 5, 1e-12)
                if done:
                    break
            else:
                damp *= 5
                if damp > 1e12:
                    break
        if best is None or r @ r < best[0]:
            best = r @ r, q
    spread = ((seen - seen.mean()) ** 2).sum()
    k, c, p = free(best[1])
    fit = 1 - best[0] / spread if spread > 0 else 0.0
    if not all(map(math.isfinite, (k, c, p, fit))):
        return out | {"reason": "METRIC_FIT_FAILED"}
    return out | {"omori_k": round(k, 4), "omori_c": round(c, 4), "omori_p": round(p, 4), "omori_fit_metric": round(fit, 4)}
