"""Near duplicates, source divergence and centroid clustering against plain Python, on odd rows and hot groups."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.llm import delta_lloyd, divergence, multi_index

NAN, INF = float("nan"), float("inf")
ODD = [None, [], [0.0] * 8, [None] + [1.0] * 7, [NAN] + [1.0] * 7, [INF] + [1.0] * 7]


def brute(rows, cosine):
    """Links and components of (id, vector, label), row by row."""
    n, up = len(rows), list(range(len(rows)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    links = [0] * n
    sound = [i is not None and label is not None and bool(v) and None not in v and np.isfinite(v).all() and any(v) for i, v, label in rows]
    for a in range(n):
        for b in range(a + 1, n):
            if sound[a] and sound[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(v) / np.abs(v).max() for v in (rows[a][1], rows[b][1]))  # squares within range
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((top(a), top(b)))
                    up[q] = p
    least = defaultdict(list)
    for k in range(n):
        least[top(k)].append(rows[k][0])
    return [(rows[k][0], links[k], min(least[top(k)]) if sound[k] else rows[k][0]) for k in range(n)]


def order(rows):
    return sorted(rows, key=lambda r: tuple(-(10**6) if v is None else v for v in r))


def test_near_duplicates(spark, monkeypatch):
    """Copies, near copies, a large group, small blocks that cut it, and vectors that link with nothing."""
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", 60)
    monkeypatch.setattr(multi_index, "CELL_ROWS", 8)
    rng = np.random.default_rng(5)
    rows = [(k, v, "a") for k, v in enumerate(ODD)] + [(20, [1.0] * 8, None), (None, [1.0] * 8, "a"), (21, [1.0, 2.0], "a"), (22, [1.0, 2.0], "a"), (23, [3.0], "a"), (24, [1e-200] * 8, "a"), (25, [1e200] * 8, "a")]
    seeds = rng.standard_normal((12, 8))
    for k in range(260):
        base = seeds[0] if k % 3 == 0 else seeds[rng.integers(12)]
        rows.append((100 + k, [float(np.float32(v)) for v in base + 0.12 * rng.standard_normal(8)], "ab"[k % 5 == 0]))
    rows += [(1000 + k, rows[40][1], rows[40][2]) for k in range(50)] + [(41, rows[40][1], rows[40][2])] * 2
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<double>, label string, node int, x string").repartition(5)
    got = multi_index.near_duplicates(df, cosine=0.93, recall=1.0)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = got.collect()
    assert order((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == order(brute(rows, 0.93))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert multi_index.near_duplicates(df.filter(F.lit(False))).collect() == []


def test_recall_at_the_threshold():
    """Random partners of just 0.93 in 64 components: the share that the cells up to reach meet."""
    rng = np.random.default_rng(1)
    x = multi_index._scaled(rng.standard_normal((4000, 64)))
    grid = multi_index.Grid.fitted(x[:2500], 12, 0.93, 0.99)
    aside = rng.standard_normal((1500, 64))
    aside -= (aside * x[2500:]).sum(1, keepdims=True) * x[2500:]
    y = 0.9301 * x[2500:] + np.sqrt(1 - 0.9301**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    a, b, here, there = grid.beyond(x[2500:]), grid.beyond(y), grid.cells(x[2500:]), grid.cells(y)
    k = np.arange(1500)
    met = (a[0][k, there[0]] + a[1][k, there[1]] <= grid.reach) | (b[0][k, here[0]] + b[1][k, here[1]] <= grid.reach)
    visited = np.mean(a[0][:, :, None] + a[1][:, None, :] <= grid.reach)
    print("recall at the threshold", met.mean(), "share of the grid visited", visited)
    assert met.mean() >= 0.97 and visited < 0.6


def lloyd(rows, clusters, rounds, dim):
    kept = [(i, [int(np.floor(1024 * v)) for v in x]) for i, x in rows if i is not None and x is not None and len(x) == dim and None not in x and np.isfinite(x).all()]
    seeds = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [x for _, x in seeds]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        owned = defaultdict(list)
        for _, x in kept:
            owned[near(x)[1]].append(x)
        centroids = [[sum(c) // len(owned[k]) for c in zip(*owned[k])] if owned[k] else centroids[k] for k in range(len(centroids))]
    out = [(i, *near(x)[::-1]) for i, x in kept]
    inertia = Counter()
    for _, k, d in out:
        inertia[k] += d
    return sorted((i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for i, k, d in out)


@pytest.mark.parametrize("size", [1.0, 40_000.0])
def test_centroids(spark, size):
    """Ties, copies that make empty clusters, odd vectors; components whose squares pass 64-bit floats are summed as whole numbers."""
    rng = np.random.default_rng(3)
    rows = [(k, v) for k, v in enumerate(ODD)] + [(10, [1.0]), (None, [1.0] * 8), (11, [0.5] * 8), (11, [0.5] * 8), (12, [-0.25] * 8)]
    rows += [(100 + k, [float(v) for v in size * rng.standard_normal(8)]) for k in range(150)] + [(400 + k, [0.5 * size] * 8) for k in range(60)]
    df = spark.createDataFrame([(*r, 1, "o") for r in rows], "vec_id long, embedding array<double>, owner int, cluster string").repartition(4)
    for rounds in (0, 1, 10):
        got = delta_lloyd.clustered(df, clusters=8, rounds=rounds, dim=8)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted(tuple(r) for r in got.collect()) == lloyd(rows, 8, rounds, 8)
    assert delta_lloyd.clustered(df.filter(F.lit(False))).collect() == []
    few = df.filter("vec_id in (11, 12)")
    assert sorted(tuple(r) for r in delta_lloyd.clustered(few, clusters=8, rounds=3, dim=8).collect()) == lloyd([(11, [0.5] * 8), (11, [0.5] * 8), (12, [-0.25] * 8)], 8, 3, 8)


def test_delta_rounds_compare_little():
    """A vector whose own centroid stayed is compared with moved ones only, and ties go to the smaller number."""
    x = np.array([[0, 0], [10, 0], [4, 0]])
    owner, distance = delta_lloyd.reassigned(x, np.array([-1, -1, -1]), np.zeros(3, int), [[0, 0], [8, 0]], [])
    assert owner.tolist() == [0, 1, 0] and distance.tolist() == [0, 4, 16]
    owner, distance = delta_lloyd.reassigned(x, owner, distance, [[0, 0], [4, 0]], [1])
    assert owner.tolist() == [0, 1, 1] and distance.tolist() == [0, 36, 0]
    owner, _ = delta_lloyd.reassigned(x, np.array([1, 1, 1]), np.array([0, 100, 16]), [[0, 0], [0, 0]], [0])
    assert owner.tolist() == [0, 0, 0]  # equal distance and smaller number, nearer, equal again


def audit(rows, least):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for _, t, lang, source in rows:
        w = terms(t or "")
        groups[lang or "", source or ""].update(w)
        df[lang or ""].update(set(w))
    out = []
    share = lambda c, kept: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept)) for t in kept}
    for lang in {k for k, _ in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        own = {s: share(c, kept) for (k, s), c in groups.items() if k == lang}
        all_ = share(sum((c for (k, _), c in groups.items() if k == lang), Counter()), kept)
        for s, p in own.items():
            pair = [(-sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept), o.encode()) for o, q in own.items() if o != s]
            term = [(-((p[t] - all_[t]) ** 2 // (p[t] + all_[t])), t.encode()) for t in kept if groups[lang, s][t] and p[t] > all_[t]]
            out += [(lang, s, part, i.decode(), -v, r + 1) for part, found in (("pair", pair), ("term", term)) for r, (v, i) in enumerate(sorted(found)) if part == "pair" or r < 10]
    return sorted(out)


@pytest.mark.parametrize("together, most", [(1 << 21, 24 << 20), (4, 300)])
def test_divergence(spark, monkeypatch, together, most):
    """Nulls, empty texts, a source without terms, a language without kept ones, a hot source, characters beyond ASCII; the same with slices of a few entries."""
    monkeypatch.setattr(divergence, "TOGETHER", together)
    monkeypatch.setattr(divergence, "SLICE_BYTES", most)
    rng = np.random.default_rng(8)
    words = ["Alpha", "beta", "ÄPFEL", "äpfel", "x1y2", "naïve", "日本", "o'clock", "gamma_delta", *[f"w{chr(97 + k)}" for k in range(20)]]
    rows = [(None, None, None, None), (1, "", "en", "none"), (2, "only here", "de", "s"), (3, "Alpha " * 3000, "en", "b")]
    for k in range(240):
        source = "a" if k % 3 == 0 else "abcdefg"[rng.integers(7)]
        rows.append((10 + k // 2, " ".join(words[int(w)] for w in rng.zipf(1.4, 12) % len(words)), ["en", "fr", None][k % 11 % 3], source))
    rows += rows[-4:]
    docs = spark.createDataFrame([(*r, 1, "v") for r in rows], "doc_id long, text string, lang string, source string, n int, term string").repartition(5)
    got = divergence.audit(docs, least_docs=4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == audit(rows, 4)
    assert divergence.audit(docs.filter(F.lit(False))).collect() == []


def test_shares_of_large_counts():
    assert divergence.shares(np.array([10**13]), np.array([3 * 10**13])).tolist() == [1 + 10**9 * (10**13 + 2) // (3 * 10**13)]
