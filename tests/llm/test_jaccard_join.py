"""Components against brute force over all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.llm import jaccard_join


def brute(rows, n, percent):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))

    sets = {}
    for d, t in rows:
        w = words(t)
        sets.setdefault(d, set()).update({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[a] and sets[b]:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in ids}


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [r.choice(vocabulary) for _ in range(60)]
    rows, texts = [], []
    for i in range(n):
        k = r.random()
        if texts and k < 0.5:
            w = list(r.choice(texts[-40:]))
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
        else:
            w = [r.choice(vocabulary) for _ in range(r.choice([1, 2, 3, 12, 40, 120]))]
            if k < 0.75:
                w = w[: len(w) // 2] + common + w[len(w) // 2 :]
        texts.append(w)
        rows.append((i * 7 % 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize("n,percent,seed", [(3, 90, 1), (5, 80, 2), (2, 70, 3)])
def test_components_equal_brute_force(spark, monkeypatch, n, percent, seed):
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 4)
    monkeypatch.setattr(jaccard_join, "QUERY_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "SLICE_TOKENS", 50)
    rows = corpus(seed, 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.linked_components(docs, n, percent).collect()}
    assert got == brute(rows, n, percent)
    assert len({c for _, c in got.values()}) < len(got)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one"), (None, "one two"), (9, "a b c d e f g " * 3000), (8, "a b c d e f g " * 3000), (8, "a b c d e f g " * 3000)]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, token string, rep int")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.linked_components(docs, 3, 90).collect())
    assert got[0] == (0, 1, None)
    assert [g for g in got if g[0]] == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (8, 7, 8), (8, 7, 8), (9, 7, 8)]
    assert jaccard_join.linked_components(docs.filter(F.lit(False)), 3, 90).collect() == []


def test_rows_of_one_id_share_their_links(spark):
    a, b = "one two three four five", "six seven eight nine ten eleven"
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (7, b), (8, ""), (7, None), (9, "x y z"), (9, "")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in jaccard_join.linked_components(docs, 3, 90).collect())
    assert got == [(3, 3), (5, 3), (5, 3), (7, 3), (7, 3), (8, 8), (9, 9), (9, 9)]


@pytest.mark.parametrize("percent", [50, 80, 90, 99])
def test_linked_sets_share_a_key(percent):
    """Every size and every way to differ up to the most that a link allows."""
    rng = np.random.default_rng(percent)
    pool = rng.integers(1, 2**63, 4000).astype(np.uint64)
    for size in [*range(1, 60), 100, 333, 1500]:
        for _ in range(6):
            a = pool[rng.permutation(len(pool))[:size]]
            gone = rng.integers(0, size)
            rest = np.setdiff1d(pool, a)
            while gone and 100 * (size - gone) < percent * size:
                gone //= 2
            new = 0
            while 100 * (size - gone) >= percent * (size + new + 1) and rng.random() < 0.9:
                new += 1
            b = np.concatenate([a[gone:], rest[rng.permutation(len(rest))[:new]]])
            if set(a) != set(b):
                assert set(jaccard_join.keys(np.sort(a), percent)) & set(jaccard_join.keys(np.sort(b), percent)), (size, gone, new)


def test_shared_keys_in_small_lots(spark, monkeypatch):
    """Each pair of a key that several nodes have is found, across lots and tasks, and no other."""
    monkeypatch.setattr(jaccard_join, "KEYS_TOGETHER", 50)
    rng = np.random.default_rng(3)
    held = [(node, sorted({int(k) for k in rng.integers(-300, 300, 12)} | ({7} if node % 3 else set()))) for node in range(200)] * 2
    rng.shuffle(held)
    leads = spark.createDataFrame(held, "node long, keys array<long>").repartition(5)
    got = {tuple(r) for r in jaccard_join._shared(leads).collect()}
    pairs = {(k, node) for node, ks in held for k in ks}
    nodes_of = Counter(k for k, _ in pairs)
    assert got == {(k, node) for k, node in pairs if nodes_of[k] > 1}
    assert jaccard_join._shared(leads.limit(0)).count() == 0
