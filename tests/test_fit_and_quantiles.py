"""The iterative fit against a scalar optimiser, and exact quantiles against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.functions import stats
from screenlake.operators import fit, hits


def scalar(y, offsets, level, weights, fixed, c):
    """One row by Adam, value by value. y, offsets: lists by group."""
    groups = len(y)
    soft = lambda s: math.log1p(math.exp(-abs(s))) + max(s, 0.0)

    def loss(x):
        """The loss and its slopes; gamma functions as sums over whole counts."""
        total, slope = 0.0, [0.0] * len(x)
        for g in range(1 if c.shared else groups):
            a = 0.0 if fixed[g] else soft(x[groups + g])
            r, n, w = 1 / (a + 1e-12), len(y[g]), weights[g]
            for v, o in zip(y[g], offsets[g]):
                mu = math.exp(o + x[g])
                ks = range(int(v))
                poisson = mu - v * math.log(mu + 1e-12) + math.lgamma(v + 1)
                nb = sum(math.log(r + k) for k in ks) - math.lgamma(v + 1) - r * math.log1p(mu / (r + 1e-12)) + v * (math.log(mu + 1e-12) - math.log(r + mu + 1e-12))
                total += ((1 - w) * poisson - w * nb) / n
                slope[g] += ((1 - w) * (1 - v / (mu + 1e-12)) - w * (v / (mu + 1e-12) - (r + v) / (r + mu + 1e-12))) * mu / n
                by_r = sum(1 / (r + k) for k in ks) - math.log1p(mu / (r + 1e-12)) + r / (r + 1e-12) - (r + v) / (r + mu + 1e-12)
                slope[groups + g] += w * by_r * r * r / n
            total += 0.0 if fixed[g] else c.l1 * a + c.l2 * a * a
            slope[groups + g] = 0.0 if fixed[g] else (slope[groups + g] + c.l1 + 2 * c.l2 * a) / (1 + math.exp(-x[groups + g]))
        return total, slope

    x = [math.log((sum(v) / len(v) + 1e-6) / (math.exp(level + sum(o - level for o in os) / len(os)) + 1e-6)) for v, os in zip(y, offsets)]
    x += [-3.0 if fixed[g] or g == 0 or c.shared else -2.0 for g in range(groups)]
    m, v, last = [0.0] * len(x), [0.0] * len(x), None
    for t in range(1, c.steps + 1):
        now, slope = loss(x)
        for k, s in enumerate(slope):
            m[k], v[k] = 0.9 * m[k] + 0.1 * s, 0.999 * v[k] + 0.001 * s * s
            x[k] -= c.rate * (m[k] / (1 - 0.9**t)) / (math.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        if last is not None and abs(last - now) < c.tolerance:
            break
        last = now
    return x[:groups], [0.0 if fixed[g] else soft(x[groups if c.shared else groups + g]) for g in range(groups)], t


@pytest.mark.parametrize("config", [fit.FitConfig(), fit.FitConfig(l1=0.05, l2=0.02, tolerance=1e-4), fit.FitConfig(steps=7), fit.FitConfig(shared=True)])
def test_fit(spark, config):
    groups = {"r1": ["a", "b", "c"], "r2": ["d", "e"], "neg1": ["n"]}
    rng = np.random.default_rng(4)
    rows = [(k, *[float(v) for v in rng.negative_binomial(1.5, 0.2, 6)], float(rng.integers(0, 20))) for k in range(40)]
    rows += [(100, *[0.0] * 6, 0.0), (101, *[500.0, 3.0, 0.0, 80.0, 81.0, 2.0], 1.0), (102, 1.0, None, 2.0, 3.0, None, 4.0, 5.0)]
    samples = ["a", "b", "c", "d", "e", "n", "del2"]
    m = spark.createDataFrame(rows, "k int, " + ", ".join(f"{s} double" for s in samples)).repartition(3)
    size = {"a": 0.5, "b": 1.0, "c": 1.5, "d": 1.0, "e": 2.0, "n": 0.7, "del2": 1.0}
    m = m.select("*", *[F.lit(v).alias(f"sf_{s}") for s, v in size.items()], *[(F.coalesce(s, F.lit(0.0)) / v).alias(f"n_{s}") for s, v in size.items()])
    m = m.withColumn("pc", 0.5 * F.greatest(F.lit(1.0), "n_del2")).withColumn("w", F.when(F.col("k") % 2 == 0, 0.8).otherwise(1.7))
    got = {r["k"]: r for r in fit.fitted(m, groups, {"r1": 0.3, "r2": "w", "neg1": 0.6}, fixed=("neg1",), config=config).collect()}
    assert len(got) == len(rows)
    for k, *counts in rows:
        y = dict(zip(samples, [0.0 if v is None else v for v in counts]))
        level = math.log(y["del2"] + 0.5 * max(1.0, y["del2"]))
        offsets = [[level + math.log(size[s]) for s in cols] for cols in groups.values()]
        delta, alpha, steps = scalar([[y[s] for s in cols] for cols in groups.values()], offsets, level, [0.3, 0.8 if k % 2 == 0 else 1.0, 0.6], [False, False, True], config)
        r = got[k]
        assert r["fit_steps"] == pytest.approx(steps, abs=2)
        for g, d, a in zip(groups, delta, alpha):
            assert r[f"fit_{g}"] == pytest.approx(d / math.log(2), abs=1e-4), (k, g)
            assert r[f"dispersion_{g}"] == pytest.approx(a, abs=1e-4), (k, g)
        assert r["dispersion"] == pytest.approx((alpha[0] + alpha[1]) / 2, abs=1e-4)


def test_log_rising():
    for r in (1e-3, 0.7, 11.9, 350.0, 1e7, 1e12):
        for y in (0, 1, 2, 40, 3000):
            want = math.fsum(math.log(r + k) for k in range(y))
            assert fit.log_rising(np.array([r]), np.array([float(y)]))[0] == pytest.approx(want, rel=1e-12, abs=1e-9)
            slope = math.fsum(1 / (r + k) for k in range(y))
            assert fit.rising_slope(np.array([r]), np.array([float(y)]))[0] == pytest.approx(slope, rel=1e-10, abs=1e-15)


def test_quantiles(spark, monkeypatch):
    """Ties, nulls, NaN, infinite values, a null group and an empty column; the same if the sketch's brackets don't hold."""
    rng = np.random.default_rng(2)
    rows = [(float(v), float(rng.integers(0, 3)), None if k % 9 == 0 else k % 4, None) for k, v in enumerate(rng.standard_normal(900))]
    rows += [(None, 1.0, 0, None), (float("nan"), 2.0, 1, None), (math.inf, 0.0, 2, None)]
    df = spark.createDataFrame(rows, "x double, y double, g int, z double").repartition(4)
    for sketch in (10_000, 3):
        monkeypatch.setattr(stats, "SKETCH", sketch)
        wanted = {"a": ("x", 0.5), "b": ("x", 0.013), "c": (F.col("y") * 2, 0.9), "d": ("y", 0.0), "e": ("x", 1.0), "f": ("z", 0.5)}
        x, y = [r[0] for r in rows if r[0] is not None and not math.isnan(r[0])], [r[1] for r in rows]
        r = stats.quantiles(df, wanted).first()
        assert list(r[:4]) == pytest.approx([np.quantile(x, 0.5), np.quantile(x, 0.013), 2 * np.quantile(y, 0.9), 0.0])
        assert r["e"] == math.inf and r["f"] is None
        for r in stats.quantiles(df, wanted, ("g",)).collect():
            own = [v for v in rows if v[2] == r["g"]]
            x = [v[0] for v in own if v[0] is not None and not math.isnan(v[0])]
            assert [r["a"], r["b"], r["c"]] == pytest.approx([np.quantile(x, 0.5), np.quantile(x, 0.013), 2 * np.quantile([v[1] for v in own], 0.9)])
    assert stats.quantiles(df.limit(0), wanted).collect()[0]["a"] is None
    assert stats.quantiles(df.limit(0), wanted, ("g",)).collect() == []


def test_no_quantile_in_one_task():
    import inspect

    from screenlake.operators import compare, counts

    assert not any(w in inspect.getsource(m) for m in (hits, compare, counts) for w in ("F.percentile(", "F.median("))
