"""The iterative fit of log fold changes: a mixture of Poisson and NB2 likelihoods for each row, by Adam.

Rows are fitted side by side: a step is a few array operations over all rows of an Arrow batch that still move, for all samples at once. A row stops for itself when its loss has
changed by less than the tolerance, just as if it were alone, so results don't depend on how rows are dealt to batches. The work is a map over partitions, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

EPS = 1e-12
SHIFT = 12.0


@dataclass(frozen=True)
class FitConfig:
    """Penalties on the dispersion, the optimiser's step, its limit and tolerance; shared: one dispersion, that of the first group, which alone is fitted then."""

    l1: float = 1e-3
    l2: float = 1e-4
    rate: float = 0.1
    steps: int = 500
    tolerance: float = 1e-6
    shared: bool = False


def log_rising(r: np.ndarray, y: np.ndarray) -> np.ndarray:
    """log(gamma(r + y) / gamma(r)) for r > 0 and y >= 0, without the loss of digits that two large logs would have."""
    out = np.zeros(np.broadcast(r, y).shape)
    low = r + np.zeros_like(out)
    high = low + y
    while (small := low < SHIFT).any():
        out += np.where(small, np.log(np.where(small, high / low, 1.0)) * -1.0, 0.0)
        low, high = np.where(small, low + 1, low), np.where(small, high + 1, high)
    series = lambda z: 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return out + (low - 0.5) * np.log1p((high - low) / low) + (high - low) * np.log(high) - (high - low) + series(high) - series(low)


def rising_slope(r: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The derivative of log_rising by r."""
    out = np.zeros(np.broadcast(r, y).shape)
    low = r + np.zeros_like(out)
    high = low + y
    while (small := low < SHIFT).any():
        out += np.where(small, 1 / low - 1 / high, 0.0)
        low, high = np.where(small, low + 1, low), np.where(small, high + 1, high)
    series = lambda z: -1 / (2 * z) - 1 / (12 * z**2) + 1 / (120 * z**4) - 1 / (252 * z**6)
    return out + np.log1p((high - low) / low) + series(high) - series(low)


def _softplus(s: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, s)


class Batch:
    """Rows of counts with offsets and weights: y and offset (rows x samples), of (the group of each sample), weight (rows x groups), fixed (groups without dispersion)."""

    def __init__(self, y: np.ndarray, offset: np.ndarray, of: np.ndarray, weight: np.ndarray, fixed: np.ndarray, config: FitConfig):
        self.y, self.offset, self.of, self.weight, self.fixed, self.config = y, offset, of, weight, fixed, config
        self.share = np.zeros((y.shape[1], len(fixed)))
        self.share[np.arange(y.shape[1]), of] = 1 / np.bincount(of, minlength=len(fixed))[of]  # sums over samples to means over groups
        self.alone = log_rising(np.ones_like(y), y)  # log of the factorials

    def take(self, rows: np.ndarray) -> Batch:
        part = object.__new__(Batch)
        part.__dict__ = self.__dict__ | {"y": self.y[rows], "offset": self.offset[rows], "weight": self.weight[rows], "alone": self.alone[rows]}
        return part

    def loss(self, delta: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The loss of each row, and its slopes by delta and by s, whose softplus is the dispersion."""
        c = self.config
        mu = np.exp(self.offset + delta[:, self.of])
        alpha = np.where(self.fixed, 0.0, _softplus(s))
        a = alpha[:, self.of]
        r = 1 / (a + EPS)
        y = self.y
        logmu, both = np.log(mu + EPS), r + mu + EPS
        poisson = mu - y * logmu + self.alone
        nb = log_rising(r, y) - self.alone - r * np.log1p(mu / (r + EPS)) + y * (logmu - np.log(both))
        loss = ((1 - self.weight) * (poisson @ self.share) - self.weight * (nb @ self.share)) + np.where(self.fixed, 0.0, c.l1 * alpha + c.l2 * alpha**2)
        by_mu = (1 - y / (mu + EPS)) * mu
        nb_mu = (y / (mu + EPS) - (r + y) / both) * mu
        by_delta = (1 - self.weight) * (by_mu @ self.share) - self.weight * (nb_mu @ self.share)
        nb_r = rising_slope(r, y) - np.log1p(mu / (r + EPS)) + r / (r + EPS) - (r + y) / both
        by_alpha = -self.weight * ((-nb_r * r * r) @ self.share) + c.l1 + 2 * c.l2 * alpha
        by_s = np.where(self.fixed, 0.0, by_alpha / (1 + np.exp(-s)))
        return loss, by_delta, by_s


def fit(batch: Batch, delta: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """delta, dispersion and the number of steps of each row. Each row stops after the step at which its loss had settled."""
    c, rows = batch.config, len(delta)
    seen = 1 if c.shared else delta.shape[1]  # groups that enter the loss
    x = np.concatenate([delta, s], axis=1)
    groups = delta.shape[1]
    used = np.tile(np.arange(groups) < seen, 2)
    m, v, last, steps = np.zeros_like(x), np.zeros_like(x), np.full(rows, np.nan), np.zeros(rows, np.int32)
    live = np.arange(rows)
    for t in range(1, c.steps + 1):
        if not len(live):
            break
        part = batch if len(live) == rows else batch.take(live)
        loss, by_delta, by_s = part.loss(x[live, :groups], x[live, groups:])
        slope = np.concatenate([by_delta, by_s], axis=1) * used
        m[live] = 0.9 * m[live] + 0.1 * slope
        v[live] = 0.999 * v[live] + 0.001 * slope * slope
        x[live] -= c.rate * (m[live] / (1 - 0.9**t)) / (np.sqrt(v[live] / (1 - 0.999**t)) + 1e-8)
        now = loss[:, :seen].sum(1)
        steps[live] = t
        done = np.abs(last[live] - now) < c.tolerance
        last[live] = now
        live = live[~done]
    alpha = np.where(batch.fixed, 0.0, _softplus(x[:, groups:]))
    return x[:, :groups], alpha, steps


def fitted(m: DataFrame, groups: dict[str, list[str]], weights: dict[str, str | float], control: str = "del2", fixed: tuple[str, ...] = (), config: FitConfig = FitConfig()) -> DataFrame:
    """Adds for each group g: fit_g, its fitted log2 fold change against the control, and dispersion_g; dispersion, the mean of the groups that aren't fixed; fit_steps.

    m has the columns of baseline(). weights: for each group the share of the negative binomial, a number or a column, cut to 0 to 1. fixed groups are Poisson, without a
    dispersion. Null counts count as 0. A row that never settles stops at the limit of steps.
    """
    names = list(groups)
    samples = [s for cols in groups.values() for s in cols]
    of = np.array([k for k, cols in enumerate(groups.values()) for _ in cols])
    still = np.array([g in fixed for g in names])
    arms = [k for k, g in enumerate(names) if g not in fixed]
    start = np.array([-3.0 if g in fixed or k == 0 or config.shared else -2.0 for k, g in enumerate(names)])
    level = F.log(F.col(f"n_{control}") + F.col("pc"))
    share = [F.col(w) if isinstance(w := weights[g], str) else F.lit(float(w)) for g in names]
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    inputs = [F.array(*[number(F.col(s)) for s in samples]).alias("_y"), F.array(*[level + F.log(F.greatest(f"sf_{s}", F.lit(1e-12))) for s in samples]).alias("_o")]
    inputs += [level.alias("_l"), F.array(*[F.least(F.greatest(number(w), F.lit(0.0)), F.lit(1.0)) for w in share]).alias("_w")]
    added = [*[f"fit_{g}" for g in names], *[f"dispersion_{g}" for g in names], "dispersion"]
    schema = StructType([*m.schema.fields, *[StructField(c, DoubleType()) for c in added], StructField("fit_steps", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lambda column: column.flatten().to_numpy().reshape(len(column), -1)
        for rows in batches:
            if not len(rows):
                continue
            y, offset, level, weight = table(rows.column("_y")), table(rows.column("_o")), rows.column("_l").to_numpy(), table(rows.column("_w"))
            batch = Batch(y, offset, of, weight, still, config)
            mean = batch.share
            delta = np.log((y @ mean + 1e-6) / (np.exp(level[:, None] + (offset - level[:, None]) @ mean) + 1e-6))
            delta, alpha, steps = fit(batch, delta, np.tile(start, (len(y), 1)))
            if config.shared:
                alpha = np.where(still, 0.0, alpha[:, :1])
            middle = alpha[:, arms].mean(1) if arms else np.zeros(len(y))
            found = [*(delta / np.log(2.0)).T, *alpha.T, middle]
            columns = [*rows.columns[:-4], *[pa.array(np.ascontiguousarray(c)) for c in found], pa.array(steps)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return m.select("*", *inputs).mapInArrow(run, schema)
