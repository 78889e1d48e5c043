"""Toxicity scores by non-negative positive-unlabelled learning (operator 3).

The classifier sees confirmed toxic texts and texts whose labels it doesn't look at. Its risk is
  prior * risk of positives as positive + max(0, risk of unlabelled as negative - prior * risk of positives as negative),
and where the bracket turns negative a step goes the other way, so that the unlabelled part isn't fitted below what it
can be. The class prior is the share of toxic rows among the labelled rows that training may see. Features are a text's distinct
words that two toxic texts of the sample or more hold and that are commoner there than in the rest of it, each one as large as the logarithm of
how much commoner, so that a penalty on the weights, the weaker the more toxic texts there are, decides between them; the model is a linear one, trained by numpy.

Training uses bounded samples (MOST_POSITIVE, MOST_UNLABELLED rows by a hash of their id): Spark counts and chooses the words, and only the pairs of a
text and a chosen word reach the driver. Scoring reads every text, whole.
Nulls and empty texts have no words and get the model's score of nothing. Repeated rows and ids give a row each. Without labelled toxic rows
every score is 0. An empty table gives an empty result. Columns other than those named are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MOST_POSITIVE = 3000
MOST_UNLABELLED = 9000
MOST_WORDS = 20000
FOLDS = 5

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass(frozen=True)
class Held:
    """The chosen words that texts hold, as pairs of a text's number and a word's."""

    texts: int
    text: np.ndarray
    word: np.ndarray


@dataclass(frozen=True)
class Model:
    """Weights of words and a bias; the score is the logistic function of their sum."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        z = self.bias + math.fsum(self.weights[w] for w in self.weights.keys() & words(text))  # the same in any order
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(words: list[str], sizes: np.ndarray, positive: Held, unlabelled: Held, prior: float, steps: int = 600, rate: float = 0.05, penalty: float = 0.05) -> Model:
    """Trains by Adam over the whole sample; prior is the share of positives among the unlabelled, sizes are those of the words as features."""
    if not positive.texts or not unlabelled.texts:
        return Model({}, -30.0)
    decay = penalty / positive.texts

    def sums(x: Held) -> np.ndarray:
        return w[-1] + np.bincount(x.text, (w[:-1] * sizes)[x.word], x.texts)

    def gradient(x: Held, errors: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(x.word, errors[x.text], len(words)) * sizes, errors.sum()) / x.texts

    w = np.zeros(len(words) + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        zp, zu = sums(positive), sums(unlabelled)
        fp, fu = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        as_positive = gradient(positive, fp - 1)  # gradients of the logistic loss
        pos_negative, all_negative = gradient(positive, fp), gradient(unlabelled, fu)
        excess = np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp))
        g = prior * as_positive + all_negative - prior * pos_negative if excess >= 0 else prior * pos_negative - all_negative
        g[:-1] += decay * w[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Model(dict(zip(words, map(float, w[:-1] * sizes), strict=True)), float(w[-1]))


def held_out(id_col: str = "doc_id"):
    """Rows whose labels training never sees."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0


def _sampled(ids: DataFrame, docs: DataFrame, side: str) -> DataFrame:
    """side, doc_id and the distinct words of the texts of a bounded set of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(words(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["doc_id", "words"])

    rows = docs.join(F.broadcast(ids), "doc_id", "left_semi")  # MOST_POSITIVE or MOST_UNLABELLED ids
    return rows.mapInArrow(run, "doc_id long, words array<string>").select(F.lit(side).alias("side"), "doc_id", "words")


def _features(sample: DataFrame, p: int, u: int) -> DataFrame:
    """word and size of the words that two positive texts or more hold and that are commoner there: at most MOST_WORDS, those that stand out most.

    The size is the logarithm of the word's smoothed share among positives over that among the unlabelled; how far it stands out is the difference of
    its shares in standard errors.
    """
    held = sample.select("side", F.explode("words").alias("word"))
    counts = held.groupBy("word").agg(F.count_if(F.col("side") == "p").alias("a"), F.count_if(F.col("side") == "u").alias("b"))
    size = F.log((F.col("a") + 0.5) / (p + 1) * (u + 1) / (F.col("b") + 0.5))
    m = (F.col("a") + F.col("b")) / F.lit(p + u)
    gain = (F.col("a") / F.lit(p) - F.col("b") / F.lit(u)) / F.sqrt(m * (1 - m) * (1 / p + 1 / u) + 1e-12)
    return counts.filter("a >= 2").select("word", size.alias("size"), gain.alias("gain")).filter("size > 0").orderBy(F.desc("gain"), "word").limit(MOST_WORDS).select("word", "size")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labels outside the held-out fold."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    seen = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    counts = seen.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1)), F.lit(0)).alias("p")).first()
    if not counts["p"]:
        return Model({}, -30.0)
    first = lambda ids, n: ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    positive = first(seen.filter("toxic = 1").select("doc_id").distinct(), MOST_POSITIVE)
    unlabelled = first(docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out()), MOST_UNLABELLED)
    prior = min(0.5, max(1e-3, counts["p"] / counts["n"]))
    sample = _sampled(positive, docs, "p").unionByName(_sampled(unlabelled, docs, "u"))
    sample = written(sample.withColumn("row", F.monotonically_increasing_id()), "sample")
    rows = {side: sample.filter(F.col("side") == side).select("row").toArrow()["row"].to_numpy() for side in "pu"}
    if not len(rows["p"]) or not len(rows["u"]):
        return Model({}, -30.0)
    chosen = written(_features(sample, len(rows["p"]), len(rows["u"])), "words")
    table = chosen.toArrow().sort_by("word")
    number = pa.table({"word": table["word"], "number": pa.array(np.arange(len(table)))})
    numbers = docs.sparkSession.createDataFrame(number.to_pandas(), "word string, number long")
    pairs = sample.select("side", "row", F.explode("words").alias("word")).join(F.broadcast(numbers), "word").select("side", "row", "number").toArrow()  # MOST_WORDS words

    def held(side: str) -> Held:
        some = pairs.filter(pa.compute.equal(pairs["side"], side)).sort_by([("row", "ascending"), ("number", "ascending")])
        ids = np.sort(rows[side])
        return Held(len(ids), np.searchsorted(ids, some["row"].to_numpy()), some["number"].to_numpy())

    return fit(table["word"].to_pylist(), table["size"].to_numpy(), held("p"), held("u"), prior)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """For each row: id, held_out, score, predicted; with keep, the rows that score below one half, with their own columns, instead. A map without a shuffle."""
    if keep:

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: model.score(t or ""))

        name = "tox_score"
        while name in docs.columns:
            name = "_" + name
        return docs.withColumn(name, score(F.col(text_col))).filter(F.col(name) < 0.5).drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(run, "doc_id long, score double")
        .select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
    )
