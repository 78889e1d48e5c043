"""Exact token counts at every prefix of a text (operator 4).

count[i] is the number of tokens of text[:i], as the model's own library would encode it. It follows from the
counts of shorter prefixes by dynamic programming over the pieces that end at i (see bpe.py), so one pass
answers how long a text is, where it has to be cut for a budget, and what any prefix costs, without encoding
again.

Nulls and empty texts count 0 tokens and 0 bytes. Texts of any length are read whole; work is linear in their
length. Repeated rows and ids give a row each. An empty table gives an empty result. Columns other than the
two that are named are ignored, whatever their names.
"""

from __future__ import annotations

import functools
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import small_batches


class PrefixCounts:
    """Token counts of all prefixes of texts under one model."""

    def __init__(self, path: str):
        self.pieces = bpe.pieces(path)
        self.known = bpe.Cache()  # token counts of chunks
        self.parts = bpe.Cache()  # and of the parts of those that fall into several
        self.inner = bpe.Cache()  # token counts of the prefixes of chunks that were asked for
        self.now: dict[str, int] = {}  # chunks of the texts at hand

    def learn(self, chunks: list[str]) -> None:
        """Token counts of chunks; those that are new are settled together."""
        known, old = self.known, self.known.old
        found = {c: known.get(c) or old.get(c) for c in dict.fromkeys(chunks)}
        for some in bpe.slices([c for c, n in found.items() if n is None]):
            found.update(zip(some, self._counted(some), strict=True))
        self.now = found
        known.put_all(found)

    def _counted(self, chunks: list[str]) -> list[int]:
        """Token counts of chunks that aren't known: the sums of their parts'."""
        parts, number = self.pieces.all_apart(chunks)
        whole = np.repeat(number == 1, number)
        counts = {p: None if alone else self.parts.get(p) or self.parts[p] for p, alone in zip(parts, whole.tolist(), strict=True)}
        new = [p for p, n in counts.items() if n is None]
        if new:
            settled = self.pieces.settle(new)
            counts.update(zip(new, settled.count[settled.start + settled.size].tolist(), strict=True))
        self.parts.put_all({p: counts[p] for p, alone in zip(parts, whole.tolist(), strict=True) if not alone})
        return np.add.reduceat(np.fromiter(map(counts.__getitem__, parts), np.int64, len(parts)), np.cumsum(number) - number).tolist()

    def learn_inner(self, chunks: list[str]) -> dict[str, tuple[int, ...]]:
        """Token counts of the prefixes of chunks, the empty one included; those that are new are settled together."""
        found = {c: self.inner.get(c) or self.inner[c] for c in dict.fromkeys(chunks)}
        for some in bpe.slices([c for c, counts in found.items() if counts is None]):
            parts, number = self.pieces.all_apart(some)
            settled = self.pieces.settle(parts)
            count, at = settled.count.tolist(), 0
            for c, n in zip(some, number.tolist(), strict=True):
                whole = [0]
                for a, size in zip(settled.start[at : at + n].tolist(), settled.size[at : at + n].tolist(), strict=True):
                    so_far = whole[-1]
                    whole += [so_far + x for x in count[a + 1 : a + size + 1]]
                found[c] = tuple(whole)
                at += n
        self.inner.put_all(found)
        return found

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """Token counts of the chunk's prefixes."""
        return self.inner.get(chunk) or self.inner[chunk] or self.learn_inner([chunk])[chunk]

    def totals(self, text: str) -> tuple[list[str], list[int]]:
        """The text's chunks and the token count before each one, with the whole text's count at the end."""
        parts = bpe.chunks(text)
        if any(p not in self.now for p in parts):
            self.learn(parts)
        now = self.now
        return parts, [0, *accumulate([now[p] for p in parts])]

    def all_prefixes(self, text: str) -> list[int]:
        """count[i] for i from 0 to the text's length; the mark before the text costs nothing until it begins."""
        parts, before = self.totals(text)
        out: list[int] = [0] if not parts else []
        inner = self.learn_inner(parts)
        for k, part in enumerate(parts):
            out += [before[k] + c for c in inner[part][1:]]
        if out and parts:
            out[0] = 0  # the space mark that the model puts before a text
        return out

    def longest_within(self, text: str, budget: int) -> int:
        """Characters of the longest prefix with at most budget tokens."""
        parts, before = self.totals(text)
        return self._within(parts, before, budget, {})

    def _within(self, parts: list[str], before: list[int], budget: int, known: dict[str, tuple[int, ...]]) -> int:
        if before[-1] <= budget:
            return max(0, sum(map(len, parts)) - 1)
        at = bisect_right(before, budget) - 1  # chunk totals never fall, so the cut lies in this chunk or just after it
        chars = sum(map(len, parts[:at]))
        inner = [i for i, c in enumerate(known.get(parts[at]) or self.chunk(parts[at])) if before[at] + c <= budget]
        return max(0, chars + inner[-1] - 1)

    def measure(self, texts: list[str], budget: int) -> list[tuple[int, int]]:
        """For each text its tokens, and characters of its longest prefix within budget."""
        split = [bpe.chunks(t) for t in texts]
        self.learn(list(chain.from_iterable(split)))
        count = self.now.__getitem__
        totals = [sum(map(count, parts)) for parts in split]
        before = {k: [0, *accumulate(map(count, split[k]))] for k, n in enumerate(totals) if n > budget}
        inner = self.learn_inner([split[k][bisect_right(b, budget) - 1] for k, b in before.items()])
        return [(n, self._within(split[k], before[k], budget, inner) if n > budget else len(t)) for k, (t, n) in enumerate(zip(texts, totals, strict=True))]


@functools.lru_cache(maxsize=2)
def prefix_counts(path: str) -> PrefixCounts:
    """One for each model and Python worker."""
    return PrefixCounts(path)


def with_counts(docs: DataFrame, model: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id, n_bytes, n_tokens, over_limit (n_tokens > budget), fit_chars (longest prefix within budget).

    A map over partitions, without a shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = prefix_counts(model)
        for batch in small_batches(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = prefix.measure(texts, budget)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([n > budget for n, _ in found], pa.bool_()),
                    pa.array([c for _, c in found], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    )


def prefix_table(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id and prefix_counts, the token counts of text[:0], text[:1], ... up to the whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = prefix_counts(model)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([prefix.all_prefixes(text or "")], pa.list_(pa.int32()))],
                    ["doc_id", "prefix_counts"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        count, "doc_id long, prefix_counts array<int>"
    )
