"""SentencePiece encoding and decoding by suffix-array matching (operator 10).

The distinct chunks of a batch of texts that aren't known yet are laid end to end. Their suffixes are sorted once, on as many
characters as the longest piece has; a binary search of every piece then gives the range of suffixes that
begin with it, which are all its occurrences in the batch. The occurrences are edges of a graph over
positions; sorted by where they begin, they are relaxed from left to right. The file at hand is a BPE model,
so an edge settles its end where its piece agrees with the last piece before it (bpe.py), which yields the
library's encoding and not merely a cheapest path.

Nulls and empty texts have no pieces and decode to an empty text. Texts of any length are read whole. Repeated rows
and ids give a row each. An empty table gives an empty result. Columns other than those named are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import small_batches


class Encoder:
    """Encodes batches of texts; chunks that are known from earlier batches aren't matched again."""

    def __init__(self, path: str):
        self.pieces = bpe.pieces(path)
        self.known = bpe.Cache()
        self.parts = bpe.Cache()
        spelled = {i: p.replace(bpe.SPACE, " ").encode("utf-8") for p, i in self.pieces.id.items()} | {i: bytes([b]) for b, i in self.pieces.byte.items()}
        top = max(spelled) + 1
        self.is_byte = np.isin(np.arange(top), list(self.pieces.byte.values()))
        self.length = np.array([len(spelled.get(i, b"")) for i in range(top)])
        self.first = np.cumsum(self.length) - self.length
        self.letters = np.frombuffer(b"".join([spelled.get(i, b"") for i in range(top)]), np.uint8)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        split = [bpe.chunks(t) for t in texts]
        found = {c: self.known.get(c) or self.known[c] for c in dict.fromkeys(chain.from_iterable(split))}
        apart = {c: self.pieces.apart(c) for c, ids in found.items() if ids is None}
        parts = {p: self.parts.get(p) or self.parts[p] for some in apart.values() for p in some}
        for new in bpe.slices([p for p, ids in parts.items() if ids is None]):
            parts |= zip(new, self.pieces.id_bytes(self.pieces.settle(new)), strict=True)
        for p, ids in parts.items():
            self.parts.put(p, ids)
        for c, some in apart.items():
            found[c] = b"".join([parts[p] for p in some])
        for c, ids in found.items():
            self.known.put(c, ids)
        return [b"".join(map(found.__getitem__, some)) for some in split]

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces joined, bytes put together, marks turned into spaces and the first one dropped."""
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        n = self.length[numbers]
        letters = self.letters[np.repeat(self.first[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        text = letters.tobytes().decode("utf-8", "replace").replace(bpe.SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each model and Python worker."""
    return Encoder(path)


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id and ids, the whole text's piece ids. A map over partitions, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for part in small_batches(batches):
            ids = own.encode([t or "" for t in part.column(1).to_pylist()])
            lists = [np.frombuffer(i, "<u4").astype(np.int32) for i in ids]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decoded(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """For each row: id and text, from its piece ids (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            texts = [own.decode(np.array(i or [], "<u4").tobytes()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, "doc_id long, text string"
    )


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id, n_pieces, n_byte_pieces, ids_crc32 (of little-endian 32-bit ids), same_text (decoding gives the text back).

    Encodes and decodes in one map, so that the ids never leave the worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for part in small_batches(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            ids = own.encode(texts)
            rows = [np.frombuffer(i, "<u4") for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([int(own.is_byte[r].sum()) for r in rows], pa.int64()),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                    pa.array([own.decode(i) == t.replace(bpe.SPACE, " ") for i, t in zip(ids, texts, strict=True)], pa.bool_()),
                ],
                ["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "same_text"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, same_text boolean"
    )
