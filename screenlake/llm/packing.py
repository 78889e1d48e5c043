"""Packing of tokenised documents into sequences of fixed length (operator 8).

Documents are dealt by a hash of their id and tokens into groups of about GROUP_DOCS, so a group is a random part of the
corpus and its size doesn't follow any source. Within a group, whole sequences are cut off long documents,
and what is left of each is placed by first-fit decreasing: the longest first, each into the first sequence
that still has room, found by a tournament tree over the sequences' free places. Then sequences that are
neither full nor a power of two long are closed up: the emptiest are taken apart and their pieces, cut where
needed, fill the others; what is left over is laid into sequences whose lengths are powers of two, which need
no padding.

A null or empty text has only the end id. Repeated rows are packed once each. An empty table gives an empty result.
Columns other than those named are ignored. Texts of any length are packed whole.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Cache
from .common import small_batches

GROUP_DOCS = 1024
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tree:
    """A tournament tree: each node holds the greatest free room below it, so the first bin with room is found from the top."""

    def __init__(self, bins: int):
        self.width = 1
        while self.width < max(1, bins):
            self.width *= 2
        self.room = [0] * (2 * self.width)

    def set(self, at: int, room: int) -> None:
        at += self.width
        self.room[at] = room
        while at > 1:
            at //= 2
            self.room[at] = max(self.room[2 * at], self.room[2 * at + 1])

    def first(self, need: int) -> int:
        """The first bin with at least this room, or -1."""
        if self.room[1] < need:
            return -1
        at = 1
        while at < self.width:
            at = 2 * at if self.room[2 * at] >= need else 2 * at + 1
        return at - self.width


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices of sizes (each from 1 to capacity); equal sizes go in the order given."""
    tree, bins = Tree(len(sizes)), []
    for i in range(len(sizes)):
        tree.set(i, capacity)
    room = [capacity] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.first(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
        room[at] -= sizes[i]
        tree.set(at, room[at])
    return bins


def packed(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that cover documents of these lengths (1 or more)."""
    full: list[list[tuple[int, int, int]]] = []
    tails: list[tuple[int, int, int]] = []
    for d, n in enumerate(lengths):
        full += [[(d, s, capacity)] for s in range(0, n - capacity + 1, capacity)]
        if n % capacity:
            tails.append((d, n - n % capacity, n % capacity))
    open_: list[list[tuple[int, int, int]]] = []
    for at in first_fit_decreasing([t[2] for t in tails], capacity):
        pieces = [tails[i] for i in at]
        used = sum(p[2] for p in pieces)
        (full if used & (used - 1) == 0 else open_).append(pieces)
    open_.sort(key=lambda pieces: -sum(p[2] for p in pieces))
    low, high = 0, len(open_)
    spare: list[tuple[int, int, int]] = []

    def take(need: int) -> list[tuple[int, int, int]]:
        """Pieces of this length in all from the spare ones, the last one cut."""
        out = []
        while need:
            d, s, n = spare.pop()
            if n > need:
                spare.append((d, s + need, n - need))
                n = need
            out.append((d, s, n))
            need -= n
        return out

    while low < high:
        need = capacity - sum(p[2] for p in open_[low])
        while sum(p[2] for p in spare) < need and high - 1 > low:
            high -= 1
            spare = open_[high][::-1] + spare
        if sum(p[2] for p in spare) < need:
            spare += open_[low]
        else:
            full.append(open_[low] + take(need))
        low += 1
    left = sum(p[2] for p in spare)
    for bit in reversed(range(left.bit_length())):
        if left >> bit & 1:
            full += [take(min(capacity, 1 << bit)) for _ in range(max(1, (1 << bit) // capacity))]
    return full


# Marks after a Latin letter and before a blank are a part of their own. Not so <, > and |, of which special tokens are made, nor marks after the one letter that falls apart in lower case (U+0130).
_STOP = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([!-/:;=?@\[-`{}~]+)( |$)"
SLICE_BYTES = 12 << 20  # of text whose different parts are looked up at once


class Tokens:
    """Ids of whole texts. A text's ids are those of its parts between blanks, as the tokenizer lowers case and drops white space; the parts' ids are cached."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Cache(2_400_000)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of parts. Words of letters are encoded many at once, as each of them ends with an id that ends a word and has no other one."""
        letters = [w for w in new if w.isalpha()]
        rest = [w for w in new if not w.isalpha()]
        out: dict[str, bytes] = {}
        for k in range(0, len(letters), 4096):
            runs = [letters[i : i + 128] for i in range(k, min(k + 4096, len(letters)), 128)]
            for words, found in zip(runs, self._encoded([" ".join(r) for r in runs]), strict=True):
                ids = np.array(found, "<u4")
                stop = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
                if len(stop) != len(words):
                    rest += words
                    continue
                blob = ids.tobytes()
                out |= zip(words, [blob[a:b] for a, b in zip([0, *stop], stop)], strict=True)
        for k in range(0, len(rest), 4096):
            some = rest[k : k + 4096]
            out |= {w: np.array(ids, "<u4").tobytes() for w, ids in zip(some, self._encoded(some), strict=True)}
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and where each text's begin, with the end of the last one."""
        plain = pc.ascii_lower(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "))
        split = pc.split_pattern(pc.replace_substring_regex(plain, _STOP, r"\1 \2\3"), " ")
        words = split.flatten().dictionary_encode()
        parts = words.dictionary.to_pylist()
        found = list(map(self.known.get, parts))
        old = self.known.old
        asked = [i for i, ids in enumerate(found) if ids is None]
        again = [old.get(parts[i]) for i in asked]
        new = self._learn([parts[i] for i, ids in zip(asked, again, strict=True) if ids is None])
        for i, ids in zip(asked, again, strict=True):
            found[i] = self.known.put(parts[i], new[parts[i]] if ids is None else ids)
        every = pa.array(found, pa.large_binary()).take(words.indices)
        stop = np.frombuffer(every.buffers()[1], np.int64)[: len(every) + 1] // 4
        ids = np.frombuffer(every.buffers()[2] or b"", "<u4")[: stop[-1]]
        begin = split.offsets.to_numpy()
        return ids, stop[begin - begin[0]]


@functools.lru_cache(maxsize=2)
def tokens_of(path: str) -> Tokens:
    """One for each tokenizer and Python worker."""
    return Tokens(path)


def sequences(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 2048,
    group_docs: int = GROUP_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece: its document and place there, its ids' CRC-32, and its sequence and place there.

    The ids travel once, to the group of their document. The number of groups follows the number of documents,
    so a group's memory doesn't grow with the corpus. A sequence's id is made of its group and its number there.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    groups = max(1, -(-rows.count() // group_docs))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side already
        known = tokens_of(tokenizer)
        for part in small_batches(batches, SLICE_BYTES):
            ids, begin = known.ids(part.column(1))
            ids = np.insert(ids, begin[1:], end_id)
            begin = begin + np.arange(len(begin))
            if ids.max(initial=0) < 65536:
                buffers = [None, pa.py_buffer((2 * begin).astype(np.int32)), pa.py_buffer(ids.astype("<u2"))]
                packed_ids = pa.Array.from_buffers(pa.binary(), len(part), buffers)
            else:  # an odd size marks 32-bit ids
                packed_ids = pa.array([b"\0" + ids[a:b].tobytes() for a, b in zip(begin, begin[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), packed_ids], ["doc_id", "ids"])

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "ids"], ignore_index=True)
        ids = [np.frombuffer(b, "<u2") if len(b) % 2 == 0 else np.frombuffer(b[1:], "<u4") for b in group["ids"]]
        out = []
        for k, pieces in enumerate(packed([len(i) for i in ids], capacity)):
            at = 0
            for d, s, n in pieces:
                crc = zlib.crc32(ids[d][s : s + n].astype("<u4").tobytes())
                out.append((group["doc_id"][d], s, n, crc, len(ids[d]), int(key[0]) << 32 | k, at))
                at += n
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return (
        rows.mapInArrow(tokens, "doc_id long, ids binary")
        .groupBy(F.pmod(F.xxhash64("doc_id", "ids"), F.lit(groups)).alias("part"))
        .applyInPandas(pack, SCHEMA)
    )
