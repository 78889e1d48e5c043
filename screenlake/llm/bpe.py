"""Pieces of a SentencePiece BPE model and the pair rule that makes its encoding a path problem.

A BPE encoding is settled by its neighbours: a sequence of pieces is the encoding of its text exactly when
each adjacent pair is the encoding of the pair's own text. So the last piece of every prefix is the one piece
that ends there and agrees with the last piece of the prefix before it, and one pass over the pieces that
occur in a text finds the encoding of all its prefixes (`Pieces.settle`, for many texts side by side). A text splits where a space follows another
character, as no piece of such a model has a space after anything but a space; the splits (chunks) repeat a
lot and are cached, one cache for each Python worker.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

SPACE = "▁"  # the model's mark for a space
PAIR_LIMIT = 200_000  # pairs of pieces that are known to agree or not
SLICE_CHARS = 200_000  # new text that is settled at once, and whose suffixes are sorted at once
CACHE_CHARS = 4_000_000  # characters of the keys of one generation of a cache, with KEY_CHARS more for each
KEY_CHARS = 10
LONGEST_KEPT = 1_000  # characters of a key; longer ones hardly ever come again
FEW = 6  # parts that are relaxed one by one


class Cache(dict):
    """A dict of bounded size: when it is full its entries become the old generation, from which those that are used again return. Values are about as long as their keys."""

    def __init__(self, limit: int = CACHE_CHARS):
        super().__init__()
        self.old: dict = {}
        self.limit = limit
        self.chars = 0

    def __missing__(self, key):
        return self.old.get(key)

    def put(self, key, value):
        if len(key) > LONGEST_KEPT or key in self:
            return value
        if self.chars >= self.limit:
            self.old = dict(self)
            self.clear()
            self.chars = 0
        self.chars += len(key) + KEY_CHARS
        self[key] = value
        return value

    def put_all(self, entries: dict) -> None:
        for key in entries.keys() - self.keys():
            self.put(key, entries[key])


@dataclass(frozen=True)
class Settled:
    """Parts laid end to end with one place between them: where each starts, its size, and for the prefix that ends at a place its last piece's number, where that
    begins, and the prefix's token count."""

    start: np.ndarray
    size: np.ndarray
    last: np.ndarray
    back: np.ndarray
    count: np.ndarray


class Pieces:
    """The vocabulary of one model file and cached merges."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.id: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte: dict[int, int] = {}
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)):
                self.id[piece] = i
                self.score[piece] = self.model.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("pieces with an inner space need another way to split texts")
        self.longest = max(map(len, self.id))
        self.beside = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        self.beside_codes = np.array(sorted(ord(a) << 21 | ord(b) for a, b in self.beside))
        self.names = sorted(self.id)  # a piece's place here is its number; an unknown character's is its code point after these
        self.number = {p: i for i, p in enumerate(self.names)}
        self.ids_of = np.array([self.id[p] for p in self.names], "<u4")
        self.long = np.array([i for i, p in enumerate(self.names) if len(p) > 1])
        self.length_of = np.array([len(p) for p in self.names])
        self.wide = np.array([self.names[i] for i in self.long], dtype=f"U{self.longest}")
        self.after = np.array([p[:-1] + chr(ord(p[-1]) + 1) for p in self.wide.tolist()], dtype=f"U{self.longest}")
        self.single = np.array(sorted(ord(p) for p in self.id if len(p) == 1))
        self.single_number = np.array([self.number[chr(c)] for c in self.single])
        self._pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merges from characters, the best pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, left: str, right: str) -> bool:
        """Whether the two pieces stay as they are when their texts meet; an empty left stands for the start."""
        return self.merged(left + right) == ([left, right] if left else [right])

    def apart(self, chunk: str) -> list[str]:
        """The chunk's parts between neighbouring characters that no piece has side by side."""
        pairs, cuts = self.beside, [0]
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in pairs:
                cuts.append(i)
        return [chunk[a:b] for a, b in zip(cuts, [*cuts[1:], len(chunk)], strict=True)]

    def all_apart(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """The parts of chunks, of which none is empty, end to end, and how many each chunk has."""
        text = "".join(chunks)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        pairs = codes[:-1] << 21 | codes[1:]
        cut = self.beside_codes[np.minimum(np.searchsorted(self.beside_codes, pairs), len(self.beside_codes) - 1)] != pairs
        start = np.cumsum([0, *map(len, chunks)])
        cut[start[1:-1] - 1] = True
        at = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(text)]))
        return [text[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.diff(np.searchsorted(at, start))

    def text(self, number: int) -> str:
        return self.names[number] if number < len(self.names) else chr(number - len(self.names))

    def occurrences(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begins, ends and numbers of all occurrences of all pieces of two characters or more in text.

        The text's suffixes are sorted on as many characters as the longest piece has, SLICE_CHARS of them at a time; each piece's occurrences are a range of them.
        """
        found = []
        for at in range(0, len(text), SLICE_CHARS):
            begin, number = self._ranges(text[at : at + SLICE_CHARS + self.longest - 1], min(SLICE_CHARS, len(text) - at))
            found.append((begin + at, number))
        begin, number = (np.concatenate(x) for x in zip(*found, strict=True))
        return begin, begin + self.length_of[number], number

    def _ranges(self, text: str, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Begins, below most, and numbers of all occurrences of pieces of two characters or more in text."""
        codes = np.frombuffer((text + "\0" * self.longest).encode("utf-32-le"), dtype=np.uint32)
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, self.longest)[:most])
        suffixes = windows.view(f"<U{self.longest}").ravel()
        order = np.argsort(suffixes, kind="stable")
        ordered = suffixes[order]
        low, high = np.searchsorted(ordered, self.wide), np.searchsorted(ordered, self.after)
        counts = high - low
        begin = order[np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
        return begin, np.repeat(self.long, counts)

    def settle(self, parts: list[str]) -> Settled:
        """The last piece of every prefix of every part (none is empty), by relaxing edges from left to right, those of all parts side by side."""
        text, known = "\0".join(parts), len(self.names)
        size = np.array([len(p) for p in parts])
        start = np.cumsum(size + 1) - size - 1
        of = np.repeat(np.arange(len(parts)), size + 1)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        place = np.minimum(np.searchsorted(self.single, codes), len(self.single) - 1)
        alone = np.where(self.single[place] == codes, self.single_number[place], known + codes)
        inside = np.ones(len(text), bool)
        inside[start[1:] - 1] = False
        here = np.flatnonzero(inside)
        begin, end, number = (np.concatenate(x) for x in zip(self.occurrences(text), (here, here + 1, alone[here]), strict=True))
        step = begin - start[of[begin]]
        order = np.argsort(step, kind="stable")
        begin, end, number = begin[order], end[order], number[order]
        bounds = np.searchsorted(step[order], np.arange(size.max() + 1))
        cost = np.where(number < known, 1, 1 + (number >= known + 0x80) + (number >= known + 0x800) + (number >= known + 0x10000))
        last, back, count = np.full(len(text) + 1, -1), np.full(len(text) + 1, -1), np.zeros(len(text) + 1, np.int64)
        last[start] = -2

        def merge(at: np.ndarray) -> None:
            """Settles prefixes where no pair agreed by merging their text."""
            for e in at.tolist():
                i = of[e - 1]
                piece = self.merged(parts[i][: e - start[i]])[-1]
                last[e], back[e] = self.number.get(piece, known + ord(piece[0])), e - len(piece)
                count[e] = count[back[e]] + self.cost(piece)

        alive = len(parts) - np.searchsorted(np.sort(size), np.arange(size.max()), "right")  # parts that are longer
        side_by_side = int((alive > FEW).sum())
        for k in range(side_by_side):
            s = slice(bounds[k], bounds[k + 1])
            b, e, piece, price = begin[s], end[s], number[s], cost[s]
            merge(np.unique(b[last[b] == -1]))
            open_ = last[e] == -1
            b, e, piece, price = b[open_], e[open_], piece[open_], price[open_]
            pairs, which = np.unique((last[b] + 2) * (1 << 21) + piece, return_inverse=True)
            fits = np.array([self._fits(p) for p in pairs.tolist()], bool)[which]
            b, e = b[fits], e[fits]
            last[e], back[e], count[e] = piece[fits], b, count[b] + price[fits]
        if side_by_side < size.max():
            self._relax_one_by_one(slice(bounds[side_by_side], None), begin, end, number, cost, last, back, count, merge)
        merge((start + size)[last[start + size] == -1])
        return Settled(start, size, last, back, count)

    def _relax_one_by_one(self, rest: slice, begin: np.ndarray, end: np.ndarray, number: np.ndarray, cost: np.ndarray, last: np.ndarray, back: np.ndarray, count: np.ndarray, merge: Callable) -> None:
        """The edges of the few parts that go on, in order: array operations for one part's next place would cost more than the edge itself."""
        seen, pairs = {}, self._pairs
        for b, e, piece, price in zip(begin[rest].tolist(), end[rest].tolist(), number[rest].tolist(), cost[rest].tolist(), strict=True):
            left = seen.get(b)
            if left is None:
                if last[b] == -1:
                    merge(np.array([b]))
                left = seen[b] = (int(last[b]), int(count[b]))
            if e in seen or last[e] != -1:
                continue
            pair = (left[0] + 2) * (1 << 21) + piece
            fits = pairs.get(pair)
            if self._fits(pair) if fits is None else fits:
                last[e], back[e], count[e] = piece, b, left[1] + price
                seen[e] = (piece, left[1] + price)

    def _fits(self, pair: int) -> bool:
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= PAIR_LIMIT:
                self._pairs.clear()
            left = (pair >> 21) - 2
            known = self._pairs[pair] = self.agree(self.text(left) if left >= 0 else "", self.text(pair & ((1 << 21) - 1)))
        return known

    def id_bytes(self, settled: Settled) -> list[bytes]:
        """Each part's ids, as little-endian unsigned 32-bit numbers."""
        at, ends = settled.start + settled.size, []
        alive = at > settled.start
        while alive.any():
            ends.append(at[alive])
            at[alive] = settled.back[at[alive]]
            alive = at > settled.start
        end = np.sort(np.concatenate(ends))
        numbers = settled.last[end]
        price = settled.count[end] - settled.count[settled.back[end]]
        known = numbers < len(self.names)
        ids = np.repeat(self.ids_of[np.where(known, numbers, 0)], price)
        first = np.cumsum(price) - price
        for i in np.flatnonzero(~known).tolist():
            ids[first[i] : first[i] + price[i]] = [self.byte[b] for b in self.text(int(numbers[i])).encode("utf-8")]
        blob, stop = ids.astype("<u4").tobytes(), (4 * np.cumsum(settled.count[settled.start + settled.size])).tolist()
        return [blob[a:b] for a, b in zip([0, *stop], stop)]

    def cost(self, piece: str) -> int:
        return 1 if piece in self.id else len(piece.encode("utf-8"))


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One copy for each model and Python worker."""
    return Pieces(path)


def slices(parts: list[str]) -> list[list[str]]:
    """The parts in order, in lists of about SLICE_CHARS characters."""
    out, size = [], SLICE_CHARS
    for p in parts:
        if size >= SLICE_CHARS:
            out.append([])
            size = 0
        out[-1].append(p)
        size += len(p) + 1
    return out


_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def chunks(text: str) -> list[str]:
    """The parts of a text, in order, that the model encodes independently of one another.

    A line break is a chunk of its own (no piece holds one); else a chunk is a run of spaces and what follows it.
    """
    if not text:
        return []
    out: list[str] = []
    for k, line in enumerate((SPACE + text.replace(" ", SPACE)).split("\n")):
        if k:
            out.append("\n")
        if SPACE + SPACE in line or line.endswith(SPACE):
            out += _RUNS.findall(line)
        elif line:
            first, *rest = line.split(SPACE)
            if first:
                out.append(first)
            out += [SPACE + w for w in rest]
    return out
