"""Secret scans by rules and by character Markov models (operator 9).

Rules find assignments, access keys and long hexadecimal strings. Beyond them, a text's long runs of key characters, and the
pieces of such runs that rule spans leave, of any length, are scored by the log-likelihood ratio of two second-order character models: one of
random strings and one of ordinary identifiers. The models are trained from labelled samples: the rules' own finds and seeded random strings on
one side, the words and remaining long runs of a bounded sample of texts (SAMPLE_DOCS) and runs joined from such words on the other; long runs that look
random to a model without them are left out of the latter. A fifth of the words and runs is held out of training: the thresholds are such
that FALSE_RATE of its runs of SHORTEST_RUN characters and more would count as random, and for a shorter piece, of parts of these runs of its length.

Offsets are code points, ends exclusive; an assignment's span is the whole match. Nulls and empty texts have no spans. Texts of any length are
read whole, in time linear in their length. Repeated rows and ids give a row each. An empty table gives an empty
result. Columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

KINDS = ("assign", "access", "hex", "random")
SAMPLE_DOCS = 2000
SHORTEST_RUN = 20  # characters of a run that the models judge; shorter are only pieces of such runs
FALSE_RATE = 0.001  # share of held-out ordinary runs above the threshold
MOST_JOINED = 20000

# Keywords in either case, letters of ASCII only: (?i) would also take a long s and a Kelvin sign.
_EITHER = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
_KEYWORD = "|".join([*map(_EITHER, ("password", "passwd", "secret", "token")), _EITHER("api") + "_?" + _EITHER("key")])
_ASSIGN = re.compile(rf"""(?:{_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run's first AKIA gives its longest match, so a shorter one hides none
_HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs: a run that is too short holds no longer one
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_IDENTIFIER = re.compile(r"[A-Za-z0-9_-]{6,}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.full(128, len(ALPHABET), np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i
_N = len(ALPHABET) + 1  # with one code for the time before a run begins


def rule_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The rules' spans by kind, each kind's in order and apart from one another."""
    return {
        "assign": [m.span() for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6],
        "access": [m.span() for m in _ACCESS.finditer(text)],
        "hex": [m.span() for m in _HEX.finditer(text)],
    }


def line(spans: dict[str, list[tuple[int, int]]]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    flat = sorted((s, KINDS.index(k), e) for k, found in spans.items() for s, e in found)
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in flat)


@dataclass(frozen=True)
class Ratio:
    """Log-likelihood ratios of characters after the two before them, and the means, by length, above which a run counts as random."""

    table: np.ndarray
    thresholds: np.ndarray

    def score(self, run: str) -> float:
        """The run's mean log-likelihood ratio, random against ordinary."""
        a, b, c = _contexts(run)
        return float(self.table[a, b, c].mean())

    def random(self, run: str) -> bool:
        """Whether a run counts as a key; ruled lines and fillers, of one character, don't."""
        return len(set(run)) > 1 and self.score(run) > self.thresholds[min(len(run), SHORTEST_RUN)]


def _contexts(run: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.concatenate(([_N - 1, _N - 1], _CODE[np.frombuffer(run.encode("ascii"), np.uint8)]))
    return codes[:-2], codes[1:-1], codes[2:]


def _markov(runs: list[str]) -> np.ndarray:
    """log P(c | a, b): counts of pairs of characters before c, smoothed by one character before it, and that by all."""
    three = np.zeros((_N, _N, _N))
    for run in runs:
        np.add.at(three, _contexts(run), 1)
    one = three.sum((0, 1)) + 0.5
    one /= one.sum()
    two = three.sum(0) + 8 * one
    two /= two.sum(1, keepdims=True)
    three += 8 * two[None]
    return np.log(three / three.sum(2, keepdims=True))


def random_strings(n: int, seed: int = 7) -> list[str]:
    """Seeded random strings over the alphabets that keys are written in."""
    rng = np.random.default_rng(seed)
    sets = ("0123456789abcdef", ALPHABET[:62], ALPHABET[:64], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[26:62], ALPHABET[:52], ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62])
    return ["".join(rng.choice(list(sets[i % len(sets)]), rng.integers(20, 64))) for i in range(n)]


def joined(words: list[str], seed: int = 11) -> list[str]:
    """Runs of SHORTEST_RUN characters and more, of words in the ways that identifiers and paths are made of them; each word is used once."""
    rng = np.random.default_rng(seed)
    out, parts = [], []
    for i in rng.permutation(len(words)):
        parts.append(words[i])
        if sum(map(len, parts)) >= SHORTEST_RUN:
            form, mark = rng.choice(4), str(rng.choice(["_", "-", "/", ""]))
            run = mark.join(parts if form == 0 else [p.lower() for p in parts] if form == 1 else [p.upper() for p in parts] if form == 2 else [p.capitalize() for p in parts])
            out.append(run)
            parts = []
            if len(out) == MOST_JOINED:
                break
    return out


def fit(secret: list[str], words: list[str], runs: list[str]) -> Ratio:
    """Models of the samples; a fifth of the words and of the other long runs, by a hash, only sets the thresholds."""
    held = lambda x: zlib.crc32(x.encode()) % 5 == 0
    keys = _markov(secret + random_strings(3600))
    base = [w for w in words if not held(w)]
    base += joined(base)
    none = np.zeros(SHORTEST_RUN + 1)
    ratio = Ratio(keys - _markov(base), none)
    ordinary: list[str] = []
    for _ in range(5):  # some of the runs are keys that no rule finds: those that look random don't teach what is ordinary
        before, ordinary = ordinary, [r for r in runs if ratio.score(r) <= 0]
        if ordinary == before:
            break
        ratio = Ratio(keys - _markov(base + [r for r in ordinary if not held(r)]), none)
    kept = joined([w for w in words if held(w)], 13) + [r for r in ordinary if held(r)]
    thresholds = none + 0.5
    if kept:
        limit = lambda x: float(np.quantile(x, 1 - FALSE_RATE, method="higher"))
        thresholds[SHORTEST_RUN] = max(0.0, limit([ratio.score(r) for r in kept]))
        # Parts begin at any character of a run.
        sums = []
        for r in kept:
            r = r[zlib.crc32(r.encode()) % (len(r) - SHORTEST_RUN + 1) :]
            sums.append(np.cumsum(ratio.table[_contexts(r)][: SHORTEST_RUN - 1]))
        for n in range(1, SHORTEST_RUN):
            thresholds[n] = max(thresholds[SHORTEST_RUN], limit([x[n - 1] / n for x in sums]))
    return Ratio(ratio.table, thresholds)


def _free_runs(text: str, spans: dict[str, list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """Long runs of key characters, and the pieces of them that the rules' spans leave."""
    taken = sorted(x for found in spans.values() for x in found)
    out, at, end = [], 0, 0
    for m in _RUN.finditer(text):
        s, e = m.span()
        while at < len(taken) and taken[at][0] < e:
            if taken[at][0] > max(s, end):
                out.append((max(s, end), taken[at][0]))
            end = max(end, taken[at][1])
            at += 1
        if max(s, end) < e:
            out.append((max(s, end), e))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Ratio:
    """Models from a bounded sample of texts, chosen by a hash of their id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = rule_spans(text)
                found = [(text[s:e].split("=")[-1].strip(" \"'"), "secret") for s, e in spans["assign"]] + [(text[s:e], "secret") for k in ("access", "hex") for s, e in spans[k]]
                found += [(text[s:e], "run") for s, e in _free_runs(text, spans) if e - s >= SHORTEST_RUN]
                free, at = [], 0
                for s, e in sorted(x for k in spans for x in spans[k]):
                    free.append(text[at:s])
                    at = max(at, e)
                found += [(w, "word") for part in (*free, text[at:]) for w in set(_IDENTIFIER.findall(part)) if len(w) < SHORTEST_RUN]  # what identifiers are made of
                found = [x for x in found if x[0] and x[0].isascii()]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string())], ["run", "kind"])

    got = rows.join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(run, "run string, kind string").distinct().toArrow()
    pairs = sorted(zip(got["run"].to_pylist(), got["kind"].to_pylist(), strict=True))
    return fit(*[[r for r, k in pairs if k == kind] for kind in ("secret", "word", "run")])


def all_spans(text: str, ratio: Ratio) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """The rules' spans, and those together with the random runs."""
    base = rule_spans(text)
    more = [(s, e) for s, e in _free_runs(text, base) if ratio.random(text[s:e])]
    return base, {**base, "random": more} if more else base


def scanned(docs: DataFrame, ratio: Ratio, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id, the rules' counts, the SHA-256 of their spans, and all spans. A map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = all_spans(text or "", ratio)
                rows.append((*[len(base[k]) for k in KINDS[:3]], hashlib.sha256(line(base).encode()).hexdigest(), line(every)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def masked(text: str, ratio: Ratio, mark: str = "[SECRET]") -> str:
    """The text with every span replaced; spans that overlap become one mark."""
    flat = sorted(x for found in all_spans(text, ratio)[1].values() for x in found)
    out, at = [], 0
    for s, e in flat:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]) if flat else text


def redacted(docs: DataFrame, ratio: Ratio, text_col: str = "text") -> DataFrame:
    """The same rows and columns with secrets masked in the text; a null stays null. A map without a shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [None if t is None else masked(t, ratio) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, text_col, pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
