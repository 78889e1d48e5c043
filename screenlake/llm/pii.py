"""Personal data by rules and a skip-chain conditional random field (operator 6).

Rules find e-mail addresses, IP addresses, payment cards and phone numbers. The field then looks for what the rules miss:
its nodes are the rules' matches, each one whole, and what else of a text's tokens has a digit or an at sign; neighbours in the text share
transition potentials, and all mentions that are equal or similar (the same last seven digits, the same mailbox) share a variable of their
own, whose potential with each mention favours equal labels, so evidence reaches each mention of a text in two steps and the links are in
proportion to the text. Groups of digits apart by blanks, which are a number that a rule found elsewhere, are one node too. Where a rule found a
mention, the shared variable is held at the kind that it found. Loopy belief propagation runs until its messages stand still; a mention of
something mentioned twice or more that ends up with a label at CERTAIN or more adds a span of that kind.

The field's weights are trained together, by pseudo-likelihood, from the rules' labels on a bounded sample of texts (SAMPLE_DOCS).

Offsets are code points, ends exclusive. Nulls and empty texts have no spans. Texts of any length are read whole, in time linear in their
length. Repeated rows and ids give a row each. An empty table gives an empty result. Columns other than
those named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 1500
CERTAIN = 0.9
MOST_ROUNDS = 2000  # a bound for messages that never settle; those of ordinary texts do within some tens of rounds
SETTLED = 1e-4
SAME_PRIOR = 4.0

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")
_WORD = re.compile(r"\S+")
_TELLING = re.compile("[0-9@]")
_SPACED = re.compile(r"[0-9]+(?:[\x20().-]{1,2}[0-9]+)+")
_GROUP = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Each at sign with the run of mailbox characters before it and a domain after it: the leftmost matches, in linear time."""
    out, end = [], 0
    at = text.find("@")
    last = 0
    while at >= 0:
        part = text[max(end, last) : at]
        size = len(part) - len(part.rstrip(_LOCAL))
        if size and (m := _DOMAIN.match(text, at + 1)):
            out.append((at - size, m.end()))
            end = m.end()
        last = at + 1
        at = text.find("@", max(last, end))
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    """Every four numbers of a dotted sequence, from its first on; a four with a number over 255 is dropped."""
    out = []
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, at, places = m.group().split("."), m.start(), []
        for p in parts:
            places.append((at, at + len(p)))
            at += len(p) + 1
        for k in range(0, len(parts) - 3, 4):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[k : k + 4]):
                out.append((places[k][0], places[k + 3][1]))
    return out


def rule_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The rules' spans by kind, each kind's in order and apart from one another."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    out["ip"] = _ips(text)
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _DIGITS.sub("", m.group())) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.sub("", m.group())) <= 15]
    return out


def line(spans: dict[str, list[tuple[int, int]]]) -> str:
    """kind:start:end by kind as listed, then start, comma-joined."""
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(spans[k]))


@dataclass
class Graph:
    """Nodes of one text with their links: places, features, the rules' labels (0: none), neighbours, and pairs of a mention and the number of what it mentions."""

    places: list[tuple[int, int]]
    features: np.ndarray
    labels: np.ndarray
    near: np.ndarray
    mentions: np.ndarray


N_FEATURES = 14


def _features(token: str) -> list[float]:
    digits = sum(c.isdigit() for c in token)
    return [
        1.0, "@" in token, token.startswith("+"), "(" in token, "-" in token, token.count(".") >= 3, token.count(".") in (1, 2),
        digits <= 2, 3 <= digits <= 6, 7 <= digits <= 8, 9 <= digits <= 12, digits >= 13, digits == len(token), any(c.isalpha() for c in token),
    ]


def _key(token: str) -> str:
    """What similar tokens have in common: the mailbox of an address, or the last seven of at least seven digits."""
    if "@" in token:
        mailbox = token.split("@")[0].lower().strip("<(\"'")
        return "@" + mailbox if len(mailbox) >= 4 else ""
    digits = _DIGITS.sub("", token)
    return digits[-7:] if len(digits) >= 7 else ""


def _outside(s: int, e: int, taken: list[tuple[int, int]], at: int) -> tuple[list[tuple[int, int]], int]:
    """The parts of a span outside the taken ones, which are in order and apart, and the place of the first taken one that reaches beyond it."""
    while at < len(taken) and taken[at][1] <= s:
        at += 1
    out, k = [], at
    while k < len(taken) and taken[k][0] < e:
        if taken[k][0] > s:
            out.append((s, taken[k][0]))
        s = max(s, taken[k][1])
        k += 1
    return out + [(s, e)] * (s < e), at


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _spaced(text: str, taken: list[tuple[int, int]], known: dict[str, str]) -> list[tuple[int, int]]:
    """Runs of two and more groups of digits, outside the taken spans, whose digits are the last of a known number (leading zeros aside)."""
    out, at = [], 0
    for m in _SPACED.finditer(text) if known else ():
        parts, at = _outside(*m.span(), taken, at)
        for s, e in parts:
            groups = [g.span() for g in _GROUP.finditer(text, s, e)]
            free = 0
            for k in range(1, len(groups)):
                tail, i = "", k + 1
                while i > free and len(tail) < 7:
                    i -= 1
                    tail = text[groups[i][0] : groups[i][1]] + tail
                number = known.get(tail[-7:]) if len(tail) >= 7 else None
                if number is None or not number.endswith(tail.lstrip("0")):
                    continue
                while i > free and number.endswith((longer := text[groups[i - 1][0] : groups[i - 1][1]] + tail).lstrip("0")):
                    tail, i = longer, i - 1
                if i < k:
                    out.append((groups[i][0], groups[k][1]))
                    free = k + 1
    return out


def graph(text: str, spans: dict[str, list[tuple[int, int]]]) -> Graph:
    nodes, known = [], {}
    for s, e, label in sorted((s, e, 1 + i) for i, k in enumerate(KINDS) for s, e in spans[k]):
        key = _key(text[s:e])
        if nodes and s < nodes[-1][1] and key == nodes[-1][3]:
            continue  # two rules found the same number
        nodes.append((s, e, label, key))
        if "@" not in key:
            known[key] = max(known.get(key, ""), _DIGITS.sub("", text[s:e]), key=len)
    known.pop("", None)
    taken = _united([n[:2] for n in nodes])
    apart = _spaced(text, taken, known)
    nodes += [(s, e, 0, _key(text[s:e])) for s, e in apart]
    taken, at = _united(taken + apart), 0
    for m in _WORD.finditer(text):
        if _TELLING.search(m.group()):
            parts, at = _outside(*m.span(), taken, at)
            nodes += [(s, e, 0, _key(text[s:e])) for s, e in parts if _TELLING.search(text, s, e)]
    nodes.sort()
    times = Counter(n[3] for n in nodes if n[3])
    number = {key: i for i, key in enumerate(k for k, n in times.items() if n > 1)}
    as_pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    return Graph(
        [n[:2] for n in nodes],
        np.array([_features(text[n[0] : n[1]]) for n in nodes], float).reshape(-1, N_FEATURES),
        np.array([n[2] for n in nodes], np.int64),
        as_pairs([(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1][0] - nodes[i][1] <= 12]),
        as_pairs([(i, number[n[3]]) for i, n in enumerate(nodes) if n[3] in number]),
    )


@dataclass(frozen=True)
class Field:
    """Log potentials: of a node's label by its features, of neighbours' labels, and of equal labels of two mentions."""

    unary: np.ndarray
    step: np.ndarray
    same: float

    def marginals(self, g: Graph) -> np.ndarray:
        """Beliefs about every node by loopy sum-product, all messages at once, damped; what the rules found is held."""
        k, size = len(KINDS) + 1, len(g.labels)
        node = g.features @ self.unary
        held = g.labels > 0
        node[held] = -20.0
        node[held, g.labels[held]] = 0.0
        # Shared variables come after the nodes; one with a found mention is held at what its mentions were found to be.
        shared = g.mentions[:, 1].max(initial=-1) + 1
        seen = np.zeros((shared, k))
        of = held[g.mentions[:, 0]]
        np.add.at(seen, (g.mentions[of, 1], g.labels[g.mentions[of, 0]]), 1.0)
        known = seen.sum(1) > 0
        top = np.zeros((shared, k))
        top[known] = np.where(seen[known] > 0, np.log(np.maximum(seen[known], 1.0)), -1e6)
        node = np.concatenate([node, top])
        # A mention bears on its shared variable so much that two mentions alone bear on one another as by the potential of equal labels.
        x = np.exp(self.same)
        link = np.log(x + np.sqrt(x * x + x * (k - 2) - (k - 1)))
        n, s = len(g.near), len(g.mentions)
        owner = size + g.mentions[:, 1]
        source = np.concatenate([g.near[:, 0], g.near[:, 1], g.mentions[:, 0], owner])
        target = np.concatenate([g.near[:, 1], g.near[:, 0], owner, g.mentions[:, 0]])
        pair = np.concatenate([np.repeat(self.step[None], n, 0), np.repeat(self.step.T[None], n, 0), np.repeat((link * np.eye(k))[None], 2 * s, 0)])
        back = np.concatenate([np.arange(n, 2 * n), np.arange(n), 2 * n + np.arange(s, 2 * s), 2 * n + np.arange(s)])
        message = np.zeros((len(source), k))
        share = 0.5
        for t in range(MOST_ROUNDS if len(message) else 0):
            belief = node.copy()
            np.add.at(belief, target, message)
            out = (belief[source] - message[back])[:, :, None] + pair
            best = out.max(1, keepdims=True)
            new = np.log(np.exp(out - best).sum(1)) + best[:, 0]
            new -= new.max(1, keepdims=True)
            if np.abs(new - message).max() < SETTLED:
                break
            if t % 200 == 199:  # messages that swing are damped more
                share = max(0.05, share / 2)
            message = (1 - share) * message + share * new
        belief = node.copy()
        np.add.at(belief, target, message)
        belief = np.exp(belief[:size] - belief[:size].max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True)


def fit(graphs: list[Graph], steps: int = 300, rate: float = 0.5) -> Field:
    """All weights together, by penalised pseudo-likelihood: each node's label given its features, its neighbours' labels and those of what it repeats.

    The labels are the rules' own. What no rule found but repeats something that a rule found is left out, as its label is what the field is for. Rules find most
    repeats in the same form, so texts tell little about how much a repeat counts: its weight is drawn to SAME_PRIOR.
    """
    k = len(KINDS) + 1
    unary, step, same = np.zeros((N_FEATURES, k)), np.zeros((k, k)), SAME_PRIOR
    at = np.cumsum([0, *(len(g.labels) for g in graphs)])
    x = np.concatenate([g.features for g in graphs]) if graphs else np.zeros((0, N_FEATURES))
    y = np.concatenate([g.labels for g in graphs]) if graphs else np.zeros(0, np.int64)
    known, like = np.ones(len(y), bool), np.zeros((len(y), k))
    for g, a in zip(graphs, at[:-1], strict=True):
        if len(g.mentions):
            node, of = g.mentions[:, 0], g.mentions[:, 1]
            seen = np.zeros((of.max() + 1, k))
            np.add.at(seen, (of, g.labels[node]), 1.0)
            others = seen[of]
            others[np.arange(len(node)), g.labels[node]] -= 1
            known[a + node] = (g.labels[node] > 0) | (seen[of, 1:].sum(1) == 0)
            like[a + node] = others / np.maximum(others.sum(1, keepdims=True), 1)
    near = np.concatenate([g.near + a for g, a in zip(graphs, at[:-1], strict=True)]) if graphs else np.zeros((0, 2), np.int64)
    near = near[known[near].all(1)]
    left, right = near[:, 0], near[:, 1]
    total = max(1, known.sum())
    for _ in range(steps if len(x) else 0):
        p = x @ unary + same * like
        np.add.at(p, right, step[y[left]])
        np.add.at(p, left, step[:, y[right]].T)
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p[~known] = 0
        change = np.zeros((k, k))
        np.add.at(change, y[left], p[right])
        np.add.at(change.T, y[right], p[left])
        unary -= rate * (x.T @ p / total + 1e-3 * unary)
        step -= rate * (change / total + 1e-3 * step)
        same -= rate * ((like * p).sum() / total + 1e-2 * (same - SAME_PRIOR))
    return Field(unary, step, float(max(same, 1.0)))


def all_spans(text: str, field: Field) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """The rules' spans, and those together with the field's."""
    base = rule_spans(text)
    if not _TELLING.search(text):
        return base, base
    g = graph(text, base)
    if not len(g.labels):
        return base, base
    beliefs = field.marginals(g)
    linked = np.zeros(len(g.labels), bool)
    linked[g.mentions[:, 0]] = True
    every = {k: list(v) for k, v in base.items()}
    for i in np.flatnonzero(linked & (g.labels == 0) & (beliefs[:, 1:].max(1) >= CERTAIN)):
        s, e = g.places[i]
        token = text[s:e]
        s, e = s + len(token) - len(token.lstrip("([{<\"'")), e - (len(token) - len(token.rstrip(".,;:!?)]}>\"'")))
        if s < e:
            every[KINDS[int(beliefs[i, 1:].argmax())]].append((s, e))
    return base, every


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field from a bounded sample of texts, chosen by a hash of their id."""
    import pickle

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                g = graph(text or "", rule_spans(text or ""))
                if len(g.labels):
                    out.append(pickle.dumps((g.features, g.labels, g.near, g.mentions)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["graph"])

    got = rows.join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(run, "graph binary").toArrow()
    return fit([Graph([], *pickle.loads(b)) for b in sorted(got["graph"].to_pylist())])


def found(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id, the rules' counts, the SHA-256 of their spans, and all spans. A map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = all_spans(text or "", field)
                rows.append((*[len(base[k]) for k in KINDS], hashlib.sha256(line(base).encode()).hexdigest(), line(every)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
