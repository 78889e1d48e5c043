"""Repeats of what the rules found are labelled in any form and at any distance."""

import numpy as np
import pytest

from screenlake.llm import pii

WORDS = "the lake lies north of the old mill and its water is cold "
PAIRS = [("+44 20 7946 0958", "02079460958"), ("4111 1111 1111 1111", "99-4111111111111111"), ("jane.roe@example.org", "jane.roe@localhost"), ("+442079460958", "020 7946 0958")]


@pytest.fixture(scope="module")
def field():
    texts = [WORDS + f"call +4420794{k:05d} or mail user{k}@example.org in {1900 + k}, room {k}, card 4111 1111 1111 1111" for k in range(200)]
    return pii.fit([pii.graph(t, pii.rule_spans(t)) for t in texts])


@pytest.mark.parametrize("found, repeat", PAIRS)
@pytest.mark.parametrize("times", [1, 60])
def test_every_repeat(field, found, repeat, times):
    text = WORDS + found + " " + WORDS + "".join(f"{repeat} {WORDS * 3}" for _ in range(times))
    base, every = pii.all_spans(text, field)
    (kind,) = [k for k in pii.KINDS if base[k]]
    got = [text[s:e] for s, e in sorted(every[kind])]
    assert len(base[kind]) == 1 and got == [found] + [repeat] * times


def test_matches_are_whole_nodes(field):
    text = "x1+44 20 7946 0958, 4111 1111 1111 1111; 12 apples"
    g = pii.graph(text, pii.rule_spans(text))
    assert [text[s:e] for s, e in g.places] == ["x1", "+44 20 7946 0958", "4111 1111 1111 1111", "12"]
    assert g.labels.tolist() == [0, 4, 3, 0]


def test_clean_numbers_stay(field):
    text = WORDS + "+44 20 7946 0958 " + WORDS + "order 1234567 order 1234567 in 1999 " * 30
    base, every = pii.all_spans(text, field)
    assert base == every
    assert np.isfinite(field.marginals(pii.graph(text, base))).all()
