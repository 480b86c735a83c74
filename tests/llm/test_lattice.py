"""Recursions on probabilities against those on logs."""

import random

import numpy as np
import pytest

from mlframe.llm import lattice


def model():
    r = random.Random(4)
    pieces = ["▁", *"abcde", *{"".join(r.choice("▁abcde") for _ in range(r.randint(2, 6))) for _ in range(300)}]
    ids = {p: i for i, p in enumerate(pieces)} | {f"\0{b}": len(pieces) + b for b in range(256)}
    weight = np.array([r.random() ** 3 + 1e-6 for _ in range(len(ids))] + [0.1])
    return lattice.Lattice(ids, np.log(weight / weight.sum())), len(weight)


def words():
    r = random.Random(5)
    return ["▁" + "".join(r.choice("abcdeé☃😀") if r.random() < 0.2 else r.choice("abcde") for _ in range(r.randint(0, 30))) for _ in range(200)]


def test_both_ways_agree():
    m, size = model()
    for w in [*words(), "▁" + "ab" * 60, "▁" + "😀" * 70, "▁" + "abc" * 400]:
        a, b = np.zeros(size), np.zeros(size)
        m.expect(w, 3.0, a)
        m.expect_log(w, 3.0, b)
        assert a == pytest.approx(b, rel=1e-9, abs=1e-12)
        assert m.forward(w) == pytest.approx(m.forward_log(w), rel=1e-12)


def test_ordinary_words_take_no_logs(monkeypatch):
    """The fit and the scores took a logarithm for every character, most of the query's CPU time."""
    m, size = model()
    taken = []
    for name in ("expect_log", "forward_log"):
        monkeypatch.setattr(m, name, lambda s, *a: taken.append(s))
    uses = [0.0] * size
    for w in words():
        m.expect(w, 1.0, uses)
        m.forward(w)
    assert not taken and sum(uses) > 0
    m.forward("▁" + "😀" * 70)  # no double holds its probability
    m.forward("▁" + "a" * 1000)
    assert len(taken) == 2
