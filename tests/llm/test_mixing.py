"""Targets by repeated capping; mixes that meet them."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from edge_rows import EDGE

from loomline.llm.mixing import flight, land, mix


def targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        open_ = [s for s in names if s not in capped]
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > cap * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weight[s]) for s in names}
        capped |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_are_met(docs, seed):
    rng = random.Random(seed)
    counts = {"a": 300, "b": 40, "c": 5, "d": 120, "é": 60, None: 30}
    rows = []
    for source, n in counts.items():
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * int(rng.lognormvariate(3, 1.2))), "en", source))
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(text.split())
    got = mix(docs(rows), block=50).collect()
    want = targets(sizes)
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.size == len(rows[r.doc_id][1].split()) and 0 <= r.taken <= 3 * r.size
    assert len(got) == len(rows)
    for source in counts:
        assert abs(taken[source] - want[source]) <= max(3, 0.02 * want[source])
    again = mix(docs(rows[::-1]).repartition(5), block=50).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in got)


def test_edge_rows(docs):
    got = mix(docs(EDGE)).collect()
    assert len(got) == len(EDGE)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mix(docs([])).count() == 0
    assert [r.taken for r in mix(docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(4)
    sizes = np.sort(rng.integers(1, 5000, 400))[::-1].astype(float)
    chances = rng.random(400)
    moved = flight(sizes, chances, rng)
    assert ((moved > 0) & (moved < 1)).sum() <= 4
    assert moved.sum() == pytest.approx(chances.sum())
    assert (moved * sizes).sum() == pytest.approx((chances * sizes).sum())
    landed = land(sizes, moved)
    assert set(np.unique(landed)) <= {0.0, 1.0}


def test_flight_is_unbiased():
    sizes = np.array([9.0, 7.0, 5.0, 4.0, 3.0, 2.0, 1.0, 1.0])
    chances = np.array([0.3, 0.5, 0.2, 0.7, 0.4, 0.6, 0.5, 0.1])
    mean = np.mean([flight(sizes, chances, np.random.default_rng(k)) for k in range(3000)], axis=0)
    assert np.abs(mean - chances).max() < 0.05


def test_equal_sizes_and_certain_chances():
    rng = np.random.default_rng(0)
    moved = flight([5.0] * 10, [0.5] * 10, rng)
    assert moved.sum() == pytest.approx(5) and ((moved == 0) | (moved == 1)).sum() >= 8
    assert flight([1.0, 2.0], [0.0, 1.0], rng).tolist() == [0.0, 1.0]
