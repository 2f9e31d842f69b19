"""Buckets of a few members are compared many at a time, with the links of the plain way."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from loomline.llm import clusters

NAMES = ["key", "x", "y", "block", "node", "component", "n_shingles", "i", "j", "least", "first", "second"]


def buckets(rng, n):
    rows = []
    for key in range(n):
        base = rng.choice(2**32, 24, replace=False).astype("<u4")
        y, i = int(rng.random() < 0.3), int(rng.integers(0, 6))
        for member in range(int(rng.integers(2, 45 if key % 5 == 0 else 7))):
            own, changed = base.copy(), int(rng.integers(0, 9))
            own[rng.choice(24, changed, replace=False)] = rng.integers(0, 2**32, changed)
            own = np.unique(own)[: int(rng.integers(18, 25))].astype("<u4")
            component, block = int(rng.integers(0, 6)), int(rng.integers(0, 2))
            first = rng.integers(0, 40, 6).astype("<i8").tobytes()
            rows.append((key, 0, y, block, 100 * key + member, component, len(own), i, 0, own.tobytes(), first, bytes(8)))
    return pa.table([pa.array(c) for c in zip(*rows)], names=NAMES)


def links(table, size):
    batches = clusters._compared(80)(iter(table.to_batches(max_chunksize=size)))
    return sorted(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))


def test_few_members_give_the_same_links(monkeypatch):
    for seed in range(3):
        table = buckets(np.random.default_rng(seed), 150)
        monkeypatch.setattr(clusters, "FEW", 0)
        wanted = links(table, 1000)
        monkeypatch.setattr(clusters, "FEW", 32)
        assert wanted
        for pairs in (7, 20_000):
            monkeypatch.setattr(clusters, "PAIRS", pairs)
            assert all(links(table, size) == wanted for size in (5, 100, 100_000))
