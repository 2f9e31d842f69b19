"""What paragraphs that meet in a band are told apart by, and how links become components."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from loomline.llm import components
from loomline.llm import paragraph_dedup as pd


def family(rng, n, size, changes):
    """Sorted rows of sets that differ from one of their number in a few shingles."""
    base = rng.integers(0, 2**63, size, dtype=np.uint64)
    out = np.empty((n, 24), np.uint64)
    for k in range(n):
        own = base.copy()
        own[rng.choice(size, min(size, int(rng.integers(0, changes + 1))), replace=False)] = rng.integers(0, 2**63, dtype=np.uint64)
        out[k] = np.sort(np.resize(own, 24))
    return out


def test_paragraphs_far_apart_are_in_no_bucket(spark):
    """One shingle that stands alone in its part made a bucket of all texts with it."""
    rows = [(k, k, " ".join([f"a{k}"] * 10 + ["of"] * 10 + [f"b{k}"] * 10)) for k in range(120)]
    texts = spark.createDataFrame(rows, "d bigint, t bigint, text string").selectExpr("d", "t", "binary(text) text")
    buckets, nodes = pd.meeting_paragraphs(texts)
    assert buckets.isEmpty() and nodes.isEmpty()


def test_similar_sets_have_near_sketches():
    rng = np.random.default_rng(1)
    sets = np.concatenate([family(rng, 40, int(rng.integers(1, 25)), 3) for _ in range(30)])
    sketch = pd.sketches(sets)
    a, b = (x.ravel() for x in np.indices((len(sets), len(sets))))
    plain = [set(x.tolist()) for x in sets]
    alike = np.array([5 * len(plain[x] & plain[y]) >= 4 * len(plain[x] | plain[y]) for x, y in zip(a.tolist(), b.tolist())])
    assert (pd._similar(sets[a], sets[b], 80) == alike).all()
    near = pd._near(sketch[a], sketch[b], 80)
    assert near[alike].all() and alike.sum() > len(sets) * 5 and (near & ~alike).sum() < alike.sum() / 5


@pytest.mark.parametrize("exact", [False, True])
def test_forests_equal_brute_force(monkeypatch, exact):
    rng = np.random.default_rng(2)
    sets = np.concatenate([family(rng, int(rng.integers(1, 60)), int(rng.integers(1, 25)), 4) for _ in range(25)])
    sets = sets[rng.permutation(len(sets))]
    group = np.sort(rng.integers(0, 4, len(sets)))
    sketch = pd.sketches(sets)
    a, b = np.triu_indices(len(sets), 1)
    good = (group[a] == group[b]) & pd._near(sketch[a], sketch[b], 80)
    if exact:
        good &= pd._similar(sets[a], sets[b], 80)
    links = set(zip(a[good].tolist(), b[good].tolist()))
    want = components.least_reachable(len(sets), a[good], b[good])
    for whole, pairs in ((10_000, 1 << 19), (10_000, 5), (2, 100), (30, 1 << 19)):
        monkeypatch.setattr(pd, "WHOLE", whole)
        monkeypatch.setattr(pd, "PAIRS", pairs)
        forest = pd.near_links(group, sketch, 80, sets if exact else None)
        left, right = forest.links()
        assert {tuple(sorted(x)) for x in zip(left.tolist(), right.tolist())} <= links
        # one link less than members in each tree
        assert len(left) == len(sets) - len(np.unique(want))
        assert (components.least_reachable(len(sets), left, right) == want).all()
        assert len(set(zip(forest.label.tolist(), want.tolist()))) == len(np.unique(want))


def test_texts_hashed_together_have_the_paragraphs_of_each(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["of", f"w{rng.randint(0, 900)}", "Ünd"]) for _ in range(rng.randint(0, 150))).encode() for _ in range(60)]
    texts[4:4] = [None, b"", b" \n ", b"one", b"x " * 400, b"Of " * 30, b"", None]
    for piece in (1, 300, 60_000):
        monkeypatch.setattr(pd, "PIECE", piece)
        got = {}
        for at, words, shingles, first, n_words in pd._hashed(texts):
            places, text = pd._beginnings(shingles, first, n_words)
            sets = np.lib.stride_tricks.sliding_window_view(shingles, 24)[places] if len(places) else []
            hashes = zip(*(x.tolist() for x in pd.paragraph_hashes(words, places)))
            for k, place, one, both in zip(text.tolist(), (places - first[text]).tolist(), sets, hashes):
                got.setdefault(at + k, []).append((place, one.tolist(), both))
        for k, text in enumerate(texts):
            words, shingles = pd.word_and_shingle_hashes(text)
            places = pd.beginnings(shingles, len(words))
            hashes = zip(*(x.tolist() for x in pd.paragraph_hashes(words, places)))
            assert got.get(k, []) == [(p, shingles[p : p + 24].tolist(), h) for p, h in zip(places.tolist(), hashes)]


def test_contracted_links_have_the_same_components(spark, monkeypatch):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(40)] + [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    rng.shuffle(links)
    table = spark.createDataFrame(links, "a bigint, b bigint").repartition(6)
    plain = {r.node: r.component for r in components.connected_components(table).collect()}
    monkeypatch.setattr(components, "LINKS", 100)
    few = components.contracted(table)
    assert {r.node: r.component for r in components.connected_components(few).collect()} == plain
    batches = pa.table({"a": [5, 3, 9], "b": [3, 1, 9]}).to_batches(max_chunksize=2)
    (got,) = components._contracted(iter(batches))
    assert got.to_pydict() == {"a": [1, 3, 5, 9], "b": [1, 1, 1, 9]}
