"""Benchmark items planted with and without changed words."""

from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest
from edge_rows import EDGE

from loomline.llm import decontaminate
from loomline.llm.decontaminate import decontaminated


def words(rng, n):
    return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_planted_items(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 200)  # several blocks
    rng = random.Random(1)
    items = [words(rng, n) for n in (6, 12, 20, 40, 60, 60, 30, 30)]
    rows, want = [], {}
    for k in range(60):
        body = words(rng, 80)
        if k % 2:
            item = k % len(items)
            part = list(items[item])
            if len(part) >= 20:
                for at in range(rng.randint(0, 6), len(part), 10):  # every tenth word
                    part[at] = "changed"
            at = rng.randint(0, 80)
            body[at:at] = [w.upper() + rng.choice(["", ",", "!!"]) for w in part]
            want[k] = item
        rows.append((k, " ".join(body)))
    got = {r.doc_id: r for r in decontaminated(docs(rows), bench(spark, [(k, " ".join(i)) for k, i in enumerate(items)])).collect()}
    assert {i: r.item_ids for i, r in got.items() if not r.kept} == {i: [k] for i, k in want.items()}
    assert all(r.n_items == (i in want) for i, r in got.items())


def test_near_misses_stay(spark, docs):
    rng = random.Random(2)
    item = words(rng, 40)
    third = [w if k % 3 else "other" for k, w in enumerate(item)]
    rows = [(1, " ".join(third)), (2, " ".join(item[:8])), (3, " ".join(item[:13])), (4, " ".join(words(rng, 500)))]
    got = {r.doc_id: r.kept for r in decontaminated(docs(rows), bench(spark, [(1, " ".join(item))])).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True}


@pytest.mark.parametrize("length", range(1, 17))
def test_every_allowed_change_meets_a_seed(length):
    window = min(decontaminate.WINDOW, length)
    item = np.arange(1, length + 1, dtype=np.uint64)
    block = decontaminate.item_block([(7, item.astype("<u8").tobytes())])
    allowed = window * (100 - decontaminate.PERCENT) // 100
    for changed in itertools.combinations(range(window), allowed):
        for at in range(length - window + 1):  # the rest of the item is another text
            text = np.arange(100, 110 + length, dtype=np.uint64)
            text[5 + at : 5 + at + window] = item[at : at + window]
            text[[5 + at + k for k in changed]] = 99
            assert decontaminate.matches(text, block) == {0: window - allowed}


def brute(words, item):
    window = min(decontaminate.WINDOW, len(item))
    return any(
        100 * sum(a == b for a, b in zip(words[i : i + window], item[j : j + window])) >= decontaminate.PERCENT * window
        for i in range(len(words) - window + 1)
        for j in range(len(item) - window + 1)
    )


def test_changed_items_against_brute_force(spark, docs):
    rng = random.Random(4)
    items = [words(rng, n) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 20)]
    rows = []
    for k in range(480):
        part = [w if rng.random() > 0.15 else "changed" for w in items[k % len(items)]]
        body = words(rng, 12)
        at = rng.randint(0, 12)
        rows.append((k, body[:at] + part + body[at:]))
    want = {(k, i) for k, body in rows for i, item in enumerate(items) if brute(body, item)}
    table = docs([(k, " ".join(body)) for k, body in rows])
    got = decontaminated(table, bench(spark, [(i, " ".join(item)) for i, item in enumerate(items)])).collect()
    assert {(r.doc_id, i) for r in got for i in r.item_ids} == want
    assert len({i for _, i in want}) == len(items)


def test_edge_rows(spark, docs):
    items = bench(spark, [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (None, "a b c d")])
    got = decontaminated(docs(EDGE), items).collect()
    assert len(got) == len(EDGE)
    assert sorted({r.doc_id for r in got if not r.kept}) == [4, 5]
    assert decontaminated(docs([]), items).count() == 0
    assert all(r.kept for r in decontaminated(docs(EDGE), bench(spark, [])).collect())


def test_periodic_texts_are_quick_and_right(spark, docs):
    item = "tick tock " * 1000
    rows = [(1, "tick tock " * 1500), (2, "tock " * 30), (3, "other words " * 20)]
    block = decontaminate.item_block([(0, decontaminate.plain_words(item).astype("<u8").tobytes())])
    start = time.perf_counter()
    found = decontaminate.matches(decontaminate.plain_words(rows[0][1]), block)
    assert found == {0: 2000} and time.perf_counter() - start < 3
    got = {r.doc_id: r.kept for r in decontaminated(docs(rows), bench(spark, [(0, item)])).collect()}
    assert got == {1: False, 2: True, 3: True}
