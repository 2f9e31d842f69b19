"""The five stages on edge rows, and the whole pipeline on the smallest tables."""

from __future__ import annotations

import collections
import random

import pytest
from edge_rows import EDGE

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
@pytest.mark.parametrize("rows", [EDGE, []])
def test_stages_take_edge_rows(spark, docs, name, stage, rows):
    out = stage(spark, docs(rows), SF)
    if name == "tokens":
        assert out.count() == len(rows)
    else:
        assert out.columns == pipeline.COLUMNS
        assert out.count() <= len(rows) * 3


def test_language_stage_rejects_what_was_not_learned(spark):
    rng = random.Random(3)
    foreign = [
        "Это обычный русский текст о погоде и людях, которые живут в большом городе. " * 5,
        "今天天气很好我们一起去公园散步吧大家都很高兴" * 5,
        "Tämä on tavallinen suomenkielinen teksti ihmisistä, jotka asuvat suuressa kaupungissa. " * 5,
        "To jest zwykły polski tekst o ludziach, którzy mieszkają w dużym mieście. " * 5,
        *("".join(rng.choices("abcdefghijklmnopqrstuvwxyz   ", k=900)) for _ in range(5)),
        "1234 5678",
    ]
    clean = spark.read.parquet(f"{SF}/documents.parquet").select(*pipeline.COLUMNS)
    # without a label nothing is learned from them
    rows = [(10**6 + k, t, None, "x", len(t)) for k, t in enumerate(foreign)]
    every = clean.unionByName(spark.createDataFrame(rows, clean.schema))
    kept = {r.doc_id for r in pipeline.identify_language(spark, every, SF).select("doc_id").collect()}
    assert not [k for k in range(len(foreign)) if 10**6 + k in kept]
    assert len(kept) >= 0.99 * clean.count()


def test_near_copies_stay_once(spark, docs):
    kept = pipeline.remove_near_copies(spark, docs(EDGE), SF).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 3, 4, 6, 7]
    assert sum(r.doc_id is None for r in kept) == 2


def rows_of(table):
    return collections.Counter((r.doc_id, r.text, r.lang, r.source) for r in table.collect())


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))


def test_near_copies_of_rows_without_or_with_one_id(spark, docs):
    rng = random.Random(21)
    a, b, c, d = (prose(rng, 100) for _ in range(4))
    rows = [
        (5, a, "en", "s"),
        (None, a + " more", "en", "s"),  # a copy of 5
        (8, b, "en", "s"),
        (8, c, "en", "s"),  # the same id, another text
        (None, d, "en", "s"),
        (None, d + " more", "en", "s"),  # a copy of the row before
        (9, d + " more words", "en", "s"),  # and of one with an id, which stays
        (None, "", "en", None),
        (None, "", None, "en"),
        (None, "", None, "en"),
    ]
    got = rows_of(pipeline.remove_near_copies(spark, docs(rows), SF))
    assert got == collections.Counter(rows[k] for k in (0, 2, 3, 6, 7, 8, 9))


def test_benchmark_judges_each_row(spark, docs):
    rng = random.Random(22)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()
    item = max((r.text for r in items), key=len)
    rows = []
    for doc_id in (None, 7):
        rows += [(doc_id, prose(rng, 50), "en", "s"), (doc_id, f"{prose(rng, 20)} {item}", "en", "s"), (doc_id, prose(rng, 50), "en", "s")]
    got = rows_of(pipeline.remove_benchmark(spark, docs(rows), SF))
    assert got == collections.Counter(r for r in rows if item not in r[1])


def test_mix_keeps_rows_without_or_with_one_id(spark, docs):
    rng = random.Random(23)
    # one source: its target is all of its words, so each row is taken once
    rows = [(None if k % 2 else 3, prose(rng, rng.randint(5, 50)), "en" if k % 3 else None, "s") for k in range(40)]
    rows += rows[:3]
    assert rows_of(pipeline.mix_sources(spark, docs(rows), SF)) == collections.Counter(rows)
    # three sources: the words of each meet its target
    rows = [(None, prose(rng, rng.randint(5, 50)), "en", f"s{k % 3}") for k in range(300)]
    got = rows_of(pipeline.mix_sources(spark, docs(rows), SF))
    assert set(got) <= set(rows) and max(got.values()) <= 3
    size = collections.Counter()
    taken = collections.Counter()
    for row in rows:
        size[row[3]] += len(row[1].split())
        taken[row[3]] += got[row] * len(row[1].split())
    for source, weight in (("s0", 1), ("s1", 2), ("s2", 3)):
        assert abs(taken[source] - size.total() * weight / 6) <= 50


def test_run(spark):
    rows = pipeline.run(spark, SF).collect()
    documents = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    times = collections.Counter(r.doc_id for r in rows)
    assert set(times) <= set(documents) and max(times.values()) <= 3
    ordered = sorted(rows, key=lambda r: r.start)
    assert all(a.doc_id <= b.doc_id and a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
    sums = collections.defaultdict(set)
    for r in rows:
        sums[r.doc_id].add((r.n_tokens, r.ids_crc32))
    assert all(len(s) == 1 for s in sums.values())
