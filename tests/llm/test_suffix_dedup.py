"""Removed bytes against a set of all strings of 100 bytes."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
from edge_rows import EDGE

from loomline.llm import suffix_dedup
from loomline.llm.common import written
from loomline.llm.suffix_dedup import repeated_suffixes, spans, without_repeats


def expected(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            if data[at : at + 100] in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(data[at : at + 100])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[doc_id] = (len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_equals_brute_force(docs):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("ab cé\n") for _ in range(n))
    passages = [word(n) for n in (99, 100, 101, 150, 400, 1000)]
    texts = ["".join([word(rng.randint(0, 300)), rng.choice(passages), word(rng.randint(0, 300)), rng.choice(passages)]) for _ in range(60)]
    texts += [texts[0], texts[1], "ab" * 400, "x" * 1000, "x" * 99, "", None]
    rows = list(enumerate(texts))
    got = {r.doc_id: tuple(r)[1:] for r in without_repeats(docs(rows)).collect()}
    assert got == expected(rows)


def test_edge_rows(docs):
    got = without_repeats(docs(EDGE)).collect()
    assert len(got) == len(EDGE)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    long = by_id[6]
    assert long.n_bytes - long.n_removed == 35 and long.n_spans == 1
    assert all(r.n_removed == 0 for r in got if r.doc_id != 6)
    assert without_repeats(docs([])).count() == 0


def test_blocks_of_suffixes():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 3, 700).astype(np.uint8)
    buffer = np.concatenate([base, rng.integers(0, 3, 50).astype(np.uint8), base, base[200:500]])
    at = np.arange(len(buffer) - 99)
    seen, want = set(), []
    for k in at:
        key = buffer[k : k + 100].tobytes()
        want.append(key in seen)
        seen.add(key)
    assert repeated_suffixes(buffer, at).tolist() == want


def test_spans_cover_a_text_in_chunks(monkeypatch):
    text = bytes(random.Random(2).choices(b"abcdef ", k=5000))
    hashes, first, count, _ = spans(text)
    assert first[0] == 0 and (first[1:] == first[:-1] + count[:-1]).all() and first[-1] + count[-1] == 4901
    whole = dict(zip(np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count), np.repeat(hashes, count)))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    hashes, first, count, gram = spans(text)
    parts = dict(zip(np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count), np.repeat(hashes, count)))
    assert parts == whole
    # the minimiser is where it is said to be
    for h, a, g in zip(hashes.tolist(), first.tolist(), gram.tolist()):
        data = np.frombuffer(text[a + g : a + g + suffix_dedup.GRAM], np.uint8)
        assert suffix_dedup.gram_hashes(data).tolist() == [h]


def templated(rng, n, line):
    """Texts that share a line, with other words before and after it, and a template."""
    word = lambda k: "".join(rng.choices("abcdefgh ", k=k))
    return [f"{word(rng.randint(0, 120))}{line}{word(rng.randint(0, 120))} {k} {line[:60]}{k % 7}{line[60:]}" for k in range(n)]


def test_large_buckets_equal_brute_force(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3000)
    rng = random.Random(3)
    line = "".join(rng.choices("abcdefghijklmnop ", k=180))
    rows = list(enumerate([*templated(rng, 70, line), "z" * 5000, line * 3, line]))
    got = {r.doc_id: tuple(r)[1:] for r in without_repeats(docs(rows)).collect()}
    assert got == expected(rows)


def test_no_block_is_much_larger_than_asked(spark, monkeypatch):
    rng = random.Random(5)
    line = "".join(rng.choices("abcdefghijklmnop ", k=180))
    texts = templated(rng, 400, line)
    cut = []
    for d, text in enumerate(texts):
        data = text.encode()
        for h, a, n, g in zip(*(x.tolist() for x in (spans(data)[0].view(np.int64), *spans(data)[1:]))):
            cut.append((h, d, d, a, n, bytearray(data[a : a + n + 99]), g, 0, suffix_dedup.REACH))
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 20_000)
    largest = []

    def seen(df, label):
        out = written(df, label)
        if label == "suffix-large":
            largest.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "written", seen)
    assert suffix_dedup._settled(spark.createDataFrame(cut, suffix_dedup.SPANS)).count() > 0
    assert largest[0] > 0 and largest[-1] == 0 and len(largest) <= 8


def test_ties_of_many_different_strings_are_quick():
    # alike in all the words that are sorted by, different between them
    base = bytes(random.Random(1).choices(b"abcdefgh", k=100))
    rows = [base[:12] + b"%08d" % k + base[20:] for k in range(4000)] * 2
    buffer = np.frombuffer(b"".join(rows), np.uint8)
    start = time.perf_counter()
    repeated = repeated_suffixes(buffer, np.arange(8000) * 100)
    assert repeated.tolist() == [False] * 4000 + [True] * 4000
    assert time.perf_counter() - start < 2
