"""The byte network against plain loops, its slopes, held-out rows, edge rows."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from edge_rows import EDGE

from loomline.llm import byte_network as bn


def plain_logit(net, text):
    """The same network one window at a time."""
    data = bytes(bn.WINDOW - bn.STRIDE) + text
    n_blocks = -(-len(data) // bn.BLOCK)
    shares = [min(1.0, max(0.0, (len(data) - k * bn.BLOCK) / bn.BLOCK)) for k in range(n_blocks)]
    data += bytes(n_blocks * bn.BLOCK + bn.WINDOW - len(data))
    blocks = []
    for b in range(n_blocks):
        answers = []
        for at in range(b * bn.BLOCK, (b + 1) * bn.BLOCK, bn.STRIDE):
            window = np.concatenate([net.bytes_[x] for x in data[at : at + bn.WINDOW]])
            answers.append(window @ net.filters + net.offset)
        blocks.append(np.maximum(np.max(answers, axis=0), 0))
    hidden = []
    for k in range(max(1, n_blocks - 1)):
        pair = blocks[k : k + 2]
        pooled = np.append(np.max(pair, axis=0), sum(shares[k : k + 2]) / 2)
        hidden.append(np.maximum(pooled @ net.inner + net.inner_offset, 0))
    both = np.concatenate([np.max(hidden, axis=0), np.mean(hidden, axis=0)])
    return float(both @ net.last + net.last_offset[0])


def some_texts(rng):
    sizes = [0, 1, 5, bn.BLOCK - 4, bn.BLOCK - 3, bn.BLOCK, 3 * bn.BLOCK + 7, 10 * bn.BLOCK]
    return [bytes(rng.choices(b"abcdef \n\xc3\xa9", k=n)) for n in sizes]


def test_logits_equal_plain_loops(monkeypatch):
    rng = random.Random(1)
    net, texts = bn.new_network(), some_texts(rng)
    want = [plain_logit(net, t) for t in texts]
    assert np.allclose(bn.logits(net, texts), want, atol=1e-4)
    # neither the slices nor the texts that are taken together matter
    monkeypatch.setattr(bn, "SLICE", bn.BLOCK)
    monkeypatch.setattr(bn, "GROUP", 600)
    assert np.allclose(bn.logits(net, texts[::-1]), want[::-1], atol=1e-4)


def test_every_byte_is_seen():
    net = bn.new_network()
    text = bytearray(b"a" * 20_000)
    plain = bn.logits(net, [bytes(text)])[0]
    for at in (0, 9_999, 19_999):
        changed = text.copy()
        changed[at : at + 1] = b"\xff"
        assert bn.logits(net, [bytes(changed)])[0] != plain


def test_slopes_equal_differences():
    rng = random.Random(2)
    texts = [t for t in some_texts(rng) if len(t) > 4]
    net = bn.new_network(3)
    for part in vars(net):
        setattr(net, part, getattr(net, part).astype(np.float64))
    net.inner_offset += 0.1
    y = np.array([k % 2 for k in range(len(texts))], float)
    weight = np.linspace(0.5, 1.5, len(texts))
    _, slopes = bn.gradients(net, texts, y, weight)
    draw = np.random.Generator(np.random.PCG64(4))
    for part, slope in zip(net.parts(), slopes):
        flat = part.reshape(-1)
        for k in draw.integers(0, flat.size, 6).tolist():
            if part is net.bytes_ and k < bn.WIDTH:
                continue
            old, h = flat[k], 1e-4
            flat[k] = old + h
            up = bn.gradients(net, texts, y, weight)[0]
            flat[k] = old - h
            down = bn.gradients(net, texts, y, weight)[0]
            flat[k] = old
            assert math.isclose((up - down) / (2 * h), slope.reshape(-1)[k], abs_tol=2e-2, rel_tol=0.05)


def labelled(n):
    rng = random.Random(7)
    words = ["the", "thing", "ander", "ouen", "hathe", "sti", "are", "of"]
    rows, labels = [], []
    for k in range(n):
        said = [rng.choice(words) for _ in range(rng.randint(20, 300))]
        low = rng.random() < 0.3
        if low:
            at = rng.randrange(len(said))
            said[at : at + 20] = [w.upper() + "!!" for w in said[at : at + 20]]
        rows.append((k, " ".join(said), "en", "s"))
        labels.append((k, int(not low), 0))
    return rows, labels


def test_quality_of_held_out_rows(spark, docs):
    rows, labels = labelled(500)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in bn.score_quality(docs(rows), table).collect()}
    held = [(i, q) for i, q, _ in labels if got[i].held_out]
    assert held and all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in labels)
    assert sum(got[i].predicted == q for i, q in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_edge_rows(spark, docs):
    labels = spark.createDataFrame(
        [(1, 1, 1), (None, 1, 1), (4, 0, None), (5, 1, 0), (5, 1, 0), (6, 0, 0), (7, None, 1), (99, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = bn.score_quality(docs(EDGE), labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert bn.score_quality(docs([]), labels).count() == 0
    none = bn.score_quality(docs(EDGE), labels.limit(0)).collect()
    assert [r.score for r in none] == [pytest.approx(0.5)] * len(EDGE)
