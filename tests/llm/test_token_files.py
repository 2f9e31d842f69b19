"""Round trips of token files, the perfect hash, and the encoder against the library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from edge_rows import EDGE

from loomline.llm import token_files
from loomline.llm.encoder import Encoder
from loomline.llm.queries import tokenizer_path
from loomline.llm.token_files import build_hash, find_slots, key_hash, look_up, token_digest, write_token_files

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def test_pieces_encode_as_whole_texts(encoder):
    rng = random.Random(3)
    bits = ["a", "B", " ", "  ", "\n", "\t", "é", "12", "'s", ",", "　", "\x1c", "\x85", "<|endoftext|>",
            "word", "\r", "  \n", "​", "😀", " ", ".", "中", "Ⅷ", "̈"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want


def test_digest(docs, encoder):
    rows = [(k, t) for k, t in enumerate(["Some words.", "", None, "x\ny z", "more  words here", "é"] * 5)]
    got = {r.doc_id: tuple(r)[1:] for r in token_digest(docs(rows[::-1]), PATH).collect()}
    start, want = 0, {}
    for doc_id, text in rows:
        ids = [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want


def test_edge_rows(docs):
    got = token_digest(docs(EDGE), PATH).collect()
    assert len(got) == len(EDGE)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
    assert token_digest(docs([]), PATH).count() == 0


def test_keyed_access(spark, docs, monkeypatch):
    monkeypatch.setattr(token_files, "BUCKET_KEYS", 20)
    files = write_token_files(docs([(k * 7, f"text {k}") for k in range(200)]), PATH)
    assert files.buckets == 10
    keys = spark.createDataFrame([(0, 1), (7, 1), (7, 2), (8, 1), (1393, 1), (9999, 1)], "doc_id bigint, nth bigint")
    assert {(r.doc_id, r.nth) for r in look_up(files, keys).collect()} == {(0, 1), (7, 1), (1393, 1)}


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(5)
    keys = rng.choice(10**9, 20_000, replace=False)
    hashes = key_hash(keys, np.ones(len(keys), np.int64))
    levels, slots = build_hash(hashes)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert (find_slots(levels, hashes) == slots).all()


def test_equal_hashes_are_left_out():
    hashes = np.array([5, 5, 9], np.uint64)
    assert (build_hash(hashes)[1] >= 0).tolist() == [False, False, True]
