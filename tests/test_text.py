"""Text rules against Python's own."""

from __future__ import annotations

import html
import random

from pyspark.sql import functions as F

from loomline.functions.arrays import running_starts
from loomline.functions.text import SPACES, has_ink, html_escape, lossy_utf8, strip_space, words


def test_space_set_is_pythons():
    every = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(SPACES) == every and len(SPACES) == 29


def test_strip_matches_python(spark):
    rng = random.Random(3)
    alphabet = list(SPACES) + ["a", "é", "﻿", "​", "᠎", "😀"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(3000)]
    texts += [c for c in SPACES] + [f"{c}x{c}y{c}" for c in SPACES]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select(
        "i", strip_space(F.col("t")).alias("s"), has_ink(F.col("t")).alias("ink"),
        words(strip_space(F.col("t"))).alias("w"),
    ).collect()
    for r in rows:
        assert r.s == texts[r.i].strip()
        assert r.ink == bool(texts[r.i].strip())
        if r.ink:
            assert r.w == texts[r.i].split()


def test_lossy_decode_matches_python(spark):
    rng = random.Random(1)
    pool = [b"\xff", b"\xfe", b"\xe2\x82", b"\xf0\x9f\x98", b"\xc3", b"\xed\xa0\x80", b"\xc0\x80",
            b"\xf4\x90\x80\x80", b"\xe0\x80", b"\xf1\x80", b"\x80", b"a", "é".encode(), "😀".encode()]
    data = [b"".join(rng.choices(pool, k=rng.randint(0, 8))) for _ in range(4000)]
    data += [bytes(rng.randrange(256) for _ in range(rng.randint(0, 7))) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(data)), "i int, b binary")
    for r in df.select("i", lossy_utf8(F.col("b")).alias("t")).collect():
        assert r.t == data[r.i].decode("utf-8", errors="replace")


def test_html_escape_matches_python(spark):
    texts = ["&lt;", "<a href=\"x\">it's</a>", "&&amp;''", "", "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", html_escape(F.col("t")).alias("h")).collect():
        assert r.h == html.escape(texts[r.i])


def test_running_starts(spark):
    rng = random.Random(5)
    lists = [[rng.randint(0, 9) for _ in range(rng.randint(0, 6))] for _ in range(500)]
    lists[7] = None
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<bigint>")
    for r in df.select("i", running_starts(F.col("x")).alias("s")).collect():
        x = lists[r.i] or []
        assert r.s == [sum(x[:j]) for j in range(len(x))]
