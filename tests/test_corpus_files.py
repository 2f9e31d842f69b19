"""Corpus folders against a plain line-by-line reading of the same bytes."""

from __future__ import annotations

import io
import os
import random

import pytest

from loomline.operators.guards import EmptyCorpusError
from loomline.plans.training_rows import Settings, index_files
from loomline.sources.byte_ranges import RANGE_BYTES
from loomline.sources.corpus_files import index_corpus, list_corpus


def plain_reading(files: dict[str, bytes]):
    """(ord, file number, byte offset, text) by reading each file in name order."""
    names = sorted(files)
    found = []
    for number, name in enumerate(names):
        at = 0
        for line in io.BytesIO(files[name]):
            text = line.decode("utf-8", errors="replace").strip()
            if text:
                found.append((number, at, text))
            at += len(line)
    return [(i, *row) for i, row in enumerate(found)]


def assert_same(spark, folder, files, pattern="*.json", range_bytes=RANGE_BYTES):
    index = index_corpus(spark, folder, pattern, range_bytes)
    want = plain_reading(files)
    assert index.n_docs == len(want)
    docs = {r.ord: (r.file_idx, r.text) for r in index.documents().collect()}
    places = {r.ord: (r.file_idx, r.byte_offset) for r in index.positions().collect()}
    assert docs == {o: (f, t) for o, f, _, t in want}
    assert places == {o: (f, at) for o, f, at, _ in want}
    summary = index.summary().first()
    assert (summary.files, summary.documents) == (len(files), len(want))
    return index


def test_edge_cases(spark, corpus):
    files = {
        "B.json": b"x\r\na\rb\n\n  \n\xc2\xa0\n\x1c\nlast",
        "a.json": b"\xef\xbb\xbffirst\nsecond\n third \n",
        "b.json": b"\xef\xbb\xbf \nafter a bare mark\n\nmore",
        "bad.json": b"p\xff\xfe\xe2\x82q\n\xe2\x82\n",
        "c.json": b"",
        "d.json": b"\n\n \n",
        "e.json": b"\xef\xbb\xbf",
        "f.json": b"\xef\xbb\xbfno newline",
        "g h[1].json": b"odd name\n",
        "z.json": "　é \n".encode(),
    }
    assert_same(spark, corpus(files), files)


def test_many_splits_and_packed_small_files(spark, corpus):
    rng = random.Random(11)

    def lines(n):
        return b"".join(
            rng.choice([b"", b"  ", b"word " * rng.randint(1, 30), "é ü".encode()]) + b"\n"
            for _ in range(n)
        )

    files = {f"f{i:02}.json": lines(rng.randint(0, 40)) for i in range(12)}
    files["big.json"] = lines(3000)
    files["marked.json"] = b"\xef\xbb\xbf\n" + lines(1500)
    folder = corpus(files)
    for range_bytes in (1000, 20_000, RANGE_BYTES):
        assert_same(spark, folder, files, range_bytes=range_bytes)


def test_ranges_of_a_few_bytes(spark, corpus):
    files = {
        "a.json": b"\xef\xbb\xbfone\n\ntwo \xe2\x82\xac\nthree",
        "b.json": b"\n\n",
        "c.json": "no end é".encode(),
        "d.json": b"x\n" * 20 + b"a long line " * 9 + b"\n",
    }
    folder = corpus(files)
    for range_bytes in (1, 2, 7, 64):
        assert_same(spark, folder, files, range_bytes=range_bytes)


@pytest.mark.parametrize("change", [b"word\n" * 41, b"word\n" * 39, b"wor\n" * 50])
def test_a_changed_file_is_refused(spark, corpus, change):
    folder = corpus({"a.json": b"word\n" * 40})
    index = index_corpus(spark, folder)
    with open(f"{folder}/a.json", "wb") as f:
        f.write(change)
    for table in (index.documents(), index.positions()):
        with pytest.raises(Exception, match="changed after indexing"):
            table.collect()


def test_hidden_files_are_read(spark, corpus):
    files = {"_h.json": b"one\n", ".d.json": b"two\n", "a.json": b"three\n", "n.txt": b"no\n"}
    folder = corpus(files)
    assert names(spark, folder) == [".d.json", "_h.json", "a.json"]
    del files["n.txt"]
    assert_same(spark, folder, files)


def names(spark, folder):
    return [r.name for r in list_corpus(spark, folder).orderBy("file_idx").collect()]


def test_name_order_is_by_code_point(spark, corpus):
    folder = corpus({n: b"x\n" for n in ("a.json", "B.json", "é.json", "_.json")})
    assert names(spark, folder) == ["B.json", "_.json", "a.json", "é.json"]


def test_very_many_empty_files(spark, corpus):
    folder = corpus({"m.json": b"only\nlines\n"})
    for k in range(100_000):
        open(f"{folder}/e{k}.json", "wb").close()
    index = index_corpus(spark, folder)
    assert (index.n_files, index.n_docs) == (100_001, 2)
    assert index.ranges.count() == 1
    assert [r.text for r in index.documents().orderBy("ord").collect()] == ["only", "lines"]
    assert index.documents().first().file_idx == 100_000


def test_wanted_documents_open_their_ranges_only(spark, corpus):
    files = {f"f{i}.json": b"".join(b"%d %d\n" % (i, k) for k in range(2000)) for i in range(4)}
    folder = corpus(files)
    index = index_corpus(spark, folder, range_bytes=500)
    want = {r[0]: r[3] for r in plain_reading(files)}
    wanted = [0, 1, 1, 3999, 4000, 7999, 123_456]
    # files without a wanted document may be gone
    os.remove(f"{folder}/f0.json")
    os.remove(f"{folder}/f3.json")
    asked = spark.createDataFrame([(k,) for k in wanted[3:5]], "ord bigint")
    assert {r.ord: r.text for r in index.fetch(asked).collect()} == {k: want[k] for k in (3999, 4000)}
    (open(f"{folder}/f0.json", "wb").write(files["f0.json"]), open(f"{folder}/f3.json", "wb").write(files["f3.json"]))
    asked = spark.createDataFrame([(k,) for k in wanted], "ord bigint")
    assert {r.ord: r.text for r in index.fetch(asked).collect()} == {k: want[k] for k in wanted if k in want}


def test_guards(spark, corpus):
    folder = corpus({"a.txt": b"x\n"})
    for missing in (folder, folder + "-none"):
        with pytest.raises(FileNotFoundError):
            index_corpus(spark, missing)
    one = index_corpus(spark, folder, "*.txt")
    with pytest.raises(EmptyCorpusError, match="train"):
        index_files(one, Settings())
    with pytest.raises(EmptyCorpusError, match="val"):
        index_files(one, Settings(val_fraction=0))


def test_empty_corpus(spark, corpus):
    index = index_corpus(spark, corpus({"a.json": b"", "b.json": b"\n \n"}))
    assert index.n_docs == 0 and index.documents().count() == 0
    with pytest.raises(EmptyCorpusError):
        index_files(index, Settings())
