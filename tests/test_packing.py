"""Packing against a plain draw-until-full loop, and its properties."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomline.functions.arrays import packed_ids, unpacked_ids
from loomline.operators import packing
from loomline.operators.packing import pack_examples, shift_pairs, to_batches
from loomline.plans.training_rows import Settings, index_files, index_table, packed_rows
from loomline.sources import length_files
from loomline.sources.corpus_files import index_corpus
from loomline.sources.vocabulary import vocabulary
from loomline.staging import staged

from test_tokens import WORDS, tokenizer_json


def draw(seed, split, example, k, n):
    digest = hashlib.md5(f"{seed}|{split}|{example}|{k}".encode()).hexdigest()
    return int(digest[:15], 16) % n


def plain_pack(docs, split, example, target, seed):
    """docs: wrapped ids of the split's documents in order."""
    ids, k = [], 0
    while len(ids) < target:
        ids += docs[draw(seed, split, example, k, len(docs))]
        k += 1
    return ids[:target]


def make_docs(rng, sizes, longest):
    return {
        split: [[1, *(rng.randint(3, 99) for _ in range(rng.randint(0, longest))), 2] for _ in range(n)]
        for split, n in sizes.items()
    }


def run(spark, docs, examples, target, seed=0, parts=3, **options):
    rows = [(s, i, ids) for s, many in docs.items() for i, ids in enumerate(many)]
    table = spark.createDataFrame(rows, "split string, split_ord bigint, ids array<int>")
    asked = spark.createDataFrame(examples, "split string, example bigint").repartition(parts)
    fetched = []

    def fetch(wanted):
        fetched.append(wanted is None)
        return table if wanted is None else table.join(wanted, ["split", "split_ord"])

    sizes = {s: len(many) for s, many in docs.items()}
    packed = pack_examples(asked, sizes, fetch, target, seed, **options)
    rows = packed.collect()
    assert len(rows) == len(examples)
    return {(r.split, r.example): r.ids for r in rows}, fetched


@pytest.mark.parametrize("limit", [100_000, 10, 0])
@pytest.mark.parametrize("longest,first_round,rounds", [(40, 16, 1), (0, 4, 2), (6, 5, 2)])
def test_packed_rows_equal_the_plain_loop(spark, limit, longest, first_round, rounds):
    rng = random.Random(longest)
    docs = make_docs(rng, {"train": 60, "val": 3}, longest)
    examples = [("train", e) for e in range(40)] + [("val", e) for e in range(15)]
    got, fetches = run(
        spark, docs, examples, 33, seed=7, first_round=first_round, broadcast_bytes=limit * 180
    )
    assert len(fetches) == rounds
    for (split, example), ids in got.items():
        assert ids == plain_pack(docs[split], split, example, 33, 7)


@pytest.mark.parametrize("n_examples,takes_all", [(10, False), (200, True)])
def test_few_draws_read_only_what_they_need(spark, n_examples, takes_all):
    docs = make_docs(random.Random(2), {"train": 700, "val": 5}, 60)
    examples = [("train", e) for e in range(n_examples)]
    got, fetches = run(spark, docs, examples, 65)
    assert fetches[0] == takes_all
    for (split, example), ids in got.items():
        assert ids == plain_pack(docs[split], split, example, 65, 0)


def test_drawn_tokens_are_not_shuffled_again(spark):
    rng = random.Random(3)
    docs = make_docs(rng, {"train": 400}, 30)
    rows = [(s, i, ids) for s, many in docs.items() for i, ids in enumerate(many)]
    table = spark.createDataFrame(rows, "split string, split_ord bigint, ids array<int>")
    asked = spark.createDataFrame([("train", e) for e in range(50)], "split string, example bigint")

    def fetch(wanted):
        return table if wanted is None else table.join(wanted, ["split", "split_ord"])

    packed = pack_examples(asked, {"train": 400}, fetch, 65, broadcast_bytes=0)
    plan = packed._jdf.queryExecution().executedPlan().toString().split("\n")
    scans = [k for k, line in enumerate(plan) if "Scan parquet" in line and "drawn_tokens" in line]
    assert scans

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    for k in scans:
        # the operators from the scan up to its join
        at = k
        while "SortMergeJoin" not in plan[at]:
            assert "Exchange" not in plan[at]
            at = next(j for j in range(at - 1, -1, -1) if depth(plan[j]) < depth(plan[at]))


def test_one_document_split_takes_every_draw(spark):
    docs = {"train": [[1, 9, 2]] * 5, "val": [[1, 8, 8, 2]]}
    examples = [("val", e) for e in range(300)]
    got, _ = run(spark, docs, examples, 129)
    assert all(ids == ([1, 8, 8, 2] * 33)[:129] for ids in got.values())


def test_same_rows_whatever_the_partitions(spark):
    docs = make_docs(random.Random(4), {"train": 50, "val": 5}, 30)
    examples = [("train", e) for e in range(30)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for parts, shuffles in ((1, "2"), (7, "13")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        results.append(run(spark, docs, examples, 65, parts=parts)[0])
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
    assert run(spark, docs, examples, 65, seed=1)[0] != results[0]


def lines():
    rng = random.Random(21)
    pool = ["the", "cat", "sat", "é", "dog"]
    return [" ".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(120)]


def plain_rows(settings, asked):
    ids = [[1, *(WORDS.get(w, 0) for w in t.split()), 2] for t in lines()]
    n_val = max(1, int(settings.val_fraction * len(ids)))
    docs = {"train": ids[:-n_val], "val": ids[-n_val:]}
    caps = {"train": settings.max_train_docs, "val": settings.max_val_docs}
    for split in docs:
        if settings.data_fraction is not None:
            docs[split] = docs[split][: int(len(docs[split]) * settings.data_fraction)]
        docs[split] = docs[split][: caps[split]]
    return {
        (s, e): plain_pack(docs[s], s, e, settings.block_size + 1, settings.seed) for s, e in asked
    }


@pytest.mark.parametrize(
    "settings", [Settings(seed=3), Settings(0.3, 0.5, 20, 4, block_size=16, seed=5)]
)
@pytest.mark.parametrize("source", ["table", "files"])
@pytest.mark.parametrize("n_train,n_val", [(70, 10), (3, 1)])
def test_corpus_to_batches(spark, corpus, settings, source, n_train, n_val):
    if source == "table":
        # three lines a row, blank ones between
        texts = ["\n \n".join(lines()[i : i + 3]) for i in range(0, 120, 3)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        index = index_table(docs, "doc_id", "text", settings)
    else:
        halves = lines()[:70], lines()[70:]
        folder = corpus(
            {f"{n}.json": ("\n\n".join(part) + "\n").encode() for n, part in zip("ab", halves)}
        )
        index = index_files(index_corpus(spark, folder), settings)
    vocab = vocabulary(spark.createDataFrame(list(WORDS.items()), "token string, id int"))
    asked = [("train", e) for e in range(n_train)] + [("val", e) for e in range(n_val)]
    examples = spark.createDataFrame(asked, "split string, example bigint")
    packed = packed_rows(index, examples, vocab, tokenizer_json(), settings)
    got = {(r.split, r.example): r.ids for r in packed.collect()}
    assert got == plain_rows(settings, asked)

    block = settings.block_size
    pairs = shift_pairs(packed, block)
    for r in pairs.collect():
        assert len(r.input_ids) == len(r.target_ids) == block
        assert r.input_ids[0] == vocab.bos and r.input_ids[1:] == r.target_ids[:-1]
    rows = {(r.split, r.batch_id, r.row_in_batch) for r in to_batches(pairs, 64).collect()}
    assert rows == {(s, e // 64, e % 64) for s, e in asked}


def test_draws_that_are_not_used_are_never_rows(spark, monkeypatch):
    """The lengths of all documents decide in place: nothing of every draw is shuffled."""
    rng = random.Random(12)
    docs = make_docs(rng, {"train": 300, "val": 4}, 40)
    examples = [("train", e) for e in range(200)] + [("val", e) for e in range(5)]
    seen = {}

    def kept(df, label):
        seen[label] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, label)

    monkeypatch.setattr(packing, "staged", kept)
    got, fetches = run(spark, docs, examples, 65, seed=4, broadcast_bytes=0)
    assert fetches[0]
    assert "Join" not in seen["used-draws"] and "Window" not in seen["used-draws"]
    for (split, example), ids in got.items():
        assert ids == plain_pack(docs[split], split, example, 65, 4)


def test_documents_of_one_number_are_told_apart_by_a_join(spark):
    # as before: both are taken by a draw, and no length is lost in a file
    docs = spark.createDataFrame(
        [("train", k, [1, 5 + k, 2]) for k in (0, 1, 1, 2)], "split string, split_ord bigint, ids array<int>"
    )
    asked = spark.createDataFrame([("train", e) for e in range(20)], "split string, example bigint")
    packed = pack_examples(asked, {"train": 3}, lambda wanted: docs, 13, 0)
    for row in packed.collect():
        drawn = [draw(0, "train", row.example, k, 3) for k in range(7)]
        starts, at = [], 0
        for n in drawn:
            starts.append([at, at + 3] if n == 1 else [at])
            at += 3 * len(starts[-1])
        plain = []
        for n, own in zip(drawn, starts):
            # each of two rows that are used finds both documents again
            rooms = sorted(13 - x for x in own if x < 13 for _ in own)
            plain += [x for room in rooms for x in [1, 5 + n, 2][:room]]
        assert row.ids == plain


def test_packed_ids_come_back(spark):
    rng = random.Random(13)
    lists = [[rng.choice([rng.randrange(1 << b) for b in (6, 8, 14, 21, 31)]) for _ in range(rng.randint(0, 30))] for _ in range(200)]
    lists += [[], [0, None, 2**31 - 1, -1, -(2**31)], [126, 127, 128, 16382, 16383, 16384]]
    rows = spark.createDataFrame([(i, ids) for i, ids in enumerate(lists)], "i int, ids array<int>")
    parts = rows.repartition(3).select("i", packed_ids(F.col("ids")).alias("p")).filter("p is not null")
    both = unpacked_ids(F.array("p", "p"), F.array(F.lit(40), F.lit(7)))
    assert {r.i: r.ids for r in parts.select("i", both.alias("ids")).collect()} == {
        i: ids + ids[:7] for i, ids in enumerate(lists)
    }


def test_lengths_are_found_in_files(spark, monkeypatch):
    monkeypatch.setattr(length_files, "BLOCK", 16)
    rng = random.Random(14)
    for longest in (200, 300, 70_000):
        known = {(s, n): rng.randint(2, longest) for s, m in (("train", 100), ("val", 3)) for n in range(m) if n % 7 != 6}
        rows = spark.createDataFrame([(*k, v) for k, v in known.items()], "split string, split_ord bigint, len int")
        lengths = length_files.written_lengths(rows.repartition(3), longest)
        assert lengths.repeats == 0 and len(lengths.parts) == 8
        asked = [(s, [rng.randrange(110) for _ in range(rng.randint(0, 20))]) for s in ("train", "val", "none") for _ in range(10)]
        table = spark.createDataFrame(asked, "split string, ords array<bigint>").repartition(2)
        got = table.select("*", length_files.lengths_of(F.col("split"), F.col("ords"), lengths).alias("lens")).collect()
        assert len(got) == 30
        assert all(r.lens == [known.get((r.split, n), 0) for n in r.ords] for r in got)
