"""Encoding, decoding, wrap and context cut."""

from __future__ import annotations

import json
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomline.operators.guards import MissingTokenError
from loomline.operators.tokens import (
    context_window,
    decode_ids,
    encode_words,
    tokenizer_ids,
    tokenizer_text,
    wrap,
)
from loomline.sources import word_files
from loomline.sources.vocabulary import (
    Vocabulary,
    read_tokenizer,
    special_ids,
    tokenizer_vocabulary,
    vocabulary,
)

WORDS = {"[UNK]": 0, "[BOS]": 1, "[EOS]": 2, "the": 3, "cat": 4, "sat": 5, "é": 6}


def tokenizer_json(template: bool = False) -> str:
    post = None
    if template:
        post = {
            "type": "TemplateProcessing",
            "single": [
                {"SpecialToken": {"id": "[BOS]", "type_id": 0}},
                {"Sequence": {"id": "A", "type_id": 0}},
                {"SpecialToken": {"id": "[EOS]", "type_id": 0}},
            ],
            "pair": [{"Sequence": {"id": "A", "type_id": 0}}, {"Sequence": {"id": "B", "type_id": 0}}],
            "special_tokens": {
                t: {"id": t, "ids": [WORDS[t]], "tokens": [t]} for t in ("[BOS]", "[EOS]")
            },
        }
    return json.dumps(
        {
            "version": "1.0", "truncation": None, "padding": None, "added_tokens": [],
            "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"},
            "post_processor": post, "decoder": None,
            "model": {"type": "WordLevel", "vocab": WORDS, "unk_token": "[UNK]"},
        }
    )


@pytest.fixture
def vocab(spark) -> Vocabulary:
    return vocabulary(spark.createDataFrame(list(WORDS.items()), "token string, id int"))


def texts(n=200):
    rng = random.Random(8)
    pool = ["the", "cat", "sat", "é", "dog"]
    return [" ".join(rng.choices(pool, k=rng.randint(1, 30))) for _ in range(n)]


def plain_ids(text):
    return [WORDS.get(w, 0) for w in text.split()]


@pytest.mark.parametrize("part_bytes", [word_files.PART_BYTES, 40])
def test_words_to_ids(spark, vocab, monkeypatch, part_bytes):
    monkeypatch.setattr(word_files, "PART_BYTES", part_bytes)
    rows = [*enumerate(texts()), (-1, None)]
    df = spark.createDataFrame(rows, "i int, text string")
    got = {r.i: r.ids for r in encode_words(df, vocab, ["i"]).collect()}
    assert got == {i: None if t is None else plain_ids(t) for i, t in rows}
    assert len(vocab.by_word.parts) > (part_bytes < 100)


def test_words_with_one_hash_are_told_apart(spark, monkeypatch):
    def same_for_all():
        return lambda: lambda array: __import__("numpy").full(len(array), 5)

    monkeypatch.setattr(word_files, "_hasher", same_for_all)
    known = vocabulary(spark.createDataFrame(list(WORDS.items()), "token string, id int"))
    df = spark.createDataFrame(list(enumerate(texts())), "i int, text string")
    got = {r.i: r.ids for r in encode_words(df, known, ["i"]).collect()}
    assert got == {i: plain_ids(t) for i, t in enumerate(texts())}


def test_unknown_words_without_an_id(spark, vocab):
    bare = Vocabulary(vocab.table.filter("id > 0"), vocab.bos, vocab.eos)
    df = spark.createDataFrame([("the dog \u2003 cat" + "x" * 5000,)], "text string")
    assert encode_words(df, bare, []).first().ids == [3, None, None]


def test_many_words_both_ways(spark):
    rng = random.Random(4)
    pool = sorted({"".join(rng.choices("abcdeé漢😀", k=rng.randint(1, 9))) for _ in range(20_000)})
    entries = [*list(WORDS.items())[:3], *((w, 10 * k + 7) for k, w in enumerate(pool))]
    known = vocabulary(spark.createDataFrame(entries, "token string, id int"))
    ids = dict(entries)
    rows = [(i, " ".join(rng.choices(pool, k=rng.randint(1, 400)))) for i in range(100)]
    df = spark.createDataFrame(rows, "i int, text string").repartition(5)
    encoded = encode_words(df, known, ["i"])
    assert {r.i: r.ids for r in encoded.collect()} == {i: [ids[w] for w in t.split()] for i, t in rows}
    assert {r.i: r.text for r in decode_ids(encoded, known, ["i"]).collect()} == dict(rows)
    assert known.by_word is known.by_word


def test_tokenizer_column_equals_word_join(spark):
    rows = [*enumerate(texts()), (-1, None), (-2, "")]
    df = spark.createDataFrame(rows, "i int, text string")
    ids = tokenizer_ids(spark, F.col("text"), tokenizer_json(), slice_rows=7)
    got = {r.i: r.ids for r in df.select("i", ids.alias("ids")).collect()}
    assert got == {i: None if t is None else plain_ids(t) for i, t in rows}


@pytest.mark.parametrize("add,want", [(True, [1, 3, 4, 2]), (False, [3, 4])])
def test_template_specials_follow_the_switch(spark, add, want):
    df = spark.createDataFrame([("the cat",)], "text string")
    ids = tokenizer_ids(spark, F.col("text"), tokenizer_json(True), add)
    assert df.select(ids.alias("ids")).first().ids == want


def test_subword_tokenizer_equals_the_library(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tokenizer = Tokenizer(models.BPE())
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel()
    trainer = trainers.BpeTrainer(
        vocab_size=300, special_tokens=["[BOS]", "[EOS]"], show_progress=False,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet(),
    )
    tokenizer.train_from_iterator(texts(), trainer)
    known = tokenizer_vocabulary(spark, tokenizer.to_str())
    assert known.table.count() == tokenizer.get_vocab_size()
    assert known.bos == tokenizer.token_to_id("[BOS]")
    rows = list(enumerate([*texts(40), "unseen wörds 😀", "a  b\tc"]))
    df = spark.createDataFrame(rows, "i int, text string")
    ids = tokenizer_ids(spark, F.col("text"), tokenizer.to_str())
    encoded = df.select("text", ids.alias("ids"))
    wrapped = wrap(F.col("ids"), known)
    whole, bare = (
        tokenizer_text(spark, wrapped, tokenizer.to_str(), skip, 7) for skip in (False, True)
    )
    for r in encoded.select("*", whole.alias("whole"), bare.alias("bare")).collect():
        assert r.ids == tokenizer.encode(r.text).ids
        assert r.bare == tokenizer.decode([known.bos, *r.ids, known.eos])
        assert r.whole == tokenizer.decode([known.bos, *r.ids, known.eos], skip_special_tokens=False)


@pytest.mark.parametrize("part_bytes", [word_files.PART_BYTES, 40])
def test_decode_skips_specials_and_keeps_order(spark, vocab, monkeypatch, part_bytes):
    monkeypatch.setattr(word_files, "PART_BYTES", part_bytes)
    rows = [(0, [1, 3, 4, 2]), (1, [0, 5, 5, 6]), (2, [1, 2]), (3, []), (4, None), (5, [99, 3, None])]
    df = spark.createDataFrame(rows, "i int, ids array<int>")
    got = {r.i: r.text for r in decode_ids(df, vocab, ["i"]).collect()}
    assert got == {0: "the cat", 1: "sat sat é", 2: "", 3: "", 4: "", 5: "the"}


def test_wrap_and_context_window(spark, vocab):
    rows = [(i, list(range(10, 10 + i))) for i in (0, 1, 3, 127, 128, 129, 400)]
    df = spark.createDataFrame(rows, "i int, ids array<int>")
    for r in df.select(
        "ids", wrap(F.col("ids"), vocab).alias("w"), context_window(F.col("ids")).alias("c")
    ).collect():
        assert r.w == [1, *r.ids, 2]
        assert r.c == r.ids[-128:]


def test_missing_specials_and_files(spark, vocab, tmp_path):
    assert special_ids(vocab.table) == {"[BOS]": 1, "[EOS]": 2}
    with pytest.raises(MissingTokenError, match="EOS"):
        special_ids(vocab.table.filter("token <> '[EOS]'"))
    with pytest.raises(FileNotFoundError):
        read_tokenizer(spark, str(tmp_path / "none.json"))
    path = tmp_path / "tok.json"
    path.write_text(tokenizer_json(), encoding="utf-8")
    known = tokenizer_vocabulary(spark, read_tokenizer(spark, str(path)), "[UNK]")
    assert (known.bos, known.eos, known.unknown) == (1, 2, 0)
    assert {r.token: r.id for r in known.table.collect()} == WORDS
    broken = json.loads(tokenizer_json())
    del broken["model"]["vocab"]["[BOS]"]
    with pytest.raises(MissingTokenError, match="BOS"):
        tokenizer_vocabulary(spark, json.dumps(broken))


def test_words_are_hashed_a_bounded_number_at_a_time(monkeypatch):
    """The hashes of a batch's words took forty bytes and more for each byte of the batch."""
    words = ["", "é" * 40, "a", *(f"word{k}" for k in range(50)), "", ""]
    whole = word_files._hasher()()(pa.array(words)).tolist()
    monkeypatch.setattr(word_files, "HASHED_BYTES", 7)
    small = word_files._hasher()()
    assert small(pa.array(words)).tolist() == whole
    assert small(pa.array(["x", *words]).slice(1)).tolist() == whole
    assert small(pa.array([], pa.string())).tolist() == []
    monkeypatch.undo()
    many = pa.array([f"w{k:011d}" for k in range(600_000)])
    hashes = word_files._hasher()()
    tracemalloc.start()
    hashes(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_a_look_up_in_several_batches_and_parts(spark, monkeypatch):
    monkeypatch.setattr(word_files, "PART_BYTES", 4000)
    words = ["", *(f"wörd{k}" * (1 + k % 5) for k in range(400))]
    table = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "token string, id int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        look_up = word_files.word_look_up(table)
        asked = spark.createDataFrame([([*words[k::9], "none"],) for k in range(9)], "words array<string>")
        got = [r.ids for r in asked.select(word_files.ids_of(F.col("words"), look_up, -5).alias("ids")).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(look_up.parts) > 3
    assert sorted(got) == sorted([*range(k, len(words), 9), -5] for k in range(9))
