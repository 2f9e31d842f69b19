"""Language and toxicity models: held-out accuracy, hashing, edge rows."""

from __future__ import annotations

import collections
import itertools
import random
import zlib

import numpy as np
from edge_rows import EDGE

from loomline.llm import langid, toxicity

SYLLABLES = {
    "en": ["the", "ing", "and", "er", "th", "wh", "tion"],
    "fr": ["é", "eau", "que", "ment", "oi", "ç", "la"],
    "de": ["sch", "ung", "ü", "keit", "ei", "ß", "der"],
}
INSULTS = ["scumbag", "moronic", "idiotly"]


def sentence(rng, lang, words=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words)) + "."


def labelled(n=240):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = "\n".join(sentence(rng, lang) for _ in range(rng.randint(1, 4)))
        toxic = int(rng.random() < 0.4)
        if toxic:
            words = text.split(" ")
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
            text = " ".join(words)
        rows.append((k, text, lang, "s"))
        labels.append((k, 1, toxic))
    return rows, labels


def test_languages_of_held_out_rows(docs):
    rows, _ = labelled()
    got = {r.doc_id: r for r in langid.predict_languages(docs(rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, _, lang, _ in rows:
        held = zlib.crc32(str(doc_id).encode()) % 4 == 2
        assert got[doc_id].held_out == held
        assert 0 <= got[doc_id].score <= 1
    assert sum(got[i].lang_pred == lang for i, _, lang, _ in rows) >= 0.98 * len(rows)


def test_language_edge_rows(docs):
    rows, _ = labelled(40)
    made = docs([*EDGE, (50, "123 !!! \n 456"), *((100 + r[0], *r[1:]) for r in rows)])
    got = langid.predict_languages(made).collect()
    assert len(got) == len(EDGE) + 1 + len(rows)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 50)} == {"und"}
    assert langid.predict_languages(docs([])).count() == 0
    unlabelled = langid.predict_languages(docs([(1, "some text", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


def test_junk_languages_do_not_grow_the_model(docs, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    rows, _ = labelled(200)
    junk = [(1000 + k, "some words of no language", f"junk{k}") for k in range(50)]
    model = langid.train(docs([*rows, *junk]))
    assert set(model.languages) == set(SYLLABLES) and model.weights.shape[1] == 3


def test_chunks_do_not_change_the_grams(monkeypatch):
    text = "Ab, cd é 12 x" * 50 + "zzz"
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert (langid.gram_counts(text) == whole).all()


def test_toxicity_of_held_out_rows(spark, docs):
    rows, labels = labelled(400)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs(rows), table).collect()}
    held = [(i, t) for i, _, t in labels if got[i].held_out]
    assert held and all(zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in held)
    assert sum(got[i].predicted == t for i, t in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_inserted_and_gapped_insults_score_higher():
    rows, labels = labelled(400)
    machine = toxicity.fit([(toxicity.bag(r[1]), lab[2]) for r, lab in zip(rows, labels)])
    plain = machine.score("theand whing tionand")
    for text in ("scumxbag moroonic", "s.c.u.m.b.a.g m o r o n i c", "sc*umbag moro-nic"):
        assert machine.score(text) > plain


def test_toxicity_edge_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 1), (None, 1, 1), (4, 0, None), (99, 0, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs(EDGE), labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(docs([]), labels).count() == 0


def test_folded_machine_equals_the_kernel():
    words = [b"\x01\x02\x03\x04", b"\x02\x03\x04\x05\x06", b"\x07\x08\x09\x07"]
    marks = [b"\x01\x02\x03\x05", b"\x07\x08\x09\x0a"]
    table = np.zeros(toxicity.KEYS)
    vectors = toxicity.Vectors(marks)
    for k, share in enumerate((0.5, -2.0)):
        keys, values = vectors.of(k)
        table[keys] += share * values
    line = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
    direct = toxicity.kernel(words, marks) @ np.array([0.5, -2.0])
    assert np.allclose(toxicity.word_sums(line, table)[2], direct)


def enumerated(word):
    """Weights of all subsequences of four characters, ends included, by looking at each."""
    line = b"\0" + word + b"\0"
    found = collections.Counter()
    for places in itertools.combinations(range(len(line)), 4):
        span = places[-1] - places[0] + 1
        if span <= toxicity.SPAN:
            found[bytes(line[k] for k in places)] += toxicity.DECAY**span
    return found


def test_kernel_equals_the_sum_over_all_subsequences():
    rng = random.Random(6)
    words = [bytes(rng.choices(range(1, 6), k=n)) for n in (1, 2, 3, 4, 5, 7, 9, 12, 4, 6)]
    scale = [float(toxicity.scales(np.array([len(w)]))[0]) for w in words]
    sums = [enumerated(w) for w in words]
    want = [
        [sum(v * b[k] for k, v in a.items()) * x * y for b, y in zip(sums, scale)] for a, x in zip(sums, scale)
    ]
    assert np.allclose(toxicity.kernel(words, words), want)


def test_short_words_are_no_witnesses():
    rows, labels = labelled(400)
    machine = toxicity.fit([(toxicity.bag(r[1]), lab[2]) for r, lab in zip(rows, labels)])
    # letters that an insult begins with, but fewer than LEAST of them
    assert machine.score("scu mor idi") == machine.score("theand") < 0.5
