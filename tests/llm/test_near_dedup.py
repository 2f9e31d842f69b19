"""Near copies and repeated paragraphs against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from edge_rows import EDGE

from loomline.llm import clusters
from loomline.llm import paragraph_dedup as pd
from loomline.llm.common import written
from loomline.llm.components import connected_components
from loomline.llm.near_dedup import near_duplicates
from loomline.llm.wordhash import mix, shingle_hashes, word_hashes


def shingles(text, size):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def least_reachable(sets):
    """sets in order: the place of the first set that each can reach."""
    least = list(range(len(sets)))

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return [root(k) for k in range(len(sets))]


def families(rng, n=12, copies=8, words=120):
    """Texts with copies that differ in a few to many words, chains among them."""
    out = []
    for _ in range(n):
        text = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
        out.append(list(text))
        for _ in range(copies):
            text = list(rng.choice([text, out[-1]]))
            for _ in range(rng.randint(0, 8)):
                text[rng.randrange(len(text))] = f"w{rng.randint(0, 5000)}"
            out.append(text)
    rng.shuffle(out)
    return [" ".join(t) for t in out]


def test_components_equal_brute_force(docs):
    rng = random.Random(3)
    texts = [*families(rng), "a b", "A b", "a b c", "x y z w", "X y z w", "", None, "one"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in near_duplicates(docs(rows)).collect()}
    sets = [shingles(t, 4) for t in texts]
    want = least_reachable(sets)
    assert {k: got[k].component_id for k in got} == dict(enumerate(want))
    assert all(got[k].n_shingles == len(s) and got[k].kept == (want[k] == k) for k, s in enumerate(sets))


def test_edge_rows(docs):
    got = near_duplicates(docs(EDGE)).collect()
    assert len(got) == len(EDGE)
    known = {r.doc_id: (r.component_id, r.kept) for r in got if r.doc_id is not None}
    assert known[4] == (4, True) and known[5] == (4, False) and known[2] == (2, True)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert near_duplicates(docs([])).count() == 0


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 999)], "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(links).collect()}
    assert found == {**{k: 0 for k in range(301)}, 999: 999, 1000: 999}


def plain_paragraphs(text):
    """Places of paragraphs by looking at each run of places in turn."""
    words = paragraph_words(text)
    last = len(words) - pd.WORDS
    if last < 0:
        return set()
    hashes = shingle_hashes(word_hashes(text.encode()), pd.SHINGLE)
    rank = [int(mix(h[None] ^ pd.ORDER)[0]) >> 20 for h in hashes]
    chosen = {0, last}
    for k in range(len(rank) - pd.SPREAD + 1):
        chosen.add(min(range(k, k + pd.SPREAD), key=lambda p: (rank[p], -p)))
    return {p for p in chosen if p <= last}


def paragraph_words(text):
    return re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_removal(texts):
    """Places of the removed paragraphs of each text, all pairs compared."""
    places, sets = [], []
    for d, text in enumerate(texts):
        words = paragraph_words(text)
        for p in sorted(plain_paragraphs(text)):
            places.append((d, p))
            sets.append(shingles(" ".join(words[p : p + pd.WORDS]), pd.SHINGLE))
    gone = collections.defaultdict(list)
    for (d, p), root in zip(places, least_reachable(sets)):
        if d != places[root][0]:
            gone[d].append(p)
    return gone


def plain_kept(text, places):
    bounds = [m.span() for m in re.finditer(b"[^\x20\x09-\x0D]+", text.encode())]
    drop = {w for p in places for w in range(p, p + pd.WORDS)}
    data, out, at = text.encode(), b"", 0
    for w, (start, _) in enumerate(bounds):
        end = bounds[w + 1][0] if w + 1 < len(bounds) else len(data)
        out += data[at:start] if w == 0 else b""
        out += b"" if w in drop else data[start:end]
        at = end
    return out + data[at:] if bounds else data


def prose(rng, n):
    return [f"w{rng.randint(0, 30_000)}" for _ in range(n)]


def test_paragraphs_equal_brute_force(docs):
    rng = random.Random(4)
    passages = [prose(rng, rng.randint(30, 90)) for _ in range(6)]
    texts = []
    for _ in range(40):
        words = prose(rng, rng.randint(0, 120))
        for _ in range(rng.randint(0, 2)):
            passage = list(rng.choice(passages))
            for _ in range(rng.choice([0, 0, 1, 3, 9])):
                passage[rng.randrange(len(passage))] = "new"
            at = rng.randint(0, len(words))
            words[at:at] = passage
        texts.append("".join(w.upper() + rng.choice([" ", " ", "\n", "\n\n", "\t"]) if rng.random() < 0.1 else w + " " for w in words))
    texts.append("Und " * 300)
    got = {r.doc_id: r for r in pd.without_repeated_paragraphs(docs(list(enumerate(texts)))).collect()}
    gone = plain_removal(texts)
    assert sum(map(len, gone.values())) > 20
    for i, text in enumerate(texts):
        kept = plain_kept(text, gone[i])
        row = got[i]
        assert (row.n_bytes, row.n_removed) == (len(text.encode()), len(text.encode()) - len(kept)), i
        assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert sum(b - a for a, b in row.spans) == row.n_removed and len(row.spans) == row.n_spans


def test_paragraphs_that_begin_otherwise_are_linked(docs):
    """Every pair at the limit counts, whichever words differ: also the first ones."""
    rng = random.Random(8)
    texts = []
    for k in range(150):
        words = prose(rng, pd.WORDS) if k % 3 else prose(rng, 6) * 5
        words = words[: pd.WORDS]
        other = list(words)
        for at in rng.choice([(0,), (1,), (26,), (27,), (0, 27)]):
            other[at] = "new"
        texts += [" ".join(words), " ".join(other), " ".join([f"x{k}", *words])]
    rng.shuffle(texts)
    gone = plain_removal(texts)
    got = {r.doc_id: r.kept_sha256 for r in pd.without_repeated_paragraphs(docs(list(enumerate(texts)))).collect()}
    assert len(gone) > 200
    assert got == {d: hashlib.sha256(plain_kept(t, gone[d])).hexdigest() for d, t in enumerate(texts)}


@pytest.mark.parametrize("kind", ["own line", "inside a line", "wrapped"])
def test_passages_are_found_wherever_they_stand(docs, kind):
    rng = random.Random(kind)
    rows, clean = [], []
    for k in range(40):
        passage = prose(rng, 55)
        for d in (2 * k, 2 * k + 1):
            before, after = " ".join(prose(rng, 60)), " ".join(prose(rng, 60))
            if kind == "own line":
                text = f"{before}\n{' '.join(passage)}\n{after}"
            elif kind == "inside a line":
                text = f"{before} {' '.join(passage)} {after}"
            else:
                at = rng.randint(5, 12)
                words = [*before.split(), *passage, *after.split()]
                text = "\n".join(" ".join(words[i : i + at]) for i in range(0, len(words), at))
            rows.append((d, text))
        license_line = "this short line stands in very many texts as it is and nobody minds it there"
        rows.append((1000 + k, f"{' '.join(prose(rng, 50))}\n{license_line}\n{' '.join(prose(rng, 50))}"))
    got = {r.doc_id: r for r in pd.without_repeated_paragraphs(docs(rows)).collect()}
    assert sum(got[2 * k + 1].n_removed > 0 for k in range(40)) == 40
    assert all(got[d].n_removed == 0 for d in got if d >= 1000 or d % 2 == 0)
    # most of a passage goes, and little else
    words = [len(rows[0][1].encode())]
    assert all(150 < got[2 * k + 1].n_removed < 450 for k in range(40)), words


def test_rows_that_share_a_key_come_through():
    rng = random.Random(3)
    keys = sorted(rng.choices(range(60), k=100))
    table = pa.table({"key": keys, "node": range(100)})
    want = [k for k, key in enumerate(keys) if keys.count(key) > 1]
    for size in (1, 2, 3, 7, 100):
        got = [x for b in pd._several(iter(table.to_batches(max_chunksize=size))) for x in b.column("node").to_pylist()]
        assert got == want


def test_paragraph_edge_rows(docs):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [*EDGE, (20, f"head\n{passage}\ntail"), (21, passage.upper()), (22, passage), (22, passage)]
    got = pd.without_repeated_paragraphs(docs(rows)).collect()
    assert len(got) == len(rows)
    removed = {r.doc_id: r.n_removed for r in got}
    assert removed[20] == 0 and removed[21] > 100 and removed[22] > 100
    assert all(removed[k] == 0 for k in (None, 1, 2, 3, 4, 5, 6, 7))
    assert pd.without_repeated_paragraphs(docs([])).count() == 0


def one_changed(rng, n, words, changes=1):
    base = prose(rng, words)
    texts = []
    for _ in range(n):
        text = list(base)
        for _ in range(changes):
            text[rng.randrange(words)] = f"x{rng.random()}"
        texts.append(" ".join(text))
    return texts


def test_a_group_of_near_copies_makes_a_forest(spark, docs, monkeypatch):
    rows = list(enumerate(one_changed(random.Random(1), 1000, 60)))
    counted = []

    def seen(df, label):
        out = written(df, label)
        if label == "near-pairs":
            counted.append(out.count())
        return out

    monkeypatch.setattr(clusters, "written", seen)
    got = near_duplicates(docs(rows)).collect()
    want = least_reachable([shingles(t, 4) for _, t in rows])
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))
    # by buckets at most their members; by pairs it would be many times as many
    assert len(counted) == 2 and counted[1] < 1000


def test_failed_pairs_are_compared_again(docs, monkeypatch):
    # digests that call every pair alike: each taken link is in doubt
    monkeypatch.setattr(clusters, "promising", lambda own, size, others, sizes, percent: np.ones(len(others), bool))
    rng = random.Random(9)
    texts = families(rng, n=5, copies=12, words=90)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(least_reachable([shingles(t, 4) for t in texts])))


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_a_repeated_id_links_all_its_texts(docs, partitions):
    rng = random.Random(2)
    groups = [one_changed(rng, 2, 80) for _ in range(30)]
    # the texts of id 7 have a near copy each, under ids of their own
    rows = [(7, a) for a, _ in groups] + [(100 + k, b) for k, (_, b) in enumerate(groups)] + [(9, "other words")]
    got = near_duplicates(docs(rows).repartition(partitions)).collect()
    assert {r.component_id for r in got if r.doc_id != 9} == {7}
    assert [(r.component_id, r.kept) for r in got if r.doc_id == 9] == [(9, True)]
