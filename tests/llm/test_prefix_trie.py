"""The prefix trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from loomline.llm.prefix_trie import trie_nodes

SCHEMA = (
    "conv_id bigint, turn bigint, role string, text string, "
    # names the operator uses inside
    "conv string, pos string, shard string, block string, size string, depth string, x1 string, low string, n string"
)
EXTRA = ("x",) * 9


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def brute_force(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
        ends[tuple(rebuilt[c])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        own_saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own_saved + sum(saved[k] for k in kids[node])
    return sorted(
        (
            m[0], len(node), members[node[:-1]][0] if node else -1, len(m), len(kids[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def random_rows(rng, n=60, most=14):
    """Conversations that share beginnings, some of them whole; few texts, so nodes meet."""
    said = ["", "a", "b", "ü ß", None, "long text " * 50]
    rows, sequences = [], []
    for conv in rng.sample(range(-20, 400), n):
        base = list(rng.choice(sequences))[: rng.randint(0, most)] if sequences and rng.random() < 0.8 else []
        base += [(rng.choice(["user", "assistant", None]), rng.choice(said)) for _ in range(rng.randint(0, 5))]
        sequences.append(base)
        start = rng.choice([None, 0, 5])
        for k, (role, text) in enumerate(base):
            rows.append((conv, start if k == 0 else k + 10, role, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shard_turns", "block"), [(1 << 14, 1 << 12), (40, 1 << 12), (25, 3), (7, 1)])
def test_nodes_equal_brute_force(spark, shard_turns, block):
    rows = random_rows(random.Random(shard_turns + block))
    got = found(trie_nodes(table(spark, rows), shard_turns, block))
    assert got == brute_force(rows)


def test_one_conversation_said_by_many(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(12)]
    rows += [(1000, t, "user", f"turn {t}") for t in range(200)]
    assert found(trie_nodes(table(spark, rows), 100, 16)) == brute_force(rows)


def test_edge_rows(spark):
    rows = [
        (None, 0, "user", "in no conversation"), (1, None, None, None), (2, 0, "user", "x" * 200_000),
        (3, 1, "user", "same"), (3, 2, "user", "same"), (4, None, "", ""), (7, 0, "user", "only"),
    ]
    assert found(trie_nodes(table(spark, rows))) == brute_force(rows)
    assert trie_nodes(table(spark, [])).count() == 0


def test_repeated_rows_and_ties(spark):
    rows = [(10, 3, "user", "a"), (10, 3, "user", "a"), (15, 3, "user", "a"), (15, 3, "user", "a")]
    assert found(trie_nodes(table(spark, rows))) == brute_force(rows)
    tied = [(20, 1, "user", "a"), (20, 1, "user", "b"), (25, 1, "user", "b"), (25, 1, "user", "a")]
    # turns of one number have one order, whatever order the rows come in
    one, other = found(trie_nodes(table(spark, tied))), found(trie_nodes(table(spark, tied[::-1])))
    assert one == other
