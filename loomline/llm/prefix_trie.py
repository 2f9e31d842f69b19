"""Conversation prefix trie by vertical bitmaps.

Conversations are numbered in order of their id and cut into shards, ranges of
ids whose turns are at most about SHARD_TURNS, and along their length into blocks
of BLOCK turns, so no task holds more than one shard's block. In a shard each
(position, turn) has a posting: the bitset of the conversations that have that
turn there. From the shard's top, a node's bitset is intersected with the
postings of the next position, depth first: each intersection that is not empty is
a child, its popcount the number of its conversations, and the bits whose
conversations end there are its end list.

The shards' nodes are then joined by what names a node everywhere: its depth and
two 64-bit hashes of its turns with their positions. Each node is counted once, in
the shard of its smallest conversation, so the totals of subtrees are sums over
shards. A subtree that goes on in later blocks is added at the block's last turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import written
from loomline.operators.ordering import rank_rows

#: Turns of the conversations of one shard, and turns of a conversation in one block.
SHARD_TURNS = 1 << 14
BLOCK = 1 << 12
#: Fixed value: a rebuilt conversation takes fewer than so many turns from its base.
HEADS = 9
#: Fixed value: conversations share the base of so many ids.
FAMILY = 5

KEY = ["depth", "x1", "x2"]
LOCAL = (
    "shard bigint, block bigint, idx bigint, up bigint, depth bigint, x1 bigint, x2 bigint, "
    "low bigint, n bigint, size bigint, n_ends bigint, ends string"
)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys (numbers, not null), each as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            own = tuple(columns[:, start].tolist())
            if own != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = own
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


class ShardTrie:
    """The nodes of one block of one shard, from their turns in order of (conv, pos).

    The first row of a conversation is its mark: the hashes of the turns before
    the block, and in size the length of the conversation.
    """

    def __init__(self, conv: list[int], pos: list[int], f1: list[int], f2: list[int], size: list[int]) -> None:
        self.top = pos[0] + 1
        self.ids: list[int] = []
        self.turns: list[list[tuple[int, int]]] = []
        self.sizes: list[list[int]] = []
        members: dict[tuple[int, int], list[int]] = {}
        posted: dict[tuple[int, int], list[int]] = {}
        ended: dict[int, list[int]] = {}
        for c, p, a, b, s in zip(conv, pos, f1, f2, size):
            if p < self.top:
                at = len(self.ids)
                self.ids.append(c)
                self.turns.append([])
                self.sizes.append([])
                members.setdefault((a, b), []).append(at)
                ended.setdefault(s, []).append(at)
            else:
                self.turns[-1].append((a, b))
                self.sizes[-1].append(s)
                posted.setdefault((a, b), []).append(at)
        self.members = {k: self.bits(v) for k, v in members.items()}
        self.posted = {k: self.bits(v) for k, v in posted.items()}
        self.ended = {k: self.bits(v) for k, v in ended.items()}
        self.out: list[tuple] = []

    def bits(self, places: list[int]) -> int:
        flags = np.zeros((len(self.ids) + 7) // 8 * 8, np.uint8)
        flags[places] = 1
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    def listed(self, bits: int) -> list[int]:
        """The conversations of a bitset in order."""
        data = np.frombuffer(bits.to_bytes((len(self.ids) + 7) // 8, "little"), np.uint8)
        return [self.ids[k] for k in np.flatnonzero(np.unpackbits(data, bitorder="little")).tolist()]

    def node(self, up: int, depth: int, key: tuple[int, int], bits: int, n: int, low: int, size: int) -> int:
        over = bits & self.ended.get(depth, 0)
        ends = self.listed(over) if over else None
        self.out.append((
            len(self.out), up, depth, *key, self.ids[low], n, size, len(ends or ()),
            None if ends is None else ",".join(map(str, ends)),
        ))
        return len(self.out) - 1

    def chain(self, up: int, at: int, depth: int, key: tuple[int, int]) -> None:
        """The nodes that one conversation alone goes on with."""
        bit = 1 << at
        for k in range(depth - self.top, len(self.turns[at])):
            a, b = self.turns[at][k]
            key = key[0] ^ a, key[1] ^ b
            up = self.node(up, self.top + k + 1, key, bit, 1, at, self.sizes[at][k])

    def build(self) -> list[tuple]:
        """idx, up, depth, x1, x2, low, n, size, n_ends, ends of each node.

        The top of a later block belongs to the block before: it is put out with
        no members, so that its children can be counted.
        """
        for key, bits in self.members.items():
            low = (bits & -bits).bit_length() - 1
            if self.top:
                self.out.append((len(self.out), -1, self.top, *key, self.ids[low], 0, 0, 0, None))
                top = len(self.out) - 1
            else:
                top = self.node(-1, 0, key, bits, bits.bit_count(), low, 0)
            stack = [(top, bits, self.top, key)]
            while stack:
                parent, bits, depth, key = stack.pop()
                rest = bits & ~self.ended.get(depth, 0)
                while rest:
                    low = (rest & -rest).bit_length() - 1
                    if depth - self.top >= len(self.turns[low]):
                        rest &= rest - 1  # it goes on in the next block
                        continue
                    turn = self.turns[low][depth - self.top]
                    child = rest & self.posted[turn]
                    rest ^= child
                    own = key[0] ^ turn[0], key[1] ^ turn[1]
                    n = child.bit_count()
                    at = self.node(parent, depth + 1, own, child, n, low, self.sizes[low][depth - self.top])
                    if n == 1:
                        self.chain(at, low, depth + 1, own)
                    else:
                        stack.append((at, child, depth + 1, own))
        return self.out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 11 + [pa.string()]
    names = [c.split()[0] for c in LOCAL.split(", ")]
    for table in runs(batches, ["shard", "block"]):
        columns = [table.column(c).to_pylist() for c in ("conv", "pos", "f1", "f2", "size")]
        found = list(zip(*ShardTrie(*columns).build()))
        n = len(found[0])
        shard, block = (table.column(c)[0].as_py() for c in ("shard", "block"))
        arrays = [pa.array(c, k) for c, k in zip([[shard] * n, [block] * n, *found], kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


TOTALS = (
    "depth bigint, x1 bigint, x2 bigint, conv_id bigint, n_convs bigint, parent_conv_id bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint"
)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a shard's nodes with what all shards know of them: its part of their totals."""
    names = [c.split()[0] for c in TOTALS.split(", ")]
    for table in runs(batches, ["shard", "block"]):
        cols = {c: table.column(c).to_pylist() for c in table.column_names}
        low, all_low, up = cols["low"], cols["all_low"], cols["up"]
        # idx is in order of the walk, so a child comes after its parent
        saved, leaves, kids = cols["saved"], cols["leaves"], [0] * len(up)
        parents: list[int | None] = [None] * len(up)
        for k in range(len(up) - 1, -1, -1):
            if up[k] >= 0:
                saved[up[k]] += saved[k]
                leaves[up[k]] += leaves[k]
                if low[k] == all_low[k]:
                    kids[up[k]] += 1
                    parents[k] = all_low[up[k]]
            elif not cols["n"][k]:
                saved[k] = leaves[k] = 0  # in the totals of the block before already
        columns = [cols["depth"], cols["x1"], cols["x2"], all_low, cols["all_n"], parents, kids, leaves, saved]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of end lists in order of (node, shard): the digest of each node's whole list."""
    last, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for *key, ends in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ends"))):
            if key != last:
                if last is not None:
                    done.append((*last, digest.hexdigest()))
                last, digest = key, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
        yield _digest_rows(done)
    if last is not None:
        yield _digest_rows([(*last, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*KEY, "ends_sha256"]
    )


def rebuilt_turns(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations, and one row for each of them.

    Turns: shard, conv, pos, f1, f2 (hashes of the turn and its position), size
    (bytes of its text). Conversations: shard, conv, length.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(role, text).alias("k1"),
        F.xxhash64(text, role, F.lit(1)).alias("k2"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    # equal rows are in any order among themselves
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")]
    ranked = rank_rows(turns, order, "place")
    heads = written(
        ranked.groupBy("conv").agg(F.min("place").alias("start"), F.count("*").alias("n")), "trie-heads"
    )
    own = heads.withColumns(
        {"h": F.crc32(F.col("conv").cast("string")) % HEADS, "base": F.col("conv") - F.col("conv") % FAMILY}
    )
    bases = heads.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    known = own.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    known = written(
        known.select(
            (F.expr(f"start div {shard_turns}")).alias("shard"), "conv", "base", "start", "h", "taken",
            length.alias("length"),
        ),
        "trie-conversations",
    )
    placed = ranked.join(known, "conv").withColumn("at", F.col("place") - F.col("start"))
    rest = placed.filter(F.col("at") >= F.col("h")).withColumn("pos", F.col("taken") + F.col("at") - F.col("h"))
    rest = rest.select("shard", "conv", "pos", "k1", "k2", "size")
    early = placed.filter(F.col("at") < HEADS - 1).select(
        F.col("conv").alias("base"), F.col("at").alias("pos"), "k1", "k2", "size"
    )
    taking = known.filter("taken > 0").select("shard", "conv", "base", "taken")
    taken = early.join(taking, "base").filter("pos < taken").select("shard", "conv", "pos", "k1", "k2", "size")
    both = rest.unionByName(taken).select(
        "shard", "conv", "pos",
        F.xxhash64("pos", "k1", "k2").alias("f1"), F.xxhash64("k2", "pos", "k1", F.lit(1)).alias("f2"),
        "size",
    )
    return both, known.select("shard", "conv", "length")


def trie_nodes(
    conversations: DataFrame, shard_turns: int = SHARD_TURNS, block: int = BLOCK
) -> DataFrame:
    """The nodes of the prefix trie of the rebuilt conversations, one row each.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 (SHA-256 of the ids that end there, in order).

    conversations has conv_id, turn, role and text; other columns are not read.
    Null roles and texts count as empty. Turns of one number are in order of the
    hash of role and text; repeated rows are turns of their own. Rows with a null
    conv_id are in no conversation. Texts are hashed whole, whatever their length.
    An empty table has no node.
    """
    both, known = rebuilt_turns(conversations, shard_turns)
    turns = written(both.withColumn("block", F.expr(f"pos div {block}")), "trie-turns")
    # The mark of a conversation in its first block, and in later ones with the
    # hashes of what came before.
    first = known.select(
        "shard", "conv", F.lit(-1).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("f1"),
        F.lit(0).cast("bigint").alias("f2"), F.col("length").alias("size"), F.lit(0).cast("bigint").alias("block"),
    )
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = known.filter(F.col("length") > block)
    parts = (
        turns.join(long.select("conv", "length"), "conv")
        .groupBy("shard", "conv", "block")
        .agg(F.bit_xor("f1").alias("f1"), F.bit_xor("f2").alias("f2"), F.max("length").alias("size"))
    )
    later = parts.select(
        "shard", "conv", (F.col("block") * block - 1).alias("pos"), F.bit_xor("f1").over(before).alias("f1"),
        F.bit_xor("f2").over(before).alias("f2"), "size", "block",
    ).filter("block > 0")
    later = written(later, "trie-later")
    local = (
        turns.unionByName(first).unionByName(later)
        .repartition("shard", "block")
        .sortWithinPartitions("shard", "block", "conv", "pos")
        .select("shard", "block", "conv", "pos", "f1", "f2", "size")
        .mapInArrow(_shards, LOCAL)
    )
    local = written(local, "trie-shards")
    total = (
        local.filter("n > 0")
        .groupBy(*KEY)
        .agg(
            F.min("low").alias("all_low"),
            F.sum("n").alias("all_n"),
            (F.sum("n") == F.sum("n_ends")).cast("bigint").alias("own_leaves"),
        )
    )
    saved = (F.col("all_n") - 1) * F.col("size")
    joined = written(local.drop("ends").join(total, KEY).withColumn("own_saved", saved), "trie-known")
    # What a conversation's own nodes add up to in each later block, and all after it,
    # belongs to the last turn before that block.
    mine = joined.filter((F.col("block") > 0) & (F.col("n") > 0) & (F.col("low") == F.col("all_low")))
    sums = mine.groupBy(F.col("low").alias("conv"), "block").agg(
        F.sum("own_saved").alias("saved"), F.sum("own_leaves").alias("leaves")
    )
    marks = later.select("conv", "block", (F.col("pos") + 1).alias("depth"), F.col("f1").alias("x1"), F.col("f2").alias("x2"))
    onward = Window.partitionBy("conv").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        marks.join(sums, ["conv", "block"], "left")
        .select(*KEY, F.sum("saved").over(onward).alias("saved"), F.sum("leaves").over(onward).alias("leaves"))
        .groupBy(*KEY)
        .agg(F.sum("saved").alias("late_saved"), F.sum("leaves").alias("late_leaves"))
    )
    owner = (F.col("n") > 0) & (F.col("low") == F.col("all_low"))
    late = {
        k: F.when(owner, F.col(f"own_{k}") + F.coalesce(F.col(f"late_{k}"), F.lit(0))).otherwise(F.lit(0))
        for k in ("saved", "leaves")
    }
    summed = (
        joined.join(carried, KEY, "left")
        .withColumns(late)
        .repartition("shard", "block")
        .sortWithinPartitions("shard", "block", "idx")
        .select(
            "shard", "block", "up", *KEY, "low", "n", "all_low", "all_n", "saved", "leaves"
        )
        .mapInArrow(_subtrees, TOTALS)
        .groupBy(*KEY)
        .agg(
            F.max("conv_id").alias("conv_id"),
            F.max("n_convs").alias("n_convs"),
            F.max("parent_conv_id").alias("parent_conv_id"),
            *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
        )
    )
    # Shards are in order of conv_id, so a node's lists follow one another.
    ends = (
        local.filter("ends is not null")
        .select(*KEY, "shard", "ends")
        .repartition(*KEY)
        .sortWithinPartitions(*KEY, "shard")
        .mapInArrow(_end_digests, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")
    )
    return summed.join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
