"""Clusters of similar texts among the members of hash buckets.

In a bucket all members are checked against one leader first, the member that
comes first in an order that all buckets share, so a large group of copies costs
one check for each member. Buckets whose members then lie in several components
are compared in full, in blocks inside tasks: pairs that lie in different
components, look similar by their sizes and digests, and meet in no earlier bucket
are taken as links, and their components are one from there on. So a block puts out a
forest, fewer pairs than it has members, however many of its members are alike. All
pairs that come out are verified on their full sets. Where one fails, what it stood
for is not known: those buckets are compared once more with the full sets at hand, and
only verified links join components there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import discard, written
from loomline.llm.components import connected_components
from loomline.llm.wordhash import U64, shingle_hashes, word_hashes

#: The digest of a set of up to SMALL shingles is 32 bits of each; that of a
#: larger one the least of each of BINS ranges of them, in 16 bits.
SMALL = 256
BINS = 256
#: A pair of larger sets is checked in full unless its digests are so many standard
#: deviations below the limit; a pair at the limit fails this with probability 3e-5.
DEVIATIONS = 4.0
#: Members of a bucket that are compared at a time, by digests and by full sets.
BLOCK = 2048
#: Buckets of up to so many members are compared many at a time, so many pairs at once.
FEW = 32
PAIRS = 20_000
EXACT_BLOCK = 256

NODES = "node bigint, n_shingles bigint, least binary, first binary, second binary"

#: From words and shingles of a text to its band hashes in two collections.
Banding = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def similar(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def word_sets(text: bytes | None, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a text, and its distinct shingles in order."""
    words = word_hashes(text)
    return words, np.unique(shingle_hashes(words, shingle))


def _sketch(heads: np.ndarray) -> np.ndarray:
    """Of sorted 32-bit numbers, 16 bits of the least in each range; 0 where there is none."""
    bins = heads >> np.uint32(24)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    out = np.zeros(BINS, "<u2")
    out[bins[first]] = (heads[first] % np.uint32(0xFFFF)).astype("<u2") + 1
    return out


def digest(shingles: np.ndarray) -> bytes:
    """The digest of a sorted set."""
    heads = (shingles >> U64(32)).astype("<u4")
    return heads.tobytes() if len(heads) <= SMALL else _sketch(heads).tobytes()


def _as_sketch(data: bytes, size: int) -> np.ndarray:
    return _sketch(np.frombuffer(data, "<u4")) if size <= SMALL else np.frombuffer(data, "<u2")


def _similar_sketches(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Of rows of sketches: which pairs may be as similar as percent.

    sizes is the sum of the sizes of a pair's sets. Of their union, at the
    limit, the bins show a part; the smaller the rest, the surer they are.
    """
    used = ((left != 0) | (right != 0)).sum(axis=1)
    equal = ((left == right) & (left != 0)).sum(axis=1)
    limit = percent / 100
    hidden = np.clip(1 - used * (1 + limit) / np.maximum(sizes, 1), 0, 1)
    slack = DEVIATIONS * np.sqrt(limit * (1 - limit) * used * hidden)
    return equal >= limit * used - slack - 1


def promising(
    own: bytes, size: int, others: list[bytes], sizes: np.ndarray, percent: int
) -> np.ndarray:
    """Which others may be as similar to one set as percent, by digests and sizes.

    Two small sets are compared number by number. Shingles that share their 32
    bits can only make sets look more similar than they are.
    """
    out = np.zeros(len(others), bool)
    small = (sizes <= SMALL) & (size <= SMALL)
    for exact in (True, False):
        at = np.flatnonzero(small == exact)
        if not len(at):
            continue
        if exact:
            heads = np.frombuffer(own, "<u4")
            every = np.frombuffer(b"".join([others[k] for k in at]), "<u4")
            place = np.minimum(np.searchsorted(heads, every), len(heads) - 1)
            starts = np.concatenate([[0], np.cumsum(sizes[at])[:-1]])
            common = np.add.reduceat((heads[place] == every).astype(np.int64), starts)
            out[at] = 100 * common >= percent * (size + sizes[at] - common)
        else:
            right = np.stack([_as_sketch(others[k], sizes[k]) for k in at])
            left = np.broadcast_to(_as_sketch(own, size), right.shape)
            out[at] = _similar_sketches(left, right, size + sizes[at], percent)
    return out


def _small_pairs(left: list[bytes], right: list[bytes], sizes: np.ndarray, percent: int) -> np.ndarray:
    """promising() of pairs of small sets, one pair for each place of the lists.

    sizes is the sum of the sizes of a pair's sets.
    """
    heads = np.frombuffer(b"".join(x for pair in zip(left, right) for x in pair), "<u4")
    pair = np.repeat(np.arange(len(left), dtype=U64), sizes)
    every = np.sort((pair << U64(32)) | heads)
    twice = every[1:][every[1:] == every[:-1]] >> U64(32)
    common = np.bincount(twice.astype(np.int64), minlength=len(left))
    return 100 * common >= percent * (sizes - common)


def _promising(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            la, lb = (batch.column(c).to_pylist() for c in ("la", "lb"))
            keep = np.zeros(batch.num_rows, bool)
            small = (na <= SMALL) & (nb <= SMALL)
            at = np.flatnonzero(small)
            if len(at):
                keep[at] = _small_pairs([la[k] for k in at], [lb[k] for k in at], (na + nb)[at], percent)
            for k in np.flatnonzero(~small).tolist():
                keep[k] = promising(la[k], int(na[k]), [lb[k]], nb[k : k + 1], percent)[0]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _set_bytes(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [word_sets(t.as_py(), shingle)[1].astype("<u8").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"]
            )

    return run


def sets_of(texts: DataFrame, shingle: int) -> Callable[[DataFrame], DataFrame]:
    """Full sets of the nodes that are asked for, from a table of node, text."""

    def needed(nodes: DataFrame) -> DataFrame:
        own = texts.join(nodes, "node").select("node", "text")
        return own.mapInArrow(_set_bytes(shingle), "node bigint, shingles binary")

    return needed


def _alike(x: bytes, y: bytes, percent: int) -> bool:
    a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    both = np.concatenate([a, b])
    both.sort()
    return similar(int(np.count_nonzero(both[1:] == both[:-1])), len(a), len(b), percent)


def _checked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
            keep = [_alike(x, y, percent) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _near_sizes(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * percent


class _Bucket:
    """Rows of one bucket, or of two blocks of it, until the next bucket begins."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.parts: list[dict] = []

    def pairs(self) -> Iterator[tuple[int, int]]:
        """The links of a forest over the members; sure ones where there are full sets."""
        digests = [x for p in self.parts for x in p.pop("least")]
        sets = [x for p in self.parts for x in p.pop("shingles", ())]
        rows = {k: np.concatenate([p[k] for p in self.parts]) for k in self.parts[0]}
        self.parts = []
        node, size, block = (rows[k] for k in ("node", "n_shingles", "block"))
        component = np.unique(rows["component"], return_inverse=True)[1]
        first, second = rows["first"], rows["second"]
        i, j = int(rows["i"][0]), int(rows["j"][0])
        across = bool(rows["x"][0] != rows["y"][0])
        for k in range(len(node) - 1):
            after = slice(k + 1, None)
            good = (component[after] != component[k]) & _near_sizes(size[after], size[k], self.percent)
            if across:
                good &= block[after] != block[k]
            # a pair is judged in the first bucket in which it meets
            good &= ~(first[after, :i] == first[k, :i]).any(axis=1)
            good &= ~(second[after, :j] == second[k, :j]).any(axis=1)
            other = np.flatnonzero(good) + k + 1
            if not len(other):
                continue
            near = [digests[x] for x in other]
            for x in other[promising(digests[k], int(size[k]), near, size[other], self.percent)].tolist():
                if component[x] == component[k] or (sets and not _alike(sets[k], sets[x], self.percent)):
                    continue
                component[component == component[x]] = component[k]
                yield min(node[k], node[x]), max(node[k], node[x])


def _links_of_few(rows: dict, starts: np.ndarray, lengths: np.ndarray, percent: int) -> list[tuple[int, int, int]]:
    """key, a, b: what _Bucket finds in each of many buckets of a few small sets."""
    at = np.repeat(starts, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    after = np.repeat(starts + lengths, lengths) - at - 1
    left = np.repeat(at, after)
    right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
    size, block, component = rows["n_shingles"], rows["block"], rows["component"]
    good = (component[left] != component[right]) & _near_sizes(size[left], size[right], percent)
    good &= (rows["x"][left] == rows["y"][left]) | (block[left] != block[right])
    left, right = left[good], right[good]
    for bands, order in (("first", "i"), ("second", "j")):
        own = rows[bands]
        earlier = np.arange(own.shape[1]) < rows[order][left][:, None]
        good = ~((own[left] == own[right]) & earlier).any(axis=1)
        left, right = left[good], right[good]
    out, root, last = [], {}, None

    def top(c: int) -> int:
        while c in root:
            c = root[c]
        return c

    digests, key, node = rows["least"], rows["key"], rows["node"]
    group = np.zeros(len(size), np.int64)
    group[starts] = 1
    group = np.cumsum(group)
    for begin in range(0, len(left), PAIRS):
        a, b = left[begin : begin + PAIRS], right[begin : begin + PAIRS]
        sides = ([digests[k] for k in x.tolist()] for x in (a, b))
        near = _small_pairs(*sides, size[a] + size[b], percent)
        for k, x in zip(a[near].tolist(), b[near].tolist()):
            if group[k] != last:
                root, last = {}, group[k]
            ck, cx = top(int(component[k])), top(int(component[x]))
            if ck != cx:
                root[cx] = ck
                out.append((key[k], min(node[k], node[x]), max(node[k], node[x])))
    return out


def _compared(percent: int):
    """Rows in order of (key, x, y): links a < b of a forest of each such group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = _Bucket(percent), None

        def made(found: list) -> pa.RecordBatch:
            columns = list(zip(*found)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "a", "b"])

        def out() -> pa.RecordBatch:
            return made([(last[0], a, b) for a, b in held.pairs()])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {
                c: batch.column(c).to_numpy()
                for c in ("key", "x", "y", "block", "node", "component", "n_shingles", "i", "j")
            }
            n = batch.num_rows
            for c in ("least", "shingles"):
                if c in batch.schema.names:
                    rows[c] = batch.column(c).to_pylist()
            for c in ("first", "second"):
                rows[c] = np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i8").reshape(n, -1)
            group = np.stack([rows["key"], rows["x"], rows["y"]])
            cuts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            starts = np.append(0, cuts)
            lengths = np.diff(np.append(starts, n))
            few = (lengths <= FEW) & (np.maximum.reduceat(rows["n_shingles"], starts) <= SMALL)
            # the first and the last may go on in other batches
            few[0] = few[-1] = False
            few &= "shingles" not in rows
            if few.any():
                yield made(_links_of_few(rows, starts[few], lengths[few], percent))
            for start, end in zip(starts[~few].tolist(), (starts + lengths)[~few].tolist()):
                own = tuple(group[:, start].tolist())
                if own != last and held.parts:
                    yield out()
                last = own  # the group that is held now
                held.parts.append({c: v[start:end] for c, v in rows.items() if c != "key"})
        if held.parts:
            yield out()

    return run


def _linked(likely: DataFrame, sets_of_nodes: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Those of pairs (a, b) whose full sets are similar, written."""
    needed = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = written(sets_of_nodes(needed), "near-sets")
    full = likely.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    full = full.select("a", "b", "sa", "sb").mapInArrow(_checked(percent), "a bigint, b bigint")
    links = written(full, "near-links")
    discard(sets)
    return links


def sketched(texts: DataFrame, shingle: int, banding: Banding) -> DataFrame:
    """node, n_shingles, digest and band hashes of a table of node, text."""
    return texts.select("node", "text").mapInArrow(_sketches(shingle, banding), NODES)


def _sketches(shingle: int, banding: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, first, second = [], [], [], []
            for text in batch.column("text"):
                words, shingles = word_sets(text.as_py(), shingle)
                sizes.append(len(shingles))
                digests.append(digest(shingles))
                for column, bands in zip((first, second), banding(words, shingles)):
                    column.append(bands.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array(sizes, pa.int64()),
                    *[pa.array(c, pa.binary()) for c in (digests, first, second)],
                ],
                names=["node", "n_shingles", "least", "first", "second"],
            )

    return run


def _led(buckets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Promising pairs of the first member of each bucket with its others."""
    # The order is the same in all buckets, so a group of copies has few leaders.
    # No two nodes have one xxhash64: it is one-to-one on numbers of 64 bits.
    leads = buckets.groupBy("key").agg(F.min_by("node", F.xxhash64("node")).alias("lead"))
    pairs = (
        buckets.join(leads, "key")
        .filter(F.col("node") != F.col("lead"))
        .select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
        .distinct()
    )
    side = lambda n: nodes.select(
        F.col("node").alias(n), F.col("least").alias(f"l{n}"), F.col("n_shingles").alias(f"n{n}")
    )
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return sized.filter(near).mapInArrow(_promising(percent), "a bigint, b bigint")


def open_links(
    buckets: DataFrame, nodes: DataFrame, labels: DataFrame | None, percent: int, block: int, least: int = 3
) -> DataFrame:
    """key, a, b: a forest of promising pairs across components, in buckets of at least
    so many members that lie in several; sure links where nodes have their full sets. Written."""
    rows = buckets
    if labels is None:
        rows = rows.withColumn("component", F.col("node"))
    else:
        rows = rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    state = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    state = state.filter((F.col("low") != F.col("high")) & (F.col("n") >= least)).select("key", "n")
    open_ = rows.join(state, "key").withColumn("blocks", F.ceil(F.col("n") / block))
    open_ = open_.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # written before digests are dealt out: by then the shuffles of the buckets are gone
    members = written(open_.drop("n"), "near-open")
    # each pair of blocks of a bucket is a group of its own
    open_ = members.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    open_ = open_.withColumn("x", F.least("block", "with")).withColumn("y", F.greatest("block", "with"))
    known = ["n_shingles", "least", "first", "second", *(["shingles"] if "shingles" in nodes.columns else [])]
    dealt = (
        open_.join(nodes, "node")
        .select("key", "x", "y", "block", "node", "component", "i", "j", *known)
        .repartition("key", "x", "y")
        .sortWithinPartitions("key", "x", "y", "node")
    )
    pairs = written(dealt.mapInArrow(_compared(percent), "key bigint, a bigint, b bigint"), "near-pairs")
    discard(members)
    return pairs


def similar_components(
    buckets: DataFrame, nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int
) -> DataFrame | None:
    """node, component over all links among the members of each bucket; None without links.

    buckets has key, node, and i and j, the bands of the two collections that
    make the key; nodes has a row for each node, as sketched() makes them, in a written
    table; sets gives node and shingles, its full sorted set in bytes, of the nodes it is
    asked for. A link is a pair in one bucket whose sets have a Jaccard similarity of
    percent or more.
    """
    likely = written(_led(buckets, nodes, percent), "near-pairs")
    links = _linked(likely, sets, percent)
    discard(likely)
    labels = None if links.isEmpty() else connected_components(links)
    # two members of a bucket were compared already, when one led the other
    taken = open_links(buckets, nodes, labels, percent, BLOCK)
    fresh = _linked(taken.select("a", "b").distinct(), sets, percent)
    wrong = written(taken.join(fresh, ["a", "b"], "left_anti").select("key").distinct(), "near-again")
    if not fresh.isEmpty():
        links = links.union(fresh)
        labels = connected_components(links)
    if not wrong.isEmpty():
        again = written(buckets.join(wrong, "key"), "near-buckets")
        members = again.select("node").distinct()
        full = nodes.join(sets(members), "node")
        sure = open_links(again, full, labels, percent, EXACT_BLOCK).select("a", "b")
        if not sure.isEmpty():
            labels = connected_components(links.union(sure))
    return labels
