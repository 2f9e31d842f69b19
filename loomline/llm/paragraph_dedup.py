"""Substring dedup by paragraph MinHash banding.

A paragraph is a run of WORDS words that begins at a word chosen by the text itself:
of every SPREAD places that follow one another the one whose five-word shingle has the
least hash is chosen. So a passage has the same paragraphs wherever it stands, on a line
of its own, inside a longer one or wrapped over several: line ends do not count, and a
run of WORDS + SPREAD - 1 words that occurs twice has a paragraph in common for sure. A
text's first and last WORDS words are paragraphs too.

Equal paragraphs are one node, and nodes meet in the bands of a one-permutation MinHash:
the hashes of a set of shingles fall into BANDS parts, and a band is the hash of all that
fall into one of them. With its bands goes a sketch of the set, BITS bits of which each
shingle turns one over: sets that differ in k shingles have sketches that differ in k bits at
most, so where nodes meet those too far apart are told at once, and what is left of a band is
a forest of links. Links are verified by the exact Jaccard similarity of the shingle sets and
clustered by connected components; where one fails, what it stood for is not known, and the
members of its tree are all compared by their sets. In each cluster the paragraphs of the
document that comes first in the corpus stay; the words of all others are removed from their
documents, as spans of bytes. What a document repeats of itself only, such as a junk text of
one word, is left to the quality rules.

Two sets of at most 24 shingles with a similarity of 0.8 differ in at most 5 shingles: one
of 6 parts holds none of these and is the same in both, so they meet, wherever in the
paragraphs the difference is. Only a part without a shingle makes no band: sets that have
one go into TABLES tables of parts, each by hashes of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.clusters import EXACT_BLOCK, NODES, open_links
from loomline.llm.common import discard, freed_shuffles, short_batches, written
from loomline.llm.components import connected_components, contracted
from loomline.llm.wordhash import U64, hashes_at, mix, powers, shingle_hashes, sliding_least, word_bounds

SHINGLE = 5
PERCENT = 80
#: Parts of the hashes in each table.
BANDS = 6
TABLES = 3
#: Words of a paragraph, and places of which one begins a paragraph.
WORDS = 28
SPREAD = 23
#: Blocks of band hashes that are held against each other, of 1 / GROUPS of all hashes, 2 ** 11, and
#: paragraphs whose bands are made at a time.
GROUPS = 2048
AT_ONCE = 25_000
#: Rows that go to Python at a time, and bytes of short texts that are hashed at a time.
BATCH = 1_000
PIECE = 60_000
#: Bits of a sketch, members of a band that are held against each other by whole sketches, not
#: by parts of them, and pairs that are at a time.
BITS = 58
WHOLE = 128
PAIRS = 1 << 19
_GENERATOR = np.random.Generator(np.random.PCG64(1))
XORS = _GENERATOR.integers(0, 2**63, TABLES, dtype=U64)
ORDER = U64(0xA24BAED4963EE407)
LOW = U64((1 << 20) - 1)


def beginnings(shingles: np.ndarray, n_words: int) -> np.ndarray:
    """Places of the words that begin a paragraph, in order."""
    return _beginnings(shingles, np.zeros(1, np.int64), np.array([n_words]))[0]


def _beginnings(shingles: np.ndarray, first: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of texts whose words follow one another, each from a first one on: places among
    all words, and the text of each."""
    last = n_words - WORDS
    text = np.repeat(np.arange(len(first)), n_words)
    long = last >= 0
    found = [first[long], (first + last)[long]]
    if len(shingles) >= SPREAD:
        # The place in the low bits: of equal hashes the last one is chosen, so that a
        # repeated word begins few paragraphs.
        own = text[: len(shingles)]
        places = np.arange(len(shingles)) - first[own]
        marked = (mix(shingles ^ ORDER) & ~LOW) | (LOW - (places.view(U64) & LOW))
        own = own[: len(own) - SPREAD + 1]
        runs = places[: len(own)].view(U64)
        chosen = (runs + ((LOW - (sliding_least(marked, SPREAD) & LOW) - runs) & LOW)).astype(np.int64)
        # runs of one text only
        good = (places[: len(own)] <= (n_words - SHINGLE + 1 - SPREAD)[own]) & (chosen <= last[own])
        found.append((first[own] + chosen)[good])
    every = np.unique(np.concatenate(found))
    return every, text[every]


def word_and_shingle_hashes(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text or b"", np.uint8)
    words = hashes_at(data, word_bounds(data)[0])
    return words, shingle_hashes(words, SHINGLE)


def _hashed(texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts that follow one another, hashed together: the place of the first one in the list,
    the words and shingles of all, the first word of each and how many it has. Shingles that
    lie across two texts are in none."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or b"") < PIECE):
            size += len(texts[end] or b"") + 1
            end += 1
        data = np.frombuffer(b" ".join(x or b"" for x in texts[at:end]), np.uint8)
        starts = word_bounds(data)[0]
        sizes = np.array([len(x or b"") + 1 for x in texts[at:end]])
        first = np.searchsorted(starts, np.cumsum(sizes) - sizes)
        words = hashes_at(data, starts)
        yield at, words, shingle_hashes(words, SHINGLE), first, np.diff(np.append(first, len(words)))
        at = end


def _paragraph_hash(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    up, down = powers(len(words))
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[places + WORDS] - sums[places]) * down[places]).view(np.int64)


def paragraph_hashes(words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two signed 64-bit hashes of each of the paragraphs at some places."""
    return _paragraph_hash(words, places), _paragraph_hash(mix(words ^ ORDER), places)


def bands(sets: np.ndarray) -> np.ndarray:
    """The band hashes of the sets in sorted rows, BANDS for each table; 0 for none."""
    out = np.zeros((len(sets), TABLES * BANDS), U64)
    for at in range(0, len(sets), 4096):
        rows = np.arange(at, min(at + 4096, len(sets)))
        columns = np.ascontiguousarray(sets[rows].T)
        # a repeated number counts once
        values = columns.copy()
        values[1:][columns[1:] == columns[:-1]] = 0
        for table in range(TABLES):
            part = (mix(columns ^ XORS[table]) if table else columns) >> U64(32)
            part = (part * U64(BANDS) >> U64(32)).astype(np.uint8)
            empty = np.zeros(len(rows), bool)
            for k in range(BANDS):
                inside = part == k
                total = (values * inside).sum(axis=0, dtype=U64)
                none = ~inside.any(axis=0)
                out[rows, table * BANDS + k] = np.where(none, U64(0), mix(total + U64(table * BANDS + k)))
                empty |= none
            rows, columns, values = rows[empty], columns[:, empty], values[:, empty]
    return out


def _table(columns: list, names: str) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in names.split(", ")])


_SET = WORDS - SHINGLE + 1


def sketches(sets: np.ndarray) -> np.ndarray:
    """Of sets in sorted rows: the sketch in BITS bits, above them the size in the 6 low bits."""
    fresh = np.ones(sets.shape, bool)
    fresh[:, 1:] = sets[:, 1:] != sets[:, :-1]
    # not of the bits that tell the parts
    place = (sets & U64(2**32 - 1)) * U64(BITS) >> U64(32)
    out = np.bitwise_xor.reduce(np.where(fresh, U64(1) << place, U64(0)), axis=1)
    return out << U64(6) | fresh.sum(axis=1).astype(U64)


def _near(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches may be of sets as similar as percent: all that are, and few more."""
    apart = np.bitwise_count((a ^ b) >> U64(6)).astype(np.int64)
    size, other = ((x & U64(63)).astype(np.int64) for x in (a, b))
    near = np.minimum(size, other) * 100 >= np.maximum(size, other) * percent
    return near & (apart * (100 + percent) <= (size + other) * (100 - percent))


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets in sorted rows are as similar as percent."""
    distinct = lambda x: 1 + (x[:, 1:] != x[:, :-1]).sum(axis=1)
    either = distinct(np.sort(np.concatenate([a, b], axis=1), axis=1))
    return 100 * (distinct(a) + distinct(b) - either) >= percent * either


def _runs(*sorted_columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and lengths of the runs of equal rows."""
    n = len(sorted_columns[0])
    changes = np.zeros(max(n - 1, 0), bool)
    for column in sorted_columns:
        changes |= column[1:] != column[:-1]
    starts = np.flatnonzero(np.append(True, changes)) if n else np.empty(0, np.int64)
    return starts, np.diff(np.append(starts, n))


class _Forest:
    """Links of a spanning forest over numbers, of the pairs that are added."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self._links = [(np.empty(0, np.int64), np.empty(0, np.int64))]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate(x) for x in zip(*self._links))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        up = False
        while True:
            la, lb = self.label[a], self.label[b]
            far = la != lb
            if not far.any():
                return
            a, b, la, lb = a[far], b[far], la[far], lb[far]
            # each tree takes one link to a tree of a lower label, next time of a higher one
            low, high = np.minimum(la, lb), np.maximum(la, lb)
            child, parent = (low, high) if up else (high, low)
            child, at = np.unique(child, return_index=True)
            self._links.append((a[at], b[at]))
            root = np.arange(len(self.label))
            root[child] = parent[at]
            while (root[root] != root).any():
                root = root[root]
            self.label, up = root[self.label], not up


def _groupings(group: np.ndarray, sketch: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of rows in an order, and runs of them, so that near ones are in a run together:
    groups of up to WHOLE rows, and of larger ones those with a part of the sketch in common."""
    starts, lengths = _runs(group)
    whole = np.repeat(lengths <= WHOLE, lengths)
    order = np.flatnonzero(whole)
    yield order, *_runs(group[order])
    # Sketches of near sets differ in at most as many bits as their sizes let them, so of one
    # part more than that one is the same. Small sets go apart: they fill few bits.
    size = (sketch & U64(63)).astype(np.int64)
    most = 2 * _SET * (100 - percent) // (100 + percent)
    for k in range(most + 1):
        last = (k + 1) * 100 > _SET * (100 - percent)
        own = ~whole & (size * (100 - percent) >= k * percent)
        if not last:
            own &= size * (100 - percent) < (k + 1) * 100
        rows = np.flatnonzero(own)
        parts = most + 1 if last else k + 1
        edges = np.arange(parts + 1) * BITS // parts + 6
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            value = sketch[rows] >> U64(low) & U64((1 << (high - low)) - 1)
            order = np.lexsort((value, group[rows]))
            yield rows[order], *_runs(group[rows][order], value[order])
        if last:
            break


def near_links(group: np.ndarray, sketch: np.ndarray, percent: int, sets: np.ndarray | None = None) -> _Forest:
    """A forest over rows in order of group: trees are what near pairs of one group connect; with
    their sets in sorted rows, what similar ones do."""
    forest = _Forest(len(group))
    if not len(group):
        return forest

    def add(a: np.ndarray, b: np.ndarray) -> None:
        good = _near(sketch[a], sketch[b], percent)
        a, b = a[good], b[good]
        if sets is not None:
            good = _similar(sets[a], sets[b], percent)
            a, b = a[good], b[good]
        forest.add(a, b)

    ways = list(_groupings(group, sketch, percent))
    for order, starts, lengths in ways:
        # the first of each run with the others: most copies are one tree from here on
        first = np.repeat(order[starts], lengths)
        others = first != order
        add(first[others], order[others])
    for order, starts, lengths in ways:
        # runs of two are done
        many = np.repeat(lengths > 2, lengths)
        run = np.repeat(np.arange(len(starts)), lengths)[many]
        order = order[many]
        order = order[np.lexsort((forest.label[order], run))]
        # each row with those of its run that come after its tree
        ends = np.cumsum(lengths[lengths > 2])
        run = np.repeat(ends, lengths[lengths > 2])
        begins, sizes = _runs(run, forest.label[order])
        after = np.repeat(begins + sizes, sizes)
        pairs = np.cumsum(run - after)
        at = 0
        while at < len(order):
            done = pairs[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(pairs, done + PAIRS, "right")))
            n = (run - after)[at:end]
            left = np.repeat(np.arange(at, end), n)
            right = after[left] + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
            add(order[left], order[right])
            at = end
    return forest


#: A row for each band of each node of a text: 27 bits of the band's hash and its number, the
#: sketch, with SEVERAL if its set has others, the node and the set. In parts from GROUPS on a
#: row for each link of two nodes of a set, the other one where bands have the sketch.
ROW = np.dtype([("key", "<u4"), ("sketch", "<u8"), ("node", "<i8"), ("set", "<u4")])
SEVERAL = U64(32)
KEYS = "part int, rows binary"


def _keys(percent: int):
    """The bands of all paragraphs, in a row for each group of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0
        for batch in batches:
            d, t = (batch.column(c).to_numpy().view(U64) for c in ("d", "t"))
            own = mix(d) + t
            for at, words, shingles, first, n_words in _hashed(batch.column("text").to_pylist()):
                places, text = _beginnings(shingles, first, n_words)
                if not len(places):
                    continue
                sets = np.lib.stride_tricks.sliding_window_view(shingles, _SET)[places]
                held.append((sets, _paragraph_hash(words, places), own[at + text]))
                n += len(places)
                if n >= AT_ONCE:
                    yield _grouped(*map(np.concatenate, zip(*held)), percent)
                    held, n = [], 0
        if n:
            yield _grouped(*map(np.concatenate, zip(*held)), percent)

    return run


def _grouped(sets: np.ndarray, nodes: np.ndarray, texts: np.ndarray, percent: int) -> pa.RecordBatch:
    # equal paragraphs of one text are one
    order = np.lexsort((nodes, texts))
    order = order[_runs(nodes[order], texts[order])[0]]
    nodes, texts = nodes[order], texts[order]
    node, first, at = np.unique(nodes, return_index=True, return_inverse=True)
    every = np.sort(sets[order[first]], axis=1)
    made, sketch = bands(every)[at], sketches(every)[at]
    row, i = np.nonzero(made)
    keys = made[row, i]
    label, a, b = _own_links(row, mix(keys + texts[row]), sketch, every, at, percent)
    several = (np.bincount(label, minlength=len(nodes)) > 1)[label]
    set_ = mix(texts + mix(nodes[label].view(U64))) >> U64(32)
    out = np.empty(len(row) + len(a), ROW)
    bands_, links = out[: len(row)], out[len(row) :]
    bands_["key"] = (keys & U64(2**27 - 1)) << U64(5) | i.astype(U64)
    bands_["sketch"] = (sketch | several * SEVERAL)[row]
    bands_["node"], bands_["set"] = nodes[row], set_[row]
    links["key"], links["sketch"], links["node"], links["set"] = 0, nodes[b].view(U64), nodes[a], set_[a]
    part = np.append(keys >> U64(53), GROUPS + (set_[a] >> U64(21))).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    out = out[order]
    starts, _ = _runs(part[order])
    cuts = np.append(starts, len(order)).astype(np.int32) * ROW.itemsize
    rows = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(out)])
    return pa.RecordBatch.from_arrays([pa.array(part[order][starts].astype(np.int32)), rows], names=["part", "rows"])


def _own_links(
    row: np.ndarray, own: np.ndarray, sketch: np.ndarray, every: np.ndarray, at: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets of paragraphs, as labels: near ones of one text; and links of a forest over what is
    similar in each. row is the paragraph of each band, own tells band and text, every[at] are
    their shingles."""
    order = np.argsort(own)
    order = order[_with_company(own[order])]
    row, own = row[order], own[order]
    forest = _Forest(len(at))
    forest.add(*(row[x] for x in near_links(own, sketch[row], percent).links()))
    label, (a, b) = forest.label, forest.links()
    wrong = np.zeros(len(at), bool)
    wrong[label[a[~_similar(every[at[a]], every[at[b]], percent)]]] = True
    if wrong.any():
        # what a link stood for that fails is not known: all of its tree once more
        right, again = ~wrong[label[a]], wrong[label[row]]
        row, own = row[again], own[again]
        forest = _Forest(len(at))
        forest.add(a[right], b[right])
        forest.add(*(row[x] for x in near_links(own, sketch[row], percent, every[at[row]]).links()))
        a, b = forest.links()
    return label, a, b


def _with_company(key: np.ndarray) -> np.ndarray:
    """Which of sorted numbers another one is equal to."""
    same = key[1:] == key[:-1]
    return np.append(False, same) | np.append(same, False) if len(key) else np.empty(0, bool)


#: What a row of MET is: a link of nodes in a band of several sets; a node whose band has no
#: near one, only other sets; a set that meets others; a link of nodes of one set.
ACROSS, EQUAL, MEETING, OWN = range(4)
MET = "kind int, key bigint, node bigint, other bigint, set bigint"


def _met(percent: int):
    """Of rows in order of part: the nodes and sets that meet in a band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        last = None
        for batch in batches:
            for part, rows in zip(*(batch.column(c).to_pylist() for c in ("part", "rows"))):
                if part != last and held:
                    yield _of_group(last, held, percent)
                    held = []
                last = part
                held.append(rows)
        if held:
            yield _of_group(last, held, percent)

    return run


def _of_group(part: int, rows: list[bytes], percent: int) -> pa.RecordBatch:
    table = np.frombuffer(b"".join(rows), ROW)
    if part >= GROUPS:
        node, other, set_ = table["node"], table["sketch"].view(np.int64), table["set"].astype(np.int64)
        # apart from the keys of bands, and in band 0
        return _table([np.full(len(table), OWN, np.int32), -32 * (set_ + 1), node, other, set_], MET)
    order = np.argsort(table["key"])
    order = order[_with_company(table["key"][order])]
    key, sketch, node, set_ = (table[c][order] for c in ("key", "sketch", "node", "set"))
    several = (sketch & SEVERAL) > 0
    sketch = sketch & ~SEVERAL
    # rows of one node in one band are one member; of two nodes of one hash each is one
    order = np.lexsort((sketch, node, key))
    key, sketch, node, set_, several = (x[order] for x in (key, sketch, node, set_, several))
    starts, lengths = _runs(key, node, sketch)
    member_key, member = key[starts], node[starts]
    forest = near_links(member_key, sketch[starts], percent)
    label = forest.label
    low, high = np.full(len(starts), 2**32, np.int64), np.full(len(starts), -1, np.int64)
    tree = np.repeat(label, lengths)  # of each row
    np.minimum.at(low, tree, set_)
    np.maximum.at(high, tree, set_)
    across, alone = (low != high)[label], (np.bincount(label, minlength=len(label)) == 1)[label]
    a, b = forest.links()
    # a tree of one set is among its own links
    a, b = a[across[a]], b[across[a]]
    # of one key the trees are told by numbers; those that share one are taken as one
    number = label - np.repeat(*_runs(member_key))
    whole = (number & 0xFFFFF) << 43 | np.int64(part) << 32 | member_key.astype(np.int64)
    none = np.int64(0)
    out = [
        (ACROSS, whole[a], member[a], member[b], none),
        (EQUAL, none, np.unique(member[across & alone]), none, none),
        (MEETING, none, none, none, np.unique(set_[(low != high)[tree] & several])),
    ]
    columns = [np.concatenate(c) for c in zip(*(np.broadcast_arrays(*(np.atleast_1d(x) for x in row)) for row in out))]
    columns = [columns[0].astype(np.int32), *[c.astype(np.int64) for c in columns[1:]]]
    return _table(columns, MET)


PARAGRAPHS = "d bigint, t bigint, place bigint, h1 bigint, h2 bigint"


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paragraphs of each text, and the hashes of each."""
    for batch in batches:
        out = [[np.empty(0, np.int64)] for _ in range(5)]
        d, t = (batch.column(c).to_numpy() for c in ("d", "t"))
        for at, words, shingles, first, n_words in _hashed(batch.column("text").to_pylist()):
            places, text = _beginnings(shingles, first, n_words)
            hashes = paragraph_hashes(words, places)
            for column, value in zip(out, (d[at + text], t[at + text], places - first[text], *hashes)):
                column.append(value)
        yield _table([np.concatenate(c) for c in out], PARAGRAPHS)


SETS = "node bigint, shingles binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts with places and nodes: the shingles of each paragraph, in the order of their hashes."""
    for batch in batches:
        sets = [np.empty((0, _SET), U64)]
        found = batch.column("found")
        place, node = (found.flatten().field(c).to_numpy() for c in ("place", "node"))
        counts = found.value_lengths().to_numpy()
        ends = np.cumsum(counts)
        for at, _, shingles, first, n_words in _hashed(batch.column("text").to_pylist()):
            own = slice(ends[at] - counts[at], ends[at + len(first) - 1])
            places = place[own] + np.repeat(first, counts[at : at + len(first)])
            if len(places):
                sets.append(np.lib.stride_tricks.sliding_window_view(shingles, _SET)[places])
        every = np.sort(np.concatenate(sets), axis=1).astype("<u8")
        fixed = pa.Array.from_buffers(pa.binary(8 * _SET), len(every), [None, pa.py_buffer(every.tobytes())])
        yield _table([node, fixed.cast(pa.binary())], SETS)


def _matrix(batch: pa.RecordBatch, column: str = "shingles") -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), "<u8").reshape(-1, _SET)


def _alike(percent: int):
    """Of links with the sets of both ends: those that are as similar as percent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = _similar(_matrix(batch, "sa"), _matrix(batch, "sb"), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _distinct(sets: np.ndarray, kind: str) -> tuple[np.ndarray, list[bytes]]:
    """Sizes of the sets in sorted rows, and the rows as bytes, repeated numbers once."""
    fresh = sets[:, 1:] != sets[:, :-1]
    size = 1 + fresh.sum(axis=1)
    shown = sets if kind == "<u8" else sets >> U64(32)
    width = np.dtype(kind).itemsize * _SET
    data = np.ascontiguousarray(shown.astype(kind)).tobytes()
    rows = [data[k : k + width] for k in range(0, len(data), width)]
    for k in np.flatnonzero(size < _SET).tolist():
        rows[k] = shown[k][np.append(True, fresh[k])].astype(kind).tobytes()
    return size, rows


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes, digests and bands of the nodes of sets, as sketched() has them, and the full sets."""
    for batch in batches:
        sets = _matrix(batch)
        size, least = _distinct(sets, "<u4")
        # of the first table: two that meet in a later one too are compared there again
        first = bands(sets)[:, :BANDS]
        # where there is no band, a number that no other node has
        own = batch.column("node").to_numpy().view(U64)[:, None] * U64(32) + np.arange(first.shape[1], dtype=U64)
        first = np.where(first == 0, mix(own), first).astype("<u8")
        width = pa.binary(8 * first.shape[1])
        rows = pa.Array.from_buffers(width, len(first), [None, pa.py_buffer(first.tobytes())])
        second = pa.array([bytes(8)] * len(first), pa.binary())
        full = pa.array(_distinct(sets, "<u8")[1], pa.binary())
        columns = [batch.column("node"), size, pa.array(least, pa.binary()), rows.cast(pa.binary()), second, full]
        yield _table(columns, NODES + ", shingles binary")


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of key: those whose key another row has too."""
    held, company = None, False  # the last row, and whether the one before it has its key
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        before = np.append(held is not None and held.column("key")[0].as_py() == key[0], key[1:] == key[:-1])
        if held is not None and (company or before[0]):
            yield held
        after = before[1:]
        yield batch.slice(0, batch.num_rows - 1).filter(pa.array(before[:-1] | after))
        held, company = batch.slice(batch.num_rows - 1), bool(before[-1])
    if held is not None and company:
        yield held


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string())
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")
    for batch in batches:
        out: list[list] = [[] for _ in kinds]
        for data, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            data = data or b""
            spans = removed_spans(data, sorted(gone or ()))
            edges = [0, *(x for span in spans for x in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            row = (len(data), len(data) - len(kept), len(spans), spans, hashlib.sha256(kept).hexdigest())
            for column, value in zip(out, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(out, kinds)]], names=list(names)
        )


def removed_spans(data: bytes, places: list[int]) -> list[list[int]]:
    """Byte spans of the paragraphs at some places, with the blanks after their last word."""
    if not places:
        return []
    starts, _ = word_bounds(np.frombuffer(data, np.uint8))
    edges = np.append(starts, len(data))
    runs: list[list[int]] = []
    for place in places:
        if runs and place <= runs[-1][1]:
            runs[-1][1] = place + WORDS
        else:
            runs.append([place, place + WORDS])
    return [[int(edges[a]), int(edges[b])] for a, b in runs]


def meeting_paragraphs(texts: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Of a table of d, t and text: key, node and other, links both ways between paragraphs that
    meet in a band and may be as similar as percent; and node of those and of the ones that meet
    their equals only. node is a paragraph's first hash. The links of a key are a forest, and
    what is similar of a band is in one key. A node may stand in the second table several times.

    Paragraphs of one text that meet so, as neighbours do that overlap, are a set. Sets that meet
    no other set are left out whole: their clusters are in one document.
    """
    keys = texts.select("d", "t", "text").mapInArrow(_keys(percent), KEYS)
    met = keys.repartition("part").sortWithinPartitions("part").mapInArrow(_met(percent), MET)
    met = written(met, "paragraphs-met")
    meeting = met.filter(F.col("kind") == MEETING).select("set").distinct()
    own = met.filter(F.col("kind") == OWN).join(meeting.hint("shuffle_hash"), "set", "left_semi")
    own = written(own.select("key", "node", "other"), "paragraphs-own")
    links = met.filter(F.col("kind") == ACROSS).select("key", "node", "other").union(own)
    buckets = links.union(links.select("key", "other", "node"))
    return buckets, buckets.select("node").union(met.filter(F.col("kind") == EQUAL).select("node"))


def repeated_paragraphs(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """d, t, place, h1, h2 of the paragraphs whose first hash is one of nodes, of a table of
    d, t (which tell texts apart) and text."""
    every = rows.mapInArrow(_paragraphs, PARAGRAPHS)
    own = nodes.select(F.col("node").alias("h1")).distinct()
    return written(every.join(own.hint("shuffle_hash"), "h1").select("d", "t", "place", "h1", "h2"), "paragraphs")


def paragraph_classes(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """h1 and h2 of the different paragraphs, and d, t, place of one text that has it; and h1,
    h2, other of those whose first hash another one has: all but one of these get other as
    their node, not the first hash."""
    # columns of one row: they are taken together
    equal = found.groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in ("d", "t", "place")])
    equal = written(equal, "paragraph-classes")
    clashes = equal.groupBy("h1").agg(F.min("h2").alias("low"), F.max("h2").alias("high")).filter("low < high")
    others = equal.join(F.broadcast(clashes), "h1").filter("h2 <> low")
    others = written(others.select("h1", "h2", F.xxhash64("h1", "h2").alias("other")), "paragraph-others")
    return equal, others


def paragraph_sets(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """node and shingles of paragraphs, each made from the text it is said to be in."""
    made = classes.groupBy("d", "t").agg(F.collect_list(F.struct("place", "node")).alias("found"))
    joined = texts.select("d", "t", "text").join(made.hint("shuffle_hash"), ["d", "t"])
    if not texts.groupBy("d").count().filter("count > 1").isEmpty():
        # rows with one id and one text: each paragraph once
        joined = joined.dropDuplicates(["d", "t"])
    return written(joined.select("found", "text").mapInArrow(_sets, SETS), "paragraph-sets")


def similar_paragraphs(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """node, component over all pairs of one key as similar as percent; None without any.

    buckets has key, node and other, the links of a forest over what is near in each key, both
    ways; sets has node and shingles, in a written table.
    """
    taken = buckets.filter("node < other").select("key", F.col("node").alias("a"), F.col("other").alias("b"))
    side = lambda n: sets.select(F.col("node").alias(n), F.col("shingles").alias(f"s{n}"))
    both = taken.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    links = written(both.select("a", "b", "sa", "sb").mapInArrow(_alike(percent), "a bigint, b bigint"), "paragraph-links")
    labels = None if links.isEmpty() else connected_components(contracted(links))
    wrong = written(taken.join(links, ["a", "b"], "left_anti").select("key").distinct(), "paragraphs-again")
    if not wrong.isEmpty():
        again = written(buckets.join(wrong, "key").select("key", "node").distinct(), "paragraph-buckets")
        full = sets.join(again.select("node").distinct(), "node").select("node", "shingles")
        full = full.mapInArrow(_nodes, NODES + ", shingles binary")
        # a key ends with its band
        again = again.withColumn("i", F.col("key").bitwiseAND(31).cast("int")).withColumn("j", F.lit(0))
        sure = open_links(again, full, labels, percent, EXACT_BLOCK).select("a", "b")
        if not sure.isEmpty():
            known = labels.select(F.col("node").alias("a"), F.col("component").alias("b")) if labels is not None else links
            labels = connected_components(contracted(written(known.union(sure), "paragraph-links")))
        discard(again)
    discard(links)
    discard(wrong)
    return labels


def without_repeated_paragraphs(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256: a row for each row of docs.

    spans are the removed bytes, from and to. Documents are in order of doc_id, null
    first, then of their text's hash; of a cluster of similar paragraphs those of the first
    document stay. Words are compared with A-Z as a-z; blanks are not compared. Rows with one doc_id and one text are one document
    and have the same result. Null and empty texts and texts of fewer than WORDS words
    lose nothing. Texts of any length are read whole. An empty table gives no rows.
    """
    with freed_shuffles(docs.sparkSession), short_batches(docs.sparkSession, BATCH):
        return _without_repeated(docs, percent)


def _without_repeated(docs: DataFrame, percent: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("d"),
        F.xxhash64(text).alias("t"),
        text.cast("binary").alias("text"),
    )
    buckets, nodes = meeting_paragraphs(rows, percent)
    found = repeated_paragraphs(rows.select("d", "t", "text"), nodes)
    classes, others = paragraph_classes(found)
    if not others.isEmpty():
        # what is linked with a hash may be with each that has it, and these with each other
        for end in ("node", "other"):
            more = buckets.join(others.select(F.col("h1").alias(end), F.col("other").alias("as")), end)
            buckets = buckets.union(more.withColumn(end, F.col("as")).select("key", "node", "other"))
        # in band 0
        both = others.select(F.col("h1").bitwiseAND(-32).alias("key"), F.col("h1").alias("node"), "other")
        buckets = buckets.union(both).union(both.select("key", "other", "node"))
    own = lambda table: table.join(F.broadcast(others), ["h1", "h2"], "left").withColumn(
        "node", F.coalesce("other", "h1")
    )
    compared = own(classes).join(buckets.select("node").distinct(), "node", "left_semi")
    sets = paragraph_sets(compared, rows)
    discard(classes)
    labels = similar_paragraphs(buckets, sets, percent)
    clustered = own(found)
    if labels is not None:
        clustered = clustered.join(labels, "node", "left").withColumn("cluster", F.coalesce("component", "node"))
    else:
        clustered = clustered.withColumn("cluster", F.col("node"))
    clustered = written(clustered.select("d", "t", "place", "cluster").distinct(), "clusters")
    for table in (buckets, sets, found):
        discard(table)
    document = F.struct("d", "t")
    firsts = clustered.groupBy("cluster").agg(F.min(document).alias("first"), F.max(document).alias("last"))
    gone = (
        clustered.join(firsts.filter("first <> last"), "cluster")
        .filter(document != F.col("first"))
        .groupBy("d", "t")
        .agg(F.collect_set("place").alias("gone"))
    )
    gone = written(gone, "paragraphs-gone")
    joined = rows.join(gone.hint("shuffle_hash"), ["d", "t"], "left")
    return joined.select("doc_id", "text", "gone").mapInArrow(
        _without,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
        "spans array<array<bigint>>, kept_sha256 string",
    )
