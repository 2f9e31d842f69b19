"""Removal of repeated byte strings by blockwise suffix sorting.

A byte goes if a string of LENGTH bytes that covers it also starts earlier in
the corpus. The suffixes that can tie for so long are found without sorting all:
a suffix belongs to the bucket of its minimiser, the least hash of the GRAM-byte
strings in its first LENGTH bytes, and equal strings have equal minimisers. Runs
of suffixes with one minimiser are kept as one span of text. Only buckets with
spans of different texts, or several spans of one, are sorted.

Buckets are sorted one block at a time. Inside a block the suffixes are sorted
by some of their words and a fingerprint; long ties are resolved by precomputed ranks
of a sample of positions that is a difference cover modulo 7: for any two suffixes
there is a shift below 7 that takes both to sampled positions, and there two ranks of
56-byte strings settle the rest. Memory holds one block's spans and ranks.

A bucket of more than BLOCK_BYTES, such as that of a line in very many texts, is not
sorted whole. Equal strings have their minimiser at the same place, so its suffixes
are parted by that place into two halves, and each half by a hash of the bytes that
all its suffixes hold; equal spans become one again, and what is still too large is
halved again. When a half is one place wide, its suffixes are equal or apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import written
from loomline.llm.wordhash import U64, mix, powers, sliding_least
from loomline.staging import broadcast_if_within

LENGTH = 100
GRAM = 32
#: Grams in the first LENGTH bytes of a suffix.
REACH = LENGTH - GRAM + 1
#: Suffixes of a text that are taken at a time.
CHUNK = (1 << 20) - 2 * REACH
#: Bytes of spans in a block, about: more only if one bucket has more.
BLOCK_BYTES = 4 << 20

_GENERATOR = np.random.Generator(np.random.PCG64(3))
_VALUES = _GENERATOR.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)

# A difference cover: the differences of its members are all numbers modulo 7.
PERIOD = 7
COVER = (0, 1, 3)
_IN_COVER = np.isin(np.arange(2 * PERIOD) % PERIOD, COVER)
#: The least shift that takes positions of two remainders into the cover.
SHIFT = np.array(
    [
        [next(s for s in range(PERIOD) if _IN_COVER[a + s] and _IN_COVER[b + s]) for b in range(PERIOD)]
        for a in range(PERIOD)
    ]
)
DEPTH = 8 * PERIOD


def gram_hashes(data: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    n = len(data) - GRAM + 1
    return mix((sums[GRAM:] - sums[:n]) * down[:n])


def spans(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser hash, first suffix and number of suffixes of the spans of a text, and
    how far the minimiser is from the first suffix."""
    hashes, firsts, counts, grams_at = [], [], [], []
    size = len(text or b"")
    for at in range(0, max(0, size - LENGTH + 1), CHUNK):
        data = np.frombuffer(text, np.uint8)[at : min(size, at + CHUNK + LENGTH - 1)]
        grams = gram_hashes(data)
        # the place in the low bits: of equal hashes the first wins
        marked = (grams >> U64(20) << U64(20)) | np.arange(len(grams), dtype=U64)
        owner = (sliding_least(marked, REACH) & U64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        hashes.append(grams[owner[first]])
        firsts.append(first + at)
        grams_at.append(owner[first] - first)
        counts.append(np.diff(np.append(first, len(owner))))
    if not hashes:
        return np.empty(0, U64), *[np.empty(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in (hashes, firsts, counts, grams_at))


def _minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text: its minimisers, each once, and whether it occurs again."""
    for batch in batches:
        for t, text in zip(batch.column("t").to_pylist(), batch.column("text")):
            found, times = np.unique(spans(text.as_py())[0], return_counts=True)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.view(np.int64)),
                        pa.array(np.full(len(found), t, np.int64)),
                        pa.array(times > 1),
                    ],
                    names=["h", "t", "again"],
                )


SPANS = (
    "h bigint, d bigint, t bigint, lo bigint, n bigint, bytes binary, "
    "gram bigint, least bigint, end bigint"
)


def _cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of a text whose minimisers are listed, with their bytes."""
    for batch in batches:
        for d, t, text, listed in zip(
            batch.column("d").to_pylist(), batch.column("t").to_pylist(), batch.column("text"), batch.column("hs")
        ):
            data = text.as_py()
            found = spans(data)
            wanted = np.isin(found[0].view(np.int64), listed.values.to_numpy(zero_copy_only=False))
            found, first, count, gram = (x[wanted] for x in found)
            n = len(found)
            if not n:
                continue
            pieces = [data[a : a + c + LENGTH - 1] for a, c in zip(first.tolist(), count.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.view(np.int64)),
                    pa.array(np.full(n, d, np.int64)),
                    pa.array(np.full(n, t, np.int64)),
                    pa.array(first, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(pieces, pa.binary()),
                    pa.array(gram, pa.int64()),
                    pa.array(np.zeros(n, np.int64)),
                    pa.array(np.full(n, REACH, np.int64)),
                ],
                names=[c.split()[0] for c in SPANS.split(", ")],
            )


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of large buckets, parted by how far their suffixes are from the minimiser.

    The suffixes of a span that are at least `least` and less than `end` before it all
    hold the bytes from least before the minimiser to the end of the last of them.
    """
    names = [c.split()[0] for c in SPANS.split(", ")]
    for batch in batches:
        out = []
        for h, d, t, lo, n, data, gram, least, end in zip(*(batch.column(c).to_pylist() for c in names)):
            middle = (least + end) // 2
            for low, high in ((middle, end), (least, middle)):
                # suffix k of the span is gram - k before the minimiser
                first, last = max(0, gram - high + 1), min(n - 1, gram - low)
                if low >= high or first > last:
                    continue
                held = data[gram - low : gram - high + 1 + LENGTH]
                name = hashlib.blake2b(b"%d %d %d " % (h, low, high) + held, digest_size=8).digest()
                part = int.from_bytes(name, "little", signed=True)
                bytes_ = data[first : last + LENGTH]
                out.append((part, d, t, lo + first, last - first + 1, bytes_, gram - first, low, high))
        kinds = [*[pa.int64()] * 5, pa.binary(), *[pa.int64()] * 3]
        columns = zip(*out) if out else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number, in byte order."""
    out = np.zeros(len(data) - 7, U64)
    for k in range(8):
        out = (out << U64(8)) | data[k : k + len(out)]
    return out


def cover_ranks(words: np.ndarray, size: int) -> np.ndarray:
    """Ranks of the DEPTH-byte strings at sampled positions; -1 elsewhere."""
    at = np.flatnonzero(_IN_COVER[np.arange(size) % PERIOD])
    rank = np.full(size + DEPTH, -1, np.int64)
    rank[at] = np.unique(words[at] >> U64(8), return_inverse=True)[1]
    step = PERIOD
    while step < DEPTH:
        pair = rank[at] * (size + 2) + rank[at + step] + 1
        rank[at] = np.unique(pair, return_inverse=True)[1]
        step *= 2
    return rank[:size]


def repeated_suffixes(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which suffixes at positions `at` of the buffer begin with LENGTH bytes that
    one before them in `at` begins with too."""
    size = len(buffer)
    padded = np.concatenate([buffer, np.zeros(DEPTH + 8, np.uint8)])
    words = _words(padded)
    ranks = cover_ranks(words, size)
    # equal suffixes have equal fingerprints, so ties of different ones are rare
    up, down = powers(size + 1)
    sums = np.zeros(size + 1, U64)
    np.cumsum(_VALUES[buffer] * up[:size], out=sums[1:])
    finger = mix((sums[at + LENGTH] - sums[at]) * down[at])
    keys = [finger, *(words[at + k] for k in (LENGTH - 8, 72, 48, 24, 0))]
    order = np.lexsort([np.arange(len(at)), *keys])
    change = np.zeros(len(at), bool)
    change[:1] = True
    for key in keys:
        own = key[order]
        change[1:] |= own[1:] != own[:-1]
    group = np.cumsum(change) - 1
    place = at[order]
    repeated = np.zeros(len(at), bool)
    open_ = np.arange(len(at))
    while len(open_):
        # the first of each group leads; the others are compared with it
        g = group[open_]
        lead = np.append(True, g[1:] != g[:-1])
        of = open_[np.flatnonzero(lead)[np.cumsum(lead) - 1]]
        a, b = place[of], place[open_]
        shift = SHIFT[a % PERIOD, b % PERIOD]
        # bytes 0 to 8 are equal by the first key, shift to shift + 56 by the first
        # rank, up to 91 at least by the second, and 92 to 100 by the last key
        second = shift + np.where(shift <= 2, 42, 35)
        same = (ranks[a + shift] == ranks[b + shift]) & (ranks[a + second] == ranks[b + second])
        repeated[order[open_[same & ~lead]]] = True
        open_ = open_[~same]
    return repeated


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    starts = np.flatnonzero(edges == 1)
    return starts, np.flatnonzero(edges == -1) - starts


def _sort_block(rows: list[tuple[int, int, int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """d, t, first suffix, number of suffixes of the repeated runs among spans."""
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    buffer = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    sizes = np.array([len(r[4]) for r in rows])
    counts = np.array([r[3] for r in rows])
    base = np.cumsum(sizes) - sizes
    first = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) - np.repeat(first - base, counts)
    repeated = repeated_suffixes(buffer, at)
    for k, (d, t, lo, n, _) in enumerate(rows):
        flags = repeated[first[k] : first[k] + n]
        if flags.any():
            for start, count in zip(*(x.tolist() for x in _runs(flags))):
                yield d, t, lo + start, count


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of bucket; whole buckets are sorted block after block."""
    held: list[tuple[int, int, int, int, bytes]] = []
    size, bucket = 0, None

    def flush() -> pa.RecordBatch:
        out = list(_sort_block(held))
        held.clear()
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["d", "t", "lo", "n"]
        )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("h", "d", "t", "lo", "n", "bytes"))):
            if size >= BLOCK_BYTES and row[0] != bucket:
                yield flush()
                size = 0
            bucket = row[0]
            held.append(row[1:])
            size += len(row[5])
    if held:
        yield flush()


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, runs, hashes = [], [], [], []
        for text, los, ns in zip(batch.column("text"), batch.column("los"), batch.column("ns")):
            data = text.as_py() or b""
            gone = np.zeros(len(data) + 1, np.int32)
            if los.is_valid:
                np.add.at(gone, los.values.to_numpy(zero_copy_only=False), 1)
                ends = los.values.to_numpy(zero_copy_only=False) + ns.values.to_numpy(zero_copy_only=False)
                np.add.at(gone, ends + LENGTH - 1, -1)
                covered = np.cumsum(gone[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                starts = _runs(covered)[0]
            else:
                kept, starts = data, ()
            sizes.append(len(data))
            removed.append(len(data) - len(kept))
            runs.append(len(starts))
            hashes.append(hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *[pa.array(x, pa.int64()) for x in (sizes, removed, runs)],
                pa.array(hashes, pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _addressed(docs: DataFrame) -> DataFrame:
    """doc_id, text in bytes, d (a number for null ids too), t and u: hashes of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text.cast("binary").alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("d"),
        F.xxhash64(text).alias("t"),
        F.xxhash64(F.lit("second"), text).alias("u"),
    )


def repeated_runs(docs: DataFrame) -> DataFrame:
    """d, t, lo, n: runs of n suffixes from byte lo that begin as an earlier one does.

    Only the first document of each text takes part: of a later copy every
    suffix is repeated, which the caller knows from its text alone.
    """
    rows = _addressed(docs)
    grams = rows.select("t", "text").mapInArrow(_minimisers, "h bigint, t bigint, again boolean")
    bucket = Window.partitionBy("h")
    shared = (
        grams.withColumn("low", F.min("t").over(bucket))
        .withColumn("high", F.max("t").over(bucket))
        .withColumn("more", F.max("again").over(bucket))
        .filter((F.col("low") != F.col("high")) | F.col("more"))
        .select("h", "t")
        .distinct()
    )
    lists = shared.groupBy("t").agg(F.collect_list("h").alias("hs"))
    firsts = rows.groupBy("t", "u").agg(F.min("d").alias("d"))
    wanted = written(lists.join(firsts, "t"), "suffix-lists")
    cut = (
        rows.join(wanted.hint("shuffle_hash"), ["t", "u", "d"])
        .select("d", "t", "text", "hs")
        .mapInArrow(_cut_spans, SPANS)
    )
    return written(_settled(cut), "suffix-runs")


def _settled(cut: DataFrame) -> DataFrame:
    """d, t, lo, n of the repeated runs of suffixes of spans.

    Each turn halves the buckets that are still larger than a block; a class of REACH
    places is one place wide after seven.
    """
    parts = []
    while True:
        # Equal spans are sorted once: all but the first are repeated from end to end.
        spread = written(
            cut.withColumn("s", F.xxhash64("bytes")).withColumn("v", F.xxhash64(F.lit("second"), "bytes")),
            "suffix-spans",
        )
        same = spread.groupBy("h", "s", "v").agg(
            F.min(F.struct("d", "t", "lo")).alias("place"),
            F.count("*").alias("times"),
            *[F.first(c).alias(c) for c in ("n", "bytes", "gram", "least", "end")],
        )
        same = written(same, "suffix-buckets")
        copies = (
            spread.select("h", "s", "v", "d", "t", "lo", "n")
            .join(same.filter("times > 1").select("h", "s", "v", "place"), ["h", "s", "v"])
            .filter(F.struct("d", "t", "lo") != F.col("place"))
            .select("d", "t", "lo", "n")
        )
        parts.append(copies)
        sizes = same.groupBy("h").agg(F.sum(F.octet_length("bytes")).alias("size"))
        large = written(sizes.filter(F.col("size") > BLOCK_BYTES).select("h"), "suffix-large")
        n_large = large.count()
        alone = same.select("h", "place.d", "place.t", "place.lo", "n", "bytes", "gram", "least", "end")
        small = alone
        if n_large:
            # at most one row for each BLOCK_BYTES of spans
            held = broadcast_if_within(large, n_large, 8)
            small = alone.join(held, "h", "left_anti")
        parts.append(
            small.select("h", "d", "t", "lo", "n", "bytes")
            .repartition("h")
            .sortWithinPartitions("h")
            .mapInArrow(_sort_buckets, "d bigint, t bigint, lo bigint, n bigint")
        )
        if not n_large:
            return reduce(DataFrame.unionByName, parts)
        cut = alone.join(held, "h", "left_semi").select(*[c.split()[0] for c in SPANS.split(", ")]).mapInArrow(
            _halved, SPANS
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each row of docs.

    Documents are in order of doc_id, null first, then of their text's hash.
    Rows with one doc_id and one text are one document and have the same result;
    documents with one doc_id and different texts are told apart. Null and empty
    texts, and texts shorter than LENGTH bytes, lose nothing. An empty table
    gives no rows.
    """
    rows = _addressed(docs)
    runs = repeated_runs(docs)
    by_text = runs.groupBy("d", "t").agg(F.collect_list("lo").alias("los"), F.collect_list("n").alias("ns"))
    firsts = rows.groupBy("t", "u").agg(F.min("d").alias("first")).withColumnRenamed("t", "ft").withColumnRenamed("u", "fu")
    copies = rows.select("doc_id", "d", "t", "u", F.octet_length("text").alias("size"))
    copies = copies.join(firsts, (F.col("t") == F.col("ft")) & (F.col("u") == F.col("fu"))).filter(
        (F.col("d") != F.col("first")) & (F.col("size") >= LENGTH)
    )
    whole = copies.select(
        "d", "t", F.array(F.lit(0).cast("bigint")).alias("los"),
        F.array((F.col("size") - LENGTH + 1).cast("bigint")).alias("ns"),
    ).distinct()
    marks = written(by_text.unionByName(whole), "suffix-marks")
    joined = rows.select("doc_id", "text", "d", "t").join(marks.hint("shuffle_hash"), ["d", "t"], "left")
    return joined.select("doc_id", "text", "los", "ns").mapInArrow(
        _removed, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
