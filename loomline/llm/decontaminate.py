"""Benchmark decontamination with spaced seeds.

A spaced seed is a fixed mask of compared and ignored words. Every place of an
item and of a document is hashed under each mask, on the compared words only, so
a changed word at an ignored place still gives the same hash. Places that meet
are verified: along the line they set, some window of WINDOW words must be equal
in all but the share of words that may be replaced.

The items are a stated query set that runs against all documents in blocks: a
block of items of bounded size is sent to all tasks, and the documents are
scanned once for each block.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import written
from loomline.llm.wordhash import U64, mix, word_hashes

# Masks of a window or a whole item of so many words; 1 is compared. They are
# chosen by enumeration: whichever words a verified window may have changed, some
# mask at some place avoids them all. Shorter items are compared whole.
MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111"),
    8: ("11111", "111011"),
    9: ("1111011", "1101111"),
    10: ("1111011", "11001111", "110110011", "11110101", "10101111"),
    11: ("1110111", "111001011", "1011111", "111111"),
    12: ("11101011", "101100111", "111111"),
    13: ("11101011", "11001111"),
}
#: A window of so many words, or a whole shorter item, must agree in PERCENT of its words.
WINDOW = 13
PERCENT = 80
#: Words of one block of items, about: its hashes are some megabytes.
BLOCK_WORDS = 200_000
#: Hits of seeds that are taken together.
HITS = 1 << 18
# A table of bits that tells most hashes that no item has.
FILTER_BITS = 20

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def plain_words(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, in lower case, without ASCII punctuation."""
    if not text:
        return np.empty(0, U64)
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    return word_hashes(data[~_PUNCTUATION[data]].tobytes())


@functools.cache
def _seeds(length: int) -> tuple[tuple[int, ...], ...]:
    """The compared places of each mask for an item of so many words."""
    masks = MASKS.get(min(length, WINDOW), ("1" * length,))
    return tuple(tuple(k for k, c in enumerate(m) if c == "1") for m in masks)


def seed_hashes(words: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    n = len(words) - places[-1]
    if n <= 0:
        return np.empty(0, U64)
    total = np.full(n, U64(hash(places) % 2**64))
    for k in places:
        total = mix(total + words[k : k + n])
    return total


@dataclass(frozen=True)
class Items:
    """A block of items: their words, and every seed hash in order with where it is."""

    ids: tuple
    words: tuple[np.ndarray, ...]
    seeds: tuple[tuple[int, ...], ...]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bits: np.ndarray


def item_block(rows: list[tuple[int, bytes]]) -> Items:
    ids, words, seeds, parts = [], [], set(), []
    for item_id, data in rows:
        own = np.frombuffer(data, "<u8").astype(U64)
        if not len(own):
            continue
        for places in _seeds(len(own)):
            seeds.add(places)
            found = seed_hashes(own, places)
            parts.append((found, np.full(len(found), len(ids)), np.arange(len(found))))
        ids.append(item_id)
        words.append(own)
    hashes = np.concatenate([np.empty(0, U64), *[p[0] for p in parts]])
    item = np.concatenate([np.empty(0, np.int64), *[p[1] for p in parts]])
    place = np.concatenate([np.empty(0, np.int64), *[p[2] for p in parts]])
    order = np.argsort(hashes, kind="stable")
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[(hashes >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Items(tuple(ids), tuple(words), tuple(sorted(seeds)), hashes[order], item[order], place[order], bits)


def matches(words: np.ndarray, items: Items) -> dict[int, int]:
    """Items that a document holds, with the most equal words along one line."""
    # a line is an item and the place of its first word in the document
    codes = [np.empty(0, np.int64)]
    span = 2 * (len(words) + max(map(len, items.words), default=0)) + 1
    for places in items.seeds:
        found = seed_hashes(words, places)
        near = np.flatnonzero(items.bits[(found >> U64(64 - FILTER_BITS)).astype(np.int64)])
        left = np.searchsorted(items.hashes, found[near], "left")
        right = np.searchsorted(items.hashes, found[near], "right")
        count = right - left
        # hits at a time; a periodic text meets a periodic item at every place
        for part in np.split(np.arange(len(near)), np.flatnonzero(np.diff(np.cumsum(count) // HITS)) + 1):
            times = count[part]
            at = np.repeat(near[part], times)
            k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - left[part], times)
            codes.append(np.unique(items.item[k] * span + at - items.place[k] + span // 2))
    best: dict[int, int] = {}
    for code in np.unique(np.concatenate(codes)).tolist():
        item, shift = code // span, code % span - span // 2
        own = items.words[item]
        first, last = max(0, -shift), min(len(own), len(words) - shift)
        window = min(WINDOW, len(own))
        if last - first < window:
            continue
        equal = own[first:last] == words[first + shift : last + shift]
        sums = np.concatenate([[0], np.cumsum(equal)])
        if 100 * int((sums[window:] - sums[:-window]).max()) >= PERCENT * window:
            best[item] = max(best.get(item, 0), int(sums[-1]))
    return best


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [plain_words(t.as_py()).astype("<u8").tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(words, pa.binary())], names=["item_id", "words"]
        )


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            docs, found, equal = [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                for item, words in matches(plain_words(text.as_py()), items).items():
                    docs.append(doc_id.as_py())
                    found.append(items.ids[item])
                    equal.append(words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, batch.column("doc_id").type),
                    pa.array(found, pa.int64()),
                    pa.array(equal, pa.int64()),
                ],
                names=["doc_id", "item_id", "n_equal"],
            )

    return run


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_equal: which items a document holds.

    Null and empty texts and items without a word have no overlap. Items of one
    to four words must be held word for word. Repeated items and documents count once for each id. An item that
    is longer than a block's size is a block by itself.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    items = written(
        benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_item_words, "item_id bigint, words binary")
        .filter(F.octet_length("words") > 0),
        "benchmark-items",
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("words") / 8), F.lit(0))).first()[0]
    blocks = int(max(1, -(-total // BLOCK_WORDS)))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = []
    for block in range(blocks):
        # one block is some megabytes, whatever the size of the benchmark
        own = items.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block)
        rows = sorted(((r["item_id"], bytes(r["words"])) for r in own.collect()), key=lambda r: (r[0] is None, r))
        shared = spark.sparkContext.broadcast(item_block(rows))
        hits = texts.mapInArrow(_scan(shared), f"doc_id {kind}, item_id bigint, n_equal bigint")
        found.append(written(hits, "benchmark-overlaps"))
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every.groupBy("doc_id", "item_id").agg(F.max("n_equal").alias("n_equal"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, item_ids, n_equal, kept: one row for each row of docs.

    A document that holds an item is not kept. item_ids lists the items in
    order, n_equal is the most words in which it agrees with one. Rows with one
    doc_id, or with a null one, are one document: what one row holds counts for
    all. Empty tables give no rows, or no overlap.
    """
    held = (
        overlaps(docs, benchmark)
        .groupBy(F.col("doc_id").alias("of"))
        .agg(
            F.sort_array(F.collect_set("item_id")).alias("item_ids"),
            F.max("n_equal").alias("n_equal"),
            F.count("*").alias("n_items"),
        )
    )
    joined = docs.select("doc_id").join(held, F.col("doc_id").eqNullSafe(F.col("of")), "left")
    return joined.select(
        "doc_id",
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("n_equal", F.lit(0)).cast("bigint").alias("n_equal"),
        F.col("n_items").isNull().alias("kept"),
    )
