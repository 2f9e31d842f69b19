"""Seeded draws packed into fixed-length next-token rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.arrays import packed_ids, running_starts, unpacked_ids
from loomline.functions.draws import keyed_draw
from loomline.sources.length_files import Lengths, lengths_of, written_lengths
from loomline.staging import BROADCAST_BYTES, bucketed, staged

DRAWS_PER_TASK = 500_000
# Bytes of a row without its ids, and of the rows of a bucket.
ROW_BYTES = 48
BUCKET_BYTES = 128 << 20

# With four draws a document, e**-4 of the documents, 2 %, are drawn by none.
DRAWS_TO_TAKE_ALL = 4

_EXAMPLE = ["split", "example"]
_DOC = ["split", "split_ord"]


def draw_documents(
    examples: DataFrame, n_docs: Column, first: int, last: int, seed: int = 0
) -> DataFrame:
    """Draws first..last of each (split, example): k and split_ord, with replacement.

    n_docs is the size of the row's split.
    """
    k = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("k")
    split_ord = keyed_draw(
        n_docs, F.lit(seed), F.col("split"), F.col("example"), F.col("k")
    )
    return examples.select("*", k).withColumn("split_ord", split_ord)


def size_of_split(sizes: Mapping[str, int]) -> Column:
    """The row's split size, from a few known numbers."""
    pairs = [F.lit(x) for name, n in sorted(sizes.items()) for x in (name, n)]
    size = F.element_at(F.create_map(*pairs), F.col("split"))
    return F.coalesce(size, F.lit(1)).cast("bigint")


def _gather(
    draws: DataFrame, docs: DataFrame, sizes: Mapping[str, int], limit: int
) -> DataFrame:
    """draws joined with their documents on (split, split_ord).

    Draws are uniform, so a document is drawn very often only in a split of few
    documents. Those splits are within the broadcast limit and are not shuffled;
    the draws of larger splits spread evenly over a shuffle join.
    """
    small = [s for s, n in sizes.items() if n <= limit]
    large = [s for s, n in sizes.items() if n > limit]
    parts = []
    if small:
        held = F.col("split").isin(small)
        parts.append(draws.filter(held).join(F.broadcast(docs.filter(held)), _DOC))
    if large:
        held = F.col("split").isin(large)
        # The planner takes exploded draws for small and might broadcast them.
        parts.append(draws.filter(held).join(docs.filter(held).hint("merge"), _DOC))
    return reduce(DataFrame.unionByName, parts)


def _used_in_place(
    examples: DataFrame,
    n_docs: Column,
    lengths: Lengths,
    first: int,
    last: int,
    seed: int,
    target_len: int,
) -> DataFrame:
    """Of draws first..last of each example those it has room for, with their place in it.

    Lengths are looked up where the draws are made: those that are not used, most of
    them, are never rows.
    """
    number = lambda k: keyed_draw(
        n_docs, F.lit(seed), F.col("split"), F.col("example"), k
    )
    drawn = examples.withColumn("ords", F.transform(F.sequence(F.lit(first), F.lit(last)), number))
    drawn = drawn.withColumn("lens", lengths_of(F.col("split"), F.col("ords"), lengths))
    drawn = drawn.withColumn("starts", running_starts(F.col("lens").cast("array<bigint>")))
    every = F.transform(
        "ords",
        lambda split_ord, i: F.struct(
            (i + first).alias("k"),
            split_ord.alias("split_ord"),
            (F.col("have") + F.get("starts", i)).alias("start"),
            F.get("lens", i).alias("len"),
        ),
    )
    used = F.filter(every, lambda d: (d["start"] < target_len) & (d["len"] > 0))
    return drawn.select(*_EXAMPLE, F.explode(used).alias("_d")).select(*_EXAMPLE, "_d.*")


def pack_examples(
    examples: DataFrame,
    sizes: Mapping[str, int],
    fetch_ids: Callable[[DataFrame | None], DataFrame],
    target_len: int = 129,
    seed: int = 0,
    first_round: int = 16,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fill each (split, example) with drawn documents up to target_len ids.

    fetch_ids(wanted) takes distinct (split, split_ord) rows and returns them with
    `ids`, wrapped; fetch_ids(None) returns all. Only drawn documents are read and
    tokenised, each once a round. When there are several draws for each document,
    nearly all are drawn, and finding out which would cost more than it saves.

    Every wrapped document has two ids or more, so target_len / 2 draws always
    suffice. Most examples need far fewer: the first round draws first_round
    documents for all, a second one the rest of the bound for those still open.
    """
    spark = examples.sparkSession
    # documents whose ids, target_len of them at most, may be broadcast
    wide = broadcast_bytes // (ROW_BYTES + 4 * target_len)
    bound = (target_len + 1) // 2
    n_docs = size_of_split(sizes)
    running = (
        Window.partitionBy(*_EXAMPLE).orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    )

    def one_round(todo: DataFrame, first: int, last: int) -> tuple[DataFrame, DataFrame]:
        n_draws = todo.count() * (last - first + 1)
        # One narrow row turns into many draws and later their ids, so the examples
        # are spread first, by the key the packing window needs. The count is given:
        # adaptive execution would merge partitions that are still this small.
        tasks = max(n_draws // DRAWS_PER_TASK + 1, spark.sparkContext.defaultParallelism)
        spread = todo.repartition(tasks, *_EXAMPLE)
        draws = draw_documents(spread, n_docs, first, last, seed)
        take_all = n_draws >= DRAWS_TO_TAKE_ALL * sum(sizes.values())
        wanted = None if take_all else draws.select(*_DOC).distinct()
        # Dealt out by document when they are written: the joins below read them where
        # they are, and only the draws move to them.
        n_wanted = min(n_draws, sum(sizes.values()))
        tokens = bucketed(
            fetch_ids(wanted).select(
                *_DOC,
                # target_len ids of a document are the most an example can hold
                packed_ids(F.slice("ids", 1, target_len)).alias("ids"),
                F.least(F.size("ids"), F.lit(target_len)).alias("len"),
            ),
            _DOC,
            n_wanted * (ROW_BYTES + 4 * target_len) // BUCKET_BYTES + 1,
            "drawn-tokens",
        )
        # With all documents at hand their lengths are files that tasks map, and only the
        # draws that are used are rows; documents of one number are told apart by a join.
        lengths = written_lengths(tokens.select(*_DOC, "len"), target_len) if take_all else None
        if lengths is not None and not lengths.repeats:
            taken = _used_in_place(spread, n_docs, lengths, first, last, seed, target_len)
        else:
            sized = _gather(draws, tokens.select(*_DOC, "len"), sizes, broadcast_bytes // ROW_BYTES)
            start = F.col("have") + F.coalesce(F.sum("len").over(running), F.lit(0))
            taken = sized.withColumn("start", start).filter(F.col("start") < target_len)
        used = staged(taken.select(*_EXAMPLE, "k", "split_ord", "start", "len"), "used-draws")
        # packed: what moves is the ids of all used draws
        room = (target_len - F.col("start")).cast("int").alias("room")
        drawn = used.select(*_EXAMPLE, "k", "split_ord", room)
        pieces = _gather(drawn, tokens.select(*_DOC, "ids"), sizes, wide).select(*_EXAMPLE, "k", "ids", "room")
        still_open = (
            used.groupBy(*_EXAMPLE)
            .agg(F.max(F.col("start") + F.col("len")).alias("have"))
            .filter(F.col("have") < target_len)
        )
        return pieces, still_open

    fresh = examples.select(*_EXAMPLE, F.lit(0).cast("bigint").alias("have"))
    pieces, still_open = one_round(fresh, 0, min(first_round, bound) - 1)
    if first_round < bound and not still_open.isEmpty():
        rest, _ = one_round(still_open, first_round, bound - 1)
        pieces = pieces.unionByName(rest)
    in_order = F.array_sort(F.collect_list(F.struct("k", "ids", "room")))
    grouped = pieces.groupBy(*_EXAMPLE).agg(in_order.alias("parts"))
    return grouped.select(*_EXAMPLE, unpacked_ids(F.col("parts.ids"), F.col("parts.room")).alias("ids"))


def shift_pairs(packed: DataFrame, block_size: int = 128) -> DataFrame:
    """Inputs and next-token targets of each packed row."""
    return packed.select(
        *_EXAMPLE,
        F.slice("ids", 1, block_size).alias("input_ids"),
        F.slice("ids", 2, block_size).alias("target_ids"),
    )


def to_batches(pairs: DataFrame, batch_size: int = 64) -> DataFrame:
    """Batch and row numbers; a batch stays batch_size rows, not one large row."""
    return pairs.select(
        "split",
        F.expr(f"example div {batch_size}").alias("batch_id"),
        (F.col("example") % batch_size).cast("int").alias("row_in_batch"),
        "input_ids",
        "target_ids",
    )
