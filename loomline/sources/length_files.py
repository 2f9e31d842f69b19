"""Lengths of the documents of each split as files, mapped into memory.

A length takes one byte, or as few as the largest needs, at the place of its document's
number. Files hold BLOCK numbers each and are made in tasks of their own. Workers map them,
so a draw finds its document's length without a join: neither the draws nor the lengths
are shuffled for it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.sources.byte_ranges import qualified
from loomline.sources.word_files import _lists, _store
from loomline.staging import new_folder

BLOCK = 1 << 18


@dataclass(frozen=True)
class Lengths:
    """Where the lengths are: (split, block, file name); and how many rows had the number
    of another one, whose lengths a file cannot hold."""

    folder: str
    kind: str
    parts: tuple[tuple[str, int, str], ...]
    repeats: int


def written_lengths(rows: DataFrame, longest: int) -> Lengths:
    """The lengths of rows (split, split_ord, len), none above longest."""
    folder = qualified(rows.sparkSession, new_folder(rows.sparkSession, "lengths"))
    kind = "<u1" if longest < 1 << 8 else "<u2" if longest < 1 << 16 else "<u4"
    store, size = _store(folder), BLOCK

    def run(batches: Iterator) -> Iterator:
        import uuid

        def ended(split: str, block: int, lengths: np.ndarray, repeats: int) -> pa.RecordBatch:
            # a repeated task writes a file of its own; only one that ended is listed
            name = f"part-{uuid.uuid4().hex}"
            with store(name) as out:
                out.write(lengths.tobytes())
            columns = ([split], [block], [name], [repeats])
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["split", "block", "name", "repeats"]
            )

        held, lengths, repeats = None, None, 0
        for batch in batches:
            splits = batch.column("split").to_numpy(zero_copy_only=False)
            blocks, places, lens = (batch.column(c).to_numpy() for c in ("block", "place", "len"))
            turns = (blocks[1:] != blocks[:-1]) | (splits[1:] != splits[:-1])
            cuts = np.concatenate([[0], np.flatnonzero(turns) + 1, [len(blocks)]])
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if start == end:
                    continue
                own = (str(splits[start]), int(blocks[start]))
                if own != held:
                    if held is not None:
                        yield ended(*held, lengths, repeats)
                    held, lengths, repeats = own, np.zeros(size, kind), 0
                place = places[start:end]
                fresh = np.unique(place)
                repeats += len(place) - len(fresh) + int((lengths[fresh] > 0).sum())
                lengths[place] = lens[start:end]
        if held is not None:
            yield ended(*held, lengths, repeats)

    dealt = rows.select(
        "split",
        F.expr(f"split_ord div {BLOCK}").alias("block"),
        (F.col("split_ord") % BLOCK).cast("int").alias("place"),
        F.col("len").cast("int").alias("len"),
    )
    dealt = dealt.repartition("split", "block").sortWithinPartitions("split", "block")
    made = dealt.mapInArrow(run, "split string, block bigint, name string, repeats bigint").collect()
    if not folder.startswith("file:/") and made:
        rows.sparkSession.sparkContext.addFile(folder, recursive=True)
    parts = tuple((r["split"], r["block"], r["name"]) for r in made)
    return Lengths(folder, kind, parts, sum(r["repeats"] for r in made))


def _reader(lengths: Lengths) -> Callable:
    """A function for tasks: the lengths of some numbers of a split, 0 where there is none."""
    local = lengths.folder.startswith("file:/")
    place = re.sub(r"^file:/+", "/", lengths.folder)
    files = {(split, block): name for split, block, name in lengths.parts}
    kind, size = lengths.kind, BLOCK

    def opened():
        at = place if local else SparkFiles.get(place.rstrip("/").rpartition("/")[2])
        mapped: dict = {}

        def found(split: str, numbers: np.ndarray) -> np.ndarray:
            out = np.zeros(len(numbers), np.int32)
            block = numbers // size
            order = np.argsort(block, kind="stable")
            sorted_ = block[order]
            cuts = np.concatenate([[0], np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1, [len(order)]])
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                key = (split, int(sorted_[start])) if start < end else None
                if key not in files:
                    continue
                if key not in mapped:
                    mapped[key] = np.memmap(f"{at}/{files[key]}", kind, "r")
                own = order[start:end]
                out[own] = mapped[key][numbers[own] % size]
            return out

        return found

    return opened


def lengths_of(split: Column, numbers: Column, lengths: Lengths) -> Column:
    """The lengths of the documents of a split whose numbers are in an array; 0 for none."""
    reader, like = _reader(lengths), _lists()

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = reader()
        for batch in batches:
            splits, lists = batch.flatten()
            splits = splits.to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(splits, sizes)
            out = np.zeros(len(flat), np.int32)
            for split in set(splits.tolist()):
                own = np.flatnonzero(owner == split)
                out[own] = found(split, flat[own])
            yield like(lists, pa.array(out))

    return run(F.struct(split.alias("split"), numbers.alias("numbers")))
