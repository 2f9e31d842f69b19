"""Array helpers that built-in functions do not cover in linear time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def running_starts(lengths: Column) -> Column:
    """Exclusive running sum inside each array<bigint>.

    The built-in way, aggregate() growing an array, copies the array once per
    element. This runs on whole Arrow batches of lengths only, so no text
    leaves the JVM and no shuffle is needed.
    """

    @F.arrow_udf("array<bigint>")
    def starts(lists: pa.Array) -> pa.Array:
        if len(lists) == 0:
            return pa.array([], pa.list_(pa.int64()))
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.cumsum(flat) - flat
        ends = np.cumsum(sizes)
        firsts = ends - sizes
        base = np.zeros(len(sizes), np.int64)
        filled = sizes > 0
        base[filled] = before[firsts[filled]]
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(before - np.repeat(base, sizes))
        )

    return starts(lengths)


def packed_ids(ids: Column) -> Column:
    """Each array<int> as bytes, seven bits of an id in each, the lowest first: common ids
    are small, so most take one or two bytes. An id's number is one more, and 0 is null."""

    @F.arrow_udf("binary")
    def packed(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        number = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.uint32).astype(np.uint64)
        number = np.where(known, number + np.uint64(1), np.uint64(0))
        width = np.ones(len(number), np.int64)
        for k in range(1, 5):
            width += number >= np.uint64(1 << 7 * k)
        ends = np.concatenate(([0], np.cumsum(width)))
        out = np.zeros(ends[-1], np.uint8)
        for k in range(5):
            at = np.flatnonzero(width > k)
            digit = (number[at] >> np.uint64(7 * k)) & np.uint64(127)
            out[ends[at] + k] = digit + np.where(width[at] > k + 1, 128, 0).astype(np.uint64)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        edges = ends[np.concatenate(([0], np.cumsum(sizes)))].astype(np.int64)
        buffers = [None, pa.py_buffer(edges), pa.py_buffer(out)]
        made = pa.Array.from_buffers(pa.large_binary(), len(lists), buffers)
        if lists.null_count:
            made = pc.if_else(lists.is_valid(), made, pa.scalar(None, pa.large_binary()))
        return made.cast(pa.binary())

    return packed(ids)


def unpacked_ids(parts: Column, most: Column) -> Column:
    """The ids of packed parts that follow one another in an array, of each part at most as
    many as the number at its place in most."""

    @F.arrow_udf("array<int>")
    def unpacked(rows: pa.Array) -> pa.Array:
        lists, limits = rows.flatten()
        limits = limits.flatten().to_numpy(zero_copy_only=False)
        flat = lists.flatten().cast(pa.large_binary())
        _, edges, data = flat.buffers()
        edges = np.frombuffer(edges, np.int64)[flat.offset : flat.offset + len(flat) + 1]
        data = np.frombuffer(data or b"", np.uint8)[edges[0] : edges[-1]]
        last = np.flatnonzero(data < 128)
        first = np.concatenate(([0], last + 1))[: len(last)]
        number = np.zeros(len(last), np.uint64)
        for k in range(5):
            at = np.flatnonzero(first + k <= last)
            number[at] |= (data[first[at] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
        ids = (number.astype(np.int64) - 1).astype(np.uint32).view(np.int32)
        # ids up to the end of each part, of which the first are taken
        cuts = np.searchsorted(last, edges - edges[0])
        taken = np.minimum(np.diff(cuts), np.maximum(limits, 0))
        offsets = np.concatenate(([0], np.cumsum(taken)))
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = offsets[np.concatenate(([0], np.cumsum(sizes)))]
        at = np.arange(offsets[-1]) + np.repeat(cuts[:-1] - offsets[:-1], taken)
        return pa.ListArray.from_arrays(
            pa.array(ends.astype(np.int32)), pa.array(ids[at], mask=number[at] == 0)
        )

    return unpacked(F.struct(parts.alias("parts"), most.alias("most")))
