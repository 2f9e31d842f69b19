"""Vocabularies as look-up files: sorted keys with their entries, mapped into memory.

A vocabulary is written once, in parts of about PART_BYTES, each sorted by key and made
in a task of its own. Workers map the parts and search them in place: nothing is built
for a task or a batch, and the pages of a part are held once for a machine. On a store
that cannot be mapped the parts are sent to each executor as files.

A word's key is a 64-bit hash. A word counts as found only if the entry's own bytes are
the same, so words that share a hash are told apart.
"""

from __future__ import annotations

import mmap
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.sources.byte_ranges import qualified
from loomline.staging import new_folder

PART_BYTES = 64 << 20
# Bytes of words that are hashed at a time: each takes some forty bytes meanwhile.
HASHED_BYTES = 1 << 20
_ENTRY = "key bigint, id bigint, token string"


@dataclass(frozen=True)
class LookUp:
    """Where the parts of a look-up are: (first key, file name, entries) in key order."""

    folder: str
    parts: tuple[tuple[int, str, int], ...]


def _hasher() -> Callable:
    """A function for tasks: a signed 64-bit hash of each string of an Arrow array."""
    most = HASHED_BYTES

    def made():
        u64 = np.uint64
        draw = np.random.Generator(np.random.PCG64(77))
        value = draw.integers(0, 2**63, 256, dtype=u64) * u64(2) + u64(1)
        powers = np.cumprod(np.full(64, u64(0x9E3779B97F4A7C15)), dtype=u64)

        def hashes(array: pa.Array) -> np.ndarray:
            array = array.cast(pa.large_string())
            out = np.empty(len(array), np.int64)
            if not len(array):
                return out
            _, edges, data = array.buffers()
            edges = np.frombuffer(edges, np.int64)[array.offset : array.offset + len(array) + 1]
            data = np.frombuffer(data or b"", np.uint8)
            start = 0
            while start < len(out):
                # a word that is longer alone; empty words by number
                end = int(np.searchsorted(edges, edges[start] + most, side="right")) - 1
                end = min(max(end, start + 1), start + most, len(out))
                out[start:end] = some(edges[start : end + 1], data)
                start = end
            return out

        def some(edges: np.ndarray, data: np.ndarray) -> np.ndarray:
            nonlocal powers
            seen = data[edges[0] : edges[-1]]
            edges = edges - edges[0]
            sizes = np.diff(edges)
            while len(powers) <= sizes.max(initial=0):
                powers = np.concatenate([powers, powers * powers[-1]])
            place = np.arange(len(seen)) - np.repeat(edges[:-1], sizes)
            sums = np.concatenate([[u64(0)], np.cumsum(value[seen] * powers[place], dtype=u64)])
            x = sums[edges[1:]] - sums[edges[:-1]] + sizes.astype(u64)
            x = (x ^ (x >> u64(30))) * u64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> u64(27))) * u64(0x94D049BB133111EB)
            return (x ^ (x >> u64(31))).view(np.int64)

        return hashes

    return made


def _store(folder: str) -> Callable:
    """A function for tasks: a file of the folder, opened for writing."""
    local = folder.startswith("file:/")
    place = re.sub(r"^file:/+", "/", folder)

    def opened(name: str):
        from pyarrow import fs

        system, at = (fs.LocalFileSystem(), place) if local else fs.FileSystem.from_uri(place)
        system.create_dir(at, recursive=True)
        return system.open_output_stream(f"{at}/{name}")

    return opened


def _written(entries: DataFrame, folder: str, n_bytes: int) -> LookUp:
    """A look-up of rows (key, id, token), n_bytes of them."""
    store = _store(folder)

    def run(batches: Iterator) -> Iterator:
        import uuid


        def token_parts(batch) -> tuple:
            token = batch.column("token").cast(pa.large_string())
            _, edges, data = token.buffers()
            edges = np.frombuffer(edges, np.int64)[token.offset : token.offset + len(token) + 1]
            return edges - edges[0], memoryview(data)[edges[0] : edges[-1]] if data else b""

        # held once, and written batch by batch
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        # a repeated task writes a file of its own; only one that ended is listed
        name = f"part-{uuid.uuid4().hex}"
        with store(name) as out:
            for column in ("key", "id"):
                for batch in held:
                    out.write(batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64).tobytes())
            end = np.int64(0)
            out.write(end.tobytes())
            for batch in held:
                edges = token_parts(batch)[0]
                out.write((edges[1:] + end).tobytes())
                end += edges[-1]
            for batch in held:
                out.write(token_parts(batch)[1])
        first, n = held[0].column("key")[0].as_py(), sum(batch.num_rows for batch in held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([first]), pa.array([name]), pa.array([n])], names=["first", "name", "n"]
        )

    parts = max(1, -(-n_bytes // PART_BYTES))
    dealt = entries.repartitionByRange(parts, "key") if parts > 1 else entries.coalesce(1)
    dealt = dealt.sortWithinPartitions("key", "id")
    made = dealt.mapInArrow(run, "first bigint, name string, n bigint").collect()
    found = LookUp(folder, tuple(sorted((r["first"], r["name"], r["n"]) for r in made)))
    if not folder.startswith("file:/"):
        entries.sparkSession.sparkContext.addFile(folder, recursive=True)
    return found


def _bytes(table: DataFrame) -> int:
    size = F.coalesce(F.sum(F.octet_length("token") + 24), F.lit(0))
    return table.agg(size).first()[0]


def word_look_up(table: DataFrame) -> LookUp:
    """A look-up of a token, id table by word."""
    hasher = _hasher()

    def run(batches: Iterator) -> Iterator:
        hashes = hasher()
        for batch in batches:
            key = pa.array(hashes(batch.column("token")))
            yield pa.RecordBatch.from_arrays(
                [key, batch.column("id"), batch.column("token")], names=["key", "id", "token"]
            )

    spark = table.sparkSession
    rows = table.select(F.col("id").cast("bigint").alias("id"), "token")
    return _written(rows.mapInArrow(run, _ENTRY), _folder(spark, "words"), _bytes(table))


def id_look_up(table: DataFrame) -> LookUp:
    """A look-up of a token, id table by id."""
    number = F.col("id").cast("bigint")
    rows = table.select(number.alias("key"), number.alias("id"), "token")
    return _written(rows, _folder(table.sparkSession, "ids"), _bytes(table))


def _folder(spark: SparkSession, label: str) -> str:
    return qualified(spark, new_folder(spark, label))


def _reader(look_up: LookUp) -> Callable:
    """A function for tasks: mapped parts, and where the keys of an array may be."""
    local = look_up.folder.startswith("file:/")
    place = re.sub(r"^file:/+", "/", look_up.folder)
    files = look_up.parts

    def opened():
        at = place if local else SparkFiles.get(place.rstrip("/").rpartition("/")[2])
        firsts = np.array([first for first, _, _ in files], np.int64)
        parts, maps = [], []
        for _, name, n in files:
            data = np.memmap(f"{at}/{name}", np.uint8, "r")
            maps.append(data.base)
            keys, ids = data[: 8 * n].view(np.int64), data[8 * n : 16 * n].view(np.int64)
            edges, text = data[16 * n : 24 * n + 8], data[24 * n + 8 :]
            buffers = [None, pa.py_buffer(edges), pa.py_buffer(text) if len(text) else pa.py_buffer(b"")]
            parts.append((keys, ids, pa.Array.from_buffers(pa.large_string(), n, buffers)))

        def places(wanted: np.ndarray):
            """For each part: its entries, the wanted keys it may have, and the first place of each."""
            part = np.searchsorted(firsts, wanted, side="right") - 1
            for k, (keys, ids, text) in enumerate(parts):
                own = np.flatnonzero(part == k) if len(parts) > 1 else np.flatnonzero(part >= 0)
                if not len(own):
                    continue
                where = np.searchsorted(keys, wanted[own])
                yield keys, ids, text, own, where
                # the pages stay in the machine's cache, and are no longer this worker's
                maps[k].madvise(mmap.MADV_DONTNEED)

        return places

    return opened


def _lists() -> Callable:
    """A function for tasks: flat as lists of the lengths of another array of lists."""

    def like(batch, flat):
        sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        edges = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
        return pa.ListArray.from_arrays(edges, flat, mask=batch.is_null() if batch.null_count else None)

    return like


def ids_of(words: Column, look_up: LookUp, missing: int | None) -> Column:
    """Each word of an array column replaced by its id, whole arrays in place.

    Runs on Arrow batches; no row is exploded and nothing is shuffled.
    """
    reader, hasher, like = _reader(look_up), _hasher(), _lists()

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places, hashes = reader(), hasher()
        for batch in batches:
            flat = batch.flatten().cast(pa.large_string())
            found = np.full(len(flat), -1, np.int64)
            wanted = hashes(flat)
            for keys, ids, text, own, where in places(wanted):
                # entries that share a hash follow one another
                while len(own):
                    inside = where < len(keys)
                    inside[inside] = keys[where[inside]] == wanted[own[inside]]
                    own, where = own[inside], where[inside]
                    same = pc.equal(text.take(pa.array(where)), flat.take(pa.array(own)))
                    same = same.to_numpy(zero_copy_only=False)
                    found[own[same]] = ids[where[same]]
                    own, where = own[~same], where[~same] + 1
            none = found < 0
            if missing is not None:
                found[none] = missing
            out = pa.array(found.astype(np.int32), mask=none if missing is None else None)
            yield like(batch, out)

    return run(words)


def words_of(ids: Column, look_up: LookUp, left_out: list[int]) -> Column:
    """Each id of an array column replaced by its word; null for those left out or unknown."""
    reader, like = _reader(look_up), _lists()

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places = reader()
        for batch in batches:
            wanted = batch.flatten().cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            shown = ~np.isin(wanted, left_out)
            at, parts, base = np.full(len(wanted), -1, np.int64), [], 0
            for keys, _, text, own, where in places(wanted):
                inside = where < len(keys)
                inside[inside] = keys[where[inside]] == wanted[own[inside]]
                known = np.zeros(len(wanted), bool)
                known[own[inside]] = True
                known &= shown
                hit = where[inside][shown[own[inside]]]
                at[known] = base + np.arange(len(hit))
                parts.append(text.take(pa.array(hit)))
                base += len(hit)
            every = pa.concat_arrays([pa.array([], pa.large_string()), *parts])
            flat = every.take(pa.array(at, mask=at < 0)).cast(pa.string())
            yield like(batch, flat)

    return run(ids)

