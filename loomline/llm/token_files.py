"""Token ids in binary shard files, with a minimal perfect hash index.

A shard file is a header and raw little-endian ids, document after document in
ascending doc_id order. A document's key is found in the index in constant time:
its bucket is one row of the index table, which holds a minimal perfect hash of
the bucket's keys (levels of bit arrays, as many slots as keys) and for each
slot a fingerprint of its key, the shard, the place and the length of its ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import written
from loomline.llm.encoder import encoder
from loomline.llm.wordhash import U64, mix
from loomline.staging import new_folder

MAGIC = b"LLMTOK01"
HEADER = 16
#: Appended to each document.
END_ID = 2
#: Keys of one index bucket, about.
BUCKET_KEYS = 50_000
LEVELS = 64
#: Bytes of a shard that are read at once.
READ_BYTES = 4 << 20

ENTRY = "doc_id bigint, nth bigint, shard int, place bigint, n_tokens bigint"


def file_system(uri: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow.fs import FileSystem

    for spark_name, name in (("s3a://", "s3://"), ("s3n://", "s3://"), ("file:///", "/"), ("file:/", "/")):
        if uri.startswith(spark_name):
            uri = name + uri[len(spark_name) :]
            break
    return FileSystem.from_uri(uri)


@dataclass(frozen=True)
class TokenFiles:
    """A folder of shards; entries: ENTRY and the shard's file name; index: a row a bucket."""

    folder: str
    dtype: str
    shards: DataFrame
    entries: DataFrame
    index: DataFrame
    buckets: int


def _write_shard(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        # a repeated attempt has a file of its own; the rows that count name one
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.bin"
        code = encoder(tokenizer)
        end = np.array([end_id], code.dtype).tobytes()
        width = code.dtype.itemsize
        files, path = file_system(folder)
        files.create_dir(path, recursive=True)
        place = 0
        out = None
        try:
            for batch in batches:
                if out is None and batch.num_rows:
                    out = files.open_output_stream(f"{path}/{name}")
                    out.write(MAGIC + width.to_bytes(4, "little") + end_id.to_bytes(4, "little"))
                places, sizes = [], []
                for text in batch.column("text"):
                    ids = code.encode(text.as_py())
                    out.write(ids)
                    out.write(end)
                    places.append(place)
                    sizes.append(len(ids) // width + 1)
                    place += sizes[-1]
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([shard] * n, pa.int32()),
                        pa.array([name] * n, pa.string()),
                        pa.array(places, pa.int64()),
                        pa.array(sizes, pa.int64()),
                    ],
                    names=["doc_id", "shard", "file", "place", "n_tokens"],
                )
        finally:
            if out is not None:
                out.close()

    return run


def key_hash(doc_id: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """64 bits for each key; different for different ids of first occurrences."""
    first = mix(doc_id.astype(np.int64).view(U64))
    return first + (nth.astype(np.int64).view(U64) - U64(1)) * U64(0xD6E8FEB86659FD93)


def _level_slots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = U64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mix(hashes + seed) % U64(size)).astype(np.int64)


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ U64(0x5851F42D4C957F2D)) >> U64(32)).astype(np.uint32)


def build_hash(hashes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Bit arrays of the levels, and the slot of each hash, 0 to n - 1.

    On each level a key that is alone in its bit has found its place; the others
    go on to the next. Equal hashes never part: they have slot -1.
    """
    slots = np.full(len(hashes), -1, np.int64)
    levels: list[bytes] = []
    open_ = np.arange(len(hashes))
    before = 0
    while len(open_) and len(levels) < LEVELS:
        size = max(64, 2 * len(open_))
        at = _level_slots(hashes[open_], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        rank = np.cumsum(alone) - 1
        slots[open_[settled]] = before + rank[at[settled]]
        before += int(alone.sum())
        levels.append(size.to_bytes(8, "little") + np.packbits(alone, bitorder="little").tobytes())
        open_ = open_[~settled]
    return levels, slots


def find_slots(levels: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """The slot of each hash; some slot or -1 for a hash that was not built in."""
    slots = np.full(len(hashes), -1, np.int64)
    open_ = np.arange(len(hashes))
    before = 0
    for level, data in enumerate(levels):
        size = int.from_bytes(data[:8], "little")
        bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=8), bitorder="little")[:size]
        rank = np.cumsum(bits) - 1
        at = _level_slots(hashes[open_], level, size)
        hit = bits[at] == 1
        slots[open_[hit]] = before + rank[at[hit]]
        before += int(bits.sum())
        open_ = open_[~hit]
    return slots


_SLOT = np.dtype(
    [("mark", "<u4"), ("shard", "<u4"), ("place", "<u8"), ("size", "<u8"), ("base", "<u8")]
)


def _build_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    hashes = key_hash(rows["doc_key"].to_numpy(), rows["nth"].to_numpy())
    levels, slots = build_hash(hashes)
    table = np.zeros(int((slots >= 0).sum()), _SLOT)
    entry = np.zeros(len(rows), _SLOT)
    entry["mark"] = fingerprints(hashes)
    for name, column in (("shard", "shard"), ("place", "place"), ("size", "n_tokens"), ("base", "base")):
        entry[name] = rows[column].to_numpy()
    table[slots[slots >= 0]] = entry[slots >= 0]
    # keys of one hash, next to impossible, are listed in full
    rest = rows[slots < 0]
    listed = np.stack([rest["doc_key"].to_numpy(np.int64), rest["nth"].to_numpy(np.int64)], 1).tobytes()
    return pd.DataFrame(
        {
            "bucket": [rows["bucket"].iloc[0]],
            "levels": [levels],
            "slots": [table.tobytes()],
            "listed": [listed],
            "listed_slots": [entry[slots < 0].tobytes()],
        }
    )


INDEX = "bucket bigint, levels array<binary>, slots binary, listed binary, listed_slots binary"


def _keyed(df: DataFrame, buckets: int) -> DataFrame:
    """Adds doc_key, a number for null ids too, and the bucket."""
    # null ids have occurrences beyond those of any other id
    nth = F.when(F.col("doc_id").isNull(), F.col("nth") + (1 << 40)).otherwise(F.col("nth"))
    keyed = df.withColumn("nth", nth).withColumn("doc_key", F.coalesce("doc_id", F.lit(0)))
    return keyed.withColumn("bucket", F.pmod(F.xxhash64("doc_key", "nth"), F.lit(buckets)))


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID, folder: str | None = None) -> TokenFiles:
    """Encode every whole text of docs into shard files and index them.

    Rows are ordered by doc_id, nulls first, then by their text's hash; shards
    are ranges of that order. Null and empty texts have the end id only. Rows of
    one doc_id are told apart by their occurrence nth, from 1. An empty table
    gives no shard.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    entries = written(
        dealt.mapInArrow(
            _write_shard(folder, tokenizer, end_id),
            "doc_id bigint, shard int, file string, place bigint, n_tokens bigint",
        ),
        "token-entries",
    )
    totals = entries.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n_tokens"))
    # one row for each shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = written(
        totals.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-shards"
    )
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("shard", "place")).cast("bigint")
    entries = entries.drop("file").withColumn("nth", nth)
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))
    keyed = _keyed(entries.join(shards.select("shard", "base"), "shard"), buckets)
    index = written(keyed.groupBy("bucket").applyInPandas(_build_bucket, INDEX), "token-index")
    return TokenFiles(folder, encoder(tokenizer).dtype.str, shards, entries, index, buckets)


def _look_up(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    columns = ["doc_id", "nth", "shard", "place", "n_tokens", "start"]
    if not len(keys) or not len(index):
        return pd.DataFrame({c: pd.Series([], dtype="int64") for c in columns})
    row = index.iloc[0]
    hashes = key_hash(keys["doc_key"].to_numpy(), keys["nth"].to_numpy())
    table = np.frombuffer(row["slots"], _SLOT)
    slots = find_slots(list(row["levels"]), hashes)
    entry = table[np.maximum(slots, 0)] if len(table) else np.zeros(len(keys), _SLOT)
    found = (slots >= 0) & (entry["mark"] == fingerprints(hashes))
    listed = np.frombuffer(row["listed"], np.int64).reshape(-1, 2)
    if len(listed):
        entry = entry.copy()
        places = {tuple(k): e for k, e in zip(listed.tolist(), np.frombuffer(row["listed_slots"], _SLOT))}
        for k, key in enumerate(zip(keys["doc_key"].tolist(), keys["nth"].tolist())):
            if key in places:
                entry[k], found[k] = places[key], True
    keys, entry = keys[found], entry[found]
    return pd.DataFrame(
        {
            "doc_id": keys["doc_id"].to_numpy(),
            "nth": keys["nth"].to_numpy(),
            "shard": entry["shard"].astype("int32"),
            "place": entry["place"].astype("int64"),
            "n_tokens": entry["size"].astype("int64"),
            "start": (entry["base"] + entry["place"]).astype("int64"),
        }
    )


def look_up(files: TokenFiles, keys: DataFrame) -> DataFrame:
    """doc_id, nth, shard, place, n_tokens, start of the keys (doc_id, nth) that the index holds.

    A key that was never written is told by its fingerprint, but for one in 2**32.
    """
    keyed = _keyed(keys.select("doc_id", "nth"), files.buckets)
    plain = keyed.withColumn("is_null", F.col("doc_id").isNull())
    found = (
        plain.select("bucket", "doc_key", F.col("doc_key").alias("doc_id"), "nth")
        .groupBy("bucket")
        .cogroup(files.index.groupBy("bucket"))
        .applyInPandas(_look_up, "doc_id bigint, nth bigint, shard int, place bigint, n_tokens bigint, start bigint")
    )
    null = F.col("nth") > (1 << 40)
    return found.withColumn("doc_id", F.when(~null, F.col("doc_id"))).withColumn(
        "nth", F.when(null, F.col("nth") - (1 << 40)).otherwise(F.col("nth"))
    )


def _read_shard(folder: str, dtype: str):
    kind = np.dtype(dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(folder)
        name, source = None, None
        try:
            for batch in batches:
                sums = []
                for file, place, size in zip(
                    batch.column("file").to_pylist(),
                    batch.column("place").to_pylist(),
                    batch.column("n_tokens").to_pylist(),
                ):
                    if file != name:
                        if source is not None:
                            source.close()
                        name, source = file, files.open_input_file(f"{path}/{file}")
                        head = source.read_at(HEADER, 0)
                        if head[:8] != MAGIC or int.from_bytes(head[8:12], "little") != kind.itemsize:
                            raise ValueError(f"not a token file: {file}")
                    crc, at, end = 0, HEADER + place * kind.itemsize, HEADER + (place + size) * kind.itemsize
                    while at < end:
                        data = source.read_at(min(READ_BYTES, end - at), at)
                        if not data:
                            raise ValueError(f"token file ends early: {file}")
                        crc = zlib.crc32(np.frombuffer(data, kind).astype("<u4").tobytes(), crc)
                        at += len(data)
                    sums.append(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("start"),
                        batch.column("n_tokens"),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
        finally:
            if source is not None:
                source.close()

    return run


def read_back(files: TokenFiles, keys: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the keys, from the index and the files."""
    found = look_up(files, keys).join(files.shards.select("shard", "file"), "shard")
    # neighbours in a file are read by one task, in order
    dealt = found.repartition("shard", F.floor(F.col("place") / (READ_BYTES * 4)))
    dealt = dealt.sortWithinPartitions("shard", "place")
    return dealt.select("doc_id", "start", "n_tokens", "file", "place").mapInArrow(
        _read_shard(files.folder, files.dtype),
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    )


def token_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write, index and read back: a row for each row of docs, null and repeated ids too."""
    files = write_token_files(docs, tokenizer)
    return read_back(files, files.entries.select("doc_id", "nth"))
