"""Text files read by byte ranges, in tasks.

A folder is listed in a task, not on the driver, and files are named one by one, so
names that Spark's own file scans skip are read like all others. A line belongs to
the range it begins in; whoever reads that range reads the line to its end. Offsets
are places in the file itself, byte order marks included.

What a task runs is local to the functions here, so executors need PyArrow and NumPy
but not this package. Folders may be in any store PyArrow opens: local or mounted
disks, S3, GCS, HDFS, ABFS.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.ordering import exclusive_prefix, rank_rows
from loomline.staging import staged

#: Bytes of a range, the least that is read for a document; bytes of the ranges of one
#: task, and bytes a range costs besides its own for being opened.
RANGE_BYTES = 4 << 20
TASK_BYTES = 128 << 20
OPEN_BYTES = 1 << 18

LISTING = "name string, size bigint"
COUNTS = "range_no bigint, n_docs bigint"
DOCUMENTS = "ord bigint, file_idx bigint, byte_offset bigint, line binary"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as the session's file systems see it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString()


def _store(folder: str) -> Callable:
    """A function for tasks: the file system of a folder and the folder's place in it."""
    local = folder.startswith("file:/")
    place = re.sub(r"^file:/+", "/", folder)

    def opened():
        from pyarrow import fs

        return (fs.LocalFileSystem(), place) if local else fs.FileSystem.from_uri(place)

    return opened


def listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """name, size of the files of a folder that match a pattern, empty ones too.

    Folders are not gone into. A missing folder has no files.
    """
    store = _store(qualified(spark, folder))

    def run(batches: Iterator) -> Iterator:
        import fnmatch

        from pyarrow import fs

        for batch in batches:
            if not batch.num_rows:
                continue
            system, place = store()
            found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
            for at in range(0, len(found), 10_000):
                files = [
                    (x.base_name, x.size)
                    for x in found[at : at + 10_000]
                    if x.type == fs.FileType.File and fnmatch.fnmatchcase(x.base_name, pattern)
                ]
                names, sizes = [n for n, _ in files], [s for _, s in files]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["name", "size"]
                )

    return spark.range(0, 1, 1, 1).mapInArrow(run, LISTING)


def file_table(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """file_idx, name, size: the listing numbered by name, in code point order."""
    ranked = rank_rows(listed(spark, folder, pattern), [F.col("name")], "file_idx")
    return staged(ranked.select("file_idx", "name", "size"), "corpus-listing")


def ranges_of(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row for each range: range_no in file order, file_idx, name, size, start,
    length, cost (a running sum that deals ranges out to tasks).

    Empty files have no range.
    """
    counted = files.withColumn("n_ranges", F.expr(f"(size + {range_bytes - 1}) div {range_bytes}"))
    counted = exclusive_prefix(counted, "file_idx", "n_ranges", "first")
    counted = exclusive_prefix(counted, "file_idx", "size", "before")
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_ranges") - 1)).alias("i")
    cut = counted.filter("n_ranges > 0").select("*", part).withColumn("start", F.col("i") * range_bytes)
    range_no = F.col("first") + F.col("i")
    return cut.select(
        range_no.alias("range_no"),
        "file_idx",
        "name",
        "size",
        "start",
        F.least(F.lit(range_bytes), F.col("size") - F.col("start")).alias("length"),
        (F.col("before") + F.col("start") + range_no * OPEN_BYTES).alias("cost"),
    )


def dealt(ranges: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Ranges with those that follow one another in one task, up to about task_bytes."""
    top = ranges.agg(F.max("cost")).first()[0]
    tasks = (top or 0) // task_bytes + 1
    return ranges.repartitionById(tasks, F.expr(f"cost div {task_bytes}").cast("int"))


def _reader(folder: str) -> Callable:
    """A function for tasks: the lines that begin in a range, in order.

    It gives the bytes, each line's place in them, in the file, and whether it is a
    document: something is left of its text after a strip.
    """
    store = _store(folder)

    def reader() -> Callable:
        system, place = store()
        chunk = 1 << 20

        def lines(name: str, size: int, start: int, length: int):
            with system.open_input_file(f"{place}/{name}") as file:
                if file.size() != size:
                    raise RuntimeError(f"{name} changed after indexing")
                lead = 1 if start else 0
                file.seek(start - lead)
                data = file.read(length + lead)
                if len(data) != length + lead:
                    raise RuntimeError(f"{name} changed after indexing")
                cuts = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A) + 1
                # the line after the last byte begins in the next range
                begins = cuts[cuts < len(data)]
                if not lead:
                    begins = np.append(0, begins)
                if not len(begins):
                    return data, begins, begins, begins, np.zeros(0, bool)
                if data[-1:] != b"\n":
                    rest = []
                    while more := file.read(chunk):
                        end = more.find(b"\n")
                        rest.append(more if end < 0 else more[: end + 1])
                        if end >= 0:
                            break
                    data = b"".join([data, *rest])
            seen = np.frombuffer(data, np.uint8)
            ends = np.append(begins[1:], len(data))
            # a byte from ! to ~ is ink; other lines are decoded and stripped
            inked = np.add.reduceat((seen > 0x20) & (seen < 0x7F), begins, dtype=np.int64) > 0
            for k in np.flatnonzero(~inked).tolist():
                inked[k] = bool(data[begins[k] : ends[k]].decode("utf-8", "replace").strip())
            return data, begins, ends, begins + (start - lead), inked

        return lines

    return reader


def counted(ranges: DataFrame, folder: str) -> DataFrame:
    """range_no, n_docs of each range. No text leaves the tasks."""
    reader = _reader(folder)

    def run(batches: Iterator) -> Iterator:
        lines = reader()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("name", "size", "start", "length")))
            found = [int(lines(*row)[4].sum()) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("range_no"), pa.array(found, pa.int64())], names=["range_no", "n_docs"]
            )

    columns = ranges.select("range_no", "name", "size", "start", "length")
    return columns.mapInArrow(run, COUNTS)


def documents_of(ranges: DataFrame, folder: str, with_text: bool = True) -> DataFrame:
    """ord, file_idx, byte_offset, line of the documents of ranges; line is null
    without text.

    ranges have ord_base and n_docs, and picked, the wanted places in the range, or null
    for all. A range whose file is no longer what was counted fails the job.
    """
    reader = _reader(folder)

    def run(batches: Iterator) -> Iterator:
        lines = reader()
        names = ("name", "size", "start", "length", "file_idx", "ord_base", "n_docs", "picked")
        for batch in batches:
            for *where, file_idx, base, n_docs, picked in zip(*(batch.column(c).to_pylist() for c in names)):
                data, begins, ends, offsets, inked = lines(*where)
                chosen = np.flatnonzero(inked)
                if len(chosen) != n_docs:
                    raise RuntimeError(f"{where[0]} changed after indexing")
                places = np.arange(n_docs)
                if picked is not None:
                    places = np.unique(np.array(picked, np.int64))
                    chosen = chosen[places]
                if not with_text:
                    text = pa.nulls(len(chosen), pa.large_binary())
                elif picked is None and len(begins):
                    edges = np.append(begins, ends[-1]).astype(np.int64)
                    buffers = [None, pa.py_buffer(edges), pa.py_buffer(data)]
                    every = pa.Array.from_buffers(pa.large_binary(), len(begins), buffers)
                    text = every.filter(pa.array(inked))
                else:
                    text = pa.array([data[begins[k] : ends[k]] for k in chosen.tolist()], pa.large_binary())
                # parts of bounded size: Spark's own arrays of bytes end at 2 GB
                for at in range(0, len(chosen), 50_000):
                    part = slice(at, at + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(base + places[part]),
                            pa.array(np.full(len(places[part]), file_idx)),
                            pa.array(offsets[chosen[part]]),
                            text.slice(at, 50_000).cast(pa.binary()),
                        ],
                        names=["ord", "file_idx", "byte_offset", "line"],
                    )

    columns = ranges.select(
        "name", "size", "start", "length", "file_idx", "ord_base", "n_docs", "picked"
    )
    return columns.mapInArrow(run, DOCUMENTS)
