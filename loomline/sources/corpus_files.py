"""Corpus folders: text files with one document per line.

The index of a folder is one row per byte range, not one row per document, written
once and read in tasks only: neither the files nor the ranges are listed on the
driver. It holds how many documents begin in each range and the ordinal of the first,
so a later pass gives each document its dense ordinal and its byte offset as it reads,
without a join or a shuffle of text, and a few wanted documents are read from their
ranges alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.text import lossy_utf8, strip_space
from loomline.operators.guards import require_files
from loomline.operators.ordering import exclusive_prefix
from loomline.sources import byte_ranges
from loomline.staging import staged

# Documents in one block of the join of wanted ordinals with ranges.
ORD_BLOCK = 10_000


def list_corpus(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """file_idx, name, size of the folder's own files that match, in name order.

    Empty files and names that begin with `_` or `.` are files like all others.
    """
    return byte_ranges.file_table(spark, folder, pattern)


@dataclass(frozen=True)
class CorpusIndex:
    """What one pass over a corpus folder found out."""

    spark: SparkSession
    folder: str
    ranges: DataFrame  # range_no, file_idx, name, size, start, length, cost, n_docs, ord_base
    n_files: int
    n_docs: int

    def summary(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(self.n_files, self.n_docs)], "files bigint, documents bigint"
        )

    def _read(self, ranges: DataFrame, with_text: bool) -> DataFrame:
        return byte_ranges.documents_of(byte_ranges.dealt(ranges), self.folder, with_text)

    def _every(self) -> DataFrame:
        return self.ranges.filter("n_docs > 0").withColumn("picked", F.lit(None).cast("array<bigint>"))

    def documents(self) -> DataFrame:
        """ord, file_idx, text of every document. One pass, no shuffle of text."""
        return _texts(self._read(self._every(), True))

    def positions(self) -> DataFrame:
        """ord, file_idx, byte_offset of every document; no text leaves the tasks."""
        return self._read(self._every(), False).select("ord", "file_idx", "byte_offset")

    def fetch(self, wanted: DataFrame) -> DataFrame:
        """ord, file_idx, text of the documents whose ord is in wanted, each once.

        Only the ranges that hold one are opened, and only the wanted texts leave
        the tasks. An ordinal without a document is left out.
        """
        block = F.expr(f"ord_base div {ORD_BLOCK}"), F.expr(f"(ord_base + n_docs - 1) div {ORD_BLOCK}")
        held = self.ranges.filter("n_docs > 0").withColumn("block", F.explode(F.sequence(*block)))
        asked = wanted.select("ord").distinct().withColumn("block", F.expr(f"ord div {ORD_BLOCK}"))
        inside = (F.col("ord") >= F.col("ord_base")) & (F.col("ord") < F.col("ord_base") + F.col("n_docs"))
        found = held.join(asked, "block").filter(inside)
        picked = found.groupBy("range_no").agg(
            F.collect_list(F.col("ord") - F.col("ord_base")).alias("picked")
        )
        # a row for each range that is read, with at most its own documents' places
        ranges = staged(self.ranges.join(picked, "range_no"), "wanted-ranges")
        return _texts(self._read(ranges, True))


def _texts(read: DataFrame) -> DataFrame:
    text = strip_space(lossy_utf8(F.col("line")))
    return read.select("ord", F.col("file_idx").cast("int").alias("file_idx"), text.alias("text"))


def index_corpus(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.json",
    range_bytes: int = byte_ranges.RANGE_BYTES,
) -> CorpusIndex:
    """Read a corpus folder once and return its index.

    A line is a document when something is left of it after a Unicode strip. A byte
    order mark is text, so a line with nothing else on it is a document too.
    """
    place = byte_ranges.qualified(spark, folder)
    files = list_corpus(spark, folder, pattern)
    n_files = files.count()
    require_files(n_files, folder)
    ranges = staged(byte_ranges.ranges_of(files, range_bytes), "corpus-ranges")
    counts = byte_ranges.counted(byte_ranges.dealt(ranges), place)
    known = exclusive_prefix(ranges.join(counts, "range_no"), "range_no", "n_docs", "ord_base")
    known = staged(known, "corpus-index")
    n_docs = known.agg(F.sum("n_docs")).first()[0] or 0
    return CorpusIndex(spark, place, known, n_files, n_docs)
