"""Document tables: one row holds one file's text, lines are documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.arrays import running_starts
from loomline.functions.text import has_ink, strip_space
from loomline.operators.ordering import exclusive_prefix, prefix_levels
from loomline.staging import staged


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table, read in the same way at every size."""
    return spark.read.parquet(path)


def lines_from_table(
    docs: DataFrame, key: str = "doc_id", text: str = "text", with_offsets: bool = False
) -> DataFrame:
    """Non-blank lines with their line number, stripped; offsets on request.

    Offsets count bytes from the start of the row's text. No shuffle: each row
    holds all its lines.
    """
    raw = docs.select(key, F.split(text, "\n").alias("_raw"))
    if with_offsets:
        sizes = F.transform("_raw", lambda line: (F.octet_length(line) + 1).cast("bigint"))
        raw = raw.withColumn("_starts", running_starts(sizes))
        raw = raw.select(key, F.posexplode(F.arrays_zip("_raw", "_starts")).alias("line_no", "_l"))
        raw = raw.select(
            key,
            "line_no",
            F.col("_l._starts").alias("byte_offset"),
            F.col("_l._raw").alias("_line"),
        )
    else:
        raw = raw.select(key, F.posexplode("_raw").alias("line_no", "_line"))
    return (
        raw.filter(has_ink(F.col("_line")))
        .withColumn("text", strip_space(F.col("_line")))
        .drop("_line")
    )


def line_slots(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row, the numbers of its non-blank lines. Narrow: the text stays behind."""
    numbered = F.transform(
        F.split(text, "\n"), lambda line, i: F.when(has_ink(line), i)
    )
    slots = F.coalesce(F.array_compact(numbered), F.array().cast("array<int>"))
    return docs.select(key, slots.alias("slots")).withColumn("n_lines", F.size("slots"))


def written_slots(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """line_slots, written once, so that the texts are read once for the count and the
    order of their lines. Rebalanced, as each task of the scan writes very little."""
    return staged(line_slots(docs, key, text).hint("rebalance"), "line-slots")


def pick_lines(
    docs: DataFrame, places: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Lines by position, stripped: split, split_ord, text.

    places has one row per wanted key, an array of (split, split_ord, line_no). Rows
    without a wanted line are dropped before their text is cut into lines.
    """
    found = docs.join(places, key).select("places", F.split(text, "\n").alias("_raw"))
    picked = F.transform(
        "places",
        lambda p: F.struct(
            p["split"].alias("split"),
            p["split_ord"].alias("split_ord"),
            strip_space(F.get("_raw", p["line_no"])).alias("text"),
        ),
    )
    return found.select(F.explode(picked).alias("_p")).select("_p.*")


def table_positions(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 10_000
) -> DataFrame:
    """Dense order of all lines by (key, line number): key, line_no, ord."""
    return slot_positions(line_slots(docs, key, text), key, width)


def slot_firsts(slots: DataFrame, key: str = "doc_id", width: int = 10_000) -> DataFrame:
    """Slots with _first, the ordinal of a row's first line, in the order of key."""
    return exclusive_prefix(slots, key, "n_lines", "_first", width, prefix_levels(slots, key, width))


def slot_positions(slots: DataFrame, key: str = "doc_id", width: int = 10_000) -> DataFrame:
    based = slot_firsts(slots, key, width)
    return based.select(key, "_first", F.posexplode("slots").alias("_i", "line_no")).select(
        key, "line_no", (F.col("_first") + F.col("_i")).alias("ord")
    )


def all_lines(docs: DataFrame, firsts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All lines in slots, stripped: ord, text. firsts has a row for each row, not for each
    line, so it can be broadcast where the positions of lines are too many."""
    found = docs.join(firsts, key).select("_first", "slots", F.split(text, "\n").alias("_raw"))
    lines = F.transform(
        "slots",
        lambda line_no, i: F.struct(
            (F.col("_first") + i).alias("ord"), strip_space(F.get("_raw", line_no)).alias("text")
        ),
    )
    return found.select(F.explode(lines).alias("_l")).select("_l.*")
