"""From documents to token files: language, near copies, benchmark, mix, ids.

Each stage takes (spark, docs, sf_dir) and returns a table; run() writes what a
stage returns in the shared folder and hands the written table to the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.common import ship_package, table, written
from loomline.llm.decontaminate import overlaps
from loomline.llm.langid import UNKNOWN, train, with_language
from loomline.llm.mixing import mix
from loomline.llm.near_dedup import near_duplicates
from loomline.llm.queries import tokenizer_path
from loomline.llm.token_files import token_digest

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language: no letter, no language, no stay.

    Which it is does not matter, and the column lang stays as it was. The least
    probability is calibrated on held-back rows (langid._least).
    """
    ship_package(spark)
    docs = docs.select(*COLUMNS)
    found = with_language(docs, train(docs), COLUMNS)
    return found.filter((F.col("lang_pred") != UNKNOWN) & F.col("lang_sure")).select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """COLUMNS and row_key, a hash of them: rows with one key agree in every column."""
    # a null leaves a hash as it is, so where the nulls are is hashed too
    nulls = [F.col(c).isNull() for c in COLUMNS]
    return docs.select(*COLUMNS, F.xxhash64(*COLUMNS, *nulls).alias("row_key"))


def _as_documents(keyed: DataFrame) -> DataFrame:
    """The keyed rows as documents of their own: doc_id is the row's key."""
    return keyed.select(F.col("row_key").alias("doc_id"), "text", "source")


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one of least doc_id, and once.

    Rows are compared whatever their doc_id: those with a null one come last in
    their group, and rows with one doc_id and different texts are no copies. Rows
    without a word are linked with nothing; of equal ones with a doc_id one stays.
    """
    ship_package(spark)
    keyed = _keyed(docs)
    found = near_duplicates(_as_documents(keyed)).select(F.col("doc_id").alias("row_key"), "component_id", "n_shingles")
    found = written(found.distinct(), "pipeline-copies").join(keyed.select("row_key", "doc_id").distinct(), "row_key")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "n_shingles")
    least = found.groupBy("component_id").agg(F.min(rank).alias("least")).select("least.row_key", "least.n_shingles")
    kept = keyed.join(least, "row_key")
    wordless = (F.col("n_shingles") == 0) & F.col("doc_id").isNull()
    once = kept.filter(~wordless).dropDuplicates(["row_key"])
    return once.select(*COLUMNS).unionByName(kept.filter(wordless).select(*COLUMNS))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of the benchmark, each judged by its own text."""
    ship_package(spark)
    keyed = _keyed(docs)
    held = overlaps(_as_documents(keyed), table(spark, sf_dir, "benchmark"))
    held = held.select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(held, "row_key", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix takes it; not at all if it takes none.

    Rows that agree in every column share their copies. Documents without a word
    are not taken.
    """
    ship_package(spark)
    keyed = _keyed(docs)
    taken = (
        mix(_as_documents(keyed))
        .filter("copies > 0")
        .groupBy(F.col("doc_id").alias("row_key"))
        .agg(F.sum("copies").cast("int").alias("copies"))
    )
    rows = keyed.dropDuplicates(["row_key"]).join(taken, "row_key")
    return rows.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, from the files written.

    A document that was taken several times is written as often.
    """
    ship_package(spark)
    return token_digest(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_copies", remove_near_copies),
    ("benchmark", remove_benchmark),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: Learned models and sampling are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
