"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import os
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.staging import new_folder

# Fixed value: blanks between words are the space and U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: read many times, computed once."""
    spark, path, schema = df.sparkSession, new_folder(df.sparkSession, label), df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a written table, or all that a table is selected from, that no later step reads."""
    context = df.sparkSession.sparkContext
    paths = [context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(x)) for x in df.inputFiles()]
    for place in {x.getParent().toString(): x.getParent() for x in paths}.values():
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that wrote them has ended, not when the driver next
    collects garbage: for operators whose steps are all written tables."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Texts go to Python in batches of at most so many rows: a batch of 10,000 is held several
    times over, by the JVM and by a worker. For operators whose steps are all written tables."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(min(before, rows) if before > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_list(text: Column) -> Column:
    """The words of a text in order."""
    return F.filter(F.split(text, BLANK_RUN, -1), lambda w: w != "")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once."""
    context = spark.sparkContext
    if any(name.endswith("/loomline-tasks.zip") for name in context.listFiles):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="loomline-"), "loomline-tasks.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(top, "loomline")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, top))
    context.addPyFile(path)
