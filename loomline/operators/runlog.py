"""Run-log tables: mean losses, best so far, schedule, summary."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loomline.functions.schedule import learning_rate
from loomline.functions.times import seconds_between

_INF = float("inf")
_ATTEMPT = "_attempt"


def eval_steps(df: DataFrame, eval_every: int = 200) -> DataFrame:
    return df.filter(F.col("step") % eval_every == 0)


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    """Equal keys, nulls too."""
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, pairs, F.lit(True))


def eval_means(losses: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean loss of each step's train and val batches; ts is the last batch's time.

    keys tell the runs of a table apart.
    """
    means = {
        f"{split}_loss": F.avg(F.when(F.col("split") == split, F.col("loss")))
        for split in ("train", "val")
    }
    extra = [F.max("ts").alias("ts")] if "ts" in losses.columns else []
    return losses.groupBy(*keys, "step").agg(*[c.alias(n) for n, c in means.items()], *extra)


def mark_best(
    log: DataFrame, steps_per_block: int = 1_000_000, keys: Sequence[str] = ()
) -> DataFrame:
    """Add best_val (lowest val_loss so far) and is_best (strictly below all earlier).

    NaN never wins. Steps are unique in a run, so a block of consecutive steps
    bounds every window; only one minimum per block of a run is compared at once.
    """
    usable = F.when(~F.isnan("val_loss"), F.col("val_loss"))
    blocked = log.withColumn("_block", F.expr(f"step div {steps_per_block}"))
    past = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(*keys, "_block")
        .agg(F.min(usable).alias("_low"))
        .select(*keys, "_block", F.min("_low").over(past).alias("_carried"))
    )
    inside = (
        Window.partitionBy(*keys, "_block").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.least(F.min(usable).over(inside), F.col("_carried"), F.lit(_INF))
    return (
        blocked.alias("l")
        .join(carried.alias("c"), _same([*keys, "_block"], "l", "c"))
        .select("l.*", "c._carried")
        .withColumn("_before", before)
        .withColumn("is_best", F.coalesce(usable < F.col("_before"), F.lit(False)))
        .withColumn("best_val", F.least(usable, F.col("_before")))
        .drop("_block", "_carried", "_before")
    )


def eval_log(
    losses: DataFrame, eval_every: int = 200, keys: Sequence[str] = (), **schedule
) -> DataFrame:
    """keys, step, train_loss, val_loss, lr, elapsed_s, best_val, is_best of each run.

    Elapsed time counts from a run's own first batch.
    """
    starts = losses.groupBy(*keys).agg(F.min("ts").alias("_started"))
    marked = mark_best(eval_means(eval_steps(losses, eval_every), keys), keys=keys)
    timed = marked.alias("l").join(starts.alias("s"), _same(keys, "l", "s"))
    started = F.col("_started")
    return timed.select("l.*", "_started").select(
        *keys,
        "step",
        "train_loss",
        "val_loss",
        learning_rate(F.col("step"), **schedule).alias("lr"),
        seconds_between(F.col("ts"), started).alias("elapsed_s"),
        "best_val",
        "is_best",
    )


def append_log(log: DataFrame, path: str, batch: str) -> None:
    """Append a log's rows under a batch name, such as a run and its part, once only.

    Rows are written first, with a mark of this attempt; then the manifest gets one row
    that names the attempt. Rows without a manifest row are never read, so an append that
    died may be repeated, and a batch that is in the manifest is not written again.
    """
    spark = log.sparkSession
    if not _committed(spark, path).filter(F.col("batch") == batch).isEmpty():
        return
    attempt = uuid.uuid4().hex
    _write_rows(log, path, attempt)
    _commit(spark, path, batch, attempt)


def _write_rows(log: DataFrame, path: str, attempt: str) -> None:
    log.withColumn(_ATTEMPT, F.lit(attempt)).write.mode("append").parquet(f"{path}/rows")


def _commit(spark: SparkSession, path: str, batch: str, attempt: str) -> None:
    entry = spark.createDataFrame([(batch, attempt)], "batch string, attempt string")
    entry = entry.withColumn("at", F.current_timestamp())
    entry.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _committed(spark: SparkSession, path: str) -> DataFrame:
    """batch, attempt of each batch in the manifest: its first attempt, should two
    writers have appended it at the same time."""
    schema = "batch string, attempt string, at timestamp"
    if not _exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], schema).drop("at")
    entries = spark.read.schema(schema).parquet(f"{path}/manifest")
    first = F.min(F.struct("at", "attempt")).alias("first")
    return entries.groupBy("batch").agg(first).select("batch", "first.attempt")


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of every batch in the manifest of a log that append_log has written."""
    if not _exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], schema)
    wide = StructType([*schema.fields, StructField(_ATTEMPT, StringType())])
    rows = spark.read.schema(wide).parquet(f"{path}/rows")
    known = _committed(spark, path).select(F.col("attempt").alias(_ATTEMPT))
    return rows.join(known, _ATTEMPT, "left_semi").select(*schema.names)


def run_summary(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return log.groupBy(*keys).agg(
        F.max("elapsed_s").alias("total_s"),
        F.min(F.when(~F.isnan("val_loss"), F.col("val_loss"))).alias("best_val"),
    )
