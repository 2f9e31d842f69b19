"""Written intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes a table may have and still be broadcast.
BROADCAST_BYTES = 64 << 20

# Folders this process has written and tables it has named, by application.
_written: dict[str, list[str]] = {}
_named: dict[str, list[str]] = {}


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only a local session may do without the setting; it then gets its own
    temporary folder. A cluster session without one is refused, because a
    machine-local folder would not outlive a lost executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="loomline-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{work_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder once and return the written table.

    Used where a result feeds several later steps: the work is not repeated,
    later scans read only the columns they need, and a lost executor costs a
    re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def bucketed(
    df: DataFrame, keys: Sequence[str], n_buckets: int, label: str, compression: str = "snappy"
) -> DataFrame:
    """Write df to the shared folder once, dealt out by keys, and return the table.

    Later joins and groupings on the keys read it in place: only their other side
    is shuffled. n_buckets is raised to the session's shuffle partitions, as the
    planner shuffles a side of fewer again.
    """
    spark = df.sparkSession
    n_buckets = max(n_buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = new_folder(spark, label)
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    _named.setdefault(spark.sparkContext.applicationId, []).append(name)
    dealt = df.repartition(n_buckets, *keys).write.bucketBy(n_buckets, *keys)
    dealt.option("path", path).option("compression", compression).format("parquet").saveAsTable(name)
    return spark.table(name)


def broadcast_if_within(
    df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Hint a broadcast when the counted rows of known width are within the limit."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def remove_staged(spark: SparkSession) -> int:
    """Delete what this process has staged for the session's application, when a job
    has written its results. Returns the number of folders; tables over them are gone."""
    context = spark.sparkContext
    for name in _named.pop(context.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    folders = _written.pop(context.applicationId, [])
    for folder in folders:
        place = context._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return len(folders)
